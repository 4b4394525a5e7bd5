"""Area totals split to parcels by a cascade of eligible building area."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.operators.joins import add_by_key, difference, numeric_columns, update
from arealens.operators.model import COMMUTE_MODES, GROUPS, HISPANIC, SECTORS
from arealens.predicates import DEVELOPED_CODES, NON_RESIDENTIAL_CODES, RESIDENT_LAND_USES, SECTOR_LAND_USES
from arealens.skew import JoinAdvice, advise, spread_join


def allocate_to_parcels(parcels: DataFrame, areas: DataFrame, area: str, parcel: str, land_use: str, living: str,
                        land: str, sectors: Sequence[str] = SECTORS, groups: Sequence[str] = (*HISPANIC, *GROUPS),
                        totals: Sequence[str] = HISPANIC, modes: Sequence[str] = COMMUTE_MODES,
                        where: Column | None = None, advice: JoinAdvice | None = None) -> DataFrame:
    """Parcel values `{variable}_PAR` whose sums give the area values back.

    Jobs of a sector go to building area of the sector's land uses; where an area has
    none, to non-residential, then developed, then any building area, then to land area.
    Residents skip the non-residential step. Commutes follow residents. All level sums of
    all sectors come from one aggregation over the parcels.
    """
    lu = F.when(F.col(land_use) != -1, F.col(land_use))
    source = parcels if where is None else parcels.where(where)
    rows = source.select(
        parcel, area, lu.alias(land_use),
        F.greatest(F.coalesce(F.col(living).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(living),
        F.greatest(F.coalesce(F.col(land).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("__land"),
    )
    code = F.col(land_use)

    def met(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    masks = {s: met(SECTOR_LAND_USES[s].on(code)) for s in sectors}
    masks["Population"] = met(RESIDENT_LAND_USES.on(code))
    non_res = met(code.isin(list(NON_RESIDENTIAL_CODES)))
    developed = met(code.isin(list(DEVELOPED_CODES)))

    def area_of(mask: Column | None, column: str = living) -> Column:
        return F.sum(F.col(column) if mask is None else F.when(mask, F.col(column)).otherwise(F.lit(0.0)))

    sums = rows.groupBy(area).agg(
        *[area_of(m).alias(f"__s_{v}") for v, m in masks.items()],
        area_of(non_res).alias("__non_res"), area_of(developed).alias("__dev"),
        area_of(None).alias("__living"), area_of(None, "__land").alias("__all_land"),
    )
    values = areas.select(area, *[
        F.greatest(F.coalesce(F.col(v).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(v)
        for v in (*sectors, *groups, *modes)])
    # The level sums have no more rows than the area table, so its size decides.
    advice = advise(source, areas, area) if advice is None else advice
    joined = spread_join(rows, sums.join(values, area), area, "inner", advice)

    def share(variable: str) -> Column:
        own, mine = F.col(f"__s_{variable}"), masks[variable]
        size, none = F.col(living), F.lit(0.0)

        def part(total: Column, eligible: Column | None, amount: Column = size) -> Column:
            ratio = F.try_divide(amount, total)
            return ratio if eligible is None else F.when(eligible, ratio).otherwise(none)

        steps = F.when(own > 0, part(own, mine))
        if variable != "Population":
            steps = steps.when(F.col("__non_res") > 0, part(F.col("__non_res"), non_res))
        steps = steps.when(F.col("__dev") > 0, part(F.col("__dev"), developed))
        steps = steps.when(F.col("__living") > 0, part(F.col("__living"), None))
        return F.coalesce(steps.otherwise(part(F.col("__all_land"), None, F.col("__land"))), none)

    # Shares of residents add up to 1 in an area, so the share of its allocated residents is the same share.
    shared = joined.withColumns({f"__p_{v}": share(v) for v in masks})
    jobs = {f"{s}_PAR": F.col(f"__p_{s}") * F.col(s) for s in sectors}
    people = {f"{g}_PAR": F.col("__p_Population") * F.col(g) for g in groups}
    commutes = {f"{m}_PAR": F.col("__p_Population") * F.col(m) for m in modes}

    def add(columns: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a + b, columns) if columns else F.lit(0.0)

    return shared.select(
        parcel, living, land_use, area,
        add(list(jobs.values())).alias("Total_Employment"), *[c.alias(n) for n, c in jobs.items()],
        add([people[f"{t}_PAR"] for t in totals]).alias("Total_Population"), *[c.alias(n) for n, c in people.items()],
        add(list(commutes.values())).alias("Total_Commutes"), *[c.alias(n) for n, c in commutes.items()],
    )


def near_term_allocation(base_parcels: DataFrame, base_areas: DataFrame, future_areas: DataFrame, future_parcels: DataFrame,
                         area: str, parcel: str, land_use: str, living: str, land: str, permit: str = "PERMIT",
                         near_term_year: int = 9998, **categories) -> DataFrame:
    """Change of area totals allocated to permit parcels and added to the base parcel values; others are carried over."""
    change = difference(future_areas, base_areas, area)
    added = allocate_to_parcels(future_parcels, change, area, parcel, land_use, living, land,
                                where=F.col(permit) == 1, **categories)
    carried = base_parcels.withColumn("Year", F.lit(near_term_year))
    numeric = numeric_columns(added, [parcel])
    touched = carried.join(added.select(parcel), parcel, "left_semi").select(
        parcel, *numeric_columns(carried, [parcel]))
    summed = add_by_key(touched, added.select(parcel, *[c for c in numeric if c != parcel]), parcel)
    return update(carried, summed, parcel)

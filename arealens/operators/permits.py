"""Building permits: cleaning, unit conversion and the short-term parcel update."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.functions.scalar import code_text, drop_suffix_if, field_arithmetic, flag_contains, money, zero_pad
from arealens.operators.joins import update
from arealens.session import cut
from arealens.skew import exact_median, first_per_key, null_safe_join, spread_join

# Permit codes and the parcel field each permit unit corresponds to.
PEDESTRIAN = "PD"
SAMPLE_MARKS = ("SMPL", "SAMPLE")
STATUS_TEXT = {"C": "Collected", "A": "Assessed", "L": "Letter of Credit submitted", "B": "Bond submitted"}
AREA_UNIT = "sq. ft."
UNIT_FIELDS = {"bed": "NO_RES_UNTS", "room": "NO_RES_UNTS", "unit": "NO_RES_UNTS", "acre": "LND_SQFOOT / 43560"}
UNIT_COUNTS = {"NO_RES_UNTS": ("bed", "room", "unit")}


def clean_permits(permits: DataFrame, categories: DataFrame, land_uses: DataFrame, points: DataFrame | None = None,
                  key: str = "FOLIO", width: int = 13) -> DataFrame:
    """Permits with padded key, cost, pedestrian flag, status text, land use and, with `points`, the parcel's place.

    `categories` is CAT_CODE to LANDUSE, UNITS, DOR_UC; `land_uses` is keyed by DOR_UC;
    `points` holds X and Y per key. Sample entries are dropped.
    """
    rows = permits.withColumns({
        key: zero_pad(F.col(key), width),
        "COST": money(F.col("CONST_COST")) + money(F.col("ADMIN_COST")),
        "PED_ORIENTED": flag_contains(F.col("CAT_CODE"), PEDESTRIAN),
        "STATUS": code_text(F.col("STATUS"), STATUS_TEXT),
    })
    for mark in SAMPLE_MARKS:
        for column in ("PROC_NUM", "ADDRESS"):
            rows = rows.where(~F.col(column).contains(mark))
    rows = rows.withColumn("CAT_CODE", drop_suffix_if(F.col("CAT_CODE"), PEDESTRIAN, len(PEDESTRIAN)))
    lookup = categories.join(land_uses, "DOR_UC")
    coded = spread_join(rows, lookup, "CAT_CODE").drop("CONST_COST", "ADMIN_COST", "CAT_CODE")
    return coded if points is None else coded.join(points.select(key, "X", "Y"), key)


def unit_reference(parcels: DataFrame, permits: DataFrame, land_use: str, living: str, unit: str,
                   unit_fields: Mapping[str, str] = UNIT_FIELDS, area_unit: str = AREA_UNIT) -> DataFrame:
    """Per land use and unit of the permits, the factor to building area or the area to use instead.

    The base unit has factor 1. A unit with a parcel field has the median of area per
    unit. Any other unit has no factor but the median area, -1 without parcels.
    """
    pairs = permits.select(
        F.coalesce(F.col(land_use), F.lit(0).cast(dict(permits.dtypes)[land_use])).alias(land_use), unit).distinct()
    area = F.coalesce(F.col(living).cast("double"), F.lit(0.0))
    fields = sorted(set(unit_fields.values()))
    column_of = {f: f"__r{i}" for i, f in enumerate(fields)}
    used = parcels.select(
        land_use, area.alias("__area"),
        *[F.try_divide(area, F.coalesce(field_arithmetic(f), F.lit(0.0))).alias(column_of[f]) for f in fields])
    used = spread_join(used, pairs.select(land_use).distinct(), land_use, "left_semi")
    medians = exact_median(used, [land_use], {"__area_med": "__area", **{f"{c}_med": c for c in column_of.values()}})
    joined = null_safe_join(pairs, medians, [land_use])
    factor = F.when(F.col(unit) == area_unit, F.lit(1.0))
    for u, f in unit_fields.items():
        factor = factor.when(F.col(unit) == u, F.col(f"{column_of[f]}_med"))
    by_field = F.col(unit).isin(area_unit, *unit_fields)
    known = F.coalesce(by_field, F.lit(False))
    return joined.select(
        land_use, unit,
        F.when(known, factor).otherwise(F.lit(-1.0)).alias("Multiplier"),
        F.when(known, F.lit(-1.0)).otherwise(F.coalesce("__area_med", F.lit(-1.0))).alias("Overwrite"),
    )


def permit_roll_up(permits: DataFrame, reference: DataFrame, key: str, land_use: str, unit: str, quantity: str, cost: str,
                   unit_counts: Mapping[str, Sequence[str]] = UNIT_COUNTS) -> DataFrame:
    """New building area, cost and unit counts per parcel, with the land use that gains most area."""
    # One row per land use and unit, made of medians: written, then checked and joined.
    reference = cut(reference)
    rows = spread_join(permits.where(F.col(quantity) >= 0), reference, [land_use, unit], "left")
    value = F.col(quantity).cast("double")
    multiplier, overwrite = F.col("Multiplier"), F.col("Overwrite")
    new_area = (
        F.when((overwrite == -1) & (multiplier != -1), value * multiplier)
        .when((multiplier == -1) & (overwrite != -1), overwrite).otherwise(F.lit(0.0))
    )
    rows = rows.withColumns({
        "UPDT_LVG_AREA": F.coalesce(new_area, F.lit(0.0)),
        **{f"UPDT_{c}": F.when(F.col(unit).isin(list(tags)), value).otherwise(F.lit(0.0)) for c, tags in unit_counts.items()},
    })
    sums = ["UPDT_LVG_AREA", *[f"UPDT_{c}" for c in unit_counts]]
    by_use = rows.groupBy(key, land_use).agg(
        F.sum(value).alias(quantity), F.sum(F.coalesce(F.col(cost).cast("double"), F.lit(0.0))).alias(cost),
        *[F.sum(s).alias(s) for s in sums])
    # The largest updated area names the land use; the smallest code on ties.
    leading = F.max(F.struct(F.col("UPDT_LVG_AREA").alias("a"), (-F.col(land_use)).alias("c"), F.col(land_use).alias("u")))
    return by_use.groupBy(key).agg(
        F.sum(quantity).alias(quantity), leading["u"].alias(land_use), F.sum(cost).alias(cost),
        *[F.sum(s).alias(s) for s in sums])


def short_term_parcels(parcels: DataFrame, permits: DataFrame, reference: DataFrame, key: str = "FOLIO",
                       land_use: str = "DOR_UC", living: str = "TOT_LVG_AREA", land_value: str = "LND_VAL",
                       total_value: str = "JV", buildings: str = "NO_BULDNG", unit: str = "UNITS",
                       quantity: str = "UNITS_VAL", cost: str = "COST",
                       unit_counts: Mapping[str, Sequence[str]] = UNIT_COUNTS) -> DataFrame:
    """Parcels after permitted development, with the added area and units.

    The value becomes the larger of land value plus cost and the old value. Parcels
    without permits stay as they are, with PERMIT 0.
    """
    change = permit_roll_up(permits, reference, key, land_use, unit, quantity, cost, unit_counts)
    known = [land_value, total_value, living, *unit_counts]
    before = parcels.join(change.select(key), key, "left_semi").groupBy(key).agg(*[
        F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in known])
    made = change.withColumns({buildings: F.when(F.col("UPDT_LVG_AREA") == 0, 0).otherwise(1), "PERMIT": F.lit(1)})
    made = made.join(before, key, "left").withColumns({
        living: F.col(living) + F.col("UPDT_LVG_AREA"),
        total_value: F.greatest(F.col(land_value) + F.col(cost), F.col(total_value)),
        **{c: F.col(c) + F.col(f"UPDT_{c}") for c in unit_counts},
    })
    updated = update(parcels.withColumn("PERMIT", F.lit(0)), made, key)
    added = ["UPDT_LVG_AREA", *[f"UPDT_{c}" for c in unit_counts]]
    return updated.join(change.select(key, *added), key, "left").fillna(0)

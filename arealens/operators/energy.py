"""Household energy use by overlap of estimates, and its allocation to parcels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.session import cut
from arealens.skew import spread_join

# Category names, the region, and the classes of housing, size and age.
CATEGORIES = ("Division", "Housing unit", "Year", "SQFT")
REGION = "South Atlantic"
FAILED = "FAILED"
SIZE_BREAKS = ((999, "Fewer than 1,000"), (1499, "1,000 to 1,499"), (1999, "1,500 to 1,999"),
               (2499, "2,000 to 2,499"), (2999, "2,500 to 2,999"))
SIZE_TOP = "3,000 or greater"
AGE_FIRST, AGE_LAST = "Before 1950", "2010 to 2015"


def housing_type(code: Column, units: Column) -> Column:
    """Housing type of a two-digit land-use code and a number of units."""
    small = code.isin("01", "02")
    return (
        F.when(~small & units.between(2, 4), "Apartments in buildings with 2-4 units")
        .when(~small & (units >= 5), "Apartments in buildings with 5 or more units")
        .when(code == "02", "Mobile homes")
        .when((code == "01") & (units > 1), "Single-family attached")
        .when((code == "01") & (units == 1), "Single-family detached")
        .otherwise(FAILED)
    )


def size_class(area: Column) -> Column:
    """Floor-area class. Classes have whole-number ends, so an area between two classes fails."""
    out = None
    low = None
    for high, label in SIZE_BREAKS:
        hit = area <= high if low is None else area.between(low, high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
        low = high + 1
    return out.when(area >= low, SIZE_TOP).otherwise(FAILED)


def age_class(year: Column) -> Column:
    out = F.when(year <= 1949, AGE_FIRST)
    for start in range(1950, 2010, 10):
        out = out.when(year.between(start, start + 9), f"{start} to {start + 9}")
    return out.when(year >= 2010, AGE_LAST).otherwise(FAILED)


def normal_density(x: Column, mean: Column, sd: Column) -> Column:
    z = (x - mean) / sd
    return F.exp(-z * z / 2) / (sd * F.lit(math.sqrt(2 * math.pi)))


def combine_levels(estimates: DataFrame, categories: Sequence[str] = CATEGORIES, region: str = REGION) -> DataFrame:
    """Every combination of one level per category, with the four estimates and errors.

    The levels of the four categories are the rows of one published table, a few each.
    They are put in one row of four lists, and the lists are opened one after another.
    """
    used = estimates.where((F.col("Fuel") == "Total Energy") & (F.col("End_Use") == "Total"))
    used = used.where((F.col("Category") != "Division") | (F.col("Level") == region))
    entry = F.struct(F.col("Level").alias("l"), F.struct(F.col("Estimate").alias("m"), F.col("SE").alias("s")).alias("e"))
    out = used.where(F.col("Category").isin(list(categories))).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("Category") == c, entry))).alias(f"__c{i}") for i, c in enumerate(categories)])
    for i in range(len(categories)):
        out = out.withColumn(f"__c{i}", F.explode(f"__c{i}"))
    return out.select(*[F.col(f"__c{i}.l").alias(c) for i, c in enumerate(categories)],
                      F.array(*[F.col(f"__c{i}.e") for i in range(len(categories))]).alias("dists"))


def energy_by_type(estimates: DataFrame, step: float = 0.001, categories: Sequence[str] = CATEGORIES,
                   region: str = REGION) -> DataFrame:
    """Energy per household type: where the lowest of the four densities is highest, on a grid over 3 errors each way."""
    combos = combine_levels(estimates, categories, region)
    low = F.array_min(F.transform("dists", lambda d: d["m"] - 3 * d["s"]))
    high = F.array_max(F.transform("dists", lambda d: d["m"] + 3 * d["s"]))
    grid = combos.withColumns({"__lo": low, "__n": F.floor((high - low) / F.lit(step) + F.lit(1e-9))})
    # Search points are spread over tasks in runs, so that one type's grid is not one task's work.
    run = 1000
    spread = grid.withColumn("__r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("__n") / run))))
    spread = spread.repartition(F.xxhash64(*categories, "__r"))
    points = spread.withColumn("__i", F.explode(F.sequence(
        F.col("__r") * run, F.least(F.col("__r") * run + F.lit(run - 1), F.col("__n")))))
    x = F.col("__lo") + F.col("__i") * F.lit(step)
    densities = F.transform("dists", lambda d: normal_density(x, d["m"], d["s"]))
    scored = points.select(*categories, x.alias("x"), F.col("__i"), F.array_min(densities).alias("d"))
    best = F.max(F.struct(F.col("d"), (-F.col("__i")).alias("i"), F.col("x")))
    return scored.groupBy(*categories).agg(best["x"].alias("Energy"))


def energy_to_parcels(parcels: DataFrame, energy: DataFrame, key: str, land_use: str, living: str, built: str, units: str,
                      region: str = REGION) -> DataFrame:
    """Energy of each parcel's household type; 0 where no type fits."""
    code = F.coalesce(F.col(land_use).cast("string"), F.lit("999"))
    labelled = parcels.select(
        key, F.lit(region).alias("Division"),
        housing_type(code, F.coalesce(F.col(units), F.lit(0))).alias("Housing unit"),
        size_class(F.coalesce(F.col(living).cast("double"), F.lit(0.0))).alias("SQFT"),
        age_class(F.coalesce(F.col(built), F.lit(0))).alias("Year"))
    # One row per household type, costly to find: written, then checked and joined.
    types = cut(energy.select(*CATEGORIES, F.col("Energy").alias("BTU_RES")))
    joined = spread_join(labelled, types, list(CATEGORIES), "left")
    return joined.select(key, F.coalesce("BTU_RES", F.lit(0.0)).alias("BTU_RES"))

"""Indicator formulas of the reports. Each keeps its own rule for nulls and zero denominators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealens.functions.scalar import SQFT_PER_ACRE, ACRES_PER_SQMI, density, divide

VACANT = "Vacant/Undeveloped"


def area_if_active(area: Column, activity: Column) -> Column:
    """Land area where there is activity, else 0."""
    return F.when(activity > 0, area).otherwise(F.lit(0.0))


def area_if_vacant(area: Column, land_use: Column) -> Column:
    return F.when(land_use == VACANT, area).otherwise(F.lit(0.0))


def directness(walk: Column, ideal: Column) -> Column:
    """Walk time over straight-line time; -1 without ideal time, -2 without walk time, never under 1."""
    one = F.lit(1.0)
    return (
        F.when(ideal.isNull(), F.lit(-1.0))
        .when(ideal == 0, one)
        .when(walk.isNull(), F.lit(-2.0))
        .when(walk == 0, one)
        .when(walk < ideal, one)
        .otherwise(F.try_divide(walk, ideal))
    )


def within(minutes: Column, limit: float = 15.0) -> Column:
    """1 up to the limit, else 0; null counts as 0."""
    return F.when(minutes <= limit, 1).otherwise(0)


def share_within(flagged: Column, count: Column) -> Column:
    return 100.0 * divide(flagged, count)


def per_acre(n: Column, area: Column) -> Column:
    return density(n, area, SQFT_PER_ACRE)


def grid_density(blocks: Column, land: Column) -> Column:
    """Blocks per square mile of land given in square feet."""
    return density(blocks, land, SQFT_PER_ACRE * ACRES_PER_SQMI)


def non_auto_share(transit: Column, non_motor: Column, other: Column, commutes: Column) -> Column:
    """Percent of commutes; 0 when a part is null or there are none."""
    share = 100.0 * F.try_divide((transit + non_motor + other).cast("double"), commutes.cast("double"))
    return F.coalesce(share, F.lit(0.0))


def value_index(value: Column, land: Column, region_value: Column, region_land: Column) -> Column:
    """Value per land of an area over the same ratio of the region."""
    return F.try_divide(divide(value, land), divide(region_value, region_land))


def class_floor_share(label: Column, parts: dict[str, Column], total: Column) -> Column:
    """Share of floor area in the class named by `label`; 0 when a part is null or the total is 0."""
    known = total.isNotNull() & label.isNotNull() & (total != 0)
    for part in parts.values():
        known = known & part.isNotNull()
    chosen = None
    for name, part in parts.items():
        chosen = F.when(label == name, part) if chosen is None else chosen.when(label == name, part)
    return F.when(known, F.try_divide(chosen.cast("double"), total.cast("double"))).otherwise(F.lit(0.0))

"""Scalar column builders: text, dates, bins, units, safe division and row folds."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

METERS_PER_MILE = 1609.344
FEET_PER_METER = 1 / 0.3048
SQFT_PER_ACRE = 43560.0
ACRES_PER_SQMI = 640.0
METERS_PER_MINUTE_WALK = 80.0
IDEAL_WALK_MPH = 3.0
INFINITY = float("inf")


# --- text -----------------------------------------------------------------

def zero_pad(c: Column, width: int) -> Column:
    """Zeros on the left up to `width`; longer text stays whole."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def money(c: Column) -> Column:
    """Number from text such as "$ 1,234.50"."""
    return F.regexp_replace(c, "[$ ,]", "").cast("double")


def thousands(c: Column, dtype: str = "double") -> Column:
    """Number from text with thousands separators."""
    return F.regexp_replace(c, ",", "").cast(dtype)


def flag_contains(c: Column, text: str) -> Column:
    return F.when(c.contains(text), 1).otherwise(0)


def drop_suffix_if(c: Column, text: str, length: int = 2) -> Column:
    """Cut the last `length` characters where `text` occurs."""
    cut = F.substring(c, F.lit(1), F.greatest(F.length(c) - F.lit(length), F.lit(0)))
    return F.when(c.contains(text), cut).otherwise(c)


def split_once(c: Column, separator: str = " - ") -> tuple[Column, Column]:
    parts = F.split(c, re.escape(separator), 2)
    return parts[0], F.get(parts, F.lit(1))


def code_text(c: Column, mapping: Mapping[str, str]) -> Column:
    """Text for a code; null for an unknown one."""
    return F.try_element_at(F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv]), c)


ARITHMETIC = re.compile(r"^\s*([A-Za-z_]\w*)\s*(?:([-+*/])\s*(\d+(?:\.\d+)?))?\s*$")


def field_arithmetic(text: str) -> Column:
    """Column for a field name with at most one arithmetic step, as "LND_SQFOOT / 43560"."""
    found = ARITHMETIC.match(text)
    if not found:
        raise ValueError(f"not a field with one arithmetic step: {text!r}")
    name, sign, number = found.groups()
    column = F.col(name).cast("double")
    if sign is None:
        return column
    value = F.lit(float(number))
    return {"+": column + value, "-": column - value, "*": column * value, "/": column / value}[sign]


def geoid(*levels: Column) -> Column:
    """Id of an area from the codes of its hierarchy."""
    return F.concat(*levels)


# --- dates ----------------------------------------------------------------

DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-M-d", "yyyy/M/d", "M/d/yyyy H:m:s", "M/d/yyyy H:m", "M/d/yyyy", "d-MMM-yyyy", "MMM d, yyyy")


def date_from_unix(c: Column) -> Column:
    """Timestamp from unix seconds or milliseconds: only the first ten digits count."""
    return F.timestamp_seconds(F.substring(c.cast("string"), 1, 10).cast("bigint"))


def date_from_text(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Timestamp from text in the first of the formats that fits; null where none does."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats])


def date_parts(ts: Column) -> dict[str, Column]:
    return {"DAY": F.dayofmonth(ts), "MONTH": F.month(ts), "YEAR": F.year(ts)}


# --- sentinels ------------------------------------------------------------

def clip_zero(c: Column) -> Column:
    """Negative values become 0; null stays null."""
    return F.when(c < 0, F.lit(0).cast("double")).otherwise(c)


def recode(c: Column, old, new) -> Column:
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


def infinite_to_zero(c: Column) -> Column:
    return F.when(F.abs(c) == F.lit(INFINITY), F.lit(0.0)).otherwise(c)


def finite(c: Column) -> Column:
    """Null in place of infinite and undefined numbers."""
    return F.when((F.abs(c) < F.lit(INFINITY)) & ~F.isnan(c), c)


# --- row folds ------------------------------------------------------------

def row_min(*cols: Column) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]


def row_max(*cols: Column) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def row_sum(*cols: Column) -> Column:
    """Sum without the nulls; 0 when all are null."""
    return reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])


def row_mean(*cols: Column) -> Column:
    """Mean without the nulls; null when all are null."""
    known = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return F.try_divide(row_sum(*cols), known.cast("double"))


def sum_or_zero(*cols: Column) -> Column:
    """Sum, but 0 as soon as one is null."""
    total = reduce(lambda a, b: a + b, [c.cast("double") for c in cols])
    return F.coalesce(total, F.lit(0.0))


# --- division -------------------------------------------------------------

def divide(n: Column, d: Column) -> Column:
    """Null on a null or zero denominator."""
    return F.try_divide(n.cast("double"), d.cast("double"))


def percent(n: Column, d: Column) -> Column:
    return divide(n, d) * 100.0


def density(n: Column, d: Column, scalar: float) -> Column:
    """n per `scalar` units of d; null on a null or zero denominator."""
    return F.try_divide(n.cast("double"), d.cast("double") / F.lit(float(scalar)))


# --- bins -----------------------------------------------------------------

def bin_label(c: Column, breaks: Sequence[int], units: str = "Min") -> Column:
    """Half-open bins [previous, break); the rest, nulls too, is "{last}{units}p"."""
    out = None
    for b in breaks:
        out = F.when(c < b, f"{b}{units}") if out is None else out.when(c < b, f"{b}{units}")
    return out.otherwise(f"{breaks[-1]}{units}p")


def bin_labels(breaks: Sequence[int], units: str = "Min") -> list[str]:
    return [f"{b}{units}" for b in breaks] + [f"{breaks[-1]}{units}p"]


def walk_time_bin(c: Column) -> Column:
    """Walk time classes of five minutes up to 30; "" for null."""
    out = F.when(c.isNull(), "")
    for high in range(5, 31, 5):
        out = out.when(c <= high, f"{high - 5} to {high} minutes")
    return out.otherwise("over 30 minutes")


def previous_break(c: Column, breaks: Sequence[int]) -> Column:
    """The break before a given one, 0 for the first."""
    lows = [0, *breaks[:-1]]
    return F.create_map(*[F.lit(v) for kv in zip(breaks, lows) for v in kv])[c.cast("int")]


# --- distance and time ----------------------------------------------------

def straight_distance(x1: Column, y1: Column, x2: Column, y2: Column, meters_per_unit: float = 1.0) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy) * F.lit(meters_per_unit)


def grid_distance(x1: Column, y1: Column, x2: Column, y2: Column, meters_per_unit: float = 1.0) -> Column:
    return (F.abs(x1 - x2) + F.abs(y1 - y2)) * F.lit(meters_per_unit)


def walk_minutes(meters: Column, mph: float = IDEAL_WALK_MPH) -> Column:
    return meters * 60.0 / F.lit(mph * METERS_PER_MILE)


def edge_minutes(length: Column, meters_per_minute: float = METERS_PER_MINUTE_WALK) -> Column:
    return length / F.lit(meters_per_minute)


# --- street classes -------------------------------------------------------

def bikeability(highway: Column) -> Column:
    """Traffic-stress class of a street: 3 unless the street type says otherwise; later rules win."""
    def named(*parts: str) -> Column:
        return reduce(lambda a, b: a | b, [highway.like(f"%{p}%") for p in parts])

    return (
        F.when(named("ycleway", "iving", "esidential", "ath"), 4)
        .when(named("econdary"), 2)
        .when(named("runk", "rimary"), 1)
        .otherwise(3)
    )


def cycleway(highway: Column) -> Column:
    return F.when(highway.like("%ycleway%"), 1).otherwise(0)

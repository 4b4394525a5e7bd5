"""Summaries: the spec-driven one, counts, crosswalks, zonal classes, diversity, unit references."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.predicates import Or
from arealens.session import cut
from arealens.skew import attach_scalars, exact_median, null_safe_join, spread_join, with_group_totals
from arealens.specs import MEDIAN, AggCol, Col, Consolidation, Melt, aggregate


def _listed(items, kind) -> list:
    found = [items] if isinstance(items, kind) else list(items or [])
    for item in found:
        if not isinstance(item, kind):
            raise ValueError(f"expected {kind.__name__}, got {type(item).__name__}")
    return found


class Summary(NamedTuple):
    """What one summary groups by and computes."""

    group: Sequence[Col]
    aggs: Sequence[AggCol] = ()
    consolidate: Sequence[Consolidation] = ()
    melt: Melt | None = None


def summarize(df: DataFrame, group: Col | Sequence[Col], aggs: AggCol | Sequence[AggCol] = (),
              consolidate: Sequence[Consolidation] = (), melt: Melt | None = None) -> DataFrame:
    """Null defaults, row folds, unpivot, domains, grouping and aggregation, as the specs say.

    Nulls are replaced before anything is aggregated, so they count in means and medians.
    """
    return summarize_all(df, [Summary(group, aggs, consolidate, melt)])[0]


def summarize_all(df: DataFrame, summaries: Sequence[Summary]) -> list[DataFrame]:
    """Several summaries of one table in one aggregation over grouping sets, split after.

    The table is read once for all sums, means and counts, and once more for medians. A
    measure that several summaries share is computed once per grouping set. Melted columns are
    aggregated side by side and turned into rows afterwards, so no row is repeated for them.
    """
    types = dict(df.dtypes)
    inputs: dict[tuple, tuple[str, Column]] = {}
    measures: dict[tuple, str] = {}

    def held(tag: tuple, value: Column, prefix: str) -> str:
        """Name of an input column, made once for equal expressions."""
        return inputs.setdefault((prefix, *tag), (f"__{prefix}{len(inputs)}", value))[0]

    plans = []
    for group, aggs, consolidate, melt in summaries:
        group, aggs, consolidate = _listed(group, Col), _listed(aggs, AggCol), _listed(consolidate, Consolidation)
        defaults = {c.name: c.default for c in [*group, *aggs]}
        for c in consolidate:
            defaults.update(c.defaults())
        if melt:
            defaults.update(melt.defaults())
        missing = sorted(set(defaults) - set(df.columns))
        if missing:
            raise ValueError(f"columns missing from the input: {missing}")
        values = {n: F.coalesce(F.col(n), F.lit(d).cast(types[n])) for n, d in defaults.items()}

        def measured(source: str, method) -> str:
            return measures.setdefault((source, method), f"__a{len(measures)}")

        keys = [(g, held((g.name, defaults[g.name]), values[g.name], "k")) for g in group]
        outs = [(a.out, measured(held((a.name, defaults[a.name]), values[a.name], "v"), a.method)) for a in aggs]
        outs += [(c.name, measured(held((c.name, c.inputs, c.fold, tuple(defaults[i] for i in c.inputs)), c.of(values), "v"), c.method)) for c in consolidate]
        cells = [(i, measured(held((i, defaults[i], "double"), values[i].cast("double"), "v"), melt.method)) for i in melt.inputs] if melt else []
        plans.append((keys, outs, melt, cells))

    rows = df.select(*[value.alias(name) for name, value in inputs.values()])
    key_names = [name for (kind, *_), (name, _) in inputs.items() if kind == "k"]
    sets = list(dict.fromkeys(tuple(sorted({name for _, name in keys}, key=key_names.index)) for keys, *_ in plans))
    medians = {out: source for (source, method), out in measures.items() if method == MEDIAN}
    if medians:
        # Read by the medians as well as by the other methods.
        rows = cut(rows)
    simple = [F.count(F.lit(1)).alias("__rows"), *[aggregate(m, F.col(source)).alias(out) for (source, m), out in measures.items() if m != MEDIAN]]
    numbers = {s: sum(1 << (len(key_names) - 1 - i) for i, k in enumerate(key_names) if k not in s) for s in sets}
    if len(sets) == 1:
        result = rows.groupBy(*sets[0]).agg(*simple).withColumn("__set", F.lit(numbers[sets[0]]).cast("bigint"))
    else:
        result = rows.groupingSets([list(s) for s in sets], *key_names).agg(F.grouping_id().cast("bigint").alias("__set"), *simple)
    if medians:
        wanted = {s: {measure for keys, outs, _, cells in plans if set(s) == {n for _, n in keys} for _, measure in outs + cells} & set(medians) for s in sets}
        result = _with_medians(result, rows, sets, numbers, key_names, medians, wanted)
    if len(plans) > 1:
        # A small table; each summary takes its grouping set from it.
        result = cut(result)
    return [_split(result, numbers[tuple(sorted({n for _, n in keys}, key=key_names.index))], keys, outs, melt, cells) for keys, outs, melt, cells in plans]


def _with_medians(result: DataFrame, rows: DataFrame, sets: Sequence[tuple[str, ...]], numbers: Mapping[tuple[str, ...], int], keys: Sequence[str],
                  medians: Mapping[str, str], wanted: Mapping[tuple[str, ...], set[str]]) -> DataFrame:
    """Medians of all grouping sets in one selection; rows go to the sets that need any."""
    types = dict(rows.dtypes)
    asked = [s for s in sets if wanted[s]]
    copies = F.explode(F.array(*[F.struct(
        F.lit(numbers[s]).cast("bigint").alias("__set"),
        *[(F.col(k) if k in s else F.lit(None).cast(types[k])).alias(k) for k in keys],
        *[(F.col(source) if out in wanted[s] else F.lit(None)).cast("double").alias(out) for out, source in medians.items()]) for s in asked]))
    spread = rows.select(copies.alias("__c")).select("__c.*")
    found = exact_median(spread, ["__set", *keys], {out: out for out in medians}, written=True)
    return null_safe_join(result, found, ["__set", *keys])


def _split(result: DataFrame, number: int, keys: Sequence[tuple[Col, str]], outs: Sequence[tuple[str, str]], melt: Melt | None,
           cells: Sequence[tuple[str, str]]) -> DataFrame:
    """One summary's rows and columns of the common aggregate, with its domains and its melted column as rows."""
    own = result.where(F.col("__set") == number)
    columns = [F.col(name).alias(g.out) for g, name in keys]
    domains = {g.domain.name: g.domain.of(F.col(name)) for g, name in keys if g.domain}
    if melt:
        pairs = F.array(*[F.struct(F.lit(label).alias("l"), F.col(name).alias("v")) for label, name in cells])
        own = own.where("__rows > 0").withColumn("__pair", F.explode(pairs))
        columns.append(F.col("__pair.l").alias(melt.label))
        outs = [*outs, (melt.value, "__pair.v")]
        if melt.domain:
            domains[melt.domain.name] = melt.domain.of(F.col("__pair.l"))
    return own.select(*columns, *[c.alias(n) for n, c in domains.items()], *[F.col(name).alias(out) for out, name in outs])


def consolidate(df: DataFrame, keep: Sequence[str], renames: Mapping[str, str], folds: Sequence[Consolidation]) -> DataFrame:
    """Base columns, renamed columns and row folds of a wide table, nulls at the folds' defaults."""
    defaults: dict[str, float] = {}
    for f in folds:
        defaults.update(f.defaults())
    missing = sorted((set(defaults) | set(keep) | set(renames)) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    types = dict(df.dtypes)
    values = {n: F.coalesce(F.col(n), F.lit(d).cast(types[n])) for n, d in defaults.items()}
    return df.select(*keep, *[F.col(old).alias(new) for old, new in renames.items()], *[f.of(values).alias(f.name) for f in folds])


def count_rows(df: DataFrame, group: Sequence[str], out: str = "count", null_value=None, skip_nulls: bool = False) -> DataFrame:
    """Row count per group."""
    source = df.dropna() if skip_nulls else df if null_value is None else df.fillna(null_value)
    return source.groupBy(*group).agg(F.count(F.lit(1)).alias(out))


def with_row_counts(df: DataFrame, group: Sequence[str], out: str) -> DataFrame:
    """Row count of its group on each row."""
    return with_group_totals(df, group, {out: F.count(F.lit(1))})


def column_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of column sums, nulls as 0."""
    return df.agg(*[F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, null read as 0."""
    kind = dict(df.dtypes)[column]
    return df.select(F.coalesce(F.col(column), F.lit(0).cast(kind)).alias(column)).distinct().orderBy(column)


def mean_then_sum(df: DataFrame, area: str, item: str, columns: Sequence[str]) -> DataFrame:
    """Mean per item, so that repeated pieces count once, then sum per area."""
    means = df.groupBy(area, item).agg(*[F.avg(c).alias(c) for c in columns])
    return means.groupBy(area).agg(*[F.sum(c).alias(c) for c in columns])


def criteria_sums(df: DataFrame, area: str, item: str, code: str, value: str, criteria: Mapping[str, Or]) -> DataFrame:
    """Per criterion: mean value of the matching rows of each item, summed over the area; 0 without any."""
    per_item = df.groupBy(area, item).agg(*[
        F.avg(F.when(crit.on(F.col(code)), F.col(value))).alias(name) for name, crit in criteria.items()
    ])
    return per_item.groupBy(area).agg(*[
        F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in criteria
    ])


# Classes of percent imperviousness, and the raster's code for no data.
IMPERVIOUS_NO_DATA = 127
IMPERVIOUS_CLASSES = {
    "NonDevArea": (0, 0), "DevOSArea": (1, 19), "DevLowArea": (20, 49), "DevMedArea": (50, 79), "DevHighArea": (80, None),
}


def zonal_imperviousness(cells: DataFrame, zone: str, value: str, cell_area: float) -> DataFrame:
    """Mean imperviousness and area by class per zone; cells without data count as 0."""
    v = F.when(F.col(value).isNull() | (F.col(value) == IMPERVIOUS_NO_DATA), F.lit(0)).otherwise(F.col(value))
    area = F.lit(float(cell_area))

    def in_class(low: int, high: int | None) -> Column:
        hit = F.col("__v") >= low if high is None else F.col("__v").between(low, high)
        return F.sum(F.when(hit, 1).otherwise(0)) * area

    return cells.select(zone, v.alias("__v")).groupBy(zone).agg(
        F.avg("__v").alias("IMP_PCT"),
        (F.count(F.lit(1)) * area).alias("TotalArea"),
        *[in_class(lo, hi).alias(name) for name, (lo, hi) in IMPERVIOUS_CLASSES.items()],
    )


def sum_to_zones(zones: DataFrame, members: DataFrame, zone: str, value: str) -> DataFrame:
    """Sum per zone; zones without members stay, with 0."""
    sums = members.groupBy(zone).agg(F.sum(F.coalesce(F.col(value).cast("double"), F.lit(0.0))).alias(value))
    return zones.select(zone).join(sums, zone, "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


EARLY_PERIOD = "2:00 AM - 2:45 AM"
EARLY_LABEL = "EARLY AM 02:45AM-05:59AM"


def ridership(df: DataFrame, lat: str = "LAT", lon: str = "LONG", period: str = "TIME_PERIOD",
              measures: Sequence[str] = ("ON", "OFF", "TOTAL")) -> DataFrame:
    """Riders per stop place and period: coordinates to four places (half to even), sums, one period relabelled."""
    rounded = df.withColumns({lat: F.bround(lat, 4), lon: F.bround(lon, 4)})
    sums = rounded.groupBy(lat, lon, period).agg(*[F.sum(m).alias(m) for m in measures])
    return sums.withColumn(period, F.when(F.col(period) == EARLY_PERIOD, EARLY_LABEL).otherwise(F.col(period)))


def pivot_sum(df: DataFrame, index: Sequence[str], column: str, value: str, values: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Sum spread to one column per stated value, blanks in names as underscores."""
    cells = [F.sum(F.when(F.col(column) == v, F.col(value))).alias(v.replace(" ", "_")) for v in values]
    out = df.groupBy(*index).agg(*cells)
    if fill is None:
        return out
    return out.fillna(fill, [v.replace(" ", "_") for v in values])


def dissolve(df: DataFrame, keys: Sequence[str], maxima: Sequence[str] = (), means: Sequence[str] = ()) -> DataFrame:
    """One row per key with piece count, maxima and means."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("NumPieces"),
        *[F.max(c).alias(c) for c in maxima], *[F.avg(c).alias(c) for c in means],
    )


def min_argmin_count(df: DataFrame, key: str, name: str, value: str, out: tuple[str, str, str]) -> DataFrame:
    """Name with the smallest value (smallest name on ties), that value, and the number of rows."""
    nearest, least, number = out
    best = F.min(F.struct(F.col(value).alias("v"), F.col(name).alias("n")))
    return df.groupBy(key).agg(best.alias("__b"), F.count(F.lit(1)).alias(number)).select(
        key, F.col("__b.n").alias(nearest), F.col("__b.v").alias(least), number)


def case_statistics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias(f"MIN_{value}"), F.avg(value).alias(f"MEAN_{value}"))


def roll_up(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def crosswalk_roll_up(blocks: DataFrame, crosswalk: DataFrame, block: str, crosswalk_block: str, level: str,
                      file_type: str = "wac") -> DataFrame:
    """Block counts summed to a larger geography. Columns with digits in their names are summed; OD files are refused."""
    if file_type.lower() == "od":
        raise ValueError("origin-destination files need od_crosswalk_roll_up")
    counts = [c for c in blocks.columns if any(ch.isdigit() for ch in c)]
    to_level = crosswalk.select(F.col(crosswalk_block).alias(block), level)
    # One row per block before the join: a block with very many rows arrives as one per map task.
    per_block = blocks.groupBy(block).agg(*[F.sum(c).alias(c) for c in counts])
    joined = per_block.join(to_level, block, "left")
    return joined.where(F.col(level).isNotNull()).groupBy(level).agg(*[F.sum(c).alias(c) for c in counts])


def od_crosswalk_roll_up(flows: DataFrame, crosswalk: DataFrame, ends: tuple[str, str], crosswalk_block: str,
                         level: str, columns: Sequence[str]) -> DataFrame:
    """Both ends of a flow mapped to a larger geography and summed by pair."""
    out, kept = flows, list(ends)
    for i, end in enumerate(ends, 1):
        # Sums of what is still told apart; the block of a large employer may stay hot, so its rows are split.
        out = out.groupBy(*kept).agg(*[F.sum(c).alias(c) for c in columns])
        out = spread_join(out, crosswalk.select(F.col(crosswalk_block).alias(end), F.col(level).alias(f"{level}{i}")), end)
        kept[i - 1] = f"{level}{i}"
    return out.groupBy(*kept).agg(*[F.sum(c).alias(c) for c in columns])


# --- land-use diversity ---------------------------------------------------
# Each index is an aggregate over rows (one per class) with weight n, for k classes.

def simpson(n: Column, k: int | Column) -> Column:
    total = F.sum(n)
    return 1 - F.try_divide(F.sum(n * (n - 1)), total * (total - 1))


def shannon(n: Column, k: int | Column) -> Column:
    total = F.sum(n)
    return (F.log(total) - F.try_divide(F.sum(n * F.log(n)), total)) / F.log(_as_double(k))


def berger_parker(n: Column, k: int | Column) -> Column:
    best = 1 / _as_double(k)
    return 1 - (F.try_divide(F.max(n), F.sum(n)) - best) / (1 - best)


def effective_number(n: Column, k: int | Column) -> Column:
    total = F.sum(n)
    return (F.try_divide(total * total, F.sum(n * n)) - 1) / (_as_double(k) - 1)


def _as_double(k: int | Column) -> Column:
    return (k if isinstance(k, Column) else F.lit(k)).cast("double")


DIVERSITY: dict[str, Callable[[Column, int | Column], Column]] = {
    "Simpson": simpson, "Shannon": shannon, "BergerParker": berger_parker, "ENP": effective_number,
}


def diversity(df: DataFrame, area: str | Sequence[str], land_use: str, weight: str | None = None,
              count_lu: int | None = None, indices: Mapping[str, Callable] = DIVERSITY, regional: bool = False) -> DataFrame:
    """Diversity indices per area from positive weights, with the ratio to the region's index as `_Adj`.

    Without `weight`, each row weighs as many as its area has rows. The rows are reduced
    to one per area and class first; all later steps read that small table.
    """
    areas = [area] if isinstance(area, str) else list(area)
    source = df
    if weight is None:
        weight = "COUNT"
        source = with_row_counts(df, areas, weight)
    sums = (
        source.where(F.col(weight) > 0)
        .groupBy(*areas, land_use).agg(F.sum(F.col(weight).cast("double")).alias("__n"))
    )
    n = F.col("__n")
    if count_lu is None:
        classes = sums.agg(F.count_distinct(land_use).alias("k"))
        k: int | Column = classes.select("k").scalar()
        sums = sums.withColumn("__k", k)
        k = F.col("__k")
        per_area = sums.groupBy(*areas, "__k")
    else:
        k = count_lu
        per_area = sums.groupBy(*areas)
    out = per_area.agg(*[f(n, k).alias(name) for name, f in indices.items()])
    if regional:
        by_class = sums.groupBy(land_use, *(["__k"] if count_lu is None else [])).agg(F.sum("__n").alias("__n"))
        region = (by_class.groupBy("__k") if count_lu is None else by_class.groupBy()).agg(
            *[f(n, k).alias(name) for name, f in indices.items()])
        out = attach_scalars(out, region, {f"__r_{name}": name for name in indices})
        out = out.withColumns({f"{name}_Adj": F.try_divide(F.col(name), F.col(f"__r_{name}")) for name in indices})
        out = out.drop(*[f"__r_{name}" for name in indices])
    return out.drop("__k")


# --- checks and exploration ------------------------------------------------

def totals_check(source: DataFrame, allocated: DataFrame, key: str, pairs: Mapping[str, str]) -> DataFrame:
    """Per variable: source total, allocated total, their difference, and the least and largest difference by area."""
    sums = allocated.groupBy(key).agg(*[F.sum(a).alias(f"__a_{s}") for s, a in pairs.items()])
    joined = source.select(key, *pairs).join(sums, key)
    tall = joined.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("Var"), F.col(s).cast("double").alias("s"), F.col(f"__a_{s}").cast("double").alias("a"))
        for s in pairs
    ])).alias("e")).select("e.*")
    off = F.abs(F.col("s") - F.col("a"))
    return tall.groupBy("Var").agg(
        F.sum("s").alias("Val_Source"), F.sum("a").alias("Val_Alloc"), F.min(off).alias("Min"), F.max(off).alias("Max"),
    ).withColumn("Off", F.round(F.abs(F.col("Val_Alloc") - F.col("Val_Source")), 3))


def yearly_totals(df: DataFrame, year: str, columns: Sequence[str], label: str = "Sector", value: str = "Total") -> DataFrame:
    """Sums by year and column, long."""
    sums = df.groupBy(year).agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    return sums.unpivot([year], list(columns), label, value)


def histogram(df: DataFrame, year: str, value: str) -> DataFrame:
    """Counts per year in bins of width max / sqrt(n)."""
    per_year = df.groupBy(year).agg(F.max(value).alias("__max"), F.count(F.lit(1)).alias("__n"))
    width = F.col("__max") / F.sqrt(F.col("__n"))
    joined = spread_join(df.select(year, value), per_year, year)
    binned = joined.withColumn("bin", F.floor(F.try_divide(F.col(value), width)).cast("bigint"))
    return binned.groupBy(year, "bin").agg(F.count(F.lit(1)).alias("n"))


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation as an aggregate; null when one side does not vary."""
    a, b = ((F.col(c) if isinstance(c, str) else c).cast("double") for c in (x, y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlations(df: DataFrame, response: str, predictors: Sequence[str]) -> DataFrame:
    """Pearson correlation of each predictor with the response; undefined ones left out."""
    row = df.agg(*[pearson(p, response).alias(p) for p in predictors])
    tall = row.unpivot([], list(predictors), "Variable", "r")
    return tall.where(F.col("r").isNotNull() & ~F.isnan("r"))


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Value over its group's total; null where the total is 0."""
    with_total = with_group_totals(df, keys, {"__total": F.sum(F.col(value).cast("double"))})
    return with_total.withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("__total"))).drop("__total")

"""Joins, medians and numbering that stay balanced when one key holds a large part of the rows.

Sums, counts, minima and maxima need nothing special: Spark combines them on the map
side, so a hot group reaches the reducer as one row per map task. Joins, medians,
windows and running numbers do not combine, and are handled here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from arealens.session import cut

HOT_SHARE = 0.01
HOT_SPLITS = 512
SAMPLE_SHARE = 0.02
SMALL_SAMPLE = 2_000
SMALL_ROWS = 50_000
SMALL_BYTES = 64 << 20
MEDIAN_DIGITS = 4096
MEDIAN_RANKED = 4096


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(value, F.lit(0).cast("bigint"), lambda n, e: n + _value_bytes(e, kind.elementType))
    elif isinstance(kind, T.MapType):
        size = (_value_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
                + _value_bytes(F.map_values(value), T.ArrayType(kind.valueType)))
    elif isinstance(kind, T.StructType):
        size = reduce(lambda a, f: a + _value_bytes(value[f.name], f.dataType), kind.fields, F.lit(0))
    else:
        size = F.lit(0)
    return (F.lit(8) + F.coalesce(size, F.lit(0))).cast("bigint")


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: 8 for each value, inside nested ones too, and the length of texts."""
    return reduce(lambda a, f: a + _value_bytes(F.col(f"`{f.name}`"), f.dataType), df.schema.fields, F.lit(0).cast("bigint"))


def is_small(df: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """Whether a table has at most `rows` rows and `size` bytes; looks at no more than that many rows."""
    rows = SMALL_ROWS if rows is None else rows
    size = SMALL_BYTES if size is None else size
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return seen["n"] <= rows and (seen["b"] or 0) <= size


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least `share` of the rows; at most 1/share of them.

    A sketch of bounded size counts the frequent keys of a sample in one pass over the
    key columns. A key named wrongly costs a little replication and changes no result.
    """
    sampled = df.select(_key_hash(keys).alias("h")).sample(False, SAMPLE_SHARE, seed=7)
    top = F.expr(f"approx_top_k(h, {int(1 / share)}, {int(10 / share)})")
    row = sampled.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    if row["n"] < SMALL_SAMPLE:
        return []
    return [int(t["item"]) for t in row["top"] if t["item"] is not None and t["count"] >= share * row["n"]]


@dataclass(frozen=True)
class JoinAdvice:
    """What is known about a join: whether the right side may be broadcast, and the hot keys of both sides."""

    small: bool = False
    hot: tuple[int, ...] = ()
    hot_right: tuple[int, ...] = ()


def advise(left: DataFrame, right: DataFrame, on: str | Sequence[str], unique: bool = True) -> JoinAdvice:
    """Advice for joining two tables. `unique` says that the right side repeats no key."""
    keys = [on] if isinstance(on, str) else list(on)
    if is_small(right):
        return JoinAdvice(small=True)
    return JoinAdvice(hot=tuple(hot_keys(left, keys)), hot_right=() if unique else tuple(hot_keys(right, keys)))


def spread_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
                advice: JoinAdvice | None = None, splits: int | None = None, parts: int | None = None) -> DataFrame:
    """Equi-join in which hot keys are split over many tasks. The left side is the longer one.

    A right side of a checked, small size is broadcast. Otherwise the rows of
    a key that is hot on one side get one of `splits` salts there, and the other side's
    rows of that key are repeated once per salt. Salts go by a row's position in its
    written table, so equal rows are spread as well. A key hot on both sides is split on
    both, into about the square root of `splits` parts each. Other keys are not touched.
    `parts` states the number of tasks of a join that makes many rows of few bytes.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join keeps or drops rows of the left side; {how!r} is not possible")
    advice = advise(left, right, keys) if advice is None else advice
    if advice.small:
        return (left.repartition(parts) if parts else left).join(F.broadcast(right), keys, how)
    if advice.hot_right and how != "inner":
        raise ValueError("only an inner join can split the right side")

    def joined(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
        if parts:
            # The tables' estimated sizes know nothing of repeated rows, so a broadcast is ruled out.
            a, b = a.repartition(parts, *on), b.repartition(parts, *on).hint("merge")
        return a.join(b, list(on), how)

    if not advice.hot and not advice.hot_right:
        return joined(left, right, keys)
    a, b = _salted(left, right, keys, keys, advice, splits or HOT_SPLITS)
    return joined(a, b, [*keys, "__salt_l", "__salt_r"]).drop("__salt_l", "__salt_r")


def _salted(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], advice: JoinAdvice,
            splits: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with salt columns `__salt_l` and `__salt_r`, 0 but for hot keys."""
    both = sorted(set(advice.hot) & set(advice.hot_right))
    only_left = sorted(set(advice.hot) - set(both))
    only_right = sorted(set(advice.hot_right) - set(both))
    root = max(int(splits ** 0.5), 2)

    def parts(keys: Sequence[str], mine: Sequence[int]) -> Column:
        """Into how many parts a side's rows of a key are split."""
        count = F.lit(1)
        if mine:
            count = F.when(_key_hash(keys).isin(list(mine)), splits).otherwise(count)
        if both:
            count = F.when(_key_hash(keys).isin(both), root).otherwise(count)
        return count

    def salt(df: DataFrame, keys: Sequence[str], own: str, other: str, mine: Sequence[int], theirs: Sequence[int]) -> DataFrame:
        if mine or both:
            # Positions stay the same when a task is run again only if the table is written.
            df = cut(df)
        row = F.xxhash64(F.monotonically_increasing_id())
        # The own salt is drawn before rows are repeated, so that all copies of a row have the same.
        salted = df.withColumn(own, F.pmod(row, parts(keys, mine)).cast("int"))
        return salted.withColumn(other, F.explode(F.sequence(F.lit(0), parts(keys, theirs) - 1)))

    return (salt(left, left_keys, "__salt_l", "__salt_r", only_left, only_right),
            salt(right, right_keys, "__salt_r", "__salt_l", only_right, only_left))


def join_to_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner",
                   small: bool | None = None) -> DataFrame:
    """Join a table of one row per group to the groups' rows; null keys match. Hot groups are split.

    The number of groups is counted on the rows' key columns, which combines on the map
    side, so that `groups` itself, often a costly aggregate, is computed once. `small`
    tells the outcome where the caller has counted already.
    """
    keys = list(keys)
    renamed = groups.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    drop = [f"__r_{k}" for k in keys]
    if is_small(rows.select(*keys).distinct()) if small is None else small:
        return rows.join(F.broadcast(renamed), same, how).drop(*drop)
    hot = hot_keys(rows, keys)
    if not hot:
        return rows.join(renamed, same, how).drop(*drop)
    a, b = _salted(rows, renamed, keys, drop, JoinAdvice(hot=tuple(hot)), HOT_SPLITS)
    b = b.withColumnsRenamed({"__salt_l": "__r_salt_l", "__salt_r": "__r_salt_r"})
    salts = [F.col("__salt_l") == F.col("__r_salt_l"), F.col("__salt_r") == F.col("__r_salt_r")]
    return a.join(b, [*same, *salts], how).drop(*drop, "__salt_l", "__salt_r", "__r_salt_l", "__r_salt_r")


def with_group_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Join group aggregates back to their rows, in place of a window over the group.

    A window would sort each whole group in one task. Here the aggregate combines on the
    map side and only the small result is joined back. Null keys match each other.
    """
    keys = list(keys)
    sums = df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return join_to_groups(df, sums, keys, "left").select(*df.columns, *totals)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by `order`. Aggregates a struct, so it combines on the map side."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    pick = F.max(packed) if last else F.min(packed)
    return df.groupBy(*keys).agg(pick.alias("__row")).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def exact_median(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], written: bool = False) -> DataFrame:
    """Exact medians per group: `columns` maps output name to input column. Nulls are skipped.

    A plain median keeps every distinct value of a group in one task. Here all groups are
    narrowed at once by radix selection: a value's digit is its place between the least and
    the greatest value left in its group, rows are counted per digit, and only the digit
    that holds the middle goes on. Counts combine on the map side. A group is ranked once
    at most MEDIAN_RANKED rows of it are left, so no task sees more of a group than that or
    than MEDIAN_DIGITS counts. The input is read several times, so its keys and values are
    written once, unless it is `written` already.
    """
    keys, names = list(keys), list(columns)
    if not names:
        return df.select(*keys).distinct()
    if not written:
        df = cut(df.select(*dict.fromkeys([*keys, *columns.values()])))
    long = (
        df.select(*keys, F.explode(F.array(*[
            F.struct(F.lit(n).alias("m"), F.col(columns[n]).cast("double").alias("v")) for n in names
        ])).alias("__e"))
        .select(*keys, F.col("__e.m").alias("__m"), F.col("__e.v").alias("__v"))
        .where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    )
    group = keys + ["__m"]
    # Of each group: values between which the middle lies, how many rows they span, and the ranks of the middle among those.
    rows = F.count(F.lit(1))
    state = cut(long.groupBy(*group).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), rows.alias("__n")).withColumns({
        "__low": F.floor((F.col("__n") + 1) / 2), "__high": F.floor(F.col("__n") / 2) + 1, "__med": F.lit(None).cast("double")}))
    few = is_small(state)
    wide = F.col("__med").isNull() & (F.col("__lo") < F.col("__hi")) & (F.col("__n") > MEDIAN_RANKED)
    while not state.where(wide).isEmpty():
        state = cut(state.where(~wide).unionByName(_narrowed(long, state.where(wide), group, few)))
    alone = state.where(F.col("__med").isNotNull() | (F.col("__lo") == F.col("__hi")))
    alone = alone.select(*group, F.coalesce("__med", "__lo").alias("__med"))
    medians = alone.unionByName(_ranked(long, state.where(F.col("__med").isNull() & (F.col("__lo") < F.col("__hi"))), group, few))
    wide_rows = medians.groupBy(*keys).agg(*[F.max(F.when(F.col("__m") == n, F.col("__med"))).alias(n) for n in names])
    return null_safe_join(df.select(*keys).distinct(), wide_rows, keys, "left")


def _left_of(long: DataFrame, state: DataFrame, group: Sequence[str], few: bool) -> DataFrame:
    """Values that lie between the bounds of their group."""
    bounded = join_to_groups(long, state.select(*group, "__lo", "__hi", "__low", "__high"), group, small=few)
    return bounded.where((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))


def _ranked(long: DataFrame, state: DataFrame, group: Sequence[str], few: bool) -> DataFrame:
    """Medians of groups with few rows left, by counting equal values and ranking the rest."""
    counted = _left_of(long, state, group, few).groupBy(*group, "__low", "__high", "__v").agg(F.count(F.lit(1)).alias("__cnt"))
    run = Window.partitionBy(*group).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    upto, low, high = F.col("__upto"), F.col("__low"), F.col("__high")
    before = upto - F.col("__cnt")
    return counted.withColumn("__upto", F.sum("__cnt").over(run)).groupBy(*group).agg(
        ((F.max(F.when((before < low) & (upto >= low), F.col("__v"))) + F.max(F.when((before < high) & (upto >= high), F.col("__v")))) / 2).alias("__med"))


def _narrowed(long: DataFrame, state: DataFrame, group: Sequence[str], few: bool) -> DataFrame:
    """State of groups after one digit. Where the two middle ranks part, they are the ends of two digits and the group is done."""
    v, lo, hi, last = F.col("__v"), F.col("__lo"), F.col("__hi"), MEDIAN_DIGITS - 1
    # Halves, so that the range cannot overflow. The ends have digits of their own in any case, so every round takes values away.
    share = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)
    inner = F.when(share.isNull() | F.isnan(share), 1).otherwise(F.least(F.greatest(F.floor(share * MEDIAN_DIGITS), F.lit(0)), F.lit(last)))
    digit = F.when(v == lo, 0).when(v == hi, last).otherwise(inner).cast("int")
    counted = _left_of(long, state, group, few).withColumn("__d", digit).groupBy(*group, "__low", "__high", "__d").agg(
        F.count(F.lit(1)).alias("__cnt"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
    run = Window.partitionBy(*group).orderBy("__d").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("__upto", F.sum("__cnt").over(run)).withColumn("__before", F.col("__upto") - F.col("__cnt"))
    cell = F.struct("__d", "__cnt", "__before", "__least", "__most")

    def holding(rank: str) -> Column:
        return F.max(F.when((F.col("__before") < F.col(rank)) & (F.col("__upto") >= F.col(rank)), cell))

    a, b = F.col("__a"), F.col("__b")
    parted = a["__d"] != b["__d"]
    return placed.groupBy(*group, "__low", "__high").agg(holding("__low").alias("__a"), holding("__high").alias("__b")).select(
        *group, a["__least"].alias("__lo"), a["__most"].alias("__hi"), a["__cnt"].alias("__n"), (F.col("__low") - a["__before"]).alias("__low"),
        (F.col("__high") - a["__before"]).alias("__high"), F.when(parted, (a["__most"] + b["__least"]) / 2).alias("__med"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match, keeping the key columns of the left side."""
    keys = list(keys)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def number_rows(df: DataFrame, order: Sequence[Column], out: str, start: int = 0) -> DataFrame:
    """Consecutive ids in a stated total order, without sorting everything in one task.

    The range-sorted rows are written once, so that positions stay fixed if an executor
    is lost. Each row's position inside its partition is known from the row id; the
    number of rows before a partition comes from one count per partition.
    """
    placed = cut(df.orderBy(*order)).withColumn("__mid", F.monotonically_increasing_id())
    placed = placed.withColumn("__part", F.shiftright("__mid", 33)).withColumn(
        "__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    # One row per partition of the sorted table, so the ungrouped window below is small.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__before") + F.col("__pos") + F.lit(start))
        .drop("__mid", "__part", "__pos", "__before")
    )


def attach_scalars(df: DataFrame, one_row: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add columns of a one-row table to every row through scalar subqueries; `columns` maps output to input name."""
    return df.select("*", *[one_row.select(src).scalar().alias(out) for out, src in columns.items()])

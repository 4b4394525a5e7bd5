"""Attribute joins, patches, updates and stacks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealens.skew import first_per_key, number_rows
from arealens.specs import FeatureSpec, TableSpec


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in without]


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def extend(left: DataFrame, right: DataFrame, left_key: str, right_key: str, append_only: bool = True) -> DataFrame:
    """Left join on a key. Same-named columns raise with `append_only`, else the right ones replace them."""
    new = [c for c in right.columns if c != right_key]
    same = [c for c in new if c in left.columns and c != left_key]
    if same and append_only:
        raise ValueError(f"columns exist already: {same}")
    renamed = right.withColumnRenamed(right_key, left_key) if right_key != left_key else right
    return left.drop(*same).join(renamed, left_key, "left")


def join_attributes(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                    fields: Sequence[str] | None = None, renames: Mapping[str, str] | None = None,
                    null_value: float = 0.0, drop_duplicates: bool = True) -> DataFrame:
    """Join chosen fields under new names, nulls of the joined table read as `null_value`.

    Fields whose new names exist already are left out; when none is left, `left` comes back as it is.
    """
    renames = dict(renames or {})
    chosen = [c for c in (fields or right.columns) if c != right_key]
    if drop_duplicates:
        chosen = [c for c in chosen if renames.get(c, c) not in left.columns]
        if not chosen:
            return left
    types = dict(right.dtypes)
    parts = right.select(
        F.col(right_key).alias(left_key),
        *[F.coalesce(F.col(c), F.lit(null_value).cast(types[c])).alias(renames.get(c, c)) for c in chosen],
    )
    return left.join(parts, left_key, "left")


def join_specs(features: Mapping[str, DataFrame], tables: Mapping[str, DataFrame],
               feature_specs: Sequence[FeatureSpec], table_specs: Sequence[TableSpec]) -> dict[str, DataFrame]:
    """Join to each layer, in order, the tables that carry its name in theirs (case ignored)."""
    out = dict(features)
    for layer in feature_specs:
        if layer.name not in out:
            continue
        for spec in table_specs:
            if layer.name.lower() in spec.name.lower() and spec.name in tables:
                out[layer.name] = join_attributes(
                    out[layer.name], tables[spec.name], layer.key, spec.key, spec.fields, spec.renames)
    return out


def lookup_left(df: DataFrame, table: DataFrame, key: str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Recode by a lookup table; the frame's nulls get their defaults before the join."""
    types = dict(df.dtypes)
    filled = {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in (defaults or {}).items() if c in types}
    return (df.withColumns(filled) if filled else df).join(table, key, "left")


def merge_many(tables: Sequence[DataFrame], on: str | Sequence[str], suffixes: Sequence[str] | None = None,
               how: str = "inner") -> DataFrame:
    """Chained merge on shared keys with one suffix per table.

    Colliding columns get the suffix of their own table. With an odd number of tables
    every column of the last one is suffixed, collision or not.
    """
    keys = _keys(on)
    frames = list(tables)
    if suffixes is None:
        return reduce(lambda a, b: a.join(b, keys, how), frames)
    marks = list(suffixes)
    if len(frames) % 2:
        last = frames[-1]
        frames[-1] = last.withColumnsRenamed({c: f"{c}{marks[-1]}" for c in last.columns if c not in keys})
    out, mark = frames[0], marks[0]
    for frame, next_mark in zip(frames[1:], marks[1:]):
        both = [c for c in frame.columns if c in out.columns and c not in keys]
        out = out.withColumnsRenamed({c: f"{c}{mark}" for c in both}).join(
            frame.withColumnsRenamed({c: f"{c}{next_mark}" for c in both}), keys, how)
        mark = next_mark
    return out


def patch(local: DataFrame, regional: DataFrame, key: str) -> DataFrame:
    """Local rows win over regional ones; regional columns the local table lacks are added to them."""
    extra = [c for c in regional.columns if c == key or c not in local.columns]
    patched = local.join(regional.select(*extra), key, "inner")
    rest = regional.join(local.select(key), key, "left_anti")
    return patched.unionByName(rest, allowMissingColumns=True)


def reconcile(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> tuple[DataFrame, DataFrame]:
    """Keep on both sides only the rows whose key the other side has."""
    in_right = left.join(right, F.col(left_key) == right[right_key], "left_semi") if left_key != right_key else \
        left.join(right.select(right_key), left_key, "left_semi")
    in_left = right.join(left, right[right_key] == left[left_key], "left_semi") if left_key != right_key else \
        right.join(left.select(left_key), right_key, "left_semi")
    return in_right, in_left


def update(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Overwrite by key with the right side's non-null values; rows and columns of the left stay."""
    keys = _keys(on)
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    new = right.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in shared])
    types = dict(left.dtypes)
    joined = left.join(new, keys, "left")
    return joined.select(*[
        F.coalesce(F.col(f"__n_{c}").cast(types[c]), F.col(c)).alias(c) if c in shared else F.col(c) for c in left.columns
    ])


def add_by_key(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Numeric sum by key; null where a key or column is on one side only."""
    keys = _keys(on)
    mine, theirs = numeric_columns(a, keys), numeric_columns(b, keys)
    names = list(dict.fromkeys(mine + theirs))
    left = a.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in mine])
    right = b.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in theirs])
    joined = left.join(right, keys, "full")
    return joined.select(*keys, *[
        (F.col(f"__a_{c}") + F.col(f"__b_{c}")).alias(c) if c in mine and c in theirs
        else F.lit(None).cast("double").alias(c) for c in names
    ])


def merge_outer(left: DataFrame, right: DataFrame, on: str | Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full join; colliding columns get the suffixes."""
    keys = _keys(on)
    both = [c for c in right.columns if c in left.columns and c not in keys]
    return left.withColumnsRenamed({c: f"{c}{suffixes[0]}" for c in both}).join(
        right.withColumnsRenamed({c: f"{c}{suffixes[1]}" for c in both}), keys, "full")


def reindex(reference: DataFrame, table: DataFrame, on: str | Sequence[str], fill: float = 0) -> DataFrame:
    """The table's columns on exactly the reference's keys. Keys the table lacks get `fill`."""
    keys = _keys(on)
    values = [c for c in table.columns if c not in keys]
    marked = table.withColumn("__found", F.lit(True))
    joined = reference.select(*keys).join(marked, keys, "left")
    types = dict(table.dtypes)
    return joined.select(*keys, *[
        F.when(F.col("__found").isNull(), F.lit(fill).cast(types[c])).otherwise(F.col(c)).alias(c) for c in values
    ])


# Fixed value: source name of areas whose values are extrapolated.
EXTRAPOLATED = "EXTRAP"


def enrich_sources(areas: DataFrame, key: str,
                   sources: Mapping[str, Sequence[tuple[str, DataFrame | None, str]]]) -> DataFrame:
    """Survey tables joined to areas, with a flag column per group naming the source.

    `sources` maps a flag column to (source name, table or None, its key). A group
    without its tables adds no columns and is flagged as extrapolated.
    """
    out = areas
    for flag, tables in sources.items():
        present = [(name, df, k) for name, df, k in tables if df is not None]
        for _, df, k in present:
            out = extend(out, df, key, k)
        complete = len(present) == len(tables) and present
        out = out.withColumn(flag, F.lit(present[0][0] if complete else EXTRAPOLATED))
    return out


def stack_years(frames: Mapping[int | str, DataFrame], year_col: str = "Year", keep_year: bool = False) -> DataFrame:
    """Yearly tables stacked by column name, each with its year.

    A year column that a table has already is rewritten, unless `keep_year` says that it is
    the table's own time axis.
    """
    out = None
    for year, df in frames.items():
        part = df if keep_year and year_col in df.columns else with_year(df, year, year_col)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# Numbers that stand for the two future pseudo-years.
PSEUDO_YEARS = {"NearTerm": 9998, "LongTerm": 9999}


def with_year(df: DataFrame, year: int | str, year_col: str = "Year") -> DataFrame:
    return df.withColumn(year_col, F.lit(int(PSEUDO_YEARS.get(year, year))).cast("int"))


def difference(this: DataFrame, base: DataFrame, index: str | Sequence[str]) -> DataFrame:
    """`this` minus `base` on the numeric columns of both, by index.

    Base rows stay; where `this` lacks one it counts as 0. Rows only in `this` are dropped.
    """
    keys = _keys(index)
    shared = [c for c in numeric_columns(base, keys) if c in numeric_columns(this, keys)]
    newer = this.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in shared], F.lit(True).alias("__found"))
    joined = base.select(*keys, *shared).join(newer, keys, "left")
    return joined.select(*keys, *[
        (F.when(F.col("__found").isNull(), F.lit(0)).otherwise(F.col(f"__t_{c}")) - F.col(c)).alias(c) for c in shared
    ])


def feature_difference(this: DataFrame, base: DataFrame, index: Sequence[str], key: str, geometry: Sequence[str] = ()) -> DataFrame:
    """Difference of two layers joined to the base's key and geometry; the other index columns are dropped."""
    keys = list(dict.fromkeys([*index, key]))
    diff = difference(this, base, keys).drop(*[c for c in keys if c != key])
    return base.select(key, *geometry).join(diff, key, "left")


def compose_edges(*layers: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Union of edge tables; for the same pair the later layer's attributes win."""
    marked = [layer.withColumn("__layer", F.lit(i)) for i, layer in enumerate(layers)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    return first_per_key(union, [src, dst], [F.col("__layer")], last=True).drop("__layer")


def replace_rows(table: DataFrame, newer: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `newer` in place of the rows with the same key."""
    keys = _keys(on)
    return table.join(newer.select(*keys).distinct(), keys, "left_anti").unionByName(newer, allowMissingColumns=True)


def unresolved(wanted: DataFrame, found: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keys not found yet."""
    keys = _keys(on)
    return wanted.select(*keys).distinct().join(found.select(*keys), keys, "left_anti")


def merge_layers(layers: Mapping[str, DataFrame], tag: str | None = None, new_id: str | None = None,
                 order: Sequence[str] = ()) -> DataFrame:
    """Layers stacked by column name, with the layer's name as a column if `tag` is given.

    `new_id` names a running id from 1 over the merged rows in the order of the `order` columns.
    """
    parts = [df.withColumn(tag, F.lit(name)) if tag else df for name, df in layers.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return number_rows(merged, [F.col(c) for c in order], new_id, start=1) if new_id else merged


def clean_parcels(shapes: DataFrame, attributes: DataFrame, shape_key: str, attribute_key: str, key: str = "FOLIO",
                  geometry: str = "geometry", width: int = 12,
                  renames: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Parcels from shapes and an attribute table: one row per parcel, and the parcels' pieces.

    Shapes without geometry are dropped and the pieces of a parcel counted; ids of the
    attribute table are padded, its columns renamed and joined. The pieces stay rows of
    their own, so a parcel of very many pieces is no problem.
    """
    from arealens.functions.scalar import zero_pad

    pieces = shapes.where(F.col(geometry).isNotNull()).select(F.col(shape_key).alias(key), geometry)
    counted = pieces.groupBy(key).agg(F.count(F.lit(1)).alias("NumPieces"))
    table = attributes.withColumn(key, zero_pad(F.col(attribute_key), width))
    if attribute_key != key:
        table = table.drop(attribute_key)
    return extend(counted, table.withColumnsRenamed(dict(renames or {})), key, key), pieces

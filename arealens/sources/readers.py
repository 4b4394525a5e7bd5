"""Table readers with stated schemas and the null rule applied on reading."""

from __future__ import annotations

import csv
import gzip
import io
import itertools
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealens.functions.scalar import thousands
from arealens.skew import number_rows

UNPACKED_ROWS = 5_000

def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             columns: Sequence[str] | None = None, renames: Mapping[str, str] | None = None,
             with_separators: Sequence[str] = ()) -> DataFrame:
    """CSV files (plain or .gz, one or many) with a stated schema.

    `with_separators` names numeric columns written like "1,234"; they are read as text
    and parsed. Id columns declared as strings keep their leading zeros.
    """
    raw = T.StructType([
        T.StructField(f.name, T.StringType(), True) if f.name in with_separators else f for f in schema.fields
    ])
    df = spark.read.schema(raw).option("header", True).option("enforceSchema", False).csv(
        path if isinstance(path, str) else list(path))
    for name in with_separators:
        df = df.withColumn(name, thousands(F.col(name), schema[name].dataType.simpleString()))
    if columns:
        df = df.select(*columns)
    return df.withColumnsRenamed(dict(renames or {}))


def read_sniffed_csv(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None,
                     renames: Mapping[str, str] | None = None, with_separators: Sequence[str] = ()) -> DataFrame:
    """CSV files with a header, of which some may be gzip under any name, told by their first bytes.

    Plain files go through `read_csv` and are split. A gzip file cannot be split: one task
    holds its compressed bytes and unpacks them as a stream, a few thousand rows at a time.
    Fields follow the header's names; fields a file lacks are null, others are left out.
    """
    files = gzip_files(spark, path).select("path", "is_gzip").collect()  # names of files only
    plain, packed = [r["path"] for r in files if not r["is_gzip"]], [r["path"] for r in files if r["is_gzip"]]
    parts = [read_csv(spark, plain, schema, None, None, with_separators)] if plain else []
    if packed:
        names = schema.names

        def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = pa.schema([(n, pa.string()) for n in names])
            for batch in batches:
                for content in batch["content"]:
                    lines = csv.reader(io.TextIOWrapper(gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer())), "utf-8-sig", newline=""))
                    header = next(lines, [])
                    at = [header.index(n) if n in header else None for n in names]
                    while rows := list(itertools.islice(lines, UNPACKED_ROWS)):
                        yield pa.RecordBatch.from_arrays([pa.array([
                            (r[i] or None) if i is not None and i < len(r) else None for r in rows if r], pa.string()) for i in at], schema=kind)

        texts = spark.read.format("binaryFile").load(packed).select("content").mapInArrow(unpack, T.StructType([T.StructField(n, T.StringType()) for n in names]))
        parts.append(texts.select(*[
            (thousands(F.col(f.name), f.dataType.simpleString()) if f.name in with_separators else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in schema.fields]))
    if not parts:
        return spark.createDataFrame([], schema)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return (out.select(*columns) if columns else out).withColumnsRenamed(dict(renames or {}))


def gzip_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with a flag telling whether its content is gzip, whatever its name.

    Only `path`, `length` and two bytes leave the scan; contents are not collected.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", (F.hex(F.substring("content", 1, 2)) == "1F8B").alias("is_gzip"))


def read_harmonised(spark: SparkSession, paths_by_year: Mapping[int, str], schemas: Mapping[int, T.StructType],
                    renames: Mapping[int, Mapping[str, str]], columns: Sequence[str]) -> DataFrame:
    """Yearly files whose column names differ, brought to one set of names with a Year column."""
    out = None
    for year, path in paths_by_year.items():
        part = read_csv(spark, path, schemas[year], renames=renames.get(year, {}))
        part = part.select(*columns).withColumn("Year", F.lit(int(year)))
        out = part if out is None else out.unionByName(part)
    return out


def read_table(df: DataFrame, keep: Sequence[str] | str = "*", null_value: Any | Mapping[str, Any] = 0,
               skip_nulls: bool = False) -> DataFrame:
    """Projection with nulls replaced (a value, or one per column), or rows with nulls dropped."""
    columns = df.columns if keep == "*" else [keep] if isinstance(keep, str) else list(keep)
    out = df.select(*columns)
    if skip_nulls:
        return out.dropna()
    defaults = dict(null_value) if isinstance(null_value, Mapping) else {c: null_value for c in columns}
    types = dict(out.dtypes)
    filled = {
        c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
        for c, v in defaults.items()
        if c in types and v is not None and not types[c].startswith(("array", "map", "struct"))
    }
    return out.withColumns(filled) if filled else out


def geojson_features(df: DataFrame, text: str, properties: T.StructType, id_col: str = "ProcessID",
                     exclude: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """One row per feature of GeoJSON documents held in column `text`.

    Properties become columns, coordinates stay as text beside the geometry type, and a
    sequential id is given in the order of the `order` columns and the feature's place.
    """
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", properties),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])),
    ])))])
    parsed = df.select(*order, F.posexplode(F.from_json(text, schema)["features"]).alias("__pos", "f"))
    kept = [p.name for p in properties.fields if p.name not in exclude]
    rows = parsed.select(
        *[F.col(o).alias(f"__o_{o}") for o in order], "__pos",
        *[F.col("f.properties")[k].alias(k) for k in kept],
        F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"),
    )
    keys = [f"__o_{o}" for o in order] + ["__pos"]
    return number_rows(rows, [F.col(k) for k in keys], id_col).drop(*keys)


def json_table(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Rows from JSON objects of equally long lists, `{"a": [..], "b": [..]}`; `schema` gives the element types."""
    lists = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema.fields])
    parsed = df.select(F.from_json(text, lists).alias("j"))
    return parsed.select(F.inline(F.arrays_zip(*[F.col("j")[f.name].alias(f.name) for f in schema.fields])))


def screen_json(df: DataFrame, text: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows whose JSON parses, and rows whose JSON does not."""
    bad = "__corrupt"
    full = T.StructType(schema.fields + [T.StructField(bad, T.StringType())])
    parsed = df.withColumn("__j", F.from_json(text, full, {"columnNameOfCorruptRecord": bad}))
    broken = F.col(text).isNull() | F.col("__j").isNull() | F.col(f"__j.{bad}").isNotNull()
    good = parsed.where(~broken).select(*df.columns, *[F.col(f"__j.{f.name}").alias(f.name) for f in schema.fields])
    return good, parsed.where(broken).select(*df.columns)


def flatten_columns(df: DataFrame, separator: str = "/", most_keys: int = 200) -> DataFrame:
    """Nested struct fields and map entries as top-level columns named by their path.

    The keys of a map are looked up in the data, and make a column each, in order; a map with
    more than `most_keys` of them is refused. Keys that name a field already are refused too.
    """
    def keys_of(value: Column) -> list:
        seen = df.select(F.explode(F.map_keys(value)).alias("k")).distinct().limit(most_keys + 1).collect()
        if len(seen) > most_keys:
            raise ValueError(f"a map holds more than {most_keys} keys")
        return sorted(r["k"] for r in seen)

    def walk(value: Column, kind: T.DataType, path: tuple[str, ...]) -> Iterator[tuple[str, Column]]:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from walk(value.getField(f.name), f.dataType, (*path, f.name))
        elif isinstance(kind, T.MapType):
            for key in keys_of(value):
                yield from walk(F.try_element_at(value, F.lit(key)), kind.valueType, (*path, str(key)))
        else:
            yield separator.join(path), value

    found = [pair for f in df.schema.fields for pair in walk(F.col(f"`{f.name}`"), f.dataType, (f.name,))]
    names = [n for n, _ in found]
    double = sorted({n for n in names if names.count(n) > 1})
    if double:
        raise ValueError(f"paths that name two values: {double}")
    return df.select(*[value.alias(name) for name, value in found])


def promote_header(sheets: Sequence[DataFrame], order: str, renames: Mapping[str, str]) -> DataFrame:
    """Sheets stacked, the first row used for column names, renamed columns kept.

    The row order is the stated `order` column; one row reaches the driver.
    """
    stacked = sheets[0]
    for sheet in sheets[1:]:
        stacked = stacked.unionByName(sheet)
    columns = [c for c in stacked.columns if c != order]
    header = sheets[0].orderBy(order).limit(1).first().asDict()
    named = {c: str(header[c]) for c in columns}
    repeats = None
    for c in columns:
        same = F.col(c).eqNullSafe(F.lit(header[c]))
        repeats = same if repeats is None else repeats & same
    body = stacked.where(~repeats)
    return body.select(*[F.col(c).alias(renames[named[c]]) for c in columns if named[c] in renames])


def file_tag(path_column, first: int = 7, last: int = 9):
    """Tag in a file name: its `_`-separated parts 7 to 9, counted from 0."""
    name = F.element_at(F.split(path_column, "/"), -1)
    return F.array_join(F.slice(F.split(name, "_"), first + 1, last - first + 1), "_")


def tag_renames(tag: str, values: Sequence[str] = ("ON", "OFF", "TOTAL")) -> dict[str, str]:
    return {f"{v}_{tag}": v for v in values}


def matrix_to_long(estimates: DataFrame, errors: DataFrame, ids: Sequence[str] = ("Category", "Level"),
                   separator: str = "|") -> DataFrame:
    """Wide energy tables, columns named "Fuel|End_Use", as one long table of estimate, relative and standard error."""
    def long(df: DataFrame, value: str) -> DataFrame:
        cells = [c for c in df.columns if c not in ids]
        tall = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in cells]).unpivot(
            list(ids), cells, "__cell", value)
        parts = F.split("__cell", re.escape(separator))
        return tall.select(*ids, parts[0].alias("Fuel"), F.regexp_replace(parts[1], "[0-9]|-", "").alias("End_Use"), value)

    joined = long(estimates, "Estimate").join(long(errors, "RSE"), [*ids, "Fuel", "End_Use"])
    return joined.withColumn("SE", F.col("RSE") / 100 * F.col("Estimate"))


def list_tables(spark: SparkSession, pattern: str) -> list[str]:
    """Names of catalog tables and views that match a wildcard."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def stack_tables(spark: SparkSession, pattern: str) -> DataFrame:
    """All tables that match a wildcard, stacked by column name."""
    names = list_tables(spark, pattern)
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    out = spark.table(names[0])
    for name in names[1:]:
        out = out.unionByName(spark.table(name), allowMissingColumns=True)
    return out

"""Table writers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealens.functions.geometry import reproject


def write_table(df: DataFrame, path: str, overwrite: bool = False, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> None:
    """Write a table; existing output raises unless `overwrite`."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("append").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def to_points(df: DataFrame, x: str, y: str, from_epsg: int = 4326, to_epsg: int = 4326, out: str = "geometry") -> DataFrame:
    """Point column from coordinate columns, reprojected between any two of the known systems (4326, 3857, 6437, 2881)."""
    return df.withColumn(out, reproject(F.col(x), F.col(y), from_epsg, to_epsg))


# --- published sets -------------------------------------------------------

MANIFESTS, DATA = "manifests", "data"


def publish(tables: Mapping[str, DataFrame], path: str, year_col: str = "Year", keep: int = 2) -> None:
    """Publish tables as one set, each replacing only the years it holds; tables without years are replaced whole.

    Every table is written into a folder of its own that nothing refers to yet. Then one small
    file, the manifest, is written beside the earlier ones and renamed into place: it
    names, for each table and year, the folder that holds it. Readers take the manifest with the
    highest number, so they see all of a set or none of it, also if the driver is lost between
    any two steps. Nothing published is rewritten or copied. If another set was published
    meanwhile, this one is refused. The last `keep` manifests and their folders stay.
    """
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    root, run = path.rstrip("/"), uuid.uuid4().hex
    number, current = _latest(spark, root)
    following = {name: dict(parts) for name, parts in current.items()}
    for name, df in tables.items():
        folder = f"{DATA}/{run}/{name}"
        yearly = year_col in df.columns
        (df.write.partitionBy(year_col) if yearly and len(df.columns) > 1 else df.write).parquet(f"{root}/{folder}")
        if not yearly:
            following[name] = {"schema": df.schema.json(), "years": None, "parts": {folder: None}}
            continue
        years = [r[0] for r in spark.read.schema(df.schema).parquet(f"{root}/{folder}").select(year_col).distinct().collect()]
        before = following.get(name)
        fields = list(df.schema.fields)
        if before is None or before["years"] != year_col:
            before = {"parts": {}}
        elif any(set(ys) - set(years) for ys in before["parts"].values()):
            # Columns that only years which stay have are kept.
            fields += [f for f in T.StructType.fromJson(json.loads(before["schema"])).fields if f.name not in df.columns]
        left = {f: [y for y in ys if y not in years] for f, ys in before["parts"].items()}
        following[name] = {"schema": T.StructType(fields).json(), "years": year_col, "parts": {**{f: ys for f, ys in left.items() if ys}, folder: years}}
    _write_manifest(spark, root, number + 1, following)
    _clean(spark, root, keep)


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables of the published set."""
    return sorted(_latest(spark, path.rstrip("/"))[1])


def read_published(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the published set. Columns that a year lacks are null there; a column keeps one type over the years."""
    root = path.rstrip("/")
    entry = _latest(spark, root)[1].get(name)
    if entry is None:
        raise ValueError(f"{name} is not published under {path}")
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    out = None
    for folder, years in entry["parts"].items():
        part = spark.read.schema(schema).parquet(f"{root}/{folder}")
        if years is not None:
            column, known = F.col(entry["years"]), [y for y in years if y is not None]
            part = part.where((column.isin(known) if known else F.lit(False)) | (column.isNull() if None in years else F.lit(False)))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out.select(*schema.names)


def _hadoop(spark: SparkSession, place: str):  # noqa: ANN202
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _listed_manifests(spark: SparkSession, root: str) -> list[int]:
    files, where = _hadoop(spark, f"{root}/{MANIFESTS}")
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(spark.read.option("wholetext", True).text(f"{root}/{MANIFESTS}/{number:012d}.json").first()[0])


def _latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    numbers = _listed_manifests(spark, root)
    return (numbers[-1], _manifest(spark, root, numbers[-1])) if numbers else (0, {})


def _write_manifest(spark: SparkSession, root: str, number: int, content: dict) -> None:
    files, final = _hadoop(spark, f"{root}/{MANIFESTS}/{number:012d}.json")
    _, draft = _hadoop(spark, f"{root}/{MANIFESTS}/draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    # A rename does not replace a file that is there, so of two writers one is refused.
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"another set was published under {root} meanwhile")


def _clean(spark: SparkSession, root: str, keep: int) -> None:
    """Remove manifests before the last `keep`, and folders that only those named."""
    numbers = _listed_manifests(spark, root)
    old, kept = numbers[:-keep], numbers[-keep:]
    used = {f for n in kept for entry in _manifest(spark, root, n).values() for f in entry["parts"]}
    gone = {f for n in old for entry in _manifest(spark, root, n).values() for f in entry["parts"]} - used
    for place in [*(f"{root}/{f}" for f in sorted(gone)), *(f"{root}/{MANIFESTS}/{n:012d}.json" for n in old)]:
        files, where = _hadoop(spark, place)
        files.delete(where, True)

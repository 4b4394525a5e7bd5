"""Stand-in tables: parcels, zones, skims, streets and cells made from the supplied parquet tables.

The SQL below is read by Spark to build the inputs of the registered queries, and is put
in front of their check SQL as common table expressions. It uses no Spark-only syntax.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {
    # points, zones and areas on a square of 1000 by 1000
    "v_points": """SELECT c_custkey AS id, CAST((c_custkey * 7919) % 1000 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS x,
        CAST((c_custkey * 104729) % 1000 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS y, c_acctbal AS w, c_mktsegment AS cls FROM customer""",
    "v_zones": """SELECT n_nationkey AS zone, (n_nationkey % 5) * 200 AS xmin, CAST(floor(n_nationkey / 5) AS INT) * 200 AS ymin,
        (n_nationkey % 5) * 200 + 200 AS xmax, CAST(floor(n_nationkey / 5) AS INT) * 200 + 200 AS ymax FROM nation""",
    "v_areas": """SELECT r_regionkey AS area, r_regionkey * 120 AS xmin, r_regionkey * 100 AS ymin,
        r_regionkey * 120 + 520 AS xmax, r_regionkey * 100 + 600 AS ymax FROM region""",
    "v_targets": """SELECT s_suppkey AS target, CAST((s_suppkey * 613) % 1000 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS tx,
        CAST((s_suppkey * 271) % 1000 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS ty, s_nationkey AS grp FROM supplier""",
    "v_lines": """SELECT s_suppkey AS line, s_nationkey AS kind, CAST((s_suppkey * 613) % 1000 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS x1,
        CAST((s_suppkey * 271) % 1000 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS y1,
        CAST((s_suppkey * 613) % 1000 AS DOUBLE) + CAST(0.25 AS DOUBLE) + CAST(10 + s_suppkey % 37 AS DOUBLE) AS x2,
        CAST((s_suppkey * 271) % 1000 AS DOUBLE) + CAST(0.25 AS DOUBLE) + CAST(5 + s_suppkey % 23 AS DOUBLE) AS y2 FROM supplier""",
    # parcels
    "v_parcels": """SELECT o_orderkey AS folio, c_nationkey AS zone, CAST(o_custkey % 103 AS INT) AS lu,
        CASE WHEN o_orderkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS living, o_totalprice * 2 AS land,
        CAST(o_custkey % 4 AS INT) AS units, CAST(o_orderkey % 11 AS INT) AS jobs, CAST(year(o_orderdate) AS INT) AS yr,
        o_custkey AS owner FROM orders JOIN customer ON o_custkey = c_custkey""",
    # origin-destination skims and zone activity
    "v_skim": """SELECT l_suppkey AS o, l_partkey % (SELECT count(*) FROM supplier) AS d, min(l_quantity) * 1.5 AS minutes,
        CAST(sum(l_linenumber) AS BIGINT) AS trips, max(l_quantity) AS dist FROM lineitem GROUP BY 1, 2""",
    "v_zone_data": """SELECT s_suppkey AS id, CAST((s_suppkey * 37) % 50 AS BIGINT) AS hh,
        CAST((s_suppkey * 91) % 120 AS BIGINT) AS jobs FROM supplier""",
    "v_flag_skim": """SELECT l_returnflag AS flag, l_suppkey AS o, l_partkey % (SELECT count(*) FROM supplier) AS d,
        min(l_quantity) - 1 AS minutes, CAST(count(*) AS BIGINT) AS trips FROM lineitem GROUP BY 1, 2, 3""",
    # streets
    "v_edges": """SELECT c_custkey AS src, (c_custkey + 1) % (SELECT count(*) FROM customer) AS dst,
        CAST(1 + c_custkey % 13 AS DOUBLE) AS cost FROM customer
        UNION ALL SELECT c_custkey, (c_custkey * 31 + 7) % (SELECT count(*) FROM customer),
        CAST(2 + c_custkey % 17 AS DOUBLE) FROM customer""",
    # cells of a raster
    "v_cells": """SELECT CAST(floor(o_orderkey / 50) AS INT) AS row_no, CAST(o_orderkey % 50 AS INT) AS col_no,
        CASE WHEN o_custkey % 17 = 0 THEN 127 ELSE CAST(o_custkey % 101 AS INT) END AS val,
        CAST(floor(floor(o_orderkey / 50) / 6) AS INT) * 10 + CAST(floor((o_orderkey % 50) / 5) AS INT) AS part,
        CASE WHEN o_custkey % 9 = 0 THEN 1 ELSE 0 END AS masked FROM orders""",
}


_OPENED: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table. Opening one reads file footers, so each is opened once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _OPENED:
        _OPENED[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _OPENED[key]


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A SELECT over the base tables; only the tables it names are opened."""
    for name in BASE_TABLES:
        if name in sql:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table as a DataFrame."""
    return run_sql(spark, sf_dir, VIEWS[name])


def with_views(names: str, body: str) -> str:
    """Check SQL with the named stand-ins in front."""
    parts = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names.split())
    rest = body.strip()
    return f"WITH {parts},\n{rest[5:]}" if rest.upper().startswith("WITH ") else f"WITH {parts}\n{rest}"

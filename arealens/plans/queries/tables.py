"""Attribute joins, patches, updates, stacks and differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.operators import joins as op
from arealens.operators.network import skim_edges
from arealens.plans.queries import register, rounded
from arealens.plans.standins import run_sql, table, view, with_views
from arealens.specs import FeatureSpec, TableSpec

YEARLY = "SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS yr, sum(o_totalprice) AS price, count(*) AS n FROM orders GROUP BY 1, 2"
WHOLE = "SELECT o_custkey, sum(o_totalprice) AS price, count(*) AS n FROM orders GROUP BY 1"
# Tables of two or three periods, which together hold every order.
HALVES = """SELECT o_custkey, CASE WHEN year(o_orderdate) < 1998 THEN 'early' ELSE 'late' END AS period,
 sum(o_totalprice) AS price, count(*) AS n FROM orders GROUP BY 1, 2"""
THIRDS = """SELECT o_custkey, CASE WHEN year(o_orderdate) < 1997 THEN 'early' WHEN year(o_orderdate) < 1999 THEN 'middle' ELSE 'late' END AS period,
 sum(o_totalprice) AS price, count(*) AS n FROM orders GROUP BY 1, 2"""


def _yearly(spark, sf):
    return run_sql(spark, sf, YEARLY)


def _year(spark, sf, y):
    return _yearly(spark, sf).where(F.col("yr") == y).drop("yr")


def _whole(spark, sf):
    return run_sql(spark, sf, WHOLE)


def _period(spark, sf, name, periods=HALVES):
    return run_sql(spark, sf, periods).where(F.col("period") == name).drop("period")


@register("extend_table", """
SELECT c_custkey, c_acctbal, s.n AS n_orders, round(s.p, 2) AS price FROM customer LEFT JOIN
 (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS p FROM orders GROUP BY 1) s ON c_custkey = o_custkey""")
def extend_table(spark, sf):
    sums = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("price"))
    out = op.extend(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), sums, "c_custkey", "o_custkey")
    return out.withColumn("price", F.round("price", 2))


@register("attribute_join", f"""
SELECT c_custkey, c_acctbal, coalesce(round(price, 2), NULL) AS price_all, n AS n_all
FROM customer LEFT JOIN ({WHOLE}) ON c_custkey = o_custkey""")
def attribute_join(spark, sf):
    right = _whole(spark, sf).withColumn("c_acctbal", F.lit(-1.0))
    out = op.join_attributes(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), right, "c_custkey", "o_custkey",
                             None, {"price": "price_all", "n": "n_all"})
    return out.withColumn("price_all", F.round("price_all", 2))


@register("spec_joins", f"""
WITH y AS ({HALVES}) SELECT c_custkey, a.n AS n_early, b.n AS n_late FROM customer
LEFT JOIN (SELECT * FROM y WHERE period = 'early') a ON c_custkey = a.o_custkey LEFT JOIN (SELECT * FROM y WHERE period = 'late') b ON c_custkey = b.o_custkey""")
def spec_joins(spark, sf):
    layers = {"Parcels": table(spark, sf, "customer").select("c_custkey")}
    tables = {"Econ_parcels": _period(spark, sf, "early"), "Walk_PARCELS": _period(spark, sf, "late"), "Other_blocks": _whole(spark, sf)}
    specs = [TableSpec("Econ_parcels", "o_custkey", ("n",), {"n": "n_early"}), TableSpec("Walk_PARCELS", "o_custkey", ("n",), {"n": "n_late"}),
             TableSpec("Other_blocks", "o_custkey")]
    return op.join_specs(layers, tables, [FeatureSpec("Parcels", "c_custkey")], specs)["Parcels"]


@register("multi_merge_suffix", f"""
WITH y AS ({THIRDS}), a AS (SELECT * FROM y WHERE period = 'early'), b AS (SELECT * FROM y WHERE period = 'middle'), c AS (SELECT * FROM y WHERE period = 'late')
SELECT o_custkey, a.n AS n_A, b.n AS n_B, c.n AS n_C, round(a.price, 2) AS price_A, round(b.price, 2) AS price_B, round(c.price, 2) AS price_C
FROM a FULL JOIN b USING (o_custkey) FULL JOIN c USING (o_custkey)""")
def multi_merge_suffix(spark, sf):
    return rounded(op.merge_many([_period(spark, sf, p, THIRDS) for p in ("early", "middle", "late")], "o_custkey", ("_A", "_B", "_C"), "full"), 2)


@register("merge_inner", f"""
WITH y AS ({HALVES}), a AS (SELECT * FROM y WHERE period = 'early'), b AS (SELECT * FROM y WHERE period = 'late')
SELECT o_custkey, a.n AS n_A, b.n AS n_B, round(a.price, 2) AS price_A, round(b.price, 2) AS price_B FROM a JOIN b USING (o_custkey)""")
def merge_inner(spark, sf):
    return rounded(op.merge_many([_period(spark, sf, p) for p in ("early", "late")], "o_custkey", ("_A", "_B")), 2)


@register("local_regional_patch", f"""
WITH y AS ({HALVES}), l AS (SELECT o_custkey AS maz, n AS hh FROM y WHERE period = 'early'),
 r AS (SELECT o_custkey AS maz, n AS hh, price AS enroll FROM y WHERE period = 'late')
SELECT maz, l.hh, round(r.enroll, 2) AS enroll FROM l JOIN r USING (maz)
UNION ALL SELECT maz, hh, round(enroll, 2) FROM r WHERE maz NOT IN (SELECT maz FROM l)""")
def local_regional_patch(spark, sf):
    local = _period(spark, sf, "early").select(F.col("o_custkey").alias("maz"), F.col("n").alias("hh"))
    regional = _period(spark, sf, "late").select(F.col("o_custkey").alias("maz"), F.col("n").alias("hh"), F.col("price").alias("enroll"))
    return rounded(op.patch(local, regional, "maz"), 2)


@register("key_reconcile", f"""
WITH y AS ({HALVES}), a AS (SELECT * FROM y WHERE period = 'early'), b AS (SELECT * FROM y WHERE period = 'late')
SELECT 'shapes' AS side, o_custkey AS k, n FROM a WHERE o_custkey IN (SELECT o_custkey FROM b)
UNION ALL SELECT 'table', o_custkey, n FROM b WHERE o_custkey IN (SELECT o_custkey FROM a)""")
def key_reconcile(spark, sf):
    left, right = op.reconcile(_period(spark, sf, "early"), _period(spark, sf, "late").withColumnRenamed("o_custkey", "key"), "o_custkey", "key")
    return left.select(F.lit("shapes").alias("side"), F.col("o_custkey").alias("k"), "n").unionByName(
        right.select(F.lit("table").alias("side"), F.col("key").alias("k"), "n"))


@register("key_update", f"""
SELECT c_custkey, coalesce(round(price, 2), c_acctbal) AS c_acctbal, c_mktsegment FROM customer
LEFT JOIN ({WHOLE}) ON c_custkey = o_custkey""")
def key_update(spark, sf):
    newer = _whole(spark, sf).select(F.col("o_custkey").alias("c_custkey"), F.round("price", 2).alias("c_acctbal"))
    return op.update(table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), newer, "c_custkey")


@register("key_add", f"""
WITH y AS ({HALVES}), a AS (SELECT * FROM y WHERE period = 'early'), b AS (SELECT * FROM y WHERE period = 'late')
SELECT o_custkey, round(a.price + b.price, 2) AS price, a.n + b.n AS n, CAST(NULL AS DOUBLE) AS extra FROM a FULL JOIN b USING (o_custkey)""")
def key_add(spark, sf):
    a = _period(spark, sf, "early").withColumn("extra", F.lit(1))
    return rounded(op.add_by_key(a, _period(spark, sf, "late"), "o_custkey"), 2)


@register("reindex_fill", f"""
SELECT c_custkey, coalesce(round(price, 2), 0.0) AS price, coalesce(n, 0) AS n FROM customer
LEFT JOIN ({WHOLE}) ON c_custkey = o_custkey""")
def reindex_fill(spark, sf):
    t = _whole(spark, sf).withColumnRenamed("o_custkey", "c_custkey")
    return rounded(op.reindex(table(spark, sf, "customer"), t, "c_custkey"), 2)


@register("lookup_recode", with_views("v_parcels", """
SELECT folio, lu AS "DOR_UC", CASE WHEN lu IN (0, 10, 40, 70, 80) THEN 'Vacant/Undeveloped' WHEN lu IN (1, 2, 4) THEN 'Single-family'
 WHEN lu = 3 OR lu BETWEEN 5 AND 8 THEN 'Multifamily' WHEN lu BETWEEN 11 AND 16 OR lu IN (21, 22) OR lu BETWEEN 25 AND 34 OR lu = 39 THEN 'Commercial/Retail'
 WHEN lu BETWEEN 17 AND 19 OR lu IN (23, 24) THEN 'Office' WHEN lu BETWEEN 41 AND 49 THEN 'Industrial/Manufacturing' ELSE 'Other' END AS "GN_VA_LU",
 CASE WHEN lu <= 9 OR lu >= 100 THEN 'RES' ELSE 'NRES' END AS "RES_NRES" FROM v_parcels"""))
def lookup_recode(spark, sf):
    from arealens.sources.lookups import land_uses

    parcels = view(spark, sf, "v_parcels").select("folio", F.col("lu").alias("DOR_UC"))
    # the lookup has 104 rows
    return op.lookup_left(parcels, F.broadcast(land_uses(spark)), "DOR_UC", {"DOR_UC": 999}).select("folio", "DOR_UC", "GN_VA_LU", "RES_NRES")


@register("source_flags", f"""
SELECT c_custkey, n AS jobs, 'LODES' AS "JOBS_SRC", 'EXTRAP' AS "DEM_SRC" FROM customer
LEFT JOIN ({WHOLE}) ON c_custkey = o_custkey""")
def source_flags(spark, sf):
    jobs = _whole(spark, sf).select("o_custkey", F.col("n").alias("jobs"))
    return op.enrich_sources(table(spark, sf, "customer").select("c_custkey"), "c_custkey",
                             {"JOBS_SRC": [("LODES", jobs, "o_custkey")], "DEM_SRC": [("ACS", None, "o_custkey")]})


@register("stack_years", f"""
SELECT o_custkey, n, CASE WHEN yr = (SELECT max(year(o_orderdate)) FROM orders) THEN 9998 ELSE yr END AS Year FROM ({YEARLY})""")
def stack_years(spark, sf):
    # Every year of the orders; the last one stands for the near term.
    first, last = run_sql(spark, sf, "SELECT min(year(o_orderdate)), max(year(o_orderdate)) FROM orders").first()
    frames = {"NearTerm" if y == last else y: _year(spark, sf, y).drop("price") for y in range(first, last + 1)}
    return op.stack_years(frames)


BY_SEGMENT = """SELECT c_nationkey, c_mktsegment, CAST(year(o_orderdate) AS INT) AS yr, count(*) AS n, sum(o_totalprice) AS price
 FROM orders JOIN customer ON o_custkey = c_custkey WHERE {cond} GROUP BY 1, 2, 3"""


@register("table_difference", f"""
WITH b AS (SELECT o_custkey, yr, price, n FROM ({YEARLY}) WHERE yr = 1996), t AS (SELECT o_custkey, price, n FROM ({YEARLY}) WHERE yr = 1997)
SELECT b.o_custkey, coalesce(t.n, 0) - b.n AS n, round(coalesce(t.price, 0) - b.price, 2) AS price FROM b LEFT JOIN t USING (o_custkey)""")
def table_difference(spark, sf):
    base = _year(spark, sf, 1996).withColumn("label", F.lit("a"))
    return rounded(op.difference(_year(spark, sf, 1997), base, "o_custkey"), 2)


@register("feature_difference", f"""
WITH b AS (SELECT o_custkey, price FROM ({YEARLY}) WHERE yr = 1996), t AS (SELECT o_custkey, price FROM ({YEARLY}) WHERE yr = 1997)
SELECT b.o_custkey, round(coalesce(t.price, 0) - b.price, 2) AS price FROM b LEFT JOIN t USING (o_custkey)""")
def feature_difference(spark, sf):
    this, base = (_year(spark, sf, y).drop("n").withColumn("Name", F.lit("x")) for y in (1997, 1996))
    return rounded(op.feature_difference(this, base, ["Name"], "o_custkey"), 2)


@register("trend_by_year", f"""
SELECT c_nationkey, c_mktsegment, yr AS Year, n, round(price, 2) AS price FROM ({BY_SEGMENT.format(cond="true")})""")
def trend_by_year(spark, sf):
    # One table for each year of the orders, made on its own.
    first, last = run_sql(spark, sf, "SELECT min(year(o_orderdate)), max(year(o_orderdate)) FROM orders").first()
    tables = {y: run_sql(spark, sf, BY_SEGMENT.format(cond=f"year(o_orderdate) = {y}")).drop("yr") for y in range(first, last + 1)}
    return rounded(op.stack_years(tables), 2)


@register("edge_compose", with_views("v_flag_skim", """
WITH s AS (SELECT *, CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS layer FROM v_flag_skim)
SELECT o AS src, d AS dst, minutes FROM (SELECT *, row_number() OVER (PARTITION BY o, d ORDER BY layer DESC) AS rn FROM s) WHERE rn = 1"""))
def edge_compose(spark, sf):
    skim = view(spark, sf, "v_flag_skim").select("flag", F.col("o").alias("src"), F.col("d").alias("dst"), "minutes")
    return op.compose_edges(*[skim.where(F.col("flag") == f).drop("flag") for f in ("A", "N", "R")])


@register("skim_to_edges", """
WITH e AS (SELECT least(l_suppkey, l_partkey) AS a, greatest(l_suppkey, l_partkey) AS b, l_quantity AS minutes,
  row_number() OVER (PARTITION BY least(l_suppkey, l_partkey), greatest(l_suppkey, l_partkey) ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn FROM lineitem)
SELECT a AS src, b AS dst, minutes FROM e WHERE rn = 1 UNION ALL SELECT b, a, minutes FROM e WHERE rn = 1 AND a <> b""")
def skim_to_edges(spark, sf):
    return skim_edges(table(spark, sf, "lineitem").withColumnRenamed("l_quantity", "minutes"), "l_suppkey", "l_partkey", ["minutes"],
                      ["l_orderkey", "l_linenumber", "minutes"], directed=False)


@register("replace_and_unresolved", f"""
WITH y AS ({HALVES}), a AS (SELECT o_custkey, n FROM y WHERE period = 'early'), b AS (SELECT o_custkey, n FROM y WHERE period = 'late')
SELECT 'table' AS part, o_custkey, n FROM a WHERE o_custkey NOT IN (SELECT o_custkey FROM b) UNION ALL SELECT 'table', o_custkey, n FROM b
UNION ALL SELECT 'open', c_custkey, 0 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM a UNION SELECT o_custkey FROM b)""")
def replace_and_unresolved(spark, sf):
    a, b = (_period(spark, sf, p).drop("price") for p in ("early", "late"))
    both = op.replace_rows(a, b, "o_custkey")
    wanted = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    left = op.unresolved(wanted, both, "o_custkey").withColumn("n", F.lit(0).cast("bigint"))
    return both.select(F.lit("table").alias("part"), "o_custkey", "n").unionByName(left.select(F.lit("open").alias("part"), "o_custkey", "n"))


@register("clean_parcels", """
SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS "FOLIO", count(*) AS "NumPieces", c_acctbal AS "JV" FROM orders
JOIN customer ON o_custkey = c_custkey GROUP BY 1, 3""")
def clean_parcels(spark, sf):
    shapes = table(spark, sf, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("PARCELNO"),
        F.struct(F.col("o_totalprice").alias("x"), F.col("o_orderkey").cast("double").alias("y")).alias("geometry"))
    attributes = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("PARCEL_ID"), "c_acctbal")
    parcels, _ = op.clean_parcels(shapes, attributes, "PARCELNO", "PARCEL_ID", renames={"c_acctbal": "JV"})
    return parcels

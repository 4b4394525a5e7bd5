"""Shortest paths, reach, centrality and components."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.operators import network as op
from arealens.plans.queries import register, rounded
from arealens.plans.standins import run_sql, table, view, with_views
from arealens.session import shelved, tasks_for

CUTOFF = 14.0
# All costs up to the cutoff from every node, by recursion over whole paths.
PATHS = f"""RECURSIVE walk(origin, node, cost) AS (SELECT DISTINCT src, src, CAST(0 AS DOUBLE) FROM v_edges
  UNION SELECT w.origin, e.dst, w.cost + e.cost FROM walk w JOIN v_edges e ON w.node = e.src WHERE w.cost + e.cost <= {CUTOFF}),
 od AS (SELECT origin, node, min(cost) AS cost FROM walk GROUP BY 1, 2)"""


def recursive(names: str, body: str) -> str:
    return with_views(names, "WITH " + body).replace("WITH ", "WITH RECURSIVE ", 1).replace("RECURSIVE walk(", "walk(", 1)


def _nodes(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("node"))


@register("od_cost", recursive("v_edges", f"{PATHS} SELECT origin, node, cost FROM od"))
def od_cost(spark, sf):
    return op.od_cost(view(spark, sf, "v_edges"), _nodes(spark, sf), CUTOFF)


@register("od_cost_between", recursive("v_edges", f"""{PATHS} SELECT origin, node, cost FROM od
 WHERE origin IN (SELECT s_suppkey FROM supplier) AND node IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')"""))
def od_cost_between(spark, sf):
    zones = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"))
    ends = table(spark, sf, "part").where("p_type = 'ECONOMY'").select(F.col("p_partkey").alias("node"))
    return op.od_cost(view(spark, sf, "v_edges"), zones, CUTOFF, destinations=ends)


@register("od_cost_carry", recursive("v_edges", f"""RECURSIVE walk(origin, node, cost, len) AS (SELECT DISTINCT src, src, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM v_edges
  UNION SELECT w.origin, e.dst, w.cost + e.cost, w.len + 100 + e.src % 7 FROM walk w JOIN v_edges e ON w.node = e.src WHERE w.cost + e.cost <= {CUTOFF}),
 r AS (SELECT *, row_number() OVER (PARTITION BY origin, node ORDER BY cost, len) AS rn FROM walk)
SELECT origin, node, cost, len FROM r WHERE rn = 1"""))
def od_cost_carry(spark, sf):
    edges = view(spark, sf, "v_edges").withColumn("len", (100 + F.col("src") % 7).cast("double"))
    return op.od_cost(edges, _nodes(spark, sf), CUTOFF, carry=["len"])


# Towards facilities, so over edges walked backwards.
BACK = f"""RECURSIVE walk(origin, node, cost) AS (SELECT s_suppkey, s_suppkey, CAST(0 AS DOUBLE) FROM supplier
  UNION SELECT w.origin, e.src, w.cost + e.cost FROM walk w JOIN v_edges e ON w.node = e.dst WHERE w.cost + e.cost <= {CUTOFF}),
 od AS (SELECT origin, node, min(cost) AS cost FROM walk GROUP BY 1, 2),
 ed AS (SELECT DISTINCT src, dst, cost FROM v_edges),
 reach AS (SELECT od.origin AS facility, src, dst, od.cost AS from_cost, least(od.cost + ed.cost, {CUTOFF}) AS to_cost FROM od JOIN ed ON od.node = ed.dst WHERE od.cost < {CUTOFF})"""


def _facilities(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"))


@register("reach_overlap", recursive("v_edges", f"{BACK} SELECT facility, src, dst, from_cost, to_cost FROM reach"))
def reach_overlap(spark, sf):
    return op.reach_edges(view(spark, sf, "v_edges"), _facilities(spark, sf), CUTOFF)


@register("reach_non_overlap", recursive("v_edges", f"""{BACK}
SELECT facility, src, dst, from_cost, to_cost FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY from_cost, facility, to_cost) AS rn FROM reach) WHERE rn = 1"""))
def reach_non_overlap(spark, sf):
    return op.reach_edges(view(spark, sf, "v_edges"), _facilities(spark, sf), CUTOFF, overlap=False)


@register("reach_rings", recursive("v_edges", f"""{BACK}
SELECT node, min(cost) AS cost, CASE WHEN min(cost) <= 7 THEN 7.0 ELSE 14.0 END AS ring FROM od GROUP BY 1""").replace("7.0 ELSE 14.0 END", "CAST(7 AS DOUBLE) ELSE CAST(14 AS DOUBLE) END"))
def reach_rings(spark, sf):
    return op.reach_rings(view(spark, sf, "v_edges"), _facilities(spark, sf), [7.0, CUTOFF])


@register("centrality", recursive("v_edges", f"""{PATHS},
 s AS (SELECT node, count(*) AS n, sum(cost) AS len FROM od GROUP BY 1), c AS (SELECT *, (n - 1) / nullif(len, 0) AS cen FROM s)
SELECT node AS "Node", n AS "N", round(cen, 6) AS centrality, round(1 / nullif(cen, 0), 6) AS "AvgLength", round(n * cen, 6) AS "CentIdx" FROM c""").replace(
    'round(n * cen, 6) AS "CentIdx"', 'round(n / nullif(1 / nullif(cen, 0), 0), 6) AS "CentIdx"'))
def centrality(spark, sf):
    return rounded(op.network_centrality(view(spark, sf, "v_edges"), CUTOFF), 6)


# Stops ride on lines flagged R or N, zones reach stops on those flagged A; stop numbers are shifted.
SKIM_CUT = 3.0
LEGS = """SELECT l_suppkey AS o, l_partkey % (SELECT count(*) FROM supplier) AS d, min(l_quantity) AS minutes, l_returnflag AS flag FROM lineitem GROUP BY 1, 2, 4"""


@register("full_skim", f"""
WITH RECURSIVE legs AS ({LEGS}), ride AS (SELECT o + 100000 AS src, d + 100000 AS dst, min(minutes) AS minutes FROM legs WHERE flag <> 'A' GROUP BY 1, 2),
 acc AS (SELECT o AS src, d + 100000 AS dst, minutes FROM legs WHERE flag = 'A'),
 e AS (SELECT * FROM ride UNION ALL SELECT * FROM acc UNION ALL SELECT dst, src, minutes FROM acc),
 walk(origin, node, cost) AS (SELECT s_suppkey, s_suppkey, CAST(0 AS DOUBLE) FROM supplier WHERE s_suppkey IN (SELECT src FROM acc)
  UNION SELECT w.origin, e.dst, w.cost + e.minutes FROM walk w JOIN e ON w.node = e.src WHERE w.cost + e.minutes <= {SKIM_CUT})
SELECT origin AS "OName", node AS "DName", min(cost) AS "Minutes" FROM walk WHERE node < 100000 GROUP BY 1, 2""")
def full_skim(spark, sf):
    zones = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"))
    with tasks_for(spark, table(spark, sf, "lineitem").count()):
        legs = shelved(run_sql(spark, sf, LEGS))
        ride = legs.where("flag <> 'A'").groupBy((F.col("o") + 100000).alias("OName"), (F.col("d") + 100000).alias("DName")).agg(F.min("minutes").alias("Minutes"))
        acc = legs.where("flag = 'A'").select(F.col("o").alias("OName"), (F.col("d") + 100000).alias("DName"), F.col("minutes").alias("Minutes"))
        return op.full_skim(ride, acc, zones, zones, SKIM_CUT, ["Minutes"])


@register("component_labels", """
SELECT node, min(node) OVER (PARTITION BY conv) AS component FROM
 (SELECT conv_id * 1000 + turn AS node, conv_id AS conv FROM conversations)""")
def component_labels(spark, sf):
    return op.components(_turns(spark, sf))


def _turns(spark, sf):
    """Turns of a conversation as a chain; a one-turn conversation is a loop."""
    rows = table(spark, sf, "conversations")
    chain = rows.select((F.col("conv_id") * 1000 + F.greatest(F.col("turn") - 1, F.lit(0))).alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("dst"))
    return chain


@register("trim_components", """
WITH n AS (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1)
SELECT o_orderkey + 1000000000 AS src, o_custkey AS dst FROM orders JOIN n USING (o_custkey) WHERE k + 1 >= 12 + 1""")
def trim_components(spark, sf):
    edges = table(spark, sf, "orders").select((F.col("o_orderkey") + 1000000000).alias("src"), F.col("o_custkey").alias("dst"))
    return op.trim_components(edges, 12)


@register("network_by_year", recursive("v_edges", f"""{BACK}, near AS (SELECT node, min(cost) AS cost FROM od GROUP BY 1)
SELECT node, cost, 'q3' AS version, Year FROM near, (SELECT 2014 AS Year UNION ALL SELECT 2015 UNION ALL SELECT 9998)"""))
def network_by_year(spark, sf):
    near = op.od_cost(view(spark, sf, "v_edges").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "cost"), _facilities(spark, sf), CUTOFF)
    solved = near.groupBy("node").agg(F.min("cost").alias("cost")).withColumn("version", F.lit("q3"))
    return op.results_by_year(solved, {2014: "q3", 2015: "q3", 2016: "q1", 9998: "q3"})

"""Summary, diversity, crosswalk, unit and indicator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.functions import indicators as ind
from arealens.functions import scalar as sc
from arealens.operators import aggregate as op
from arealens.plans.queries import register, rounded
from arealens.plans.standins import run_sql, table, view, with_views
from arealens.predicates import And, Comp, Or, any_of, area_criteria, span
from arealens.skew import attach_scalars, exact_median, first_per_key, number_rows
from arealens.specs import MEDIAN, AggCol, Col, Consolidation, DomainCol, Melt

ORDERS = """SELECT o_orderkey, c_nationkey, n_regionkey, c_mktsegment, o_orderpriority, o_orderstatus, o_totalprice,
  CAST(year(o_orderdate) AS INT) AS yr, CASE WHEN o_totalprice > 300000 THEN NULL ELSE c_acctbal END AS bal
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def _orders(spark, sf):
    return run_sql(spark, sf, ORDERS)


# --- spec-driven summaries ------------------------------------------------

@register("summarize_wide", f"""
SELECT c_nationkey AS nation, count(*) AS n_orders, round(sum(o_totalprice), 2) AS o_totalprice,
  round(avg(coalesce(bal, 0.0)), 4) AS mean_bal, round(sum(o_totalprice + coalesce(bal, 0.0)), 2) AS both,
  round(sum(o_totalprice * coalesce(bal, 0.0)) / 1000000.0, 2) AS prod FROM ({ORDERS}) GROUP BY 1""")
def summarize_wide(spark, sf):
    out = op.summarize(
        _orders(spark, sf), Col("c_nationkey", rename="nation"),
        [AggCol("o_orderkey", rename="n_orders", method="size"), AggCol("o_totalprice"), AggCol("bal", rename="mean_bal", method="mean")],
        [Consolidation("both", ("o_totalprice", "bal")), Consolidation("prod", ("o_totalprice", "bal"), fold="product")])
    return out.select("nation", "n_orders", F.round("o_totalprice", 2).alias("o_totalprice"), F.round("mean_bal", 4).alias("mean_bal"),
                      F.round("both", 2).alias("both"), F.round(F.col("prod") / 1e6, 2).alias("prod"))


PRIORITY_ORDER = DomainCol("PRIO_DOM", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5})
MEASURE_ORDER = DomainCol("MEASURE_DOM", {"o_totalprice": 1, "bal": 2})


@register("summarize_melt_domain", f"""
WITH b AS ({ORDERS}), m AS (SELECT n_regionkey, o_orderpriority, yr, 'o_totalprice' AS Measure, o_totalprice AS Amount FROM b
  UNION ALL SELECT n_regionkey, o_orderpriority, yr, 'bal', coalesce(bal, 0.0) FROM b)
SELECT n_regionkey, o_orderpriority,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 5 ELSE -1 END AS PRIO_DOM,
  Measure, CASE Measure WHEN 'o_totalprice' THEN 1 ELSE 2 END AS MEASURE_DOM, round(avg(CAST(yr AS DOUBLE)), 4) AS mean_year,
  round(sum(Amount), 2) AS Amount FROM m GROUP BY 1, 2, 3, 4, 5""")
def summarize_melt_domain(spark, sf):
    out = op.summarize(
        _orders(spark, sf), [Col("n_regionkey"), Col("o_orderpriority", default="", domain=PRIORITY_ORDER)],
        [AggCol("yr", rename="mean_year", method="mean")], (),
        Melt("Measure", "Amount", ("o_totalprice", "bal"), domain=MEASURE_ORDER))
    return rounded(out).withColumn("Amount", F.round("Amount", 2))


@register("summarize_median", f"""
SELECT n_regionkey, c_mktsegment, round(median(coalesce(bal, 0.0)), 4) AS med_bal, round(median(o_totalprice), 4) AS med_price,
  count(*) AS n FROM ({ORDERS}) GROUP BY 1, 2""")
def summarize_median(spark, sf):
    return rounded(op.summarize(
        _orders(spark, sf), [Col("n_regionkey"), Col("c_mktsegment", default="")],
        [AggCol("bal", rename="med_bal", method=MEDIAN), AggCol("o_totalprice", rename="med_price", method=MEDIAN),
         AggCol("o_orderkey", rename="n", method="size")]))


@register("median_null_skipping", f"""
SELECT c_nationkey, median(bal) AS med_bal FROM ({ORDERS}) GROUP BY 1""")
def median_null_skipping(spark, sf):
    return exact_median(_orders(spark, sf), ["c_nationkey"], {"med_bal": "bal"})


@register("row_counts", "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def row_counts(spark, sf):
    return op.count_rows(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], "n")


@register("row_counts_joined", """
SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""")
def row_counts_joined(spark, sf):
    return op.with_row_counts(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], "n")


@register("distinct_values", "SELECT DISTINCT p_type FROM part")
def distinct_values(spark, sf):
    return op.distinct_values(table(spark, sf, "part"), "p_type")


@register("region_totals", with_views("v_parcels", """
WITH a AS (SELECT zone, CAST(sum(units) AS DOUBLE) AS u, CAST(sum(jobs) AS DOUBLE) AS j, sum(living) AS l, sum(land) AS la FROM v_parcels GROUP BY 1),
  r AS (SELECT CAST(sum(units) AS DOUBLE) AS u, CAST(sum(jobs) AS DOUBLE) AS j, sum(living) AS l, sum(land) AS la FROM v_parcels)
SELECT a.zone, round(a.u / r.u, 6) AS SHR_RES_UNTS, round(a.j / r.j, 6) AS SHR_JOBS, round((a.l / a.la) / (r.l / r.la), 6) AS TV_IDX
FROM a, r"""))
def region_totals(spark, sf):
    parcels = view(spark, sf, "v_parcels")
    cols = ["units", "jobs", "living", "land"]
    areas = op.roll_up(parcels, "zone", cols)
    known = attach_scalars(areas, op.column_sums(parcels, cols), {f"r_{c}": c for c in cols})
    return rounded(known.select(
        "zone", sc.divide(F.col("units"), F.col("r_units")).alias("SHR_RES_UNTS"),
        sc.divide(F.col("jobs"), F.col("r_jobs")).alias("SHR_JOBS"),
        ind.value_index(F.col("living"), F.col("land"), F.col("r_living"), F.col("r_land")).alias("TV_IDX")), 6)


# --- two-level and conditional sums ---------------------------------------

@register("mean_then_sum", with_views("v_parcels", """
SELECT zone, round(sum(living), 2) AS living, round(sum(units), 4) AS units FROM
 (SELECT zone, owner, avg(living) AS living, avg(CAST(units AS DOUBLE)) AS units FROM v_parcels GROUP BY 1, 2) GROUP BY 1"""))
def mean_then_sum(spark, sf):
    out = op.mean_then_sum(view(spark, sf, "v_parcels"), "zone", "owner", ["living", "units"])
    return out.select("zone", F.round("living", 2).alias("living"), F.round("units", 4).alias("units"))


CRITERIA_SQL = {
    "CNS_01_par": "lu BETWEEN 50 AND 69", "CNS_02_par": "lu = 92", "CNS_03_par": "lu = 91", "CNS_04_par": "lu IN (17, 19)",
    "CNS_05_par": "lu IN (41, 42)", "CNS_06_par": "lu = 29", "CNS_07_par": "lu BETWEEN 11 AND 16", "CNS_08_par": "lu IN (20, 48, 49)",
    "CNS_09_par": "lu IN (17, 18, 19)", "CNS_10_par": "lu IN (23, 24)", "CNS_11_par": "lu IN (17, 18, 19)",
    "CNS_12_par": "lu IN (17, 18, 19)", "CNS_13_par": "lu IN (17, 18, 19)", "CNS_14_par": "lu = 89",
    "CNS_15_par": "lu IN (72, 83, 84)", "CNS_16_par": "lu IN (73, 85)", "CNS_17_par": "lu BETWEEN 30 AND 38 OR lu = 82",
    "CNS_18_par": "lu IN (21, 22, 33, 39)", "CNS_19_par": "lu IN (27, 28)", "CNS_20_par": "lu BETWEEN 86 AND 89",
    "RES_par": "lu BETWEEN 1 AND 9 OR lu BETWEEN 100 AND 102",
}


@register("criteria_area_sums", with_views("v_parcels", "SELECT zone, " + ", ".join(
    f"round(coalesce(sum({n}), 0.0), 2) AS {n}" for n in CRITERIA_SQL) + " FROM (SELECT zone, owner, " + ", ".join(
    f"avg(CASE WHEN {c} THEN living END) AS {n}" for n, c in CRITERIA_SQL.items()) + " FROM v_parcels GROUP BY 1, 2) GROUP BY 1"))
def criteria_area_sums(spark, sf):
    return rounded(op.criteria_sums(view(spark, sf, "v_parcels"), "zone", "owner", "lu", "living", area_criteria()), 2)


@register("predicate_flags", with_views("v_parcels", """
SELECT folio, CAST(lu >= 10 AND units < 3 AS INT) AS pairwise, CAST(lu > 50 AND lu <> 60 AS INT) AS both_on_one,
  CAST(lu = 1 OR lu BETWEEN 20 AND 30 OR lu >= 100 AS INT) AS any_of FROM v_parcels"""))
def predicate_flags(spark, sf):
    lu, units = F.col("lu"), F.col("units")
    return view(spark, sf, "v_parcels").select(
        "folio", And([Comp(">=", 10), Comp("<", 3)]).on(lu, units).cast("int").alias("pairwise"),
        And([Comp(">", 50), Comp("!=", 60)]).on(lu).cast("int").alias("both_on_one"),
        Or([Comp("==", 1), span(20, 30), Comp(">=", 100)]).on(lu).cast("int").alias("any_of"))


# --- crosswalks -----------------------------------------------------------

@register("crosswalk_rollup", """
SELECT n_regionkey AS region, CAST(sum(C01) AS BIGINT) AS C01, round(sum(C02), 2) AS C02 FROM
 (SELECT c_nationkey AS w_geocode, count(*) AS C01, sum(c_acctbal) AS C02 FROM customer GROUP BY 1)
 JOIN nation ON w_geocode = n_nationkey GROUP BY 1""")
def crosswalk_rollup(spark, sf):
    blocks = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("w_geocode")).agg(
        F.count(F.lit(1)).alias("C01"), F.sum("c_acctbal").alias("C02"))
    xwalk = table(spark, sf, "nation").select(F.col("n_nationkey").alias("tabblk2010"), F.col("n_regionkey").alias("region"))
    out = op.crosswalk_roll_up(blocks, xwalk, "w_geocode", "tabblk2010", "region")
    return out.withColumn("C02", F.round("C02", 2))


@register("od_crosswalk_rollup", """
SELECT s_nationkey AS nation1, c_nationkey AS nation2, CAST(sum(l_quantity) AS BIGINT) AS S000, CAST(sum(l_linenumber) AS BIGINT) AS SA01
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2""")
def od_crosswalk_rollup(spark, sf):
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    flows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("s"), "l_suppkey").alias("w"), F.concat(F.lit("c"), "o_custkey").alias("h"),
        F.col("l_quantity").alias("S000"), F.col("l_linenumber").alias("SA01"))
    homes = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("block"), F.col("c_nationkey").alias("nation"))
    works = table(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("block"), F.col("s_nationkey").alias("nation"))
    out = op.od_crosswalk_roll_up(flows, works.unionByName(homes), ("w", "h"), "block", "nation", ["S000", "SA01"])
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("S000", "SA01")})


# --- zonal classes, ridership, pivots -------------------------------------

@register("ridership_by_stop", """
SELECT round_even(25 + value / 100, 4) AS "LAT", round_even(-80 - CAST(user_id % 50 AS DOUBLE) / 64, 4) AS "LONG",
  CASE event_type WHEN 'click' THEN 'EARLY AM 02:45AM-05:59AM' ELSE event_type END AS "TIME_PERIOD",
  CAST(sum(event_id % 7) AS BIGINT) AS "ON", CAST(sum(event_id % 5) AS BIGINT) AS "OFF", CAST(sum(event_id % 7 + event_id % 5) AS BIGINT) AS "TOTAL"
FROM events GROUP BY 1, 2, 3""")
def ridership_by_stop(spark, sf):
    rows = table(spark, sf, "events").select(
        (25 + F.col("value") / 100).alias("LAT"), (-80 - (F.col("user_id") % 50).cast("double") / 64).alias("LONG"),
        F.when(F.col("event_type") == "click", op.EARLY_PERIOD).otherwise(F.col("event_type")).alias("TIME_PERIOD"),
        (F.col("event_id") % 7).alias("ON"), (F.col("event_id") % 5).alias("OFF"),
        (F.col("event_id") % 7 + F.col("event_id") % 5).alias("TOTAL"))
    return op.ridership(rows)


@register("pivot_by_type", """
SELECT c_nationkey, coalesce(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END), 0.0) > 0 AS has_urgent,
  round(coalesce(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END), 0.0), 2) AS "1-URGENT",
  round(coalesce(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END), 0.0), 2) AS "2-HIGH",
  round(coalesce(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice END), 0.0), 2) AS "3-MEDIUM",
  round(coalesce(sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice END), 0.0), 2) AS "4-NOT_SPECIFIED",
  round(coalesce(sum(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END), 0.0), 2) AS "5-LOW"
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def pivot_by_type(spark, sf):
    out = op.pivot_sum(_orders(spark, sf), ["c_nationkey"], "o_orderpriority", "o_totalprice", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
    return rounded(out.withColumn("has_urgent", F.col("`1-URGENT`") > 0), 2)


@register("case_and_nearest", with_views("v_skim", """
SELECT o, min(minutes) AS MIN_minutes, round(avg(minutes), 4) AS MEAN_minutes, min_by(d, minutes * 1000000 + d) AS nearest_d,
  min(minutes) AS min_time_d, count(*) AS n_d FROM v_skim GROUP BY 1"""))
def case_and_nearest(spark, sf):
    skim = view(spark, sf, "v_skim")
    stats = op.case_statistics(skim, ["o"], "minutes")
    near = op.min_argmin_count(skim, "o", "d", "minutes", ("nearest_d", "min_time_d", "n_d"))
    return rounded(stats.join(near, "o"))


@register("zone_roll_up", with_views("v_zone_data", """
SELECT s_nationkey AS taz, CAST(sum(hh) AS BIGINT) AS hh, CAST(sum(jobs) AS BIGINT) AS jobs FROM v_zone_data JOIN supplier ON id = s_suppkey GROUP BY 1"""))
def zone_roll_up(spark, sf):
    zones = view(spark, sf, "v_zone_data").join(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("taz")), "id")
    return op.roll_up(zones, "taz", ["hh", "jobs"])


@register("sum_to_zones", with_views("v_points", """
SELECT p_partkey AS zone, round(coalesce(s.w, 0.0), 2) AS w FROM part LEFT JOIN
 (SELECT id % 211 AS zone, sum(w) AS w FROM v_points GROUP BY 1) s ON p_partkey = s.zone"""))
def sum_to_zones(spark, sf):
    zones = table(spark, sf, "part").select(F.col("p_partkey").alias("zone"))
    members = view(spark, sf, "v_points").select((F.col("id") % 211).alias("zone"), "w")
    return rounded(op.sum_to_zones(zones, members, "zone", "w"), 2)


@register("dissolve_stations", """
SELECT s_nationkey, count(*) AS "NumPieces", max(CAST(s_suppkey % 2 AS INT)) AS odd, round(avg(s_acctbal), 4) AS s_acctbal FROM supplier GROUP BY 1""")
def dissolve_stations(spark, sf):
    rows = table(spark, sf, "supplier").withColumn("odd", (F.col("s_suppkey") % 2).cast("int"))
    return rounded(op.dissolve(rows, ["s_nationkey"], ["odd"], ["s_acctbal"]))


# --- diversity ------------------------------------------------------------

def _diversity_sql(rows: str, k: str, places: int = 6) -> str:
    def indices(grp: str) -> str:
        return f"""SELECT {grp}1 - sum(n * (n - 1)) / nullif(max(t) * (max(t) - 1), 0) AS Simpson,
          -sum(n / t * ln(n / t)) / ln(CAST({k} AS DOUBLE)) AS Shannon, 1 - (max(n / t) - 1.0 / {k}) / (1 - 1.0 / {k}) AS BergerParker,
          (1 / sum((n / t) * (n / t)) - 1) / ({k} - 1.0) AS ENP"""
    adj = ", ".join(f"round(g.{c}, {places}) AS {c}, round(g.{c} / r.{c}, {places}) AS {c}_Adj" for c in ("Simpson", "Shannon", "BergerParker", "ENP"))
    return f"""WITH src AS ({rows}), kk AS (SELECT CAST(count(DISTINCT lu) AS DOUBLE) AS k FROM src WHERE w > 0),
      s AS (SELECT area, lu, sum(CAST(w AS DOUBLE)) AS n FROM src WHERE w > 0 GROUP BY 1, 2),
      st AS (SELECT *, sum(n) OVER (PARTITION BY area) AS t FROM s),
      rg AS (SELECT lu, sum(n) AS n FROM s GROUP BY 1), rt AS (SELECT *, sum(n) OVER () AS t FROM rg),
      g AS ({indices("area, ")} FROM st GROUP BY area), r AS ({indices("")} FROM rt)
      SELECT area, {adj} FROM g, r"""


@register("diversity_all", _diversity_sql(
    "SELECT c_nationkey AS area, c_mktsegment AS lu, o_totalprice / 1000 AS w FROM orders JOIN customer ON o_custkey = c_custkey", "13"))
def diversity_all(spark, sf):
    rows = _orders(spark, sf).select(F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("lu"), (F.col("o_totalprice") / 1000).alias("w"))
    return rounded(op.diversity(rows, "area", "lu", "w", 13, regional=True), 6)


@register("diversity_by_count", _diversity_sql(
    "SELECT c_nationkey AS area, c_mktsegment AS lu, count(*) OVER (PARTITION BY c_nationkey) AS w FROM customer", "(SELECT k FROM kk)"))
def diversity_by_count(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("lu"))
    return rounded(op.diversity(rows, "area", "lu", None, None, regional=True), 6)


# --- windows --------------------------------------------------------------

@register("share_of_total", """
SELECT event_id, round(value / sum(value) OVER (PARTITION BY user_id), 8) AS share FROM events""")
def share_of_total(spark, sf):
    out = op.share_of_total(table(spark, sf, "events").select("event_id", "user_id", "value"), ["user_id"], "value", "share")
    return rounded(out.select("event_id", "share"), 8)


@register("sequential_ids", "SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS pid FROM part")
def sequential_ids(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return number_rows(parts, [F.col("p_retailprice").desc(), F.col("p_partkey")], "pid").select("p_partkey", "pid")


@register("keep_first_by_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM
 (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def keep_first_by_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


# --- checks and exploration -----------------------------------------------

@register("yearly_totals", f"""
WITH b AS (SELECT yr, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END) AS a, sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END) AS b,
  sum(CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN o_totalprice ELSE 0.0 END) AS c FROM ({ORDERS}) GROUP BY 1)
SELECT yr, 'done' AS Sector, round(a, 2) AS Total FROM b UNION ALL SELECT yr, 'open', round(b, 2) FROM b UNION ALL SELECT yr, 'part', round(c, 2) FROM b""")
def yearly_totals(spark, sf):
    rows = _orders(spark, sf).withColumns({
        "done": F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0),
        "open": F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(0.0),
        "part": F.when(~F.col("o_orderstatus").isin("F", "O"), F.col("o_totalprice")).otherwise(0.0)})
    return rounded(op.yearly_totals(rows, "yr", ["done", "open", "part"]), 2)


@register("histogram_counts", f"""
WITH b AS ({ORDERS}), s AS (SELECT yr, max(o_totalprice) AS m, count(*) AS n FROM b GROUP BY 1)
SELECT yr, CAST(floor(o_totalprice / (m / sqrt(s.n))) AS BIGINT) AS bin, count(*) AS n FROM b JOIN s USING (yr) GROUP BY 1, 2""")
def histogram_counts(spark, sf):
    return op.histogram(_orders(spark, sf), "yr", "o_totalprice")


@register("correlations", "SELECT 'c_nationkey' AS Variable, round(corr(c_nationkey, c_acctbal), 6) AS r FROM customer "
          "UNION ALL SELECT 'c_custkey', round(corr(c_custkey, c_acctbal), 6) FROM customer")
def correlations(spark, sf):
    rows = table(spark, sf, "customer").withColumn("same", F.lit(1.0))
    return rounded(op.correlations(rows, "c_acctbal", ["c_nationkey", "c_custkey", "same"]), 6)


@register("share_within_area", with_views("v_points v_areas", """
SELECT area, round(avg(CASE WHEN cls = 'BUILDING' THEN 1.0 ELSE 0.0 END), 6) AS share FROM v_points
JOIN v_areas ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax GROUP BY 1"""))
def share_within_area(spark, sf):
    from arealens.plans.queries.places import in_areas

    hits = in_areas(spark, sf)
    return rounded(hits.groupBy("area").agg(F.avg(F.when(F.col("cls") == "BUILDING", 1.0).otherwise(0.0)).alias("share")), 6)


# --- indicators -----------------------------------------------------------

@register("indicator_calcs", with_views("v_parcels", """
WITH p AS (SELECT *, CASE WHEN lu IN (0, 10, 40, 70, 80) THEN land ELSE 0.0 END AS vac, CASE WHEN units > 0 THEN land ELSE 0.0 END AS res,
   CASE WHEN jobs > 0 THEN land ELSE 0.0 END AS nres,
   CASE WHEN jobs = 0 THEN NULL ELSE CAST(jobs * 3 AS DOUBLE) END AS walk, CASE WHEN units = 3 THEN NULL ELSE CAST(units * 2 AS DOUBLE) END AS ideal FROM v_parcels),
 q AS (SELECT *, CASE WHEN ideal IS NULL THEN -1.0 WHEN ideal = 0 THEN 1.0 WHEN walk IS NULL THEN -2.0 WHEN walk = 0 THEN 1.0
   WHEN walk < ideal THEN 1.0 ELSE walk / ideal END AS dir, CASE WHEN walk <= 15 THEN 1 ELSE 0 END AS in15 FROM p)
SELECT zone, round(sum(vac), 2) AS VAC_AREA, round(sum(res), 2) AS RES_AREA, round(sum(nres), 2) AS NRES_AREA,
  round(sum(units) / nullif(sum(res) / 43560.0, 0), 6) AS RES_DENS, round(sum(jobs) / nullif(sum(res) / 43560.0, 0), 6) AS NRES_DENS,
  round(sum(living) / nullif(sum(land), 0), 6) AS FAR, round(CAST(sum(jobs) AS DOUBLE) / nullif(sum(units), 0), 6) AS JHRatio,
  round(count(*) / (sum(land) / (43560.0 * 640.0)), 4) AS GRID_DENS, round(100.0 * sum(in15) / count(*), 6) AS Prop_stn15,
  round(avg(dir), 6) AS DirIdx_mean, round(sum(living * jobs) / nullif(sum(living), 0), 6) AS CentIdx,
  round(100 * CAST(sum(units) + sum(jobs) AS DOUBLE) / nullif(sum(lu), 0), 6) AS SHR_NONAUTO FROM q GROUP BY 1"""))
def indicator_calcs(spark, sf):
    c = F.col
    rows = view(spark, sf, "v_parcels").withColumns({
        "VAC_AREA": ind.area_if_vacant(c("land"), F.when(c("lu").isin(0, 10, 40, 70, 80), ind.VACANT).otherwise("Other")),
        "RES_AREA": ind.area_if_active(c("land"), c("units")), "NRES_AREA": ind.area_if_active(c("land"), c("jobs")),
        "walk": F.when(c("jobs") != 0, (c("jobs") * 3).cast("double")), "ideal": F.when(c("units") != 3, (c("units") * 2).cast("double"))})
    rows = rows.withColumns({"dir": ind.directness(c("walk"), c("ideal")), "in15": ind.within(c("walk"))})
    sums = rows.groupBy("zone").agg(
        *[F.sum(n).alias(n) for n in ("VAC_AREA", "RES_AREA", "NRES_AREA", "units", "jobs", "living", "land", "in15", "lu")],
        F.count(F.lit(1)).alias("n"), F.avg("dir").alias("DirIdx_mean"), F.sum(c("living") * c("jobs")).alias("CentIdxFA"))
    return sums.select(
        "zone", *[F.round(n, 2).alias(n) for n in ("VAC_AREA", "RES_AREA", "NRES_AREA")],
        F.round(ind.per_acre(c("units"), c("RES_AREA")), 6).alias("RES_DENS"), F.round(ind.per_acre(c("jobs"), c("RES_AREA")), 6).alias("NRES_DENS"),
        F.round(sc.divide(c("living"), c("land")), 6).alias("FAR"), F.round(sc.divide(c("jobs"), c("units")), 6).alias("JHRatio"),
        F.round(ind.grid_density(c("n"), c("land")), 4).alias("GRID_DENS"), F.round(ind.share_within(c("in15"), c("n")), 6).alias("Prop_stn15"),
        F.round("DirIdx_mean", 6).alias("DirIdx_mean"), F.round(sc.divide(c("CentIdxFA"), c("living")), 6).alias("CentIdx"),
        F.round(ind.non_auto_share(c("units"), c("jobs"), F.lit(0), c("lu")), 6).alias("SHR_NONAUTO"))


@register("safe_division", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_tax / nullif(l_discount, 0), 6) AS ratio, round(l_tax / nullif(l_discount, 0) * 100, 6) AS pct,
  round(l_quantity / nullif(l_discount / 0.5, 0), 6) AS dens,
  CASE WHEN l_tax = 0 OR l_discount = 0 THEN 0.0 ELSE round(l_tax + l_discount, 6) END AS total,
  least(CASE WHEN l_tax <> 0 THEN l_tax END, CASE WHEN l_discount <> 0 THEN l_discount END) AS lowest,
  greatest(l_tax, l_discount) AS highest FROM lineitem""")
def safe_division(spark, sf):
    c = F.col
    tax, disc = F.when(c("l_tax") != 0, c("l_tax")), F.when(c("l_discount") != 0, c("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(sc.divide(c("l_tax"), c("l_discount")), 6).alias("ratio"),
        F.round(sc.percent(c("l_tax"), c("l_discount")), 6).alias("pct"), F.round(sc.density(c("l_quantity"), c("l_discount"), 0.5), 6).alias("dens"),
        F.round(sc.sum_or_zero(tax, disc), 6).alias("total"), sc.row_min(tax, disc).alias("lowest"),
        sc.row_max(c("l_tax"), c("l_discount")).alias("highest"))


@register("time_bins", with_views("v_skim", """
SELECT o, d, CASE WHEN minutes < 15 THEN '15Min' WHEN minutes < 30 THEN '30Min' WHEN minutes < 45 THEN '45Min' WHEN minutes < 60 THEN '60Min' ELSE '60Minp' END AS bin,
  CASE WHEN minutes <= 5 THEN '0 to 5 minutes' WHEN minutes <= 10 THEN '5 to 10 minutes' WHEN minutes <= 15 THEN '10 to 15 minutes'
  WHEN minutes <= 20 THEN '15 to 20 minutes' WHEN minutes <= 25 THEN '20 to 25 minutes' WHEN minutes <= 30 THEN '25 to 30 minutes' ELSE 'over 30 minutes' END AS walk_bin FROM v_skim"""))
def time_bins(spark, sf):
    return view(spark, sf, "v_skim").select(
        "o", "d", sc.bin_label(F.col("minutes"), (15, 30, 45, 60)).alias("bin"), sc.walk_time_bin(F.col("minutes")).alias("walk_bin"))


@register("floor_share_by_class", with_views("v_parcels", """
WITH p AS (SELECT zone, land * living AS floor, CASE WHEN lu < 20 THEN 'NonDevArea' WHEN lu < 40 THEN 'DevOSArea' WHEN lu < 60 THEN 'DevLowArea' WHEN lu < 80 THEN 'DevMedArea' ELSE 'DevHighArea' END AS cls FROM v_parcels),
 t AS (SELECT zone, sum(floor) AS t FROM p GROUP BY 1), s AS (SELECT zone, cls, sum(floor) AS s FROM p GROUP BY 1, 2),
 c AS (SELECT unnest(['NonDevArea', 'DevOSArea', 'DevLowArea', 'DevMedArea', 'DevHighArea']) AS cls)
SELECT t.zone, c.cls AS DevStatus, round(CASE WHEN t = 0 THEN 0 ELSE coalesce(s, 0) / t END, 6) AS FA_SHR FROM t CROSS JOIN c LEFT JOIN s ON s.zone = t.zone AND s.cls = c.cls"""))
def floor_share_by_class(spark, sf):
    c = F.col
    floor = c("land") * c("living")
    bounds = {"NonDevArea": (0, 20), "DevOSArea": (20, 40), "DevLowArea": (40, 60), "DevMedArea": (60, 80), "DevHighArea": (80, 1000)}
    sums = view(spark, sf, "v_parcels").groupBy("zone").agg(
        F.sum(floor).alias("t"),
        *[F.sum(F.when((c("lu") >= low) & (c("lu") < high), floor).otherwise(0)).alias(n) for n, (low, high) in bounds.items()])
    tall = sums.withColumn("DevStatus", F.explode(F.array(*[F.lit(n) for n in bounds])))
    share = ind.class_floor_share(c("DevStatus"), {n: c(n) for n in bounds}, c("t"))
    return tall.select("zone", "DevStatus", F.round(share, 6).alias("FA_SHR"))


@register("value_per_area", with_views("v_parcels", """
SELECT zone, round(median(living / nullif(land, 0)), 6) AS JV_SF_median, round(sum(living) / nullif(sum(land), 0), 6) AS JV_SF FROM v_parcels GROUP BY 1"""))
def value_per_area(spark, sf):
    rows = view(spark, sf, "v_parcels").withColumn("sf", sc.divide(F.col("living"), F.col("land")))
    sums = op.roll_up(rows, "zone", ["living", "land"]).select("zone", sc.divide(F.col("living"), F.col("land")).alias("JV_SF"))
    return rounded(sums.join(exact_median(rows, ["zone"], {"JV_SF_median": "sf"}), "zone"), 6)


@register("park_and_class_percent", with_views("v_parcels", """
SELECT zone, round(sum(land) / nullif(CAST(sum(units) AS DOUBLE) / 1000, 0), 2) AS PARK_AC_PER1000,
  round(100 * sum(CASE WHEN lu = 5 THEN living ELSE 0 END) / nullif(sum(living), 0), 6) AS NONDEV_FA_SHR FROM v_parcels GROUP BY 1"""))
def park_and_class_percent(spark, sf):
    c = F.col
    sums = view(spark, sf, "v_parcels").groupBy("zone").agg(
        F.sum("land").alias("land"), F.sum("units").alias("units"), F.sum("living").alias("living"),
        F.sum(F.when(any_of(5).on(c("lu")), c("living")).otherwise(0)).alias("part"))
    return sums.select("zone", F.round(sc.density(c("land"), c("units"), 1000), 2).alias("PARK_AC_PER1000"),
                       F.round(sc.percent(c("part"), c("living")), 6).alias("NONDEV_FA_SHR"))


@register("consolidated_zones", with_views("v_zone_data", """
SELECT id, hh AS "HH", CAST(jobs * 2 + 1 AS BIGINT) AS "OffJobs", hh * jobs AS "Mixed" FROM v_zone_data"""))
def consolidated_zones(spark, sf):
    zones = view(spark, sf, "v_zone_data").withColumns({"a": F.col("jobs"), "b": F.col("jobs") + 1, "c": F.lit(None).cast("bigint")})
    return op.consolidate(zones, ["id"], {"hh": "HH"}, [Consolidation("OffJobs", ("a", "b", "c")), Consolidation("Mixed", ("hh", "a"), fold="product")])

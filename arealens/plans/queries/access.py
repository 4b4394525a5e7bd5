"""Accessibility, travel statistics and skim queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.operators import access as op
from arealens.operators.joins import merge_outer
from arealens.plans.queries import register, rounded
from arealens.plans.standins import view, with_views

BREAKS = (15, 30, 45, 60)


def _bins(act: str) -> str:
    out, low = [], None
    for b in BREAKS:
        cond = f"minutes < {b}" if low is None else f"minutes >= {low} AND minutes < {b}"
        out.append(f"sum(CASE WHEN {cond} THEN CAST({act} AS DOUBLE) END) AS {act}{b}Min")
        low = b
    out.append(f"sum(CASE WHEN minutes >= {low} THEN CAST({act} AS DOUBLE) END) AS {act}{low}Minp")
    return ", ".join(out)


def _access_sql(end: str, report: str, acts=("hh", "jobs")) -> str:
    avgs = ", ".join(f"round(sum(minutes * {a}) / nullif(sum(CAST({a} AS DOUBLE)), 0), 4) AS AvgMin{a}" for a in acts)
    return (f"SELECT {report}, {', '.join(_bins(a) for a in acts)}, {avgs} "
            f"FROM v_skim JOIN v_zone_data ON {end} = id GROUP BY {report}")


@register("access_summary_dest", with_views("v_skim v_zone_data", _access_sql("d", "o")))
def access_summary_dest(spark, sf):
    return rounded(op.access_summary(view(spark, sf, "v_skim"), view(spark, sf, "v_zone_data"), "o", "d", "minutes", "id",
                                     ["hh", "jobs"], BREAKS, "Min", "D"))


@register("access_summary_orig", with_views("v_skim v_zone_data", _access_sql("o", "d")))
def access_summary_orig(spark, sf):
    return rounded(op.access_summary(view(spark, sf, "v_skim"), view(spark, sf, "v_zone_data"), "o", "d", "minutes", "id",
                                     ["hh", "jobs"], BREAKS, "Min", "O"))


@register("access_by_zone", with_views("v_skim v_zone_data", f"""
WITH a AS ({_access_sql("d", "o", ("jobs",))}), b AS ({_access_sql("o", "d", ("hh",))})
SELECT coalesce(a.o, b.d) AS id, a.* EXCLUDE (o), b.* EXCLUDE (d) FROM a FULL JOIN b ON a.o = b.d"""))
def access_by_zone(spark, sf):
    return rounded(op.access_by_zone(view(spark, sf, "v_skim"), view(spark, sf, "v_zone_data"), "o", "d", "minutes", "id",
                                     ["jobs"], ["hh"], BREAKS))


@register("wide_to_long_access", with_views("v_skim v_zone_data", f"""
WITH w AS ({_access_sql("d", "o")})
""" + " UNION ALL ".join(
    f"SELECT o, '{a}' AS Activity, {b} AS TimeBin, {lo} AS from_time, coalesce({a}{b}Min, 0.0) AS value, 2019 AS Year FROM w"
    for a in ("hh", "jobs") for b, lo in zip(BREAKS, (0, *BREAKS[:-1])))))
def wide_to_long_access(spark, sf):
    wide = op.access_summary(view(spark, sf, "v_skim"), view(spark, sf, "v_zone_data"), "o", "d", "minutes", "id",
                             ["hh", "jobs"], BREAKS)
    walk = wide.withColumnsRenamed(op.access_columns(["hh", "jobs"], BREAKS, "Walk"))
    return op.long_access(walk, ["o"], ["hh", "jobs"], BREAKS, "Walk", 2019)


def _end_sql(end: str, suffix: str) -> str:
    return f"""SELECT id, round(vmt / nullif(t, 0), 4) AS AVG_DIST_{suffix}, round(vht / nullif(t, 0), 4) AS AVG_TIME_{suffix},
      CASE WHEN act = 0 THEN 0.0 ELSE vmt / act END AS VMT_PER_ACT_{suffix},
      CASE WHEN act = 0 THEN 0.0 ELSE t / act END AS TRIPS_PER_ACT_{suffix}
      FROM (SELECT {end} AS id, CAST(sum(trips) AS DOUBLE) AS t, sum(trips * dist) AS vmt, sum(trips * minutes) AS vht
            FROM v_skim GROUP BY 1) s LEFT JOIN (SELECT id, CAST(hh + jobs AS DOUBLE) AS act FROM v_zone_data) z USING (id)"""


_STATS = f"""stats AS (SELECT coalesce(a.id, b.id) AS id, a.* EXCLUDE (id), b.* EXCLUDE (id)
  FROM ({_end_sql("o", "FROM")}) a FULL JOIN ({_end_sql("d", "TO")}) b ON a.id = b.id)"""


def _travel(spark, sf):
    return op.travel_stats(view(spark, sf, "v_skim"), view(spark, sf, "v_zone_data"), "o", "d", "trips", "minutes", "dist",
                           "id", "hh", "jobs")


@register("travel_stats", with_views("v_skim v_zone_data", f"""
WITH {_STATS} SELECT id, AVG_DIST_FROM, AVG_TIME_FROM, round(VMT_PER_ACT_FROM, 4) AS VMT_PER_ACT_FROM,
  round(TRIPS_PER_ACT_FROM, 4) AS TRIPS_PER_ACT_FROM, AVG_DIST_TO, AVG_TIME_TO, round(VMT_PER_ACT_TO, 4) AS VMT_PER_ACT_TO,
  round(TRIPS_PER_ACT_TO, 4) AS TRIPS_PER_ACT_TO FROM stats"""))
def travel_stats(spark, sf):
    return rounded(_travel(spark, sf))


@register("zone_vmt_loaded", with_views("v_skim v_zone_data", f"""
WITH {_STATS}, y AS (SELECT id, CAST(hh * 2 + jobs AS DOUBLE) AS act FROM v_zone_data)
SELECT id, round(VMT_PER_ACT_FROM * act, 3) AS VMT_FROM, round(VMT_PER_ACT_TO * act, 3) AS VMT_TO,
  round((coalesce(VMT_PER_ACT_FROM * act, 0) + coalesce(VMT_PER_ACT_TO * act, 0))
    / nullif((CASE WHEN VMT_PER_ACT_FROM IS NULL THEN 0 ELSE 1 END) + (CASE WHEN VMT_PER_ACT_TO IS NULL THEN 0 ELSE 1 END), 0), 3) AS VMT_ALL
FROM stats JOIN y USING (id)"""))
def zone_vmt_loaded(spark, sf):
    year = view(spark, sf, "v_zone_data").withColumn("hh", F.col("hh") * 2)
    return rounded(op.load_rates(_travel(spark, sf), year, "id", "hh", "jobs").select("id", "VMT_FROM", "VMT_TO", "VMT_ALL"), 3)


@register("transit_skim_join", with_views("v_flag_skim", """
WITH acc AS (SELECT o, d, minutes FROM v_flag_skim WHERE flag = 'A'), ride AS (SELECT o, d, minutes FROM v_flag_skim WHERE flag <> 'A')
SELECT a.o AS OName, e.o AS DName, min(a.minutes + r.minutes + e.minutes) AS Minutes
FROM acc a JOIN ride r ON a.d = r.o JOIN acc e ON r.d = e.d
WHERE a.minutes <= 6 AND r.minutes <= 6 AND e.minutes <= 6 AND a.minutes + r.minutes + e.minutes <= 6 GROUP BY 1, 2"""))
def transit_skim_join(spark, sf):
    skim = view(spark, sf, "v_flag_skim").withColumnsRenamed({"o": "OName", "d": "DName", "minutes": "Minutes"})
    return op.join_legs(skim.where("flag = 'A'"), skim.where("flag <> 'A'"), cutoff=6.0)


@register("best_transit_time", with_views("v_flag_skim", """
WITH au AS (SELECT o, d, minutes, trips FROM v_flag_skim WHERE flag = 'A'),
  lo AS (SELECT o, d, minutes FROM v_flag_skim WHERE flag = 'N'), pr AS (SELECT o, d, minutes FROM v_flag_skim WHERE flag = 'R'),
  k AS (SELECT o, d FROM au UNION SELECT o, d FROM lo UNION SELECT o, d FROM pr),
  j AS (SELECT k.o, k.d, au.minutes AS TIME_AU, CASE WHEN lo.minutes = 0 THEN CAST('inf' AS DOUBLE) ELSE lo.minutes END AS TIME_LOC,
    CASE WHEN pr.minutes = 0 THEN CAST('inf' AS DOUBLE) ELSE pr.minutes END AS TIME_PRM, au.trips AS TRIPS
    FROM k LEFT JOIN au USING (o, d) LEFT JOIN lo USING (o, d) LEFT JOIN pr USING (o, d))
SELECT o AS OName, d AS DName, TIME_AU, TRIPS, isinf(least(TIME_LOC, TIME_PRM)) AS no_service,
  CASE WHEN isinf(least(TIME_LOC, TIME_PRM)) THEN NULL ELSE least(TIME_LOC, TIME_PRM) END AS TIME_TR FROM j"""))
def best_transit_time(spark, sf):
    skim = view(spark, sf, "v_flag_skim").withColumnsRenamed({"o": "OName", "d": "DName", "minutes": "TIME"})
    auto, local, prem = (skim.where(F.col("flag") == f).select("OName", "DName", "TIME") for f in ("A", "N", "R"))
    trips = skim.where("flag = 'A'").select("OName", "DName", F.col("trips").alias("TRIPS"))
    best = op.best_transit_time(auto, local, prem, trips, ["OName", "DName"])
    never = F.col("TIME_TR") == float("inf")
    return best.select("OName", "DName", "TIME_AU", "TRIPS", never.alias("no_service"),
                       F.when(~never, F.col("TIME_TR")).alias("TIME_TR"))


@register("skim_clean", with_views("v_flag_skim", """
SELECT flag, o + 5000 AS F_TAP, d + 5000 AS T_TAP, minutes AS IVT FROM v_flag_skim WHERE minutes <> 0"""))
def skim_clean(spark, sf):
    skim = view(spark, sf, "v_flag_skim").drop("trips")
    return op.clean_skim(skim, "IVT", 0, {"o": "F_TAP", "d": "T_TAP", "minutes": "IVT"}, ["F_TAP", "T_TAP"], 5000)


@register("stats_outer_merge", with_views("v_skim", """
SELECT coalesce(a.id, b.id) AS id, a.trips AS trips_FROM, b.trips AS trips_TO
FROM (SELECT o AS id, CAST(sum(trips) AS BIGINT) AS trips FROM v_skim GROUP BY 1) a
FULL JOIN (SELECT d AS id, CAST(sum(trips) AS BIGINT) AS trips FROM v_skim GROUP BY 1) b ON a.id = b.id"""))
def stats_outer_merge(spark, sf):
    skim = view(spark, sf, "v_skim")
    ends = [skim.groupBy(F.col(e).alias("id")).agg(F.sum("trips").alias("trips")) for e in ("o", "d")]
    return merge_outer(*ends, "id", ("_FROM", "_TO"))

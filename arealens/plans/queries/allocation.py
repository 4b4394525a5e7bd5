"""Models, shares, allocation to parcels, permits and energy."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.operators import allocate, energy, model, permits
from arealens.operators import joins
from arealens.operators.aggregate import summarize, totals_check
from arealens.operators.spatial import adjacency, point_in_polygon
from arealens.plans import report_specs as rs
from arealens.plans.queries import register, rounded
from arealens.plans.queries.places import INSIDE, boxes, in_zones
from arealens.plans.queries.summaries import CRITERIA_SQL
from arealens.plans.standins import run_sql, table, view, with_views

# --- models ---------------------------------------------------------------

PANEL = """SELECT c_nationkey AS bg, CAST(year(o_orderdate) AS INT) AS "Year", sum(o_totalprice) AS "JV", CAST(count(*) AS DOUBLE) AS "NO_BULDNG",
 CAST(sum(o_custkey % 4) AS DOUBLE) AS "NO_RES_UNTS", CAST(sum(o_orderkey % 11) AS DOUBLE) AS "Total_Employment", sum(o_totalprice) / 1000 - count(*) AS "Total_Population",
 1.0 AS same FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
SPARK_PANEL = PANEL.replace('"', "`")
INPUTS = ["JV", "NO_BULDNG", "NO_RES_UNTS", "same"]


def _panel(spark, sf):
    return run_sql(spark, sf, SPARK_PANEL)


def _years(df):
    return sorted(r[0] for r in df.select("Year").distinct().collect())


def _fit_sql(name: str, rows: str, response: str, two_sided: bool) -> str:
    """CTEs that fit a response to JV, NO_BULDNG and NO_RES_UNTS: `name` holds one row of coefficients b0 to b3 and flags u1 to u3.

    Predictors qualify by Student's t, whose tail is integrated by Simpson's rule; the cutoff rises
    by 0.05 until one does. The normal equations are solved on correlations by Cramer's
    rule, with rows of the identity for predictors that do not take part.
    """
    xs = ("JV", "NO_BULDNG", "NO_RES_UNTS")
    pairs = [(i, j) for i in range(3) for j in range(i + 1, 3)]
    stats = ", ".join([f'corr("{x}", "{response}") AS r{i}, stddev_pop("{x}") AS s{i}, avg("{x}") AS m{i}' for i, x in enumerate(xs)]
                      + [f'corr("{xs[i]}", "{xs[j]}") AS c{i}{j}' for i, j in pairs])

    def tail(i: int) -> str:
        t = f"r{i} * sqrt(df / greatest(1 - r{i} * r{i}, 1e-300))"
        t = f"abs({t})" if two_sided else t
        # Beyond 60 the tail is nothing; 6,000 steps of Simpson's rule up to there.
        end = f"least(greatest({t}, -60), 60)"
        area = (f"list_sum(list_transform(range(0, 6001), lambda k: (CASE WHEN k = 0 OR k = 6000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * "
                f"exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * pow(1 + pow(k * {end} / 6000.0, 2) / df, -(df + 1) / 2))) * {end} / 18000.0")
        return f"2 * (0.5 - {area}) AS p{i}"

    def det(cells: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, k) = cells
        return f"({a} * ({e} * {k} - {f} * {h}) - {b} * ({d} * {k} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    square = [["1.0" if i == j else f"q{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    solved = []
    for i in range(3):
        swapped = [[f"z{r}" if c == i else square[r][c] for c in range(3)] for r in range(3)]
        solved.append(f"{det(swapped)} / {det(square)} * sy / s{i} AS b{i + 1}")
    return f"""{name}_s AS (SELECT CAST(count(*) - 2 AS DOUBLE) AS df, stddev_pop("{response}") AS sy, avg("{response}") AS my, {stats} FROM ({rows})),
 {name}_p AS (SELECT *, {', '.join(tail(i) for i in range(3))} FROM {name}_s),
 {name}_u AS (SELECT *, {', '.join(f'p{i} <= cut AS u{i + 1}' for i in range(3))} FROM (SELECT *, 0.05 * greatest(1, ceil(least(p0, p1, p2) / 0.05)) AS cut FROM {name}_p)),
 {name}_m AS (SELECT *, {', '.join(f'CASE WHEN u{i + 1} THEN r{i} ELSE 0.0 END AS z{i}' for i in range(3))},
  {', '.join(f'CASE WHEN u{i + 1} AND u{j + 1} THEN c{i}{j} ELSE 0.0 END AS q{i}{j}' for i, j in pairs)} FROM {name}_u),
 {name} AS (SELECT b1, b2, b3, u1, u2, u3, my - b1 * m0 - b2 * m1 - b3 * m2 AS b0 FROM (SELECT *, {', '.join(solved)} FROM {name}_m))"""


_YEARS = f"""p AS ({PANEL}), y AS (SELECT max("Year") AS last, max("Year") FILTER ("Year" < (SELECT max("Year") FROM p)) AS prior FROM p)"""
_LINE = 'greatest(0.0, b0 + b1 * "JV" + b2 * "NO_BULDNG" + b3 * "NO_RES_UNTS")'


@register("fit_models", f"""
WITH {_YEARS}, {_fit_sql("e", "SELECT * FROM p", "Total_Employment", False)},
 {_fit_sql("t", 'SELECT * FROM p WHERE "Year" < (SELECT last FROM y)', "Total_Population", False)}
""" + " UNION ALL ".join(f"""SELECT '{v}' AS "Variable", round(e.b{i}, 6) + 0.0 AS "Total_Employment", round(t.b{i}, 6) + 0.0 AS "Total_Population" FROM e, t WHERE e.u{i} OR t.u{i}"""
                        for i, v in enumerate(INPUTS[:3], 1)))
def fit_models(spark, sf):
    panel = _panel(spark, sf)
    years = _years(panel)
    fits = model.fit_models(panel, {"Total_Employment": years, "Total_Population": years[:-1]}, INPUTS)
    # A coefficient that rounds to zero must not keep its sign.
    return rounded(fits, 6).withColumns({c: F.col(c) + 0.0 for c in ("Total_Employment", "Total_Population")})


@register("apply_models", f"""
SELECT bg, "Year", round(greatest(0.0, "JV" * 0.00001 + "NO_BULDNG" * -0.25 + "NO_RES_UNTS" * 0.125), 4) AS "Total_Employment",
 round(greatest(0.0, "NO_BULDNG" * 2.5 - "NO_RES_UNTS" * 3), 4) AS "Total_Population" FROM ({PANEL})""")
def apply_models(spark, sf):
    rows = [("JV", 0.00001, 0.0), ("NO_BULDNG", -0.25, 2.5), ("NO_RES_UNTS", 0.125, -3.0)]
    coefficients = spark.createDataFrame(rows, "Variable string, Total_Employment double, Total_Population double")
    return rounded(model.apply_models(_panel(spark, sf), coefficients, ["bg", "Year"]))


@register("model_residuals", f"""
SELECT bg, "Year", round("JV" * 0.00001 - "Total_Employment", 4) AS "Error" FROM ({PANEL})""")
def model_residuals(spark, sf):
    coefficients = spark.createDataFrame([("JV", 0.00001)], "Variable string, Pred double")
    predicted = model.apply_models(_panel(spark, sf), coefficients, ["bg", "Year"]).join(_panel(spark, sf), ["bg", "Year"])
    return rounded(model.residuals(predicted, "Pred", "Total_Employment").select("bg", "Year", "Error"))


@register("extrapolated_years", f"""
WITH {_YEARS}, {_fit_sql("f1", 'SELECT * FROM p WHERE "Year" < (SELECT prior FROM y)', "Total_Employment", True)},
 a1 AS (SELECT bg, "Year", "JV", "NO_BULDNG", "NO_RES_UNTS", "Total_Employment", "Total_Population" FROM p WHERE "Year" < (SELECT prior FROM y)
  UNION ALL SELECT bg, "Year", "JV", "NO_BULDNG", "NO_RES_UNTS", {_LINE}, "Total_Population" FROM p, y, f1 WHERE "Year" = prior),
 {_fit_sql("f2", "SELECT * FROM a1", "Total_Employment", True)}, {_fit_sql("f3", "SELECT * FROM a1", "Total_Population", True)},
 z AS (SELECT p.* FROM p, y WHERE "Year" = last)
SELECT bg, "Year", round("Total_Employment", 6) AS "Total_Employment", round("Total_Population", 6) AS "Total_Population" FROM a1
UNION ALL SELECT z.bg, z."Year", round({_LINE.replace("b0", "f2.b0").replace("b1", "f2.b1").replace("b2", "f2.b2").replace("b3", "f2.b3")}, 6),
 round({_LINE.replace("b0", "f3.b0").replace("b1", "f3.b1").replace("b2", "f3.b2").replace("b3", "f3.b3")}, 6) FROM z, f2, f3""")
def extrapolated_years(spark, sf):
    panel = _panel(spark, sf)
    years = _years(panel)
    frames = {y: panel.where(F.col("Year") == y).drop("Year") for y in years}
    observed = {"Total_Employment": years[:-2], "Total_Population": years[:-1]}
    out = model.extrapolate_years(frames, observed, "bg", INPUTS)
    # Populations are thousandths of money, so three places would round at ties.
    return rounded(out.select("bg", "Year", "Total_Employment", "Total_Population"), 6)


# --- shares ---------------------------------------------------------------

SEGMENTS = {"c1": "AUTOMOBILE", "c2": "BUILDING", "c3": "FURNITURE", "c4": "HOUSEHOLD", "c5": "MACHINERY"}
_SEG = ", ".join(f"sum(CASE WHEN c_mktsegment = '{s}' AND c_nationkey % 5 < 2 THEN c_acctbal + 2000 ELSE 0.0 END) AS {c}" for c, s in SEGMENTS.items())
# Three of five columns of the zone grid have no counts and are filled from their neighbours in turn.
COUNTS = f"SELECT c_nationkey AS zone, {_SEG} FROM customer GROUP BY 1"
_TOT = " + ".join(SEGMENTS)


def _fill_sql(rounds: int) -> str:
    cs = list(SEGMENTS)
    out = [f"f0 AS (SELECT zone, {', '.join(f'{c} / nullif({_TOT}, 0) AS {c}' for c in cs)} FROM ({COUNTS}))",
           "t AS (SELECT a.zone AS src, b.zone AS nbr FROM v_zones a JOIN v_zones b ON a.zone <> b.zone AND a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin)"]
    for i in range(rounds):
        out.append(f"m{i} AS (SELECT src AS zone, {', '.join(f'avg({c}) AS {c}' for c in cs)} FROM t JOIN f{i} ON nbr = f{i}.zone WHERE c1 IS NOT NULL GROUP BY 1)")
        whole = " + ".join(f"m{i}.{c}" for c in cs)
        filled = ", ".join(f"coalesce(f{i}.{c}, m{i}.{c} / ({whole})) AS {c}" for c in cs)
        out.append(f"f{i + 1} AS (SELECT f{i}.zone, {filled} FROM f{i} LEFT JOIN m{i} ON f{i}.zone = m{i}.zone)")
    return "WITH " + ", ".join(out)


def _zone_counts(spark, sf):
    return run_sql(spark, sf, COUNTS)


def _touch(spark, sf):
    return adjacency(boxes(view(spark, sf, "v_zones"), "zone"), "zone", "rings")


@register("neighbour_fill", with_views("v_zones", _fill_sql(3) + f" SELECT zone, {', '.join(f'round({c}, 8) AS {c}' for c in SEGMENTS)} FROM f3"))
def neighbour_fill(spark, sf):
    shares = model.area_shares(_zone_counts(spark, sf), ["zone"], list(SEGMENTS))
    return rounded(model.fill_from_neighbours(shares, _touch(spark, sf), ["zone"], list(SEGMENTS)), 8)


@register("nearest_fill", with_views("v_zones", f"""
WITH f AS (SELECT zone, {', '.join(f'{c} / nullif({_TOT}, 0) AS {c}' for c in SEGMENTS)} FROM ({COUNTS})),
 p AS (SELECT f.*, (xmin + xmax) / 2.0 AS x, (ymin + ymax) / 2.0 AS y FROM f JOIN v_zones USING (zone)),
 n AS (SELECT a.zone, b.zone AS donor, row_number() OVER (PARTITION BY a.zone ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.zone) AS rn
  FROM p a, p b WHERE a.c1 IS NULL AND b.c1 IS NOT NULL)
SELECT zone, {', '.join(f'round({c}, 8) AS {c}' for c in SEGMENTS)} FROM f WHERE c1 IS NOT NULL
UNION ALL SELECT n.zone, {', '.join(f'round({c}, 8)' for c in SEGMENTS)} FROM n JOIN f ON n.donor = f.zone WHERE rn = 1"""))
def nearest_fill(spark, sf):
    shares = model.area_shares(_zone_counts(spark, sf), ["zone"], list(SEGMENTS))
    places = view(spark, sf, "v_zones").select("zone", ((F.col("xmin") + F.col("xmax")) / 2.0).alias("x"), ((F.col("ymin") + F.col("ymax")) / 2.0).alias("y"))
    return rounded(model.fill_from_nearest(shares, places, ["zone"], list(SEGMENTS)), 8)


@register("renormalise", f"""
SELECT zone, {', '.join(f'round({c} / nullif({_TOT}, 0), 8) AS {c}' for c in SEGMENTS)} FROM ({COUNTS})""")
def renormalise(spark, sf):
    return rounded(model.renormalise(_zone_counts(spark, sf), ["zone"], list(SEGMENTS)), 8)


DAILY = """SELECT user_id, CAST(hour(ts) AS INT) AS slot, sum(CASE WHEN event_type = 'click' THEN value ELSE 0.0 END) AS clicks, sum(value) AS total FROM events GROUP BY 1, 2"""


@register("locf_shares", f"""
SELECT user_id, slot, round(last_value(share IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS share
FROM (SELECT user_id, slot, CASE WHEN clicks > 0 THEN clicks / total END AS share FROM ({DAILY}))""")
def locf_shares(spark, sf):
    rows = run_sql(spark, sf, DAILY).select("user_id", "slot", F.when(F.col("clicks") > 0, F.col("clicks") / F.col("total")).alias("share"))
    return rounded(model.carry_forward(rows, ["user_id"], "slot", ["share"]), 6)


@register("donor_year", f"""
WITH o AS (SELECT DISTINCT "Year" AS y FROM ({PANEL}) WHERE "Year" IN (1996, 1999)), w AS (SELECT DISTINCT "Year" AS "Year" FROM ({PANEL})),
 d AS (SELECT w."Year", o.y, row_number() OVER (PARTITION BY w."Year" ORDER BY abs(o.y - w."Year"), o.y) AS rn FROM w, o)
SELECT bg, d."Year", d.y AS "DonorYear", round("JV", 2) AS "JV" FROM d JOIN ({PANEL}) p ON d.y = p."Year" WHERE rn = 1""")
def donor_year(spark, sf):
    panel = _panel(spark, sf)
    seen = panel.where(F.col("Year").isin(1996, 1999)).select("bg", "Year", "JV")
    return rounded(model.shares_with_donors(seen, panel.select("Year"), ["bg"]), 2)


@register("levels_from_shares", f"""
WITH s AS (SELECT zone, {', '.join(f'{c} / nullif({_TOT}, 0) AS {c}' for c in SEGMENTS)} FROM ({COUNTS})),
 t AS (SELECT bg AS zone, "Year", "NO_BULDNG" * 3 AS total FROM ({PANEL}))
SELECT zone, "Year", total, {', '.join(f'round({c} * total, 4) AS {c}' for c in SEGMENTS)} FROM t JOIN s USING (zone)""")
def levels_from_shares(spark, sf):
    shares = model.area_shares(_zone_counts(spark, sf), ["zone"], list(SEGMENTS))
    totals = _panel(spark, sf).select(F.col("bg").alias("zone"), "Year", (F.col("NO_BULDNG") * 3).alias("total"))
    return rounded(model.levels_from_shares(totals, shares, ["zone"], {"seg": list(SEGMENTS)}, {"seg": "total"}))


@register("modelled_areas", with_views("v_zones", _fill_sql(3) + f""", j AS (SELECT zone, greatest(0.0, 0.001 * {" + ".join(f"c1 * {i}" for i in range(1, 21))} + 30.0) AS jobs FROM ({COUNTS}))
SELECT j.zone, round(jobs, 4) AS "Jobs", {', '.join(f'round({c} * jobs, 4) AS {c}' for c in SEGMENTS)} FROM j JOIN f3 ON j.zone = f3.zone""".replace("0.001 * c1 * 1 +", "0.001 * (c1 * 1 +").replace("c1 * 20 + 30.0", "c1 * 20) + 30.0")))
def modelled_areas(spark, sf):
    """Totals from fixed coefficients and shares filled from neighbours, for one year."""
    counts = _zone_counts(spark, sf)
    area = {f"CNS_{i:02d}_par": (F.col("c1") * i).alias(f"CNS_{i:02d}_par") for i in range(1, 21)}
    enriched = counts.select("zone", *SEGMENTS, *area.values())
    coefficients = spark.createDataFrame([("Total_Emp_Area", 0.001), ("Since_2013", 5.0)], "Variable string, Jobs double")
    return rounded(model.model_areas(enriched, _touch(spark, sf), coefficients, "zone", 2019, groups={"g": list(SEGMENTS)}, total_of={"g": "Jobs"}), 4)


@register("extrapolated_shares", f"""
WITH {_YEARS}, {_fit_sql("f", 'SELECT * FROM p WHERE "Year" < (SELECT last FROM y)', "Total_Employment", True)},
 k AS (SELECT bg, "Year", {_LINE} AS total, CASE WHEN "Year" < last THEN "NO_RES_UNTS" / ("NO_RES_UNTS" + "NO_BULDNG") END AS share FROM p, f, y),
 c AS (SELECT *, last_value(share IGNORE NULLS) OVER (PARTITION BY bg ORDER BY "Year" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known FROM k)
SELECT bg AS zone, "Year", round(total, 3) AS "Total_Employment", round(known * total, 3) AS sub_a, round((1 - known) * total, 3) AS sub_b FROM c""")
def extrapolated_shares(spark, sf):
    panel = _panel(spark, sf)
    years = _years(panel)
    sub = panel.withColumns({"sub_a": F.col("NO_RES_UNTS"), "sub_b": F.col("NO_BULDNG")}).withColumnRenamed("bg", "zone")
    frames = {y: sub.where(F.col("Year") == y).drop("Year") for y in years}
    places = view(spark, sf, "v_zones").select("zone", F.col("xmin").alias("x"), F.col("ymin").alias("y"))
    out = model.extrapolate_constant_shares(frames, {"Total_Employment": years[:-1]}, _touch(spark, sf), places, "zone", INPUTS,
                                            {"g": ["sub_a", "sub_b"]}, {"g": "Total_Employment"})
    return rounded(out, 3)


# --- allocation to parcels ------------------------------------------------

SECTORS = ("CNS01", "CNS02", "CNS07", "CNS09", "CNS16")
GROUPS = ("Total_Hispanic", "Total_Non_Hisp", "White_Hispanic")
MODES = ("Drove", "Transit")
ZONE_TOTALS = """SELECT n_nationkey AS zone, 100.0 + n_nationkey * 7 AS CNS01, 50.0 + n_nationkey AS CNS02, 300.0 - n_nationkey AS CNS07, 10.0 * n_nationkey AS CNS09,
 20.0 + n_nationkey AS CNS16, 1000.0 + n_nationkey AS Total_Hispanic, 500.0 - n_nationkey AS Total_Non_Hisp, 400.0 AS White_Hispanic, 600.0 + n_nationkey AS Drove, 90.0 AS Transit FROM nation"""
ZONE_TOTALS = ZONE_TOTALS.replace("100.0 + n", "CAST(100 AS DOUBLE) + n")
_NR = "lu BETWEEN 11 AND 24 OR lu BETWEEN 27 AND 39 OR lu IN (41, 42, 48, 49, 72, 73, 82) OR lu BETWEEN 84 AND 89"
_AD = f"{_NR} OR lu BETWEEN 1 AND 9 OR lu BETWEEN 100 AND 102"


def _cascade_sql(parcels: str, totals: str, name: str = "pp") -> str:
    masks = {s: CRITERIA_SQL[f"CNS_{s[3:]}_par"] for s in SECTORS} | {"Population": CRITERIA_SQL["RES_par"]}
    sums = ", ".join(f"sum(CASE WHEN {m} THEN living ELSE 0.0 END) AS s_{v}" for v, m in masks.items())
    shares = ", ".join(
        f"coalesce(CASE WHEN s_{v} > 0 THEN CASE WHEN {m} THEN living / s_{v} ELSE 0.0 END "
        + ("" if v == "Population" else f"WHEN nr > 0 THEN CASE WHEN {_NR} THEN living / nr ELSE 0.0 END ")
        + f"WHEN ad > 0 THEN CASE WHEN {_AD} THEN living / ad ELSE 0.0 END WHEN lv > 0 THEN living / lv ELSE land / nullif(ld, 0) END, 0.0) AS p_{v}"
        for v, m in masks.items())
    cols = [f"p_{s} * {s} AS {s}_PAR" for s in SECTORS] + [f"p_Population * {g} AS {g}_PAR" for g in (*GROUPS, *MODES)]
    return f"""{name}_a AS (SELECT zone, {sums}, sum(CASE WHEN {_NR} THEN living ELSE 0.0 END) AS nr, sum(CASE WHEN {_AD} THEN living ELSE 0.0 END) AS ad,
       sum(living) AS lv, sum(land) AS ld FROM ({parcels}) GROUP BY 1),
     {name}_s AS (SELECT p.folio, p.zone, p.living, p.lu, {shares} FROM ({parcels}) p JOIN {name}_a a ON p.zone = a.zone),
     {name} AS (SELECT folio, s.zone, living, lu, {', '.join(cols)} FROM {name}_s s JOIN ({totals}) t ON s.zone = t.zone)"""


_OUT = [f"{c}_PAR" for c in (*SECTORS, *GROUPS, *MODES)]
_SUMS = {"Total_Employment": " + ".join(f"{s}_PAR" for s in SECTORS), "Total_Population": "Total_Hispanic_PAR + Total_Non_Hisp_PAR",
         "Total_Commutes": "Drove_PAR + Transit_PAR"}


def _allocated(spark, sf, parcels=None, totals=None, where=None):
    return allocate.allocate_to_parcels(
        view(spark, sf, "v_parcels") if parcels is None else parcels, run_sql(spark, sf, ZONE_TOTALS) if totals is None else totals,
        "zone", "folio", "lu", "living", "land", SECTORS, GROUPS, ("Total_Hispanic", "Total_Non_Hisp"), MODES, where)


@register("cascade_allocation", with_views("v_parcels", f"""
WITH {_cascade_sql("SELECT * FROM v_parcels", ZONE_TOTALS)} SELECT folio, zone, living, lu, {', '.join(f'round({c}, 6) AS {c}' for c in _OUT)},
 {', '.join(f'round({e}, 6) AS {n}' for n, e in _SUMS.items())} FROM pp"""))
def cascade_allocation(spark, sf):
    return rounded(_allocated(spark, sf), 6, without=("living",))


@register("allocation_check", with_views("v_parcels", f"""
WITH {_cascade_sql("SELECT * FROM v_parcels", ZONE_TOTALS)}, z AS ({ZONE_TOTALS})
""" + " UNION ALL ".join(f"""SELECT '{v}' AS "Var", round((SELECT sum({v}) FROM z), 3) AS "Val_Source", round((SELECT sum({v}_PAR) FROM pp), 3) AS "Val_Alloc", CAST(0 AS DOUBLE) AS "Off", true AS conserved"""
                         for v in (*SECTORS, *GROUPS, *MODES))))
def allocation_check(spark, sf):
    pairs = {v: f"{v}_PAR" for v in (*SECTORS, *GROUPS, *MODES)}
    check = totals_check(run_sql(spark, sf, ZONE_TOTALS), _allocated(spark, sf), "zone", pairs)
    return rounded(check.select("Var", "Val_Source", "Val_Alloc", "Off", (F.col("Max") < 0.001).alias("conserved")), 3)


FUTURE_TOTALS = "SELECT zone, " + ", ".join(f"{c} * {f} AS {c}" for c, f in zip((*SECTORS, *GROUPS, *MODES), (1.5, 1, 2, 1, 1.25, 1.5, 1, 1.5, 2, 1))) + f" FROM ({ZONE_TOTALS})"
_DIFF = "SELECT f.zone, " + ", ".join(f"greatest(f.{c} - b.{c}, 0.0) AS {c}" for c in (*SECTORS, *GROUPS, *MODES)) + f" FROM ({FUTURE_TOTALS}) f JOIN ({ZONE_TOTALS}) b ON f.zone = b.zone"
_PERMITTED = "SELECT * FROM v_parcels WHERE jobs >= 8"


@register("near_term_increment", with_views("v_parcels", f"""
WITH {_cascade_sql("SELECT * FROM v_parcels", ZONE_TOTALS, "base")}, {_cascade_sql(_PERMITTED, _DIFF, "incr")}
SELECT b.folio, 9998 AS "Year", {', '.join(f'round(b.{c} + coalesce(i.{c}, 0.0), 6) AS {c}' for c in _OUT)} FROM base b LEFT JOIN incr i ON b.folio = i.folio"""))
def near_term_increment(spark, sf):
    future = view(spark, sf, "v_parcels").withColumn("PERMIT", (F.col("jobs") >= 8).cast("int"))
    out = allocate.near_term_allocation(
        _allocated(spark, sf), run_sql(spark, sf, ZONE_TOTALS), run_sql(spark, sf, FUTURE_TOTALS), future, "zone", "folio", "lu", "living", "land",
        sectors=SECTORS, groups=GROUPS, totals=("Total_Hispanic", "Total_Non_Hisp"), modes=MODES)
    return rounded(out.select("folio", "Year", *_OUT), 6)


# --- zone estimates -------------------------------------------------------

@register("zone_estimates", with_views("v_points v_zones", f"""
WITH j AS (SELECT c_custkey AS id, CAST(c_custkey % 5 AS DOUBLE) AS u, c_acctbal AS a FROM customer),
 l AS (SELECT zone, zone % 5 AS taz, sum(u) AS hh, sum(a) AS jobs, sum(u + a) AS total FROM v_points p JOIN j USING (id) JOIN v_zones ON {INSIDE} GROUP BY 1, 2),
 r AS (SELECT n_nationkey + k * 5 AS zone, n_nationkey % 5 AS taz, CAST(10 AS DOUBLE) AS hh, CAST(20 AS DOUBLE) AS jobs, CAST(30 AS DOUBLE) AS total, CAST(7 AS DOUBLE) AS enroll
  FROM nation, (SELECT 0 AS k UNION ALL SELECT 5)),
 z AS (SELECT l.zone, l.taz, l.hh, l.jobs, l.total, r.enroll FROM l JOIN r USING (zone) UNION ALL SELECT * FROM r WHERE zone NOT IN (SELECT zone FROM l))
SELECT taz, round(sum(hh), 2) AS hh, round(sum(jobs), 2) AS jobs, round(sum(total), 2) AS total, round(sum(enroll), 2) AS enroll FROM z GROUP BY 1"""))
def zone_estimates(spark, sf):
    """Zone sums from parcels, patched over a regional table and rolled up."""
    zones = boxes(view(spark, sf, "v_zones"), "zone")
    hits = point_in_polygon(view(spark, sf, "v_points"), zones, "x", "y", "rings").withColumn("taz", F.col("zone") % 5)
    jobs = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 5).cast("double").alias("u"), F.col("c_acctbal").alias("a"))
    rows = joins.join_attributes(hits, jobs, "id", "id")
    local = summarize(rows, [rs.Col("zone"), rs.Col("taz")], [rs.AggCol("u", rename="hh"), rs.AggCol("a", rename="jobs")],
                      [rs.Consolidation("total", ("u", "a"))])
    # The region has as many zones again, outside the area that the points cover.
    regional = table(spark, sf, "nation").withColumn("k", F.explode(F.array(F.lit(0), F.lit(5)))).select(
        (F.col("n_nationkey") + F.col("k") * 5).alias("zone"), (F.col("n_nationkey") % 5).alias("taz"), F.lit(10.0).alias("hh"), F.lit(20.0).alias("jobs"),
        F.lit(30.0).alias("total"), F.lit(7.0).alias("enroll"))
    patched = joins.patch(local, regional, "zone")
    from arealens.operators.aggregate import roll_up

    return rounded(roll_up(patched, "taz", ["hh", "jobs", "total", "enroll"]), 2)


# --- permits --------------------------------------------------------------

CATEGORIES = "(VALUES ('10', 'Shops', 'sq. ft.', 11), ('11', 'Homes', 'unit', 1), ('12', 'Offices', 'acre', 17), ('13', 'Cinema', 'screen', 32), ('14', 'Hotel', 'room', 39))"
PERMITS = """SELECT l_orderkey AS "PROC", CASE WHEN l_quantity = 50 THEN concat('SMPL', CAST(l_orderkey AS {t})) ELSE concat('P', CAST(l_orderkey AS {t})) END AS "PROC_NUM",
 l_linenumber AS line, l_partkey AS pk, l_suppkey AS sk, CAST(l_orderkey AS {t}) AS "FOLIO", CASE WHEN l_linenumber = 7 THEN 'A SAMPLE ST' ELSE 'MAIN ST' END AS "ADDRESS", substr('CALBX', CAST(1 + l_partkey % 5 AS INT), 1) AS "STATUS",
 l_extendedprice AS con, CAST(l_partkey % 100 AS DOUBLE) AS adm, concat(CAST(10 + l_suppkey % 6 AS {t}), CASE WHEN l_returnflag = 'R' THEN 'PD' ELSE '' END) AS "CAT_CODE", l_quantity AS "UNITS_VAL" FROM lineitem"""


@register("permit_clean", with_views("v_parcels", f"""
WITH p AS ({PERMITS.format(t="VARCHAR")}), c AS (SELECT * FROM {CATEGORIES} t(cat, "LANDUSE", "UNITS", "DOR_UC")),
 x AS (SELECT lpad(CAST(folio AS VARCHAR), 13, '0') AS f, CAST(folio % 1000 AS DOUBLE) AS "X", CAST(folio % 500 AS DOUBLE) AS "Y" FROM v_parcels)
SELECT "PROC_NUM", line, pk, sk, lpad("FOLIO", 13, '0') AS "FOLIO", "ADDRESS", CASE "STATUS" WHEN 'C' THEN 'Collected' WHEN 'A' THEN 'Assessed' WHEN 'L' THEN 'Letter of Credit submitted' WHEN 'B' THEN 'Bond submitted' END AS "STATUS",
 "UNITS_VAL", round(con + adm, 2) AS "COST", CASE WHEN contains("CAT_CODE", 'PD') THEN 1 ELSE 0 END AS "PED_ORIENTED", "DOR_UC", "LANDUSE", "UNITS", x."X", x."Y"
FROM p JOIN c ON replace("CAT_CODE", 'PD', '') = cat JOIN x ON lpad("FOLIO", 13, '0') = x.f
WHERE NOT contains("PROC_NUM", 'SMPL') AND NOT contains("PROC_NUM", 'SAMPLE') AND NOT contains("ADDRESS", 'SMPL') AND NOT contains("ADDRESS", 'SAMPLE')"""))
def permit_clean(spark, sf):
    rows = run_sql(spark, sf, PERMITS.format(t="STRING").replace('"', "`")).drop("PROC")
    raw = rows.withColumns({"CONST_COST": F.concat(F.lit("$ "), F.format_number("con", 2)), "ADMIN_COST": F.concat(F.lit("$"), F.format_number("adm", 2))}).drop("con", "adm")
    listed = [("10", "Shops", "sq. ft.", 11), ("11", "Homes", "unit", 1), ("12", "Offices", "acre", 17), ("13", "Cinema", "screen", 32), ("14", "Hotel", "room", 39)]
    categories = spark.createDataFrame(listed, "CAT_CODE string, LANDUSE string, UNITS string, DOR_UC int")
    uses = categories.select("DOR_UC").distinct()
    places = view(spark, sf, "v_parcels").select(F.lpad(F.col("folio").cast("string"), 13, "0").alias("FOLIO"),
                                                 (F.col("folio") % 1000).cast("double").alias("X"), (F.col("folio") % 500).cast("double").alias("Y"))
    return rounded(permits.clean_permits(raw, categories, uses, places), 2)


PERMIT_ROWS = """SELECT l_orderkey AS folio, CAST(l_partkey % 40 AS INT) AS lu, CASE l_linenumber WHEN 1 THEN 'sq. ft.' WHEN 2 THEN 'unit' WHEN 3 THEN 'acre' WHEN 4 THEN 'room' ELSE 'screen' END AS unit_name,
 l_quantity AS qty, l_extendedprice AS cost FROM lineitem"""
_REFERENCE = f"""u AS (SELECT DISTINCT lu, unit_name FROM ({PERMIT_ROWS})),
 m AS (SELECT lu, median(living) AS area, median(CASE WHEN units <> 0 THEN living / units END) AS per_unit, median(CASE WHEN land <> 0 THEN living / (land / 43560) END) AS per_acre FROM v_parcels GROUP BY 1),
 ref AS (SELECT u.lu, u.unit_name, CASE WHEN unit_name = 'sq. ft.' THEN 1.0 WHEN unit_name IN ('unit', 'room') THEN per_unit WHEN unit_name = 'acre' THEN per_acre ELSE -1.0 END AS mult,
  CASE WHEN unit_name = 'screen' THEN coalesce(area, -1.0) ELSE -1.0 END AS over FROM u LEFT JOIN m ON u.lu = m.lu)"""
FIELDS = {"bed": "units", "room": "units", "unit": "units", "acre": "land / 43560"}


def _permit_rows(spark, sf):
    return run_sql(spark, sf, PERMIT_ROWS)


def _reference(spark, sf):
    return permits.unit_reference(view(spark, sf, "v_parcels"), _permit_rows(spark, sf), "lu", "living", "unit_name", FIELDS)


@register("unit_reference", with_views("v_parcels", f"""
WITH {_REFERENCE} SELECT lu, unit_name, round(mult, 4) AS "Multiplier", round(over, 4) AS "Overwrite" FROM ref"""))
def unit_reference(spark, sf):
    return rounded(_reference(spark, sf))


_ROLL = f"""{_REFERENCE}, pr AS (SELECT p.*, coalesce(CASE WHEN over = -1 AND mult <> -1 THEN qty * mult WHEN mult = -1 AND over <> -1 THEN over ELSE 0.0 END, 0.0) AS upd,
  CASE WHEN p.unit_name IN ('bed', 'room', 'unit') THEN qty ELSE 0.0 END AS upd_u FROM ({PERMIT_ROWS}) p LEFT JOIN ref ON p.lu = ref.lu AND p.unit_name = ref.unit_name),
 bu AS (SELECT folio, lu, sum(qty) AS qty, sum(cost) AS cost, sum(upd) AS upd, sum(upd_u) AS upd_u FROM pr GROUP BY 1, 2),
 ru AS (SELECT folio, sum(qty) AS qty, sum(cost) AS cost, sum(upd) AS upd, sum(upd_u) AS upd_u FROM bu GROUP BY 1),
 top AS (SELECT folio, lu FROM (SELECT *, row_number() OVER (PARTITION BY folio ORDER BY upd DESC, lu) AS rn FROM bu) WHERE rn = 1)"""


@register("permit_rollup", with_views("v_parcels", f"""
WITH {_ROLL} SELECT folio, lu, qty, round(cost, 4) AS cost, round(upd, 4) AS "UPDT_LVG_AREA", upd_u AS "UPDT_units" FROM ru JOIN top USING (folio)"""))
def permit_rollup(spark, sf):
    return rounded(permits.permit_roll_up(_permit_rows(spark, sf), _reference(spark, sf), "folio", "lu", "unit_name", "qty", "cost",
                                          {"units": ("bed", "room", "unit")}), 4)


@register("short_term_update", with_views("v_parcels", f"""
WITH {_ROLL}, p AS (SELECT folio, lu, living, land, land * 0.8 AS jv, CAST(jobs AS DOUBLE) AS bld, CAST(units AS DOUBLE) AS units FROM v_parcels)
SELECT p.folio, coalesce(top.lu, p.lu) AS lu, round(p.living + coalesce(upd, 0), 4) AS living, round(p.land, 4) AS land, round(CASE WHEN upd IS NULL THEN jv ELSE greatest(p.land + cost, jv) END, 4) AS jv,
 CASE WHEN upd IS NULL THEN bld WHEN upd = 0 THEN 0.0 ELSE 1.0 END AS bld, p.units + coalesce(upd_u, 0) AS units, CASE WHEN upd IS NULL THEN 0 ELSE 1 END AS "PERMIT",
 round(coalesce(upd, 0.0), 4) AS "UPDT_LVG_AREA", coalesce(upd_u, 0.0) AS "UPDT_units" FROM p LEFT JOIN ru USING (folio) LEFT JOIN top USING (folio)"""))
def short_term_update(spark, sf):
    parcels = view(spark, sf, "v_parcels").select("folio", "lu", "living", "land", (F.col("land") * 0.8).alias("jv"), F.col("jobs").cast("double").alias("bld"),
                                                  F.col("units").cast("double").alias("units"))
    return rounded(permits.short_term_parcels(parcels, _permit_rows(spark, sf), _reference(spark, sf), "folio", "lu", "living", "land", "jv", "bld",
                                              "unit_name", "qty", "cost", {"units": ("bed", "room", "unit")}), 4)


# --- energy ---------------------------------------------------------------

# Estimates by level come from the data: means of prices by class, with their errors.
TYPES = ("Apartments in buildings with 2-4 units", "Apartments in buildings with 5 or more units", "Mobile homes", "Single-family attached", "Single-family detached")
SIZES = ("Fewer than 1,000", "1,000 to 1,499", "1,500 to 1,999", "2,000 to 2,499", "2,500 to 2,999", "3,000 or greater")
AGES = ("Before 1950", *(f"{y} to {y + 9}" for y in range(1950, 2010, 10)), "2010 to 2015")


def _case(column: str, labels) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels)) + " END"


def _level(category: str, label: str, expr: str) -> str:
    return (f"SELECT '{category}' AS Category, {label} AS Level, avg({expr}) AS Estimate, stddev_pop({expr}) / 8 AS SE FROM part GROUP BY 2")


ENERGY = " UNION ALL ".join([
    _level("Division", _case("p_partkey % 2", ("South Atlantic", "Mountain")), "p_size / 10.0"),
    _level("Housing unit", _case("p_partkey % 5", TYPES), "(p_size + p_partkey % 5 * 3) / 10.0"),
    _level("Year", _case("p_partkey % 8", AGES), "(p_size + p_partkey % 8 * 2) / 10.0"),
    _level("SQFT", _case("p_partkey % 6", SIZES), "(p_size + p_partkey % 6 * 4) / 10.0")])


def _estimates(spark, sf):
    return run_sql(spark, sf, ENERGY).withColumns({"Fuel": F.lit("Total Energy"), "End_Use": F.lit("Total")})


_COMBOS = f"""e AS ({ENERGY}), cb AS (SELECT a.Level AS "Division", b.Level AS "Housing unit", c.Level AS "Year", d.Level AS "SQFT",
  a.Estimate AS m1, a.SE AS s1, b.Estimate AS m2, b.SE AS s2, c.Estimate AS m3, c.SE AS s3, d.Estimate AS m4, d.SE AS s4
  FROM e a, e b, e c, e d WHERE a.Category = 'Division' AND a.Level = 'South Atlantic' AND b.Category = 'Housing unit' AND c.Category = 'Year' AND d.Category = 'SQFT'),
 lim AS (SELECT *, least(m1 - 3 * s1, m2 - 3 * s2, m3 - 3 * s3, m4 - 3 * s4) AS lo, greatest(m1 + 3 * s1, m2 + 3 * s2, m3 + 3 * s3, m4 + 3 * s4) AS hi FROM cb),
 g AS (SELECT *, unnest(range(CAST(floor((hi - lo) / 0.001 + 1e-9) AS BIGINT) + 1)) AS i FROM lim), gx AS (SELECT *, lo + i * 0.001 AS x FROM g),
 sc AS (SELECT "Division", "Housing unit", "Year", "SQFT", i, x, least({', '.join(f'exp(-((x - m{k}) / s{k}) * ((x - m{k}) / s{k}) / 2) / (s{k} * sqrt(2 * pi()))' for k in range(1, 5))}) AS d FROM gx),
 best AS (SELECT "Division", "Housing unit", "Year", "SQFT", arg_max(x, d) AS energy FROM sc GROUP BY 1, 2, 3, 4)"""


@register("energy_overlap", f"""WITH {_COMBOS} SELECT "Division", "Housing unit", "Year", "SQFT", round(energy, 2) AS "Energy" FROM best""")
def energy_overlap(spark, sf):
    return rounded(energy.energy_by_type(_estimates(spark, sf)), 2)


@register("energy_to_parcels", f"""
WITH {_COMBOS}, p AS (SELECT o_orderkey, CASE o_custkey % 3 WHEN 0 THEN '01' WHEN 1 THEN '02' ELSE '03' END AS lu, CAST(floor(o_totalprice / 100) AS DOUBLE) AS tla, CAST(1940 + o_custkey % 80 AS INT) AS yr, CAST(o_orderkey % 7 AS INT) AS ru FROM orders),
 k AS (SELECT o_orderkey, CASE WHEN lu = '03' AND ru BETWEEN 2 AND 4 THEN 'Apartments in buildings with 2-4 units' WHEN lu = '03' AND ru >= 5 THEN 'Apartments in buildings with 5 or more units'
   WHEN lu = '02' THEN 'Mobile homes' WHEN lu = '01' AND ru > 1 THEN 'Single-family attached' WHEN lu = '01' AND ru = 1 THEN 'Single-family detached' ELSE 'FAILED' END AS h,
  CASE WHEN tla <= 999 THEN 'Fewer than 1,000' WHEN tla <= 1499 THEN '1,000 to 1,499' WHEN tla <= 1999 THEN '1,500 to 1,999' WHEN tla <= 2499 THEN '2,000 to 2,499' WHEN tla <= 2999 THEN '2,500 to 2,999' ELSE '3,000 or greater' END AS s,
  CASE WHEN yr <= 1949 THEN 'Before 1950' WHEN yr >= 2010 THEN '2010 to 2015' ELSE concat(CAST(yr - yr % 10 AS VARCHAR), ' to ', CAST(yr - yr % 10 + 9 AS VARCHAR)) END AS y FROM p)
SELECT o_orderkey, round(coalesce(energy, 0.0), 2) AS "BTU_RES" FROM k LEFT JOIN best ON h = "Housing unit" AND s = "SQFT" AND y = "Year" """)
def energy_to_parcels(spark, sf):
    c = F.col
    parcels = table(spark, sf, "orders").select(
        "o_orderkey", F.when(c("o_custkey") % 3 == 0, "01").when(c("o_custkey") % 3 == 1, "02").otherwise("03").alias("lu"),
        F.floor(c("o_totalprice") / 100).cast("double").alias("tla"), (1940 + c("o_custkey") % 80).cast("int").alias("yr"), (c("o_orderkey") % 7).cast("int").alias("ru"))
    return rounded(energy.energy_to_parcels(parcels, energy.energy_by_type(_estimates(spark, sf)), "o_orderkey", "lu", "tla", "yr", "ru"), 2)

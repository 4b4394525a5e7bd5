"""Spatial queries: membership, distance, nearest, clipping and summary areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.functions import geometry as geo
from arealens.functions import scalar as sc
from arealens.operators import areas as ar
from arealens.operators import network as nw
from arealens.operators import spatial as sp
from arealens.operators.aggregate import diversity, zonal_imperviousness
from arealens.operators.joins import merge_layers, update
from arealens.operators.aggregate import pivot_sum
from arealens.plans.queries import register, rounded
from arealens.plans.standins import run_sql, table, view, with_views
from arealens.sources.writers import to_points


def boxes(df, key: str):
    """Rectangles as polygons with one ring."""
    c = F.col
    return df.select(key, F.array(geo.box_ring(c("xmin"), c("ymin"), c("xmax"), c("ymax"))).alias("rings"))


def in_zones(spark, sf):
    return sp.point_in_polygon(view(spark, sf, "v_points"), boxes(view(spark, sf, "v_zones"), "zone"), "x", "y", "rings")


def in_areas(spark, sf):
    return sp.point_in_polygon(view(spark, sf, "v_points"), boxes(view(spark, sf, "v_areas"), "area"), "x", "y", "rings")


INSIDE = "x >= xmin AND x < xmax AND y >= ymin AND y < ymax"


@register("point_in_polygon", with_views("v_points v_areas", f"SELECT id, area, cls FROM v_points JOIN v_areas ON {INSIDE}"))
def point_in_polygon(spark, sf):
    return in_areas(spark, sf).select("id", "area", "cls")


# One outline per nation: its customers around a middle place, by bearing in steps, joined in turn.
OUTLINES = """SELECT zone, x1, y1, coalesce(lead(x1) OVER (PARTITION BY zone ORDER BY turn, id), fx) AS x2, coalesce(lead(y1) OVER (PARTITION BY zone ORDER BY turn, id), fy) AS y2 FROM (
 SELECT *, first_value(x1) OVER (PARTITION BY zone ORDER BY turn, id) AS fx, first_value(y1) OVER (PARTITION BY zone ORDER BY turn, id) AS fy FROM (
 SELECT c_nationkey AS zone, c_custkey AS id, CAST((c_custkey * 37) % 360 AS DOUBLE) AS turn,
  500 + (200 + (c_custkey * 7919) % 300) * cos(((c_custkey * 37) % 360) / CAST(57.3 AS DOUBLE)) AS x1,
  500 + (200 + (c_custkey * 7919) % 300) * sin(((c_custkey * 37) % 360) / CAST(57.3 AS DOUBLE)) AS y1 FROM customer) a) b"""


@register("points_in_outlines", with_views("v_points", f"""
WITH e AS ({OUTLINES}) SELECT id, zone FROM v_points JOIN e ON (y1 <= y) <> (y2 <= y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1)
GROUP BY 1, 2 HAVING count(*) % 2 = 1"""))
def points_in_outlines(spark, sf):
    return sp.point_in_edges(view(spark, sf, "v_points").select("id", "x", "y"), run_sql(spark, sf, OUTLINES), "x", "y", "zone").select("id", "zone")


@register("area_sums", with_views("v_points v_areas", f"""
SELECT area, count(*) AS n, round(sum(w), 2) AS w FROM v_points JOIN v_areas ON {INSIDE} GROUP BY 1"""))
def area_sums(spark, sf):
    return rounded(in_areas(spark, sf).groupBy("area").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")), 2)


@register("centre_in_area", with_views("v_points v_areas", f"""
SELECT id FROM v_points WHERE EXISTS (SELECT 1 FROM v_areas WHERE {INSIDE})"""))
def centre_in_area(spark, sf):
    county = boxes(view(spark, sf, "v_areas"), "area")
    return sp.centre_in_area(view(spark, sf, "v_points"), county, "x", "y", "rings", "id").select("id")


@register("zones_by_year", with_views("v_points v_areas", f"""
SELECT id, Year FROM (SELECT id FROM v_points WHERE EXISTS (SELECT 1 FROM v_areas WHERE {INSIDE})),
 (SELECT CAST(2014 AS INT) AS Year UNION ALL SELECT CAST(2015 AS INT))"""))
def zones_by_year(spark, sf):
    county = boxes(view(spark, sf, "v_areas"), "area")
    return ar.zones_by_year(view(spark, sf, "v_points"), county, [2014, 2015], "id").select("id", "Year")


@register("centroid_area", with_views("v_areas", """
SELECT area, CAST((xmax - xmin) * (ymax - ymin) AS DOUBLE) AS size, round((xmin + xmax) / 2.0, 6) AS cx, round((ymin + ymax) / 2.0, 6) AS cy,
  CAST(2 * (xmax - xmin) + 2 * (ymax - ymin) AS DOUBLE) AS outline FROM v_areas"""))
def centroid_area(spark, sf):
    ring = F.element_at("rings", 1)
    return boxes(view(spark, sf, "v_areas"), "area").select(
        "area", geo.polygon_area(F.col("rings")).alias("size"), F.round(geo.ring_centroid(ring)["x"], 6).alias("cx"),
        F.round(geo.ring_centroid(ring)["y"], 6).alias("cy"), geo.line_length(ring).alias("outline"))


@register("parcel_centroids", """
SELECT o_orderkey, round((o_custkey % 900) + (10 + o_orderkey % 50) / 2.0, 4) AS cx, CAST((o_orderkey % 900) + 4 AS DOUBLE) AS cy, CAST((10 + o_orderkey % 50) * 8 AS DOUBLE) AS size FROM orders""")
def parcel_centroids(spark, sf):
    c = F.col
    lots = table(spark, sf, "orders").select(
        "o_orderkey", (c("o_custkey") % 900).alias("x0"), (c("o_orderkey") % 900).alias("y0"), (10 + c("o_orderkey") % 50).alias("w"))
    ring = geo.box_ring(c("x0"), c("y0"), c("x0") + c("w"), c("y0") + 8)
    shaped = lots.select("o_orderkey", ring.alias("ring"))
    centre = geo.ring_centroid(c("ring"))
    return rounded(shaped.select("o_orderkey", centre["x"].alias("cx"), centre["y"].alias("cy"), geo.ring_area(c("ring")).alias("size")))


@register("adjacency", with_views("v_zones", """
SELECT a.zone AS src, b.zone AS nbr FROM v_zones a JOIN v_zones b ON a.zone <> b.zone
 AND a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin"""))
def adjacency(spark, sf):
    return sp.adjacency(boxes(view(spark, sf, "v_zones"), "zone"), "zone", "rings")


DIST = "sqrt((x - tx) * (x - tx) + (y - ty) * (y - ty))"


@register("within_distance", with_views("v_points v_targets", f"""
SELECT id, target, round({DIST}, 6) AS dist FROM v_points JOIN v_targets ON {DIST} <= 60"""))
def within_distance(spark, sf):
    hits = sp.within_distance(view(spark, sf, "v_points"), view(spark, sf, "v_targets"), "x", "y", "tx", "ty", 60.0)
    return rounded(hits.select("id", "target", "dist"), 6)


@register("within_distance_keep_all", with_views("v_points v_targets", f"""
SELECT id, count(target) AS n FROM v_points LEFT JOIN v_targets ON {DIST} <= 25 GROUP BY 1"""))
def within_distance_keep_all(spark, sf):
    hits = sp.within_distance(view(spark, sf, "v_points"), view(spark, sf, "v_targets"), "x", "y", "tx", "ty", 25.0, how="left", key="id")
    return hits.groupBy("id").agg(F.count("target").alias("n"))


@register("nearest_target", with_views("v_points v_targets", f"""
SELECT id, target, round(dist, 6) AS dist FROM (SELECT id, target, {DIST} AS dist,
 row_number() OVER (PARTITION BY id ORDER BY {DIST}, target) AS rn FROM v_points, v_targets) WHERE rn = 1"""))
def nearest_target(spark, sf):
    return rounded(sp.nearest(view(spark, sf, "v_points"), view(spark, sf, "v_targets"), "id", "x", "y", "tx", "ty", "target"), 6)


@register("nearest_in_group", with_views("v_points v_targets", f"""
SELECT id, target, round(dist, 6) AS dist FROM (SELECT id, target, {DIST} AS dist,
 row_number() OVER (PARTITION BY id ORDER BY {DIST}, target) AS rn FROM v_points JOIN customer ON id = c_custkey JOIN v_targets ON c_nationkey = grp) WHERE rn = 1"""))
def nearest_in_group(spark, sf):
    points = view(spark, sf, "v_points").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("grp")), "id")
    return rounded(sp.nearest(points, view(spark, sf, "v_targets"), "id", "x", "y", "tx", "ty", "target", by=["grp"]), 6)


T = "greatest(0.0, least(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))))"
SEG = f"sqrt((x - (x1 + {T} * (x2 - x1))) * (x - (x1 + {T} * (x2 - x1))) + (y - (y1 + {T} * (y2 - y1))) * (y - (y1 + {T} * (y2 - y1))))"


@register("snap_to_edges", with_views("v_points v_lines", f"""
SELECT id, line, round(dist, 6) AS dist FROM (SELECT id, line, {SEG} AS dist, row_number() OVER (PARTITION BY id ORDER BY {SEG}, line) AS rn
 FROM v_points, v_lines) WHERE rn = 1 AND dist <= 30"""))
def snap_to_edges(spark, sf):
    return rounded(sp.snap_to_edges(view(spark, sf, "v_points"), view(spark, sf, "v_lines"), "id", "x", "y", "line", tolerance=30.0), 6)


@register("spatial_anti", with_views("v_points v_lines", f"""
SELECT id FROM v_points WHERE NOT EXISTS (SELECT 1 FROM v_lines WHERE {SEG} <= 40)"""))
def spatial_anti(spark, sf):
    return sp.beyond_distance_of_lines(view(spark, sf, "v_points"), view(spark, sf, "v_lines"), "x", "y", 40.0, "id").select("id")


@register("ideal_walk_time", with_views("v_points v_targets", f"""
WITH n AS (SELECT id, target, {DIST} * 10 * 60.0 / (3.0 * 1609.344) AS m FROM v_points JOIN v_targets ON {DIST} <= 100),
 r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, target) AS rn, count(*) OVER (PARTITION BY id) AS k FROM n)
SELECT id, target AS nearest_stn, round(m, 6) AS min_time_stn, k AS n_stn,
  CASE WHEN m <= 5 THEN '0 to 5 minutes' WHEN m <= 10 THEN '5 to 10 minutes' WHEN m <= 15 THEN '10 to 15 minutes'
  WHEN m <= 20 THEN '15 to 20 minutes' WHEN m <= 25 THEN '20 to 25 minutes' WHEN m <= 30 THEN '25 to 30 minutes' ELSE 'over 30 minutes' END AS bin_stn
FROM r WHERE rn = 1"""))
def ideal_walk_time(spark, sf):
    return rounded(nw.ideal_walk_times(view(spark, sf, "v_points"), view(spark, sf, "v_targets"), "id", "x", "y", "target",
                                       "tx", "ty", "stn", 100.0, meters_per_unit=10.0), 6)


@register("feature_walk_time", with_views("v_points v_lines", f"""
WITH n AS (SELECT id, kind, avg(CAST(line % 40 AS DOUBLE)) AS m FROM v_points JOIN v_lines ON {SEG} <= 30 GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, kind) AS rn, count(*) OVER (PARTITION BY id) AS k FROM n)
SELECT p.id, kind AS nearest_park, round(m, 6) AS min_time_park, coalesce(k, 0) AS n_park,
  CASE WHEN m IS NULL THEN '' WHEN m <= 5 THEN '0 to 5 minutes' WHEN m <= 10 THEN '5 to 10 minutes' WHEN m <= 15 THEN '10 to 15 minutes'
  WHEN m <= 20 THEN '15 to 20 minutes' WHEN m <= 25 THEN '20 to 25 minutes' WHEN m <= 30 THEN '25 to 30 minutes' ELSE 'over 30 minutes' END AS bin_park
FROM v_points p LEFT JOIN (SELECT * FROM r WHERE rn = 1) b ON p.id = b.id"""))
def feature_walk_time(spark, sf):
    lines = view(spark, sf, "v_lines").withColumn("t", (F.col("line") % 40).cast("double"))
    return rounded(nw.feature_walk_times(view(spark, sf, "v_points"), lines, "id", "x", "y", "kind", "t", "park", 30.0), 6)


@register("grid_fallback", with_views("v_points v_lines v_targets", f"""
SELECT id AS OName, target AS DName, round((abs(tx - x) + abs(ty - y)) * 20 * 60.0 / (3.0 * 1609.344), 6) AS Minutes
FROM (SELECT * FROM v_points WHERE NOT EXISTS (SELECT 1 FROM v_lines WHERE {SEG} <= 40)) JOIN v_targets ON {DIST} <= 120
WHERE (abs(tx - x) + abs(ty - y)) * 20 * 60.0 / (3.0 * 1609.344) <= 15"""))
def grid_fallback(spark, sf):
    return rounded(nw.grid_fallback(view(spark, sf, "v_points"), view(spark, sf, "v_targets"), view(spark, sf, "v_lines"),
                                    "id", "x", "y", "target", "tx", "ty", 40.0, 120.0, 15.0, meters_per_unit=20.0), 6)


@register("walk_geometry", with_views("v_points v_targets", f"""
SELECT id, round(sqrt((x - 500) * (x - 500) + (y - 500) * (y - 500)) * 0.3048, 6) AS meters,
  round((abs(x - 500) + abs(y - 500)) * 0.3048 * 60.0 / (3.0 * 1609.344), 6) AS grid_minutes, round(x * y / 43560.0, 8) AS acres FROM v_points"""))
def walk_geometry(spark, sf):
    c, m = F.col, F.lit(500.0)
    return view(spark, sf, "v_points").select(
        "id", F.round(sc.straight_distance(c("x"), c("y"), m, m, 0.3048), 6).alias("meters"),
        F.round(sc.walk_minutes(sc.grid_distance(c("x"), c("y"), m, m, 0.3048)), 6).alias("grid_minutes"),
        F.round(c("x") * c("y") / sc.SQFT_PER_ACRE, 8).alias("acres"))


# The equations of a geodesic solved by Simpson's rule on their integrals, in sixteen rounds; the operator uses series.
_F = "(1 / CAST(298.257222101 AS DOUBLE))"


def _simpson(body: str) -> str:
    return (f"list_sum(list_transform(range(0, 41), lambda i: (CASE WHEN i = 0 OR i = 40 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * "
            f"{body.replace('@', f'(k2 * pow(sin(s1 + arc * i / 40), 2))')})) * arc / 120")


_GEODESIC = f"""
WITH RECURSIVE l AS (SELECT s_suppkey, atan((1 - {_F}) * tan(radians(25.0 + (s_suppkey % 100) / 100.0))) AS b1,
  atan((1 - {_F}) * tan(radians(25.0 + (s_suppkey % 100) / 100.0 + (1 + s_suppkey % 7) / 10.0))) AS b2, radians((1 + s_suppkey % 11) / 10.0) AS turn FROM supplier),
 w(s_suppkey, b1, b2, turn, w, n, k2, s1, arc) AS (SELECT s_suppkey, b1, b2, turn, turn, 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM l UNION ALL
  SELECT s_suppkey, b1, b2, turn, turn + {_F} * sa * {_simpson(f'(2 - {_F}) / (1 + (1 - {_F}) * sqrt(1 + @))')}, n + 1, k2, s1, arc FROM (
   SELECT *, (1 - sa * sa) * (1 / pow(1 - {_F}, 2) - 1) AS k2, atan2(sin(b1), cos(a1) * cos(b1)) AS s1 FROM (
    SELECT s_suppkey, b1, b2, turn, n, a1, arc, sin(a1) * cos(b1) AS sa FROM (
     SELECT s_suppkey, b1, b2, turn, n, atan2(cos(b2) * sin(w), cos(b1) * sin(b2) - sin(b1) * cos(b2) * cos(w)) AS a1,
      acos(sin(b1) * sin(b2) + cos(b1) * cos(b2) * cos(w)) AS arc FROM w WHERE n < 16))))
SELECT s_suppkey, round(6378137.0 * (1 - {_F}) * {_simpson('sqrt(1 + @)')} / 1609.344, 6) AS Bike_Miles FROM w WHERE n = 16"""


@register("geodesic_miles", _GEODESIC)
def geodesic_miles(spark, sf):
    c = F.col
    rows = table(spark, sf, "supplier").withColumns({
        "lat": F.lit(25.0) + (c("s_suppkey") % 100) / 100.0, "dlat": (1 + c("s_suppkey") % 7) / 10.0, "dlon": (1 + c("s_suppkey") % 11) / 10.0})
    line = F.array(F.struct(F.lit(-80.0).alias("x"), c("lat").alias("y")), F.struct((F.lit(-80.0) + c("dlon")).alias("x"), (c("lat") + c("dlat")).alias("y")))
    return rows.select("s_suppkey", F.round(geo.geodesic_miles(line), 6).alias("Bike_Miles"))


@register("web_mercator_points", with_views("v_points", """
SELECT id, round(radians(x / 100 - 80) * 6378137.0, 4) AS px, round(ln(tan(pi() / 4 + radians(y / 100 + 20) / 2)) * 6378137.0, 4) AS py FROM v_points"""))
def web_mercator_points(spark, sf):
    c = F.col
    p = geo.project(c("x") / 100 - 80, c("y") / 100 + 20, 3857)
    return view(spark, sf, "v_points").select("id", F.round(p["x"], 4).alias("px"), F.round(p["y"], 4).alias("py"))


# The projection by conformal latitude and the series in the third flattening; the operator uses the series in the longitude.
_N = "(1 / (2 * CAST(298.257222101 AS DOUBLE) - 1))"
_KRUEGER = {1: f"{_N} / 2 - 2 * pow({_N}, 2) / 3 + 5 * pow({_N}, 3) / 16 + 41 * pow({_N}, 4) / 180", 2: f"13 * pow({_N}, 2) / 48 - 3 * pow({_N}, 3) / 5 + 557 * pow({_N}, 4) / 1440",
            3: f"61 * pow({_N}, 3) / 240 - 103 * pow({_N}, 4) / 140", 4: f"49561 * pow({_N}, 4) / 161280"}
_CONFORMAL = f"sinh(atanh(sin(phi)) - 2 * sqrt({_N}) / (1 + {_N}) * atanh(2 * sqrt({_N}) / (1 + {_N}) * sin(phi)))"
_RECTIFIED = f"0.999941177 * 6378137.0 / (1 + {_N}) * (1 + pow({_N}, 2) / 4 + pow({_N}, 4) / 64)"
_GRID = f"""SELECT id, {_RECTIFIED} * (eta + {' + '.join(f'({a}) * cos({2 * j} * xi) * sinh({2 * j} * eta)' for j, a in _KRUEGER.items())}) AS e,
  {_RECTIFIED} * (xi + {' + '.join(f'({a}) * sin({2 * j} * xi) * cosh({2 * j} * eta)' for j, a in _KRUEGER.items())}) AS n FROM (
 SELECT id, atan2(t, cos(w)) AS xi, atanh(sin(w) / sqrt(1 + t * t)) AS eta FROM (SELECT id, w, {_CONFORMAL} AS t FROM q))"""


@register("state_plane_points", with_views("v_points", f"""
WITH q AS (SELECT id, radians(x / 1000 - 80.5 + 81) AS w, radians(y / 1000 + 25) AS phi FROM v_points UNION ALL SELECT -1, 0.0, radians(24 + CAST(20 AS DOUBLE) / 60)),
 g AS ({_GRID})
SELECT id, round((e + 200000) * 3937 / 1200, 3) AS px, round((n - (SELECT n FROM g WHERE id = -1)) * 3937 / 1200, 3) AS py FROM g WHERE id >= 0"""))
def state_plane_points(spark, sf):
    c = F.col
    p = geo.project(c("x") / 1000 - 80.5, c("y") / 1000 + 25, 2881)
    return view(spark, sf, "v_points").select("id", F.round(p["x"], 3).alias("px"), F.round(p["y"], 3).alias("py"))


@register("state_plane_to_mercator", with_views("v_points", """
SELECT id, round(radians(x / 1000 - 80.5) * 6378137.0, 4) AS px, round(ln(tan(pi() / 4 + radians(y / 1000 + 25) / 2)) * 6378137.0, 4) AS py FROM v_points"""))
def state_plane_to_mercator(spark, sf):
    """Points in feet of the state plane, projected on to web Mercator through the degrees they stand for."""
    c = F.col
    feet = view(spark, sf, "v_points").select("id", geo.project(c("x") / 1000 - 80.5, c("y") / 1000 + 25, 2881).alias("p")).select("id", "p.x", "p.y")
    out = to_points(feet, "x", "y", 2881, 3857)
    return out.select("id", F.round("geometry.x", 4).alias("px"), F.round("geometry.y", 4).alias("py"))


# Clip a line to a box: the share of the line between the later entry and the earlier exit.
CLIP = ("greatest(0.0, least(1.0, (xmax - x1) / (x2 - x1), (ymax - y1) / (y2 - y1)) - greatest(0.0, (xmin - x1) / (x2 - x1), (ymin - y1) / (y2 - y1)))"
        " * sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))")


def _line_miles(spark, sf):
    return sp.line_length_in_polygons(view(spark, sf, "v_lines"), boxes(view(spark, sf, "v_areas"), "area"), "rings")


@register("line_in_polygon", with_views("v_lines v_areas", f"""
SELECT line, area, round({CLIP}, 6) AS inside FROM v_lines JOIN v_areas ON {CLIP} > 0"""))
def line_in_polygon(spark, sf):
    return rounded(_line_miles(spark, sf).select("line", "area", "inside"), 6)


@register("bike_miles_by_area", with_views("v_lines v_areas", f"""
WITH m AS (SELECT area, kind % 3 AS k, {CLIP} AS i FROM v_lines JOIN v_areas ON {CLIP} > 0),
 s AS (SELECT area, sum(CASE WHEN k = 0 THEN i ELSE 0.0 END) AS a, sum(CASE WHEN k = 1 THEN i ELSE 0.0 END) AS b, sum(CASE WHEN k = 2 THEN i ELSE 0.0 END) AS c FROM m GROUP BY 1)
SELECT v_areas.area, round(coalesce(a, 0.0), 4) AS "Bike_Lane", round(coalesce(b, 0.0), 4) AS "Paved_Path", round(coalesce(c, 0.0), 4) AS "Sidepath"
FROM v_areas LEFT JOIN s USING (area)"""))
def bike_miles_by_area(spark, sf):
    types = ["Bike Lane", "Paved Path", "Sidepath"]
    kind = F.element_at(F.array(*[F.lit(t) for t in types]), (F.col("kind") % 3 + 1).cast("int"))
    pivot = pivot_sum(_line_miles(spark, sf).withColumn("fac", kind), ["area"], "fac", "inside", types)
    zero = view(spark, sf, "v_areas").select("area", *[F.lit(0.0).alias(t.replace(" ", "_")) for t in types])
    return rounded(update(zero, pivot, "area"))


@register("inside_boundary", with_views("v_points", """
SELECT id, CASE WHEN (y < 400 AND x >= 300 + y * 0.5) OR (y >= 400 AND x >= 500 - (y - 400) * 0.25) THEN 1 ELSE 0 END AS "IN_UDB" FROM v_points"""))
def inside_boundary(spark, sf):
    # a boundary of two straight parts, from south to north
    bends = [(300.0, 0.0, 500.0, 400.0), (500.0, 400.0, 350.0, 1000.0)]
    line = spark.createDataFrame(bends, "x1 double, y1 double, x2 double, y2 double")
    return sp.inside_boundary(view(spark, sf, "v_points"), line, "x", "y").select("id", "IN_UDB")


@register("zonal_classes", with_views("v_cells v_zones", """
WITH c AS (SELECT zone, CASE WHEN val = 127 THEN 0 ELSE val END AS v FROM (SELECT *, col_no * 20 + 10 AS x, (row_no % 100) * 10 + 5 AS y FROM v_cells)
 JOIN v_zones ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax)
SELECT zone, round(avg(v), 6) AS "IMP_PCT", CAST(count(*) * 200 AS DOUBLE) AS "TotalArea", CAST(sum(CASE WHEN v = 0 THEN 200 ELSE 0 END) AS DOUBLE) AS "NonDevArea",
  CAST(sum(CASE WHEN v BETWEEN 1 AND 19 THEN 200 ELSE 0 END) AS DOUBLE) AS "DevOSArea", CAST(sum(CASE WHEN v BETWEEN 20 AND 49 THEN 200 ELSE 0 END) AS DOUBLE) AS "DevLowArea",
  CAST(sum(CASE WHEN v BETWEEN 50 AND 79 THEN 200 ELSE 0 END) AS DOUBLE) AS "DevMedArea", CAST(sum(CASE WHEN v >= 80 THEN 200 ELSE 0 END) AS DOUBLE) AS "DevHighArea"
FROM c GROUP BY 1"""))
def zonal_classes(spark, sf):
    cells = view(spark, sf, "v_cells").select("val", (F.col("col_no") * 20 + 10).alias("x"), ((F.col("row_no") % 100) * 10 + 5).alias("y"))
    hits = sp.point_in_polygon(cells, boxes(view(spark, sf, "v_zones"), "zone"), "x", "y", "rings")
    return rounded(zonal_imperviousness(hits, "zone", "val", 200.0), 6)


# --- station areas, corridors, summary areas ------------------------------

STATIONS = """SELECT target AS "StnId", tx, ty, concat('Station ', CAST(target AS VARCHAR(20))) AS "Name", CASE WHEN grp % 2 = 0 THEN 'Open' ELSE 'Planned' END AS "Status",
  CAST(CASE WHEN grp < 8 THEN 1 ELSE 0 END AS INT) AS "Green", CAST(CASE WHEN grp >= 5 AND grp < 15 THEN 1 ELSE 0 END AS INT) AS "EastWest",
  1 AS "AllCorridors" FROM v_targets"""
SPARK_STATIONS = STATIONS.replace('"', "`").replace("VARCHAR(20)", "STRING")
LABELS = {"EastWest": "East-West", "AllCorridors": ar.ALL_CORRIDORS}


def _stations(spark, sf):
    view(spark, sf, "v_targets").createOrReplaceTempView("v_targets")
    return spark.sql(SPARK_STATIONS)


def _stations_long(spark, sf):
    return ar.stations_long(_stations(spark, sf), ["StnId", "Name", "Status"], ["Green", "EastWest", "AllCorridors"], "tx", "ty", LABELS)


LONG_SQL = f"""st AS ({STATIONS}), sl AS (SELECT "StnId", "Name", "Status", tx, ty, 'Green' AS "Corridor" FROM st WHERE "Green" = 1
 UNION ALL SELECT "StnId", "Name", "Status", tx, ty, 'East-West' FROM st WHERE "EastWest" = 1 UNION ALL SELECT "StnId", "Name", "Status", tx, ty, '(All corridors)' FROM st)"""
# Corridor lines: the lines of the suppliers by nation group.
CORRIDOR_SQL = f"""al AS (SELECT CASE WHEN kind < 8 THEN 'Green' ELSE 'East-West' END AS "Corridor", x1, y1, x2, y2 FROM v_lines),
 co AS (SELECT DISTINCT id, "Corridor" FROM v_points JOIN al ON {SEG} <= 40), cm AS (SELECT * FROM co UNION ALL SELECT DISTINCT id, '(All corridors)' FROM co)"""


def _corridor_members(spark, sf):
    lines = view(spark, sf, "v_lines").withColumn("Corridor", F.when(F.col("kind") < 8, "Green").otherwise("East-West"))
    return ar.corridor_members(view(spark, sf, "v_points"), lines, "id", "x", "y", "Corridor", 40.0)


def _station_members(spark, sf):
    return ar.station_members(view(spark, sf, "v_points"), _stations(spark, sf), "id", "x", "y", "StnId", "tx", "ty", 50.0)


@register("stations_long", with_views("v_targets", f'WITH {LONG_SQL} SELECT "StnId", "Name", "Status", tx, ty, "Corridor", 1 AS "InCor" FROM sl'))
def stations_long(spark, sf):
    return _stations_long(spark, sf)


@register("station_areas", with_views("v_points v_targets", f'SELECT DISTINCT id, target AS "StnId" FROM v_points JOIN v_targets ON {DIST} <= 50'))
def station_areas(spark, sf):
    return _station_members(spark, sf)


@register("corridor_areas", with_views("v_points v_lines", f"WITH {CORRIDOR_SQL} SELECT * FROM cm"))
def corridor_areas(spark, sf):
    return _corridor_members(spark, sf)


@register("preset_areas", with_views("v_points v_targets v_areas", f"""
WITH d AS (SELECT DISTINCT id, target AS "StnId" FROM v_points JOIN v_targets ON {DIST} <= 50)
SELECT * FROM d WHERE "StnId" NOT IN (SELECT area FROM v_areas) UNION ALL SELECT id, CAST(area AS BIGINT) FROM v_points JOIN v_areas ON {INSIDE}"""))
def preset_areas(spark, sf):
    preset = in_areas(spark, sf).select("id", F.col("area").cast("bigint").alias("StnId"))
    return ar.override_members(_station_members(spark, sf), preset, "StnId").select("id", "StnId")


AREAS_SQL = f"""{LONG_SQL}, c AS (SELECT DISTINCT "Corridor" FROM sl),
 rows AS (SELECT 1 AS r, CAST(-1 AS BIGINT) AS "STN_ID", '(Entire corridor)' AS "Name", 'NA' AS "Status", "Corridor", 0 AS k FROM c
  UNION ALL SELECT 2, "StnId", "Name", "Status", "Corridor", "StnId" FROM sl
  UNION ALL SELECT 3, -2, '(All stations)', 'NA', "Corridor", 2 FROM c UNION ALL SELECT 3, -3, '(Outside station areas)', 'NA', "Corridor", 3 FROM c),
 sa AS (SELECT "STN_ID", "Name", "Status", "Corridor", row_number() OVER (ORDER BY r, "Corridor", k) AS "SummID" FROM rows)"""


def _areas(spark, sf):
    long = _stations_long(spark, sf)
    return ar.summary_areas(long.select("Corridor"), long, station="StnId")


@register("summary_areas", with_views("v_targets", f"WITH {AREAS_SQL} SELECT * FROM sa"))
def summary_areas(spark, sf):
    return _areas(spark, sf)


@register("summary_area_members", with_views("v_points v_targets v_lines", f"""
WITH {AREAS_SQL}, {CORRIDOR_SQL}, sm AS (SELECT DISTINCT id, target AS "STN_ID" FROM v_points JOIN v_targets ON {DIST} <= 50),
 near AS (SELECT DISTINCT sm.id, sa."Corridor" FROM sm JOIN sa USING ("STN_ID"))
SELECT "SummID", id FROM sa JOIN sm USING ("STN_ID")
UNION ALL SELECT "SummID", id FROM sa JOIN cm USING ("Corridor") WHERE "STN_ID" = -1
UNION ALL SELECT "SummID", id FROM sa JOIN near USING ("Corridor") WHERE "STN_ID" = -2
UNION ALL SELECT "SummID", cm.id FROM sa JOIN cm USING ("Corridor") WHERE "STN_ID" = -3
  AND NOT EXISTS (SELECT 1 FROM near WHERE near.id = cm.id AND near."Corridor" = cm."Corridor")"""))
def summary_area_members(spark, sf):
    return ar.summary_members(_areas(spark, sf), _corridor_members(spark, sf), _station_members(spark, sf), "id")


@register("floating_zones", with_views("v_targets", """
SELECT a.target AS zone, b.target AS member, round(sqrt((a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty)), 6) AS dist
FROM v_targets a JOIN v_targets b ON sqrt((a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty)) <= 90"""))
def floating_zones(spark, sf):
    return rounded(ar.floating_zones(view(spark, sf, "v_targets"), "target", "tx", "ty", 90.0), 6)


_AROUND = "FROM v_points a JOIN v_points b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 150"


def _around(spark, sf, by=()):
    points = view(spark, sf, "v_points")
    return ar.floating_sums(points, points, "id", "x", "y", "x", "y", 150.0, ["w"], by)


@register("floating_zone_sums", with_views("v_points", f"SELECT a.id AS zone, round(sum(b.w), 2) AS w, count(*) AS n {_AROUND} GROUP BY 1"))
def floating_zone_sums(spark, sf):
    return rounded(_around(spark, sf), 2)


@register("floating_zone_diversity", with_views("v_points", f"""
WITH s AS (SELECT a.id AS zone, b.cls, CAST(count(*) AS DOUBLE) AS n {_AROUND} GROUP BY 1, 2), t AS (SELECT *, n / sum(n) OVER (PARTITION BY zone) AS p FROM s)
SELECT zone, round(1 - sum(n * (n - 1)) / nullif(sum(n) * (sum(n) - 1), 0), 6) + 0.0 AS "Simpson", round(-sum(p * ln(p)) / ln(5.0), 6) + 0.0 AS "Shannon", round(1 - (max(p) - 0.2) / 0.8, 6) + 0.0 AS "BergerParker",
 round((1 / sum(p * p) - 1) / 4.0, 6) + 0.0 AS "ENP" FROM t GROUP BY 1"""))
def floating_zone_diversity(spark, sf):
    """Mix of classes around every point, five classes in all."""
    out = rounded(diversity(_around(spark, sf, ["cls"]), "zone", "cls", "n", 5), 6)
    return out.withColumns({c: F.col(c) + 0.0 for c in ("Simpson", "Shannon", "BergerParker", "ENP")})


@register("merged_layers", with_views("v_points v_targets", """
SELECT 'parks' AS layer, id, x, y, cls FROM v_points UNION ALL SELECT 'stations', target, tx, ty, NULL FROM v_targets"""))
def merged_layers(spark, sf):
    stations = view(spark, sf, "v_targets").select(F.col("target").alias("id"), F.col("tx").alias("x"), F.col("ty").alias("y"))
    return merge_layers({"parks": view(spark, sf, "v_points").drop("w"), "stations": stations}, "layer")


@register("merged_numbered", with_views("v_points v_targets", """
SELECT layer, id, row_number() OVER (ORDER BY layer, id) AS new_id FROM
 (SELECT 'parks' AS layer, id FROM v_points UNION ALL SELECT 'stations', target FROM v_targets)"""))
def merged_numbered(spark, sf):
    stations = view(spark, sf, "v_targets").select(F.col("target").alias("id"))
    return merge_layers({"parks": view(spark, sf, "v_points").select("id"), "stations": stations}, "layer", "new_id", ["layer", "id"])


@register("single_parts", with_views("v_points", """
SELECT id, CAST(k AS INT) AS part, CAST(1 + id % 3 AS DOUBLE) * k AS size FROM v_points, (SELECT unnest([1, 2, 3]) AS k)
WHERE k <= 1 + id % 2 OR id % 5 = 0"""))
def single_parts(spark, sf):
    c = F.col

    def strip(k):
        return F.array(geo.box_ring(c("x"), c("y") + 10 * k, c("x") + (1 + c("id") % 3), c("y") + 10 * k + k))

    shapes = view(spark, sf, "v_points").select("id", F.when(c("id") % 5 == 0, F.array(strip(1), strip(2), strip(3)))
                                                .when(c("id") % 2 == 1, F.array(strip(1), strip(2))).otherwise(F.array(strip(1))).alias("shape"))
    return rounded(ar.single_parts(shapes, "shape").select("id", "part", geo.polygon_area(c("rings")).alias("size")), 6)


_MERCATOR = "6378137 * ln(tan(pi() / 4 + radians({0}) / 2))"


@register("study_box_grown", with_views("v_points", f"""
WITH b AS (SELECT max(y) / 100 AS n, min(y) / 100 AS s, max(x) / 100 AS e, min(x) / 100 AS w FROM v_points)
SELECT round(degrees(2 * atan(exp(({_MERCATOR.format("n")} + 1609.34) / 6378137)) - pi() / 2), 9) AS north,
 round(degrees(2 * atan(exp(({_MERCATOR.format("s")} - 1609.34) / 6378137)) - pi() / 2), 9) AS south,
 round(e + degrees(1609.34 / 6378137), 9) AS east, round(w - degrees(1609.34 / 6378137), 9) AS west FROM b"""))
def study_box_grown(spark, sf):
    box = view(spark, sf, "v_points").agg(F.max("y").alias("n"), F.min("y").alias("s"), F.max("x").alias("e"), F.min("x").alias("w"))
    grown = geo.grown_box(*[F.col(c) / 100 for c in "nsew"])
    return box.select(*[F.round(c, 9).alias(n) for n, c in grown.items()])


@register("study_bbox", with_views("v_points", """
SELECT max(y) / 100 AS north, min(y) / 100 AS south, max(x) / 100 AS east, min(x) / 100 AS west,
  max(y) / 100 < 90 AND min(y) / 100 > -90 AND max(x) / 100 < 180 AND min(x) / 100 > -180 AS valid, max(y) < 90 AS raw_valid FROM v_points"""))
def study_bbox(spark, sf):
    box = view(spark, sf, "v_points").agg(F.max("y").alias("n"), F.min("y").alias("s"), F.max("x").alias("e"), F.min("x").alias("w"))
    c = F.col
    return box.select(
        (c("n") / 100).alias("north"), (c("s") / 100).alias("south"), (c("e") / 100).alias("east"), (c("w") / 100).alias("west"),
        geo.box_is_valid(c("n") / 100, c("s") / 100, c("e") / 100, c("w") / 100).alias("valid"),
        geo.box_is_valid(c("n"), c("s"), c("e"), c("w")).alias("raw_valid"))


@register("merged_subset", with_views("v_points v_targets v_areas", f"""
WITH a AS (SELECT * FROM v_areas), m AS (SELECT 'lots' AS layer, id, x, y FROM v_points UNION ALL SELECT 'stops', target, tx, ty FROM v_targets)
SELECT layer, id FROM m WHERE EXISTS (SELECT 1 FROM a WHERE {INSIDE})"""))
def merged_subset(spark, sf):
    stops = view(spark, sf, "v_targets").select(F.col("target").alias("id"), F.col("tx").alias("x"), F.col("ty").alias("y"))
    area = boxes(view(spark, sf, "v_areas"), "area")
    return ar.merge_subset({"lots": view(spark, sf, "v_points").select("id", "x", "y"), "stops": stops}, area, "id", tag="layer").select("layer", "id")


@register("reach_places", with_views("v_points v_lines", f"""
SELECT id, min(CASE WHEN line % 3 = 0 THEN CAST(15 AS DOUBLE) ELSE CAST(30 AS DOUBLE) END) AS ring FROM v_points JOIN v_lines ON {SEG} <= 25 GROUP BY 1"""))
def reach_places(spark, sf):
    lines = view(spark, sf, "v_lines").withColumn("ring", F.when(F.col("line") % 3 == 0, 15.0).otherwise(30.0))
    return nw.reach_cells(view(spark, sf, "v_points"), lines, "id", "x", "y", "ring", 25.0)

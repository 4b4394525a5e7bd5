"""Cell queries: contiguity, developable parts, rasterising, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.functions import geometry as geo
from arealens.operators import raster as op
from arealens.plans.queries import register, rounded
from arealens.plans.queries.places import OUTLINES, boxes
from arealens.plans.standins import run_sql, table, view, with_views


def _cells(spark, sf):
    return view(spark, sf, "v_cells").select(F.col("row_no").cast("bigint").alias("row"), F.col("col_no").cast("bigint").alias("col"), "part", "masked")


def _contiguity_sql(weight: str, top: int, keep: str = "masked = 0") -> str:
    return f"""c AS (SELECT row_no, col_no, part FROM v_cells WHERE {keep}),
     w AS (SELECT a.row_no, a.col_no, a.part, sum({weight}) AS w FROM c a JOIN c b ON a.part = b.part AND b.row_no BETWEEN a.row_no - 1 AND a.row_no + 1
      AND b.col_no BETWEEN a.col_no - 1 AND a.col_no + 1 GROUP BY 1, 2, 3),
     p AS (SELECT part, (avg(w) - 1) / {top - 1}.0 AS "Contiguity", count(*) * 1600.0 / 43560 AS "Developable_Area" FROM w GROUP BY 1)"""


_ROOK = "CASE WHEN abs(a.row_no - b.row_no) + abs(a.col_no - b.col_no) < 2 THEN 1 ELSE 0 END"
_QUEEN = "CASE abs(a.row_no - b.row_no) + abs(a.col_no - b.col_no) WHEN 1 THEN 2 ELSE 1 END"


def _index(spark, sf, weights):
    return rounded(op.contiguity(_cells(spark, sf).where("masked = 0"), "part", weights), 6)


for _name, _sql, _top in (("nn", "1", 9), ("rook", _ROOK, 5), ("queen", _QUEEN, 13)):
    register(f"contiguity_index_{_name}", with_views("v_cells", f"""
WITH {_contiguity_sql(_sql, _top)} SELECT part, round("Contiguity", 6) AS "Contiguity", round("Developable_Area", 6) AS "Developable_Area" FROM p"""))(
        lambda spark, sf, weights=_name: _index(spark, sf, weights))


@register("contiguity_summary", with_views("v_cells", f"""
WITH {_contiguity_sql("1", 9)}, q AS (SELECT part % 10 AS folio, "Contiguity" AS c, "Developable_Area" AS a FROM p)
SELECT folio, round(sum(a), 6) AS "Developable_Area", round(min(c), 6) AS "Min_Contiguity", round(max(c), 6) AS "Max_Contiguity", round(median(c), 6) AS "Median_Contiguity",
 round(avg(c), 6) AS "Mean_Contiguity", round(sum(a) * min(c), 6) AS "Min_Scaled_Area", round(sum(a) * max(c), 6) AS "Max_Scaled_Area",
 round(sum(a) * median(c), 6) AS "Median_Scaled_Area", round(sum(a) * avg(c), 6) AS "Mean_Scaled_Area" FROM q GROUP BY 1"""))
def contiguity_summary(spark, sf):
    parts = op.contiguity(_cells(spark, sf).where("masked = 0"), "part").withColumn("folio", F.col("part") % 10)
    return rounded(op.contiguity_summary(parts, "folio"), 6)


@register("developable_parts", with_views("v_cells", """
WITH c AS (SELECT row_no AS r, col_no AS c, part AS p, CAST(row_no AS BIGINT) * 100000 + col_no AS id FROM v_cells WHERE masked = 0),
 walk(id, r, c, p, seen) AS (SELECT id, r, c, p, id FROM c UNION SELECT b.id, b.r, b.c, b.p, w.seen FROM walk w JOIN c b ON w.p = b.p AND abs(w.r - b.r) + abs(w.c - b.c) = 1),
 l AS (SELECT id, min(p) AS p, min(seen) AS lab FROM walk GROUP BY 1)
SELECT p AS parcel, lab AS part, count(*) AS cells FROM l GROUP BY 1, 2""").replace("WITH ", "WITH RECURSIVE ", 1))
def developable_parts(spark, sf):
    cells = _cells(spark, sf).withColumnRenamed("part", "parcel")
    parts = op.developable_parts(cells.select("row", "col", "parcel"), cells.where("masked = 1"), "parcel")
    half = 1 << 31
    row, col = F.floor(F.col("part") / (2 * half)), F.col("part") % (2 * half) - half
    return parts.withColumn("part", (row * 100000 + col).cast("bigint")).groupBy("parcel", "part").agg(F.count(F.lit(1)).alias("cells"))


@register("rasterised_zones", with_views("v_areas", """
WITH g AS (SELECT unnest(range(0, 40)) AS i), c AS (SELECT a.i AS "row", b.i AS "col" FROM g a, g b)
SELECT max(area) AS area, CAST("row" AS BIGINT) AS "row", CAST("col" AS BIGINT) AS "col" FROM c JOIN v_areas ON ("col" + 0.5) * 40 >= xmin AND ("col" + 0.5) * 40 < xmax AND ("row" + 0.5) * 40 >= ymin AND ("row" + 0.5) * 40 < ymax GROUP BY 2, 3"""))
def rasterised_zones(spark, sf):
    return op.rasterise(boxes(view(spark, sf, "v_areas"), "area"), "area", "rings", 40.0)


@register("rasterised_lots", """
WITH l AS (SELECT c_custkey AS k, (c_custkey % 100) * 100 AS x0, CAST(floor(c_custkey / 100) AS INT) * 60 AS y0, 30 + c_nationkey AS w FROM customer)
SELECT k, count(*) AS cells FROM (SELECT k, unnest(range(CAST(ceil(x0 / 10.0 - 0.5) AS INT), CAST(ceil((x0 + w) / 10.0 - 0.5) AS INT))) AS c FROM l), (SELECT unnest(range(4)) AS r) GROUP BY 1""")
def rasterised_lots(spark, sf):
    c = F.col
    lots = table(spark, sf, "customer").select(
        c("c_custkey").alias("k"), ((c("c_custkey") % 100) * 100).alias("x0"), (F.floor(c("c_custkey") / 100) * 60).alias("y0"), (30 + c("c_nationkey")).alias("w"))
    shaped = lots.select("k", F.array(geo.box_ring(c("x0"), c("y0"), c("x0") + c("w"), c("y0") + 40)).alias("rings"))
    return op.rasterise(shaped, "k", "rings", 10.0).groupBy("k").agg(F.count(F.lit(1)).alias("cells"))


@register("rasterised_outlines", f"""
WITH e AS ({OUTLINES}), g AS (SELECT unnest(range(0, 50)) AS i), c AS (SELECT a.i AS "row", b.i AS "col", (b.i + 0.5) * CAST(20 AS DOUBLE) AS x, (a.i + 0.5) * CAST(20 AS DOUBLE) AS y FROM g a, g b)
SELECT zone, CAST("row" AS BIGINT) AS "row", CAST("col" AS BIGINT) AS "col" FROM c JOIN e ON (y1 <= y) <> (y2 <= y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1)
GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1""")
def rasterised_outlines(spark, sf):
    return op.edge_cells(run_sql(spark, sf, OUTLINES), "zone", 20.0)


@register("chunk_ids", with_views("v_points", """
WITH e AS (SELECT min(x) AS x0, min(y) AS y0, max(x) - min(x) AS ew, max(y) - min(y) AS eh FROM v_points),
 s AS (SELECT r, CAST(20 / r AS INT) AS c, row_number() OVER (ORDER BY abs(CAST(r AS DOUBLE) / (20 / r) - (SELECT eh / ew FROM e)), r) AS rn FROM (VALUES (1), (2), (4), (5), (10), (20)) t(r)),
 g AS (SELECT r, c FROM s WHERE rn = 1)
SELECT id, CAST(least(floor((y - y0) / (eh / r)), r - 1) * c + least(floor((x - x0) / (ew / c)), c - 1) AS INT) AS "ChunkID" FROM v_points, e, g"""))
def chunk_ids(spark, sf):
    return op.assign_chunks(view(spark, sf, "v_points"), "x", "y").select("id", "ChunkID")


# Cells of each lot, without the masked ones; parts by walking to the four neighbours; then what surrounds each cell in its part.
@register("contiguity_by_parcel", """
WITH RECURSIVE l AS (SELECT c_custkey AS k, (c_custkey % 100) * 10 AS c0, CAST(floor(c_custkey / 100) AS BIGINT) * 10 AS r0, 40 + c_nationkey AS w FROM customer),
 m AS (SELECT DISTINCT CAST(floor(o_custkey / 100) AS BIGINT) * 10 + o_orderkey % 6 AS r, (o_custkey % 100) * 10 + o_orderkey % 5 AS c FROM orders),
 g AS (SELECT unnest(range(0, 10)) AS i),
 f AS (SELECT k, r0 + a.i AS r, c0 + b.i AS c FROM l, g a, g b WHERE (a.i + 0.5) * 10 < w AND (b.i + 0.5) * 10 < w),
 n AS (SELECT f.*, r * 1000000 + c AS id FROM f ANTI JOIN m ON m.r = f.r AND m.c = f.c),
 walk(id, r, c, k, seen) AS (SELECT id, r, c, k, id FROM n UNION SELECT b.id, b.r, b.c, b.k, w.seen FROM walk w JOIN n b ON w.k = b.k AND abs(w.r - b.r) + abs(w.c - b.c) = 1),
 p AS (SELECT id, any_value(r) AS r, any_value(c) AS c, any_value(k) AS k, min(seen) AS part FROM walk GROUP BY 1),
 s AS (SELECT a.id, any_value(a.k) AS k, any_value(a.part) AS part, count(*) AS n FROM p a JOIN p b ON a.part = b.part AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY 1),
 q AS (SELECT k, part, (avg(n) - 1) / 8 AS x, count(*) * 100 / 43560.0 AS a FROM s GROUP BY 1, 2),
 o AS (SELECT l.k, coalesce(x, 0.0) AS x, coalesce(a, 0.0) AS a FROM l LEFT JOIN q ON q.k = l.k),
 z AS (SELECT k, sum(a) AS a, min(x) AS lo, max(x) AS hi, avg(x) AS mean, median(x) AS mid FROM o GROUP BY 1)
SELECT k AS folio, round(a, 6) AS "Developable_Area", round(lo, 6) AS "Min_Contiguity", round(hi, 6) AS "Max_Contiguity", round(mean, 6) AS "Mean_Contiguity", round(mid, 6) AS "Median_Contiguity",
 round(a * lo, 6) AS "Min_Scaled_Area", round(a * hi, 6) AS "Max_Scaled_Area", round(a * mid, 6) AS "Median_Scaled_Area", round(a * mean, 6) AS "Mean_Scaled_Area" FROM z""")
def contiguity_by_parcel(spark, sf):
    """Lots cut by masked cells, from shapes to parcel summary."""
    c = F.col
    lots = table(spark, sf, "customer").select(
        c("c_custkey").alias("folio"), ((c("c_custkey") % 100) * 100).alias("x0"), (F.floor(c("c_custkey") / 100) * 100).alias("y0"), (40 + c("c_nationkey")).alias("w"))
    shaped = lots.select("folio", (c("x0") + c("w") / 2).alias("x"), (c("y0") + c("w") / 2).alias("y"),
                         F.array(geo.box_ring(c("x0"), c("y0"), c("x0") + c("w"), c("y0") + c("w"))).alias("rings"))
    masked = table(spark, sf, "orders").select((F.floor(c("o_custkey") / 100) * 10 + c("o_orderkey") % 6).cast("bigint").alias("row"),
                                               ((c("o_custkey") % 100) * 10 + c("o_orderkey") % 5).cast("bigint").alias("col"))
    return rounded(op.contiguity_by_parcel(shaped, masked, "folio", "rings", "x", "y", 10.0), 6)


@register("cells_in_extent", with_views("v_cells v_areas", """
WITH b AS (SELECT min(xmin) AS a, min(ymin) AS b, max(xmax) AS c, max(ymax) AS d FROM v_areas),
 s AS (SELECT row_no, col_no, val, col_no * 20 + 10 AS x, (row_no % 100) * 10 + 5 AS y FROM v_cells)
SELECT row_no, col_no, val, CAST(200 AS DOUBLE) AS "CellArea" FROM s, b WHERE x >= a AND x <= c AND y >= b AND y <= d"""))
def cells_in_extent(spark, sf):
    cells = view(spark, sf, "v_cells").select("row_no", "col_no", "val", (F.col("col_no") * 20 + 10).alias("x"), ((F.col("row_no") % 100) * 10 + 5).alias("y"))
    areas = boxes(view(spark, sf, "v_areas"), "area")
    return op.cells_in_extent(cells, areas, "x", "y", "rings", 20.0, 10.0).drop("x", "y")

"""Spatial membership as joins: boxes on a grid, point in polygon, distance, nearest, adjacency, clipping.

Two devices carry everything here.

`box_join` pairs boxes that overlap. Each right-hand box goes to a grid whose cells are
at least as large as the box, so it lies in at most four cells, whatever mix of sizes
the table has. Cells that hold a large part of the rows are split by `spread_join`.

`nearest` walks down a pyramid of cells. Each cell carries the tight box of its members;
a cell is followed only while it can still hold a nearer member than some other cell
must hold. No pair list of a whole cell or a whole search radius is made.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arealens import skew
from arealens.functions.geometry import segment_distance, straight_line_pieces, vertex_pairs
from arealens.session import cut
from arealens.skew import JoinAdvice, hot_keys, spread_join

Box = tuple[str, str, str, str]
LEVEL_STEP = 2
LEAST_LEVEL = -20
LONG_EDGES = 1024
MOST_HALVINGS = 4  # of the grid's cells where points lie close together
PAIRS_PER_CELL_ROW = 8
TASK_PAIRS = 4_000_000
MOST_TASKS = 10_000


def _level(box: Box) -> Column:
    """Exponent of the grid for a box: cells of side 2^level, at least the box's longer side."""
    size = F.greatest(F.col(box[2]) - F.col(box[0]), F.col(box[3]) - F.col(box[1]), F.lit(2.0 ** LEAST_LEVEL))
    return (F.ceil(F.log2(size) / LEVEL_STEP) * LEVEL_STEP).cast("int")


def _cells(low: Column, high: Column, side: Column) -> Column:
    return F.sequence(F.floor(low / side), F.floor(high / side))


def _box_sizes(right: DataFrame, rbox: Box, *by: Column) -> list[Row]:
    """Number of boxes (n) and their bytes (b) per level, and per further key."""
    boxed = right.withColumn("__rl", _level(rbox))
    return boxed.where(F.col("__rl").isNotNull()).groupBy("__rl", *by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(skew.row_bytes(right)).alias("b")).collect()


def pairs_met(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> float:
    """How many pairs of rows have equal keys, from counts per key."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__a"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__b"))
    return a.join(b, list(keys)).agg(F.sum(F.col("__a") * F.col("__b").cast("double"))).first()[0] or 0.0


def tasks_for(pairs: float) -> int | None:
    """Into how many tasks a join of so many pairs goes, or None if one will do."""
    return min(int(pairs / TASK_PAIRS) + 1, MOST_TASKS) if pairs > TASK_PAIRS else None


def box_join(left: DataFrame, lbox: Box, right: DataFrame, rbox: Box, by: Sequence[str] = (), sizes: list[Row] | None = None) -> DataFrame:
    """All pairs of rows whose boxes overlap or touch. Column names of both sides must differ, except `by`.

    `left` is the longer table. Boxes of two sizes meet on the grid of the larger one, so
    a box of either side lies in at most four cells per size of the other side. The sizes
    in use, the number of boxes at each and their bytes are read to the driver, unless
    `sizes` holds them.

    Rows that share a cell are counted first. Where `left` are points and their cells hold
    many boxes, cells are halved up to MOST_HALVINGS times, so that most pairs that meet overlap.
    The join runs in a task for every TASK_PAIRS pairs, however few bytes the tables have.
    """
    boxed = right.withColumn("__rl", _level(rbox))
    counts = _box_sizes(right, rbox) if sizes is None else sizes
    levels = sorted(r["__rl"] for r in counts) or [0]
    are_points = lbox[0] == lbox[2] and lbox[1] == lbox[3]
    # Left boxes below the least right size need no grid of their own.
    if are_points:
        # Opened from an array: a literal among the keys would be folded, and the join would shuffle by other keys than the rows lie by.
        own, left_levels = F.explode(F.array(F.lit(levels[0]))), [levels[0]]
    else:
        own = F.greatest(_level(lbox), F.lit(levels[0]))
        found = left.select(own.alias("v")).where(F.col("v").isNotNull()).distinct().collect()
        left_levels = sorted(r["v"] for r in found) or [levels[0]]
    keys = ["__ll", "__rl", "__cx", "__cy", *by]

    def cell_side(halvings: int) -> Column:
        return F.pow(F.lit(2.0), F.greatest("__ll", "__rl") - halvings)

    def on_grid(df: DataFrame, box: Box, side: Column) -> DataFrame:
        x1, y1, x2, y2 = (F.col(c).cast("double") for c in box)
        return (
            df.withColumn("__cx", F.explode(_cells(x1, x2, side)))
            .withColumn("__cy", F.explode(_cells(y1, y2, side)))
        )

    def any_of(values: Sequence[int]) -> Column:
        return F.explode(F.array(*[F.lit(v) for v in values]))

    def gridded(halvings: int) -> tuple[DataFrame, DataFrame]:
        side = cell_side(halvings)
        return (on_grid(left.withColumn("__ll", own).withColumn("__rl", any_of(levels)), lbox, side),
                on_grid(boxed.withColumn("__ll", any_of(left_levels)), rbox, side))

    n_boxes = sum(r["n"] for r in counts)
    spread, boxes = gridded(0)
    met, halvings = pairs_met(spread, boxes, keys), 0
    if are_points:
        while halvings < MOST_HALVINGS and n_boxes * 4 ** (halvings + 1) * PAIRS_PER_CELL_ROW <= met:
            halvings += 1
        if halvings:
            spread, boxes = gridded(halvings)
            # A box is half as wide as a cell of its level on average.
            met *= ((0.5 + 0.5 ** halvings) / 1.5) ** 2
    side = cell_side(halvings)
    # At most so many cells per size of the left boxes, so the counts bound the gridded table.
    copies = (4 if not halvings else (2 ** halvings + 1) ** 2) * len(left_levels)
    if n_boxes * copies <= skew.SMALL_ROWS and sum(r["b"] for r in counts) * copies <= skew.SMALL_BYTES:
        advice = JoinAdvice(small=True)
    else:
        advice = JoinAdvice(hot=tuple(hot_keys(spread, keys)), hot_right=tuple(hot_keys(boxes, keys)))
    pairs = spread_join(spread, boxes, keys, "inner", advice, parts=tasks_for(met))
    corner_x = F.greatest(F.col(lbox[0]).cast("double"), F.col(rbox[0]).cast("double"))
    corner_y = F.greatest(F.col(lbox[1]).cast("double"), F.col(rbox[1]).cast("double"))
    overlap = (
        (F.col(lbox[0]) <= F.col(rbox[2])) & (F.col(lbox[2]) >= F.col(rbox[0]))
        & (F.col(lbox[1]) <= F.col(rbox[3])) & (F.col(lbox[3]) >= F.col(rbox[1]))
    )
    # A pair that shares several cells is kept only in the cell of the overlap's lower corner.
    home = (F.floor(corner_x / side) == F.col("__cx")) & (F.floor(corner_y / side) == F.col("__cy"))
    return pairs.where(overlap & home).drop("__ll", "__rl", "__cx", "__cy")


# --- polygons -------------------------------------------------------------

def with_box(df: DataFrame, rings: str, prefix: str = "__b") -> DataFrame:
    """Bounding box columns of a polygon column (array of rings)."""
    points = F.flatten(F.col(rings))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return df.withColumns({
        f"{prefix}x1": F.array_min(xs), f"{prefix}y1": F.array_min(ys),
        f"{prefix}x2": F.array_max(xs), f"{prefix}y2": F.array_max(ys),
    })


def inside_rings(x: Column, y: Column, edges: Column) -> Column:
    """Ray-crossing parity against an array of edges struct<a, b>. Half-open, so a shared edge counts once."""
    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        straddles = (a["y"] <= y) != (b["y"] <= y)
        at = a["x"] + F.try_divide(y - a["y"], b["y"] - a["y"]) * (b["x"] - a["x"])
        return F.when(straddles & (x < at), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda acc, e: acc + crossed(e)) % 2 == 1


def ring_edges(rings: str | Column) -> Column:
    rings = F.col(rings) if isinstance(rings, str) else rings
    return F.flatten(F.transform(rings, vertex_pairs))


def point_in_polygon(points: DataFrame, polygons: DataFrame, x: str, y: str, rings: str) -> DataFrame:
    """Points joined to the polygons that hold them: one row per (point, polygon); areas may overlap.

    The few edges of a small polygon travel with its row. Polygons of more than LONG_EDGES
    vertices are taken apart into rows of edges, see `point_in_edges`.
    """
    pts = points.withColumns({"__px": F.col(x).cast("double"), "__py": F.col(y).cast("double")})
    box = ("__bx1", "__by1", "__bx2", "__by2")

    def boxed(df: DataFrame) -> DataFrame:
        return with_box(df, rings).withColumn("__edges", ring_edges(rings)).drop(rings)

    is_long = F.size(F.flatten(F.col(rings))) > LONG_EDGES
    counts = _box_sizes(boxed(polygons.withColumn("__long", is_long)), box, F.col("__long"))
    some_long = any(r["__long"] for r in counts)
    small = polygons.where(~is_long) if some_long else polygons
    pairs = box_join(pts, ("__px", "__py", "__px", "__py"), boxed(small), box, sizes=[r for r in counts if not r["__long"]])
    hits = pairs.where(inside_rings(F.col("__px"), F.col("__py"), F.col("__edges"))).drop("__edges", "__bx1", "__by1", "__bx2", "__by2")
    if some_long:
        # Written, so that a polygon keeps its number.
        numbered = cut(polygons.where(is_long).withColumn("__pid", F.monotonically_increasing_id()))
        inside = point_in_edges(pts.select("__px", "__py"), polygon_edges(numbered, "__pid", rings), "__px", "__py", "__pid")
        place = F.struct("__px", "__py")
        found = spread_join(inside, numbered.drop(rings), "__pid").drop("__pid").withColumn("__at", place).drop("__px", "__py")
        found = cut(found)
        located = pts.withColumn("__at", place)
        both = spread_join(located, found, "__at", advice=skew.advise(located, found, "__at", unique=False)).drop("__at")
        hits = hits.unionByName(both.select(*hits.columns))
    return hits.drop("__px", "__py")


def edge_slabs(edges: DataFrame, key: str, ends: Sequence[str] = ("x1", "y1", "x2", "y2")) -> tuple[DataFrame, DataFrame]:
    """Edges once per horizontal slab they pass, (key, __slab, ends); and of each polygon its box and its slabs, (key, __b..., __h).

    Slabs of a polygon are as high as its edges are on average, so they hold twice as many
    rows as there are edges at most, and there are at most half as many slabs as edges.
    """
    x1, y1, x2, y2 = ends
    sloped = edges.where(F.col(y1) != F.col(y2))
    shapes = sloped.groupBy(key).agg(
        F.min(F.least(x1, x2)).alias("__bx1"), F.min(F.least(y1, y2)).alias("__by1"), F.max(F.greatest(x1, x2)).alias("__bx2"),
        F.max(F.greatest(y1, y2)).alias("__by2"), F.avg(F.abs(F.col(y2) - F.col(y1))).alias("__h"))
    shapes = cut(shapes)
    # A polygon may hold most of the edges; its one row of sizes is sent to all of them.
    known = spread_join(sloped.select(key, *ends), shapes.select(key, "__by1", "__h"), key)
    low, high = _slab(F.least(y1, y2)), _slab(F.greatest(y1, y2))
    return known.withColumn("__slab", F.explode(F.sequence(low, high))).select(key, "__slab", *ends), shapes


def _slab(y: Column) -> Column:
    return F.floor((y - F.col("__by1")) / F.col("__h"))


def crossing(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Where an edge meets the level y, if it does to the right of x, else null. Half-open, so a shared vertex counts once."""
    at = x1 + F.try_divide(y - y1, y2 - y1) * (x2 - x1)
    return F.when(((y1 <= y) != (y2 <= y)) & (x < at), at)


def point_in_edges(points: DataFrame, edges: DataFrame, x: str, y: str, key: str, ends: Sequence[str] = ("x1", "y1", "x2", "y2")) -> DataFrame:
    """Points joined to the polygons that hold them, where polygons are a table of edges: (columns of points, key).

    A point meets only the edges of its own slab of a polygon; it lies inside if an odd number
    of them cross its level to its right. Edges are rows throughout, so a polygon of any
    length is spread over the tasks. Equal rows of `points` count as one.
    """
    slabs, shapes = edge_slabs(edges, key, ends)
    place = {"__sx": F.col(x).cast("double"), "__sy": F.col(y).cast("double")}
    # Points at one place are tested once.
    places = points.select(*[c.alias(n) for n, c in place.items()]).distinct()
    around = box_join(places, ("__sx", "__sy", "__sx", "__sy"), shapes, ("__bx1", "__by1", "__bx2", "__by2"))
    placed = cut(around.withColumn("__slab", _slab(F.col("__sy"))).drop("__bx1", "__by1", "__bx2", "__by2", "__h"))
    slabs, keys = cut(slabs), [key, "__slab"]
    meets = spread_join(placed, slabs, keys, advice=skew.advise(placed, slabs, keys, unique=False), parts=tasks_for(pairs_met(placed, slabs, keys)))
    right = crossing(F.col("__sx"), F.col("__sy"), *[F.col(e) for e in ends])
    counted = meets.groupBy(*place, key).agg(F.count(right).alias("__n"))
    found = cut(counted.where(F.col("__n") % 2 == 1).drop("__n"))
    located = points.distinct().withColumns(place)
    return spread_join(located, found, list(place), advice=skew.advise(located, found, list(place), unique=False)).select(*points.columns, key)


def centre_in_area(features: DataFrame, areas: DataFrame, x: str, y: str, rings: str, key: str) -> DataFrame:
    """Features whose centre lies in at least one area, each once."""
    hits = point_in_polygon(features.select(key, x, y), areas.select(F.col(rings)), x, y, rings)
    return features.join(hits.select(key).distinct(), key, "left_semi")


def polygon_edges(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """One row per polygon edge."""
    return polygons.select(key, F.explode(ring_edges(rings)).alias("__e")).select(
        key, F.col("__e.a.x").alias("x1"), F.col("__e.a.y").alias("y1"),
        F.col("__e.b.x").alias("x2"), F.col("__e.b.y").alias("y2"))


def adjacency(polygons: DataFrame, key: str, rings: str, tolerance: float = 1e-9) -> DataFrame:
    """Ordered pairs of polygons that touch: a vertex of one lies on the boundary of the other."""
    edges = polygon_edges(polygons, key, rings)
    vertices = edges.select(F.col(key).alias("__v"), F.col("x1").alias("__vx"), F.col("y1").alias("__vy")).distinct()
    boxed = edges.withColumns({
        "__bx1": F.least("x1", "x2"), "__by1": F.least("y1", "y2"),
        "__bx2": F.greatest("x1", "x2"), "__by2": F.greatest("y1", "y2"),
    })
    pairs = box_join(vertices, ("__vx", "__vy", "__vx", "__vy"), boxed, ("__bx1", "__by1", "__bx2", "__by2"))
    far = segment_distance(F.col("__vx"), F.col("__vy"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    touching = pairs.where((F.col("__v") != F.col(key)) & (far <= tolerance)).select(
        F.col("__v").alias("src"), F.col(key).alias("nbr"))
    return touching.unionByName(touching.select(F.col("nbr").alias("src"), F.col("src").alias("nbr"))).distinct()


# --- distance -------------------------------------------------------------

def within_distance(points: DataFrame, targets: DataFrame, x: str, y: str, tx: str, ty: str, radius: float,
                    out: str = "dist", how: str = "inner", key: str | None = None) -> DataFrame:
    """Points paired with the targets within `radius`. With `how="left"`, points without one stay (needs `key`)."""
    r = F.lit(float(radius))
    pts = points.withColumns({"__px": F.col(x).cast("double"), "__py": F.col(y).cast("double")})
    boxed = targets.withColumns({
        "__bx1": F.col(tx) - r, "__by1": F.col(ty) - r, "__bx2": F.col(tx) + r, "__by2": F.col(ty) + r})
    pairs = box_join(pts, ("__px", "__py", "__px", "__py"), boxed, ("__bx1", "__by1", "__bx2", "__by2"))
    dx, dy = F.col("__px") - F.col(tx), F.col("__py") - F.col(ty)
    hits = pairs.withColumn(out, F.sqrt(dx * dx + dy * dy)).where(F.col(out) <= r)
    hits = hits.drop("__px", "__py", "__bx1", "__by1", "__bx2", "__by2")
    return _keep_left(points, hits, key) if how == "left" else hits


def within_distance_of_lines(points: DataFrame, segments: DataFrame, x: str, y: str, radius: float,
                             ends: Box = ("x1", "y1", "x2", "y2"), out: str = "dist", how: str = "inner",
                             key: str | None = None) -> DataFrame:
    """Points paired with the segments within `radius`."""
    r = F.lit(float(radius))
    x1, y1, x2, y2 = (F.col(c).cast("double") for c in ends)
    pts = points.withColumns({"__px": F.col(x).cast("double"), "__py": F.col(y).cast("double")})
    boxed = segments.withColumns({
        "__bx1": F.least(x1, x2) - r, "__by1": F.least(y1, y2) - r,
        "__bx2": F.greatest(x1, x2) + r, "__by2": F.greatest(y1, y2) + r})
    pairs = box_join(pts, ("__px", "__py", "__px", "__py"), boxed, ("__bx1", "__by1", "__bx2", "__by2"))
    hits = pairs.withColumn(out, segment_distance(F.col("__px"), F.col("__py"), x1, y1, x2, y2)).where(F.col(out) <= r)
    hits = hits.drop("__px", "__py", "__bx1", "__by1", "__bx2", "__by2")
    return _keep_left(points, hits, key) if how == "left" else hits


def _keep_left(points: DataFrame, hits: DataFrame, key: str | None) -> DataFrame:
    if key is None:
        raise ValueError("how='left' needs the key of the points")
    new = [c for c in hits.columns if c not in points.columns]
    return points.join(hits.select(key, *new), key, "left")


def beyond_distance_of_lines(points: DataFrame, segments: DataFrame, x: str, y: str, radius: float, key: str,
                             ends: Box = ("x1", "y1", "x2", "y2")) -> DataFrame:
    """Points farther than `radius` from every segment."""
    near = within_distance_of_lines(points.select(key, x, y), segments.select(*ends), x, y, radius, ends)
    return points.join(near.select(key).distinct(), key, "left_anti")


# --- nearest --------------------------------------------------------------

FANOUT = 4
LEAF_SIZE = 32
MAX_DEPTH = 12
BROADCAST_DEPTH = 4  # a level holds at most 16^depth cells, so 65,536 rows here


def _nearest(points: DataFrame, key: str, x: str, y: str, items: DataFrame, box: Box, shape: Sequence[str],
             distance: Callable[[Column, Column], Column], take: Sequence[str], order: str,
             out: str, radius: float | None, by: Sequence[str]) -> DataFrame:
    """Nearest item per point by descent through a pyramid of cells; ties go to the smallest `order` value.

    `box` names the item's bounding box, `shape` the columns its distance is computed from.
    """
    by = list(by)
    bx1, by1, bx2, by2 = (F.col(c).cast("double") for c in box)
    known = items.where(bx1.isNotNull() & by1.isNotNull()).withColumns({
        "__mx": (bx1 + bx2) / 2, "__my": (by1 + by2) / 2,
        "__x1": bx1, "__y1": by1, "__x2": bx2, "__y2": by2,
    })
    ext = known.agg(F.min("__mx"), F.min("__my"), F.max("__mx"), F.max("__my")).first()
    x0, y0 = (ext[0] or 0.0), (ext[1] or 0.0)
    extent = max((ext[2] or 0.0) - x0, (ext[3] or 0.0) - y0, 1e-9) * (1 + 1e-9)

    def cell(column: str, start: float, depth: int) -> Column:
        return F.floor((F.col(column) - F.lit(start)) / F.lit(extent / FANOUT ** depth))

    def fullest(depth: int) -> int:
        counts = known.select(*by, "__mx", "__my").distinct().groupBy(
            *by, cell("__mx", x0, depth), cell("__my", y0, depth)).count()
        return counts.agg(F.max("count")).first()[0] or 0

    depth = 1
    while depth < MAX_DEPTH and fullest(depth) > LEAF_SIZE:
        depth += 1

    def pyramid(level: int) -> DataFrame:
        """Tight boxes of the filled cells of a level, with the cell one level up."""
        cells = known.groupBy(*by, cell("__mx", x0, level).alias("__ncx"), cell("__my", y0, level).alias("__ncy")).agg(
            F.min("__x1").alias("__x1"), F.min("__y1").alias("__y1"),
            F.max("__x2").alias("__x2"), F.max("__y2").alias("__y2"),
        )
        cells = cells.withColumns({
            "__cx": F.floor(F.col("__ncx") / FANOUT), "__cy": F.floor(F.col("__ncy") / FANOUT)})
        return cells

    px, py = F.col("__px"), F.col("__py")

    def gap(low: str, high: str, p: Column) -> Column:
        return F.greatest(F.col(low) - p, p - F.col(high), F.lit(0.0))

    def reach(low: str, high: str, p: Column) -> Column:
        return F.greatest(F.abs(F.col(low) - p), F.abs(F.col(high) - p))

    nearest_possible = gap("__x1", "__x2", px) * gap("__x1", "__x2", px) + gap("__y1", "__y2", py) * gap("__y1", "__y2", py)
    surely_within = reach("__x1", "__x2", px) * reach("__x1", "__x2", px) + reach("__y1", "__y2", py) * reach("__y1", "__y2", py)

    # Points at one place, of one group, are searched once.
    located = points.select(F.col(key).alias("__key"), *by, F.col(x).cast("double").alias("__px"), F.col(y).cast("double").alias("__py"))
    place = [*by, "__px", "__py"]
    state = located.select(*place).distinct().select(
        F.struct(*place).alias("__pk"), *place, F.lit(0).cast("bigint").alias("__cx"), F.lit(0).cast("bigint").alias("__cy"))
    per_point = Window.partitionBy("__pk")

    def descend(cells: DataFrame) -> DataFrame:
        """The state joined to cells. Points of one group or one dense place share a key, so hot keys are split."""
        keys = [*by, "__cx", "__cy"]
        if skew.is_small(cells):
            return state.join(F.broadcast(cells), keys)
        kept = cut(state)
        return spread_join(kept, cells, keys, "inner", JoinAdvice(hot=tuple(hot_keys(kept, keys))))

    for level in range(1, depth + 1):
        if level == 1 and not by:
            # The first level is at most 16 cells, the same for all points: one list, opened on each point.
            first_cells = pyramid(1).drop("__cx", "__cy")
            listed = first_cells.agg(F.collect_list(F.struct(*first_cells.columns)).alias("__cells")).scalar()
            opened = state.drop("__cx", "__cy").withColumn("__cells", listed).withColumn("__cell", F.explode("__cells"))
            opened = opened.select("__pk", "__px", "__py", "__cell.*")
        elif level <= BROADCAST_DEPTH and not by:
            opened = state.join(F.broadcast(pyramid(level)), ["__cx", "__cy"])
        else:
            opened = descend(pyramid(level))
        opened = opened.withColumns({"__near": nearest_possible, "__sure": surely_within})
        if radius is not None:
            opened = opened.where(F.col("__near") <= float(radius) ** 2)
        # The window holds the few cells one point still follows. The factor guards against rounding.
        opened = opened.withColumn("__best", F.min("__sure").over(per_point)).where(
            F.col("__near") <= F.col("__best") * (1 + 1e-9))
        state = opened.select("__pk", *by, "__px", "__py", F.col("__ncx").alias("__cx"), F.col("__ncy").alias("__cy"))
    leaves = known.withColumns({"__cx": cell("__mx", x0, depth), "__cy": cell("__my", y0, depth)})
    # Of items with one shape, the first by `order` is enough.
    first = F.min(F.struct(F.col(order).alias("__ord"), *[F.col(t) for t in take]))
    leaves = leaves.groupBy(*by, "__cx", "__cy", *shape).agg(first.alias("__item"))
    found = descend(leaves).withColumn("__d", distance(px, py))
    if radius is not None:
        found = found.where(F.col("__d") <= float(radius))
    best = found.groupBy("__pk").agg(F.min(F.struct(F.col("__d"), F.col("__item"))).alias("__w"))
    best = cut(best.select("__pk.*", "__w"))
    # A key may have several places.
    each = spread_join(located, best, place, advice=skew.advise(located, best, place)).groupBy("__key").agg(F.min("__w").alias("__w"))
    return each.select(F.col("__key").alias(key), *[F.col("__w.__item")[t].alias(t) for t in take], F.col("__w.__d").alias(out))


def nearest(points: DataFrame, targets: DataFrame, key: str, x: str, y: str, tx: str, ty: str, order: str,
            take: Sequence[str] = (), out: str = "dist", radius: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Nearest target per point: the point's key, the target columns and the distance.

    Points without a target (none within `radius`, or none with equal `by` columns) are left out.
    """
    wanted = list(dict.fromkeys([order, *take]))

    def distance(px: Column, py: Column) -> Column:
        dx, dy = px - F.col(tx).cast("double"), py - F.col(ty).cast("double")
        return F.sqrt(dx * dx + dy * dy)

    return _nearest(points, key, x, y, targets, (tx, ty, tx, ty), (tx, ty), distance, wanted, order, out, radius, by)


def snap_to_edges(points: DataFrame, edges: DataFrame, key: str, x: str, y: str, edge: str,
                  ends: Box = ("x1", "y1", "x2", "y2"), tolerance: float = 1500.0, take: Sequence[str] = (),
                  out: str = "dist") -> DataFrame:
    """Closest edge within the tolerance per point; points without one are left out (unlocated)."""
    x1, y1, x2, y2 = (F.col(c).cast("double") for c in ends)
    boxed = edges.withColumns({
        "__ex1": F.least(x1, x2), "__ey1": F.least(y1, y2), "__ex2": F.greatest(x1, x2), "__ey2": F.greatest(y1, y2)})
    wanted = list(dict.fromkeys([edge, *take]))

    def distance(px: Column, py: Column) -> Column:
        return segment_distance(px, py, x1, y1, x2, y2)

    return _nearest(points, key, x, y, boxed, ("__ex1", "__ey1", "__ex2", "__ey2"), ends, distance, wanted, edge,
                    out, tolerance, ())


# --- clipping -------------------------------------------------------------

def line_length_in_polygons(segments: DataFrame, polygons: DataFrame, rings: str, ends: Box = ("x1", "y1", "x2", "y2"),
                            out: str = "inside") -> DataFrame:
    """Segments paired with the polygons they cross, with the length inside each.

    A segment is cut where it meets the polygon's edges, and the pieces whose middle lies
    inside are added up.
    """
    x1, y1, x2, y2 = (F.col(c).cast("double") for c in ends)
    lines = segments.withColumns({
        "__lx1": F.least(x1, x2), "__ly1": F.least(y1, y2), "__lx2": F.greatest(x1, x2), "__ly2": F.greatest(y1, y2)})
    boxed = with_box(polygons, rings).withColumn("__edges", ring_edges(rings)).drop(rings)
    pairs = box_join(lines, ("__lx1", "__ly1", "__lx2", "__ly2"), boxed, ("__bx1", "__by1", "__bx2", "__by2"))
    share = straight_line_pieces(x1, y1, x2, y2, F.col("__edges"), inside_rings)
    length = F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))
    inside = pairs.withColumn(out, share * length).where(F.col(out) > 0)
    return inside.drop("__lx1", "__ly1", "__lx2", "__ly2", "__bx1", "__by1", "__bx2", "__by2", "__edges")


def inside_boundary(points: DataFrame, boundary: DataFrame, x: str, y: str, ends: Box = ("x1", "y1", "x2", "y2"),
                    out: str = "IN_UDB") -> DataFrame:
    """1 for points east of a boundary line that splits the area from south to north, 0 west of it.

    A westward ray meets the line an odd number of times from the east. The line's
    segments are paired with points by bands of y, so no point meets the whole line.
    """
    x1, y1, x2, y2 = ends
    key = "__row"
    rows = points.withColumns({"__px": F.col(x).cast("double"), "__py": F.col(y).cast("double")})
    places = rows.select("__px", "__py").distinct()
    far = 1e15
    strips = boundary.select(
        F.col(x1).cast("double").alias("__sx1"), F.col(y1).cast("double").alias("__sy1"),
        F.col(x2).cast("double").alias("__sx2"), F.col(y2).cast("double").alias("__sy2"))
    strips = strips.withColumns({"__low": F.least("__sy1", "__sy2"), "__high": F.greatest("__sy1", "__sy2")})
    strips = strips.withColumns({"__z1": F.lit(0.0), "__z2": F.lit(0.0)})
    pairs = box_join(places.withColumn("__pz", F.lit(0.0)), ("__pz", "__py", "__pz", "__py"),
                     strips, ("__z1", "__low", "__z2", "__high"))
    straddles = (F.col("__sy1") <= F.col("__py")) != (F.col("__sy2") <= F.col("__py"))
    at = F.col("__sx1") + F.try_divide(F.col("__py") - F.col("__sy1"), F.col("__sy2") - F.col("__sy1")) * (F.col("__sx2") - F.col("__sx1"))
    crossings = pairs.where(straddles & (F.col("__px") >= at)).groupBy("__px", "__py").agg(F.count(F.lit(1)).alias("__n"))
    flagged = rows.join(crossings, ["__px", "__py"], "left")
    return flagged.withColumn(out, (F.coalesce(F.col("__n"), F.lit(0)) % 2).cast("int")).drop("__px", "__py", "__n")

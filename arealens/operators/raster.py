"""Cells: rasterising polygons, developable parts and contiguity."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arealens.functions.scalar import SQFT_PER_ACRE
from arealens.operators.network import components
from arealens.operators.spatial import polygon_edges, with_box
from arealens.session import cut
from arealens.skew import exact_median, null_safe_join, spread_join

# Names of a cell's neighbours and where they lie, (row step, column step).
POSITIONS = {
    "top_left": (-1, -1), "top_center": (-1, 0), "top_right": (-1, 1),
    "middle_left": (0, -1), "self": (0, 0), "middle_right": (0, 1),
    "bottom_left": (1, -1), "bottom_center": (1, 0), "bottom_right": (1, 1),
}

# Cells of a tile's side, and rows of cells a task labels at a time.
TILE = 64
TILE_ROWS = 200_000


def neighbour_weights(weights: str | Mapping[str, float]) -> dict[str, float]:
    """Weights of the nine positions: "rook" (sides), "queen" (sides count double), "nn" (all 1), or a full mapping."""
    if isinstance(weights, str):
        schemes = {"rook": (0, 1), "queen": (1, 2), "nn": (1, 1)}
        if weights.lower() not in schemes:
            raise ValueError(f"weights must be 'rook', 'queen', 'nn' or a mapping, got {weights!r}")
        corner, side = schemes[weights.lower()]
        by_steps = {0: 1, 1: side, 2: corner}
        return {name: by_steps[abs(r) + abs(c)] for name, (r, c) in POSITIONS.items()}
    missing = sorted(set(POSITIONS) - set(weights))
    if missing:
        raise ValueError(f"weights lack positions: {missing}")
    return dict(weights)


# --- grids ----------------------------------------------------------------

def grid_shape(width: float, height: float, chunks: int = 20) -> tuple[int, int]:
    """Rows and columns with rows * columns = chunks and rows / columns closest to height / width."""
    pairs = [(r, chunks // r) for r in range(1, chunks + 1) if chunks % r == 0]
    return min(pairs, key=lambda p: abs(p[0] / p[1] - height / width))


def assign_chunks(df: DataFrame, x: str, y: str, chunks: int = 20, out: str = "ChunkID") -> DataFrame:
    """Chunk number of each point in a grid over the extent; the extent is one row."""
    x0, y0, x1, y1 = df.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    width, height = max(x1 - x0, 1e-9), max(y1 - y0, 1e-9)
    rows, cols = grid_shape(width, height, chunks)

    def place(column: str, low: float, size: float, n: int) -> Column:
        return F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(size / n)), F.lit(n - 1))

    return df.withColumn(out, (place(y, y0, height, rows) * cols + place(x, x0, width, cols)).cast("int"))


def cells_in_extent(cells: DataFrame, areas: DataFrame, x: str, y: str, rings: str, dx: float, dy: float,
                    out: str = "CellArea") -> DataFrame:
    """Cells inside the bounding box of all areas, with the area of a cell. The box is read by scalar subqueries."""
    boxed = with_box(areas, rings)
    box = boxed.agg(F.min("__bx1").alias("x1"), F.min("__by1").alias("y1"), F.max("__bx2").alias("x2"), F.max("__by2").alias("y2"))
    edge = {c: box.select(c).scalar() for c in ("x1", "y1", "x2", "y2")}
    inside = (F.col(x) >= edge["x1"]) & (F.col(x) <= edge["x2"]) & (F.col(y) >= edge["y1"]) & (F.col(y) <= edge["y2"])
    return cells.where(inside).withColumn(out, F.lit(float(dx * dy)))


def rasterise(polygons: DataFrame, key: str, rings: str, size: float, keep: Sequence[str] = ()) -> DataFrame:
    """Cells whose centre lies in a polygon: (key, row, col). Where polygons overlap the largest key wins."""
    # Written, so that a polygon keeps its number; equal keys may name several polygons.
    numbered = cut(polygons.select(key, *keep, rings).withColumn("__pid", F.monotonically_increasing_id()))
    names = numbered.select("__pid", key, *keep)
    cells = edge_cells(polygon_edges(numbered, "__pid", rings), "__pid", size)
    named = spread_join(cells, names, "__pid")
    one = named.groupBy("row", "col").agg(F.max(F.struct(key, *keep)).alias("__p"))
    return one.select(*[F.col("__p")[c].alias(c) for c in (key, *keep)], "row", "col")


def edge_cells(edges: DataFrame, key: str, size: float, ends: Sequence[str] = ("x1", "y1", "x2", "y2")) -> DataFrame:
    """Cells whose centre lies in a polygon, where polygons are a table of edges: (key, row, col).

    Every edge becomes one row per row of cells whose middle it crosses, with the place
    where it does. Along a row of cells, a polygon lies between its first and second crossing,
    its third and fourth, and so on, so cells are written down without testing any against
    an edge. Work grows with crossings and cells, and no task holds more of a polygon than
    its crossings of one row.
    """
    s = F.lit(float(size))
    x1, y1, x2, y2 = (F.col(e) for e in ends)
    # Rows are taken a little wide; whether the edge crosses the middle of one is asked exactly below.
    first, last = F.floor(F.least(y1, y2) / s - 0.5), F.ceil(F.greatest(y1, y2) / s - 0.5)
    lined = edges.where(y1 != y2).withColumn("row", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))
    level = (F.col("row") + 0.5) * s
    crossed = lined.where((y1 <= level) != (y2 <= level)).select(
        key, "row", (x1 + F.try_divide(level - y1, y2 - y1) * (x2 - x1)).alias("__at"))
    along = Window.partitionBy(key, "row").orderBy("__at")
    spans = crossed.select(key, "row", "__at", F.lead("__at").over(along).alias("__to"), F.row_number().over(along).alias("__i"))
    spans = spans.where((F.col("__i") % 2 == 1) & F.col("__to").isNotNull())
    start, stop = F.floor(F.col("__at") / s - 0.5).cast("bigint"), F.ceil(F.col("__to") / s - 0.5).cast("bigint")
    cells = spans.withColumn("col", F.explode(F.sequence(start, stop)))
    centre = (F.col("col") + 0.5) * s
    return cells.where((centre >= F.col("__at")) & (centre < F.col("__to"))).select(key, "row", "col")


def developable_parts(cells: DataFrame, mask: DataFrame, parcel: str, out: str = "part") -> DataFrame:
    """Cells outside the mask with the connected part (4 neighbours, same parcel) they belong to.

    A part is named by its smallest cell id, row and column packed in one number. Parts are
    found tile by tile first; only what touches the edge of a tile is linked over all tiles.
    """
    free = cells.join(mask.select("row", "col").distinct(), ["row", "col"], "left_anti").where("row is not null and col is not null")
    names = free.columns
    marked = cut(tile_parts(free, parcel, out, "__seam"))
    seam = marked.where("__seam").select("row", "col", parcel, out).distinct()
    links = None
    for step, line in (("row", "col"), ("col", "row")):
        here = F.pmod(line, F.lit(TILE))
        last = seam.where(here == TILE - 1).select(step, (F.col(line) + 1).alias(line), parcel, F.col(out).alias("src"))
        first = seam.where(here == 0).select(step, line, parcel, F.col(out).alias("dst"))
        met = last.join(first, [step, line, parcel]).select("src", "dst").distinct()
        links = met if links is None else links.unionByName(met)
    labels = cut(components(links)).withColumnsRenamed({"node": out, "component": "__whole"})
    touching = marked.where("__seam").join(labels, out, "left").withColumn(out, F.coalesce("__whole", out))
    return marked.where("not __seam").select(*names, out).unionByName(touching.select(*names, out))


def tile_parts(cells: DataFrame, parcel: str, out: str, seam: str) -> DataFrame:
    """Cells with the part of their tile they belong to, by its smallest cell id, and whether that part touches the tile's edge.

    Tiles are `TILE` cells wide and high and lie whole in a partition, so a task holds about
    `TILE_ROWS` rows at a time, or one tile.
    """
    tile, limit = TILE, TILE_ROWS

    def mark(table: pa.Table) -> pa.Table:
        row, col = (table[c].to_numpy().astype(np.int64) for c in ("row", "col"))
        owner = table[parcel].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        nodes, at = np.unique((row << 32) + col + (1 << 31), return_inverse=True)
        ends = []
        for step, line in ((col, row), (row, col)):
            # Neighbours of one parcel follow each other in this order.
            order = np.lexsort((step, line, owner))
            a, b = order[:-1], order[1:]
            near = (owner[a] == owner[b]) & (owner[a] >= 0) & (line[a] == line[b]) & (line[a] // tile == line[b] // tile)
            near &= (step[a] + 1 == step[b]) & (step[a] // tile == step[b] // tile)
            ends.append((at[a[near]], at[b[near]]))
        a, b = (np.concatenate(e) for e in zip(*ends))
        least = np.arange(len(nodes))
        while len(a):
            # The larger of two linked names takes the smaller, and names are followed to their ends.
            low, high = np.minimum(least[a], least[b]), np.maximum(least[a], least[b])
            np.minimum.at(least, high, low)
            while (least[least] != least).any():
                least = least[least]
            apart = least[a] != least[b]
            a, b = a[apart], b[apart]
        part = least[at]
        edge = (row % tile == 0) | (row % tile == tile - 1) | (col % tile == 0) | (col % tile == tile - 1)
        touched = np.zeros(len(nodes), bool)
        touched[part[edge]] = True
        return table.append_column(out, pa.array(nodes[part])).append_column(seam, pa.array(touched[part]))

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, enough = [], 0, limit
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < enough:
                continue
            table = pa.Table.from_batches(held)
            row, col = (table[c].to_numpy() // tile for c in ("row", "col"))
            # The last tile may go on in the next batch.
            other = np.flatnonzero((row != row[-1]) | (col != col[-1]))
            whole = int(other[-1]) + 1 if len(other) else 0
            if whole:
                yield from mark(table.slice(0, whole)).to_batches()
            held, rows = table.slice(whole).to_batches(), rows - whole
            enough = max(limit, 2 * rows)
        if rows:
            yield from mark(pa.Table.from_batches(held)).to_batches()

    place = [F.floor(F.col(c) / tile) for c in ("row", "col")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields)
    return cells.repartition(*place).sortWithinPartitions(*place).mapInArrow(label, f"{kinds}, `{out}` long, `{seam}` boolean")


# --- contiguity -----------------------------------------------------------

def contiguity(cells: DataFrame, part: str, weights: str | Mapping[str, float] = "nn", size: float = 40.0,
               chunk: str | None = None) -> DataFrame:
    """Contiguity and developable acres per part.

    Every cell sends its weight to the nine places around it. What arrives at a cell from
    cells of the same part (and chunk, if given) adds up to the cell's weight. No cell is
    paired with another, and the sums combine before the shuffle.
    """
    table = neighbour_weights(weights)
    sends = F.array(*[
        F.struct((F.col("row") - r).alias("row"), (F.col("col") - c).alias("col"), F.lit(float(w)).alias("w"),
                 F.lit(1 if name == "self" else 0).alias("own"))
        for name, (r, c) in POSITIONS.items() for w in [table[name]] if w or name == "self"
    ])
    keys = [part] + ([chunk] if chunk else [])
    sent = cells.select(*keys, F.explode(sends).alias("s")).select(*keys, "s.*")
    per_cell = sent.groupBy(*keys, "row", "col").agg(F.sum("w").alias("w"), F.max("own").alias("own")).where("own = 1")
    top = float(sum(table.values()))
    return per_cell.groupBy(*keys).agg(
        ((F.avg("w") - 1) / F.lit(top - 1)).alias("Contiguity"),
        (F.count(F.lit(1)) * F.lit(size * size / SQFT_PER_ACRE)).alias("Developable_Area"),
    )


CONTIGUITY_SUMMARIES = ("min", "max", "median", "mean")


def contiguity_summary(parts: DataFrame, parcel: str, summaries: Sequence[str] = CONTIGUITY_SUMMARIES,
                       scale_area: bool = True) -> DataFrame:
    """Per parcel: least, largest, median and mean contiguity of its parts, summed area, and area times each."""
    named = {"min": F.min, "max": F.max, "mean": F.avg}
    unknown = [s for s in summaries if s not in (*named, "median")]
    if unknown:
        raise ValueError(f"unknown summaries: {unknown}")
    filled = parts.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("Contiguity", "Developable_Area")})
    if "median" in summaries:
        # Written once, since medians read it several times and it may come from a long plan.
        filled = cut(filled.select(parcel, "Contiguity", "Developable_Area"))
    out = filled.groupBy(parcel).agg(
        F.sum("Developable_Area").alias("Developable_Area"),
        *[named[s]("Contiguity").alias(f"{s.title()}_Contiguity") for s in summaries if s in named])
    if "median" in summaries:
        out = null_safe_join(out, exact_median(filled, [parcel], {"Median_Contiguity": "Contiguity"}, written=True), [parcel])
    if scale_area:
        out = out.withColumns({
            f"{s.title()}_Scaled_Area": F.col("Developable_Area") * F.col(f"{s.title()}_Contiguity") for s in summaries})
    return out


def contiguity_by_parcel(parcels: DataFrame, mask_cells: DataFrame, key: str, rings: str, x: str, y: str, size: float = 40.0,
                         weights: str | Mapping[str, float] = "nn", chunks: int = 20, cross_chunks: bool = True) -> DataFrame:
    """Whole pipeline: chunks, cells, mask, parts, contiguity, parcel summary. Parcels without free cells get 0.

    Cells of one part have one parcel and so one chunk; a part never crosses chunks.
    """
    chunked = assign_chunks(parcels, x, y, chunks)
    cells = rasterise(chunked, key, rings, size, keep=["ChunkID"])
    parts = developable_parts(cells, mask_cells, key)
    per_part = contiguity(parts.select(key, "part", "row", "col", "ChunkID"), "part", weights, size,
                          None if cross_chunks else "ChunkID")
    owners = parts.select("part", key).distinct()
    full = parcels.select(key).join(owners.join(per_part, "part"), key, "left")
    return contiguity_summary(full, key)

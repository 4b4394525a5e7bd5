"""Shortest-path tables, reach, centrality, components and walk times on edge tables.

Paths are searched from all origins at once, see `arealens.operators.paths`. Each round's
findings are written to the shared checkpoint folder, so lineage stays one round long and
a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.functions.scalar import grid_distance, straight_distance, walk_minutes, walk_time_bin
from arealens.operators.aggregate import min_argmin_count
from arealens.operators.areas import floating_sums
from arealens.operators.joins import compose_edges
from arealens.operators.paths import least_paths, total
from arealens.operators.spatial import beyond_distance_of_lines, nearest, within_distance, within_distance_of_lines
from arealens.session import cut, shelved, tasks_for
from arealens.skew import JoinAdvice, advise, first_per_key, hot_keys, is_small, null_safe_join, spread_join


# --- edges ----------------------------------------------------------------

def two_way(edges: DataFrame, src: str = "src", dst: str = "dst", oneway: str | None = None) -> DataFrame:
    """Edges in both directions; one-way edges (flag not 0) only as they are."""
    back = edges if oneway is None else edges.where(F.coalesce(F.col(oneway).cast("int"), F.lit(0)) == 0)
    flipped = back.withColumnsRenamed({src: "__s"}).withColumnsRenamed({dst: src}).withColumnsRenamed({"__s": dst})
    return edges.unionByName(flipped)


def allowed_edges(edges: DataFrame, stress: str | None = None, levels: Sequence[int] = (1, 2, 3, 4),
                  cycleway: str | None = None, cycleways_only: bool = False) -> DataFrame:
    """Edges that the restrictions leave: traffic-stress classes, or cycleways only."""
    out = edges
    if stress is not None:
        out = out.where(F.col(stress).isin(list(levels)))
    if cycleways_only:
        if cycleway is None:
            raise ValueError("cycleways_only needs the cycleway column")
        out = out.where(F.col(cycleway) == 1)
    return out


def skim_edges(skim: DataFrame, origin: str, destination: str, attributes: Sequence[str], order: Sequence[str],
               directed: bool = True) -> DataFrame:
    """Edge table of a skim. Of rows for one pair the last by `order` wins; undirected pairs go both ways."""
    rows = skim.select(F.col(origin).alias("src"), F.col(destination).alias("dst"), *attributes,
                       *[F.col(o).alias(f"__ord{i}") for i, o in enumerate(order)])
    marks = [F.col(f"__ord{i}") for i in range(len(order))]
    drop = [f"__ord{i}" for i in range(len(order))]
    if directed:
        return first_per_key(rows, ["src", "dst"], marks, last=True).drop(*drop)
    pair = rows.withColumns({"src": F.least("src", "dst"), "dst": F.greatest("src", "dst")})
    one = first_per_key(pair, ["src", "dst"], marks, last=True).drop(*drop)
    back = one.where(F.col("src") != F.col("dst")).select(F.col("dst").alias("src"), F.col("src").alias("dst"), *attributes)
    return one.unionByName(back)


# --- shortest paths -------------------------------------------------------

def od_cost(edges: DataFrame, origins: DataFrame, cutoff: float, cost: str = "cost", src: str = "src", dst: str = "dst",
            destinations: DataFrame | None = None, carry: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """Least cost from each origin to each node within the cutoff: (origin, node, cost).

    Costs must not be negative. `origins` and `destinations` are one-column tables of
    nodes. `carry` names further edge columns added up along the least-cost path; of
    equally cheap paths the one with the smallest sums is taken. `width` is the cost a slot
    of the search covers; it changes the number of rounds, never the result.
    """
    sums = [cost, *carry]
    ends = None if destinations is None else destinations.select(F.col(destinations.columns[0]).alias("node")).distinct()
    return least_paths(edges, origins, cutoff, sums, src, dst, width, ends).select("origin", "node", *[total(sums, c).alias(c) for c in sums])


def full_skim(stop_to_stop: DataFrame, zone_to_stop: DataFrame, origins: DataFrame, zones: DataFrame, cutoff: float,
              order: Sequence[str], origin: str = "OName", destination: str = "DName", time: str = "Minutes") -> DataFrame:
    """Zone-to-zone times over directed stop pairs and two-way zone-stop pairs. An origin reaches itself at 0.

    Zones that no edge touches are not in the network and give no row.
    """
    with tasks_for(stop_to_stop.sparkSession, stop_to_stop.count() + zone_to_stop.count()):
        rides = skim_edges(stop_to_stop, origin, destination, [time], order)
        walks = skim_edges(zone_to_stop, origin, destination, [time], order, directed=False)
        edges = shelved(compose_edges(rides, walks))
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    present = origins.select(F.col(origins.columns[0]).alias("node")).join(nodes, "node", "left_semi")
    table = od_cost(edges, present, cutoff, cost=time, destinations=zones)
    return table.select(F.col("origin").alias(origin), F.col("node").alias(destination), time)


# --- reach ----------------------------------------------------------------

def reach_edges(edges: DataFrame, facilities: DataFrame, cutoff: float, overlap: bool = True, cost: str = "cost",
                src: str = "src", dst: str = "dst", carry: Sequence[str] = ()) -> DataFrame:
    """Edges from which a facility is reached within the cutoff, travelling towards it.

    `from_cost` is the cost left at the edge's end, `to_cost` that at its start, held at
    the cutoff where the edge is only partly in reach. With `overlap` every facility in
    reach has its row; without, each edge belongs to its nearest facility.
    """
    back = edges.select(F.col(dst).alias("src"), F.col(src).alias("dst"), F.col(cost).alias("cost"), *carry)
    costs = od_cost(back, facilities, cutoff, carry=carry).select(
        F.col("origin").alias("facility"), F.col("node").alias(dst), F.col("cost").alias("from_cost"),
        *[F.col(c).alias(f"from_{c}") for c in carry])
    lines = edges.select(src, dst, F.col(cost).cast("double").alias("__cost")).distinct()
    reached = spread_join(costs, lines, dst, advice=advise(costs, lines, dst, unique=False)).where(F.col("from_cost") < float(cutoff))
    reached = reached.select(
        "facility", src, dst, "from_cost",
        F.least(F.col("from_cost") + F.col("__cost"), F.lit(float(cutoff))).alias("to_cost"),
        *[f"from_{c}" for c in carry])
    if overlap:
        return reached
    return first_per_key(reached, [src, dst], [F.col("from_cost"), F.col("facility")])


def reach_rings(edges: DataFrame, facilities: DataFrame, breaks: Sequence[float], merge: bool = True, cost: str = "cost",
                src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes with the ring (smallest break not below their cost) in which a facility is reached, per facility or merged."""
    back = edges.select(F.col(dst).alias("src"), F.col(src).alias("dst"), F.col(cost).alias("cost"))
    costs = od_cost(back, facilities, max(breaks))
    if merge:
        costs = costs.groupBy("node").agg(F.min("cost").alias("cost"))
    else:
        costs = costs.withColumnRenamed("origin", "facility")
    ring = None
    for b in sorted(breaks):
        ring = F.when(F.col("cost") <= b, F.lit(float(b))) if ring is None else ring.when(F.col("cost") <= b, F.lit(float(b)))
    return costs.withColumn("ring", ring)


def reach_cells(cells: DataFrame, lines: DataFrame, key: str, x: str, y: str, ring: str, trim: float = 100.0,
                facility: str | None = None) -> DataFrame:
    """Places within `trim` of reached lines, with the lowest ring: of all facilities together, or of each."""
    ends = ("x1", "y1", "x2", "y2")
    extra = [facility] if facility else []
    near = within_distance_of_lines(cells.select(key, x, y), lines.select(*ends, ring, *extra), x, y, trim, ends)
    return near.groupBy(key, *extra).agg(F.min(ring).alias(ring))


# --- centrality -----------------------------------------------------------

def centrality_of(paths: DataFrame, node: str, cost: str) -> DataFrame:
    """Closeness per destination: N paths in, (N-1)/sum of lengths, mean length and N over it; null when undefined."""
    sums = paths.groupBy(F.col(node).alias("Node")).agg(F.count(F.lit(1)).alias("N"), F.sum(cost).alias("__len"))
    closeness = F.try_divide((F.col("N") - 1).cast("double"), F.col("__len"))
    out = sums.withColumn("centrality", closeness)
    out = out.withColumn("AvgLength", F.try_divide(F.lit(1.0), F.col("centrality")))
    return out.withColumn("CentIdx", F.try_divide(F.col("N").cast("double"), F.col("AvgLength"))).drop("__len")


def network_centrality(edges: DataFrame, cutoff: float, cost: str = "cost", src: str = "src", dst: str = "dst") -> DataFrame:
    """Centrality of every node over paths from all nodes within the cutoff."""
    nodes = edges.select(F.col(src).alias("node")).unionByName(edges.select(F.col(dst).alias("node"))).distinct()
    return centrality_of(od_cost(edges, nodes, cutoff, cost, src, dst), "node", cost)


# --- components -----------------------------------------------------------

def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Weakly connected component of each node, named by its smallest node: (node, component).

    Alternates two steps: every node points its larger neighbours, then its smaller
    ones, at the smallest neighbour it knows. The number of rounds grows with the
    logarithm of the graph's size, not with its diameter.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
    # Written once: the edges may come from a long plan that rounds must not repeat.
    nodes = cut(pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct())
    few = is_small(nodes)
    links = cut(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return row[0], row[1]

    def busy(df: DataFrame) -> JoinAdvice:
        """A node's smallest neighbour is one row; the node itself may have very many neighbours."""
        return JoinAdvice(small=True) if few else JoinAdvice(hot=tuple(hot_keys(df, ["u"])))

    before = mark(links)
    while True:
        # Larger neighbours: each learns the smallest node its neighbour knows.
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        outward = spread_join(around, least, "u", advice=busy(around)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = outward.where("u <> v").distinct()
        # Smaller neighbours, and the node itself, point at the smallest of them.
        links = cut(links)
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        inward = spread_join(links, least, "u", advice=busy(links)).select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut(inward.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = mark(links)
        if after == before:
            break
        before = after
    return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def trim_components(edges: DataFrame, min_edges: int = 2, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges of components with at least `min_edges` + 1 nodes."""
    labels = cut(components(edges, src, dst))
    large = labels.groupBy("component").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_edges + 1)
    kept = spread_join(labels, large.select("component"), "component", "left_semi").select(F.col("node").alias(src))
    return edges.join(kept, src, "left_semi")


# --- walk times -----------------------------------------------------------

def _time_columns(target: str) -> tuple[str, str, str]:
    return f"nearest_{target}", f"min_time_{target}", f"n_{target}"


def feature_walk_times(features: DataFrame, lines: DataFrame, key: str, x: str, y: str, name: str, time: str,
                       target: str, distance: float = 80.0) -> DataFrame:
    """Nearest target, walk time and number in reach per feature, from reach lines close to it.

    The time to a target is the mean over its lines within `distance`. Features without
    a line stay with null time, no target in reach and an empty time bin.
    """
    ends = ("x1", "y1", "x2", "y2")
    near = within_distance_of_lines(features.select(key, x, y), lines.select(*ends, name, time), x, y, distance, ends)
    means = near.groupBy(key, name).agg(F.avg(time).alias("__time"))
    best = min_argmin_count(means, key, name, "__time", _time_columns(target))
    out = features.select(key).join(best, key, "left")
    nearest, least, number = _time_columns(target)
    return out.withColumns({number: F.coalesce(number, F.lit(0)), f"bin_{target}": walk_time_bin(F.col(least))})


def ideal_walk_times(features: DataFrame, targets: DataFrame, key: str, x: str, y: str, name: str, tx: str, ty: str,
                     target: str, radius: float, meters_per_unit: float = 1.0, mph: float = 3.0) -> DataFrame:
    """Straight-line walk minutes to the targets within the radius: nearest, least and number; with time bins.

    The nearest is searched down a pyramid of cells and the others are counted by cells, so no list of pairs is made.
    """
    nearest_name, least, number = _time_columns(target)

    def finite_places(df: DataFrame, *places: str) -> DataFrame:
        return df.where(reduce(lambda a, b: a & b, [F.abs(F.col(c).cast("double")) < float("inf") for c in places]))

    places, stops = finite_places(features.select(key, x, y), x, y), finite_places(targets.select(name, tx, ty), tx, ty)
    best = nearest(places, stops, key, x, y, tx, ty, name, out="__dist", radius=radius)
    minutes = walk_minutes(F.col("__dist") * F.lit(meters_per_unit), mph)
    # A feature named twice counts its targets twice, as does a target.
    counted = floating_sums(stops, places, key, x, y, tx, ty, radius, (), count=number).withColumnRenamed("zone", key)
    found = null_safe_join(best.select(key, F.col(name).alias(nearest_name), minutes.alias(least)), counted, [key])
    return found.withColumn(f"bin_{target}", walk_time_bin(F.col(least)))


def grid_fallback(zones: DataFrame, stops: DataFrame, edges: DataFrame, zone: str, zx: str, zy: str, stop: str, sx: str,
                  sy: str, tolerance: float, radius: float, cutoff: float, meters_per_unit: float = 1.0,
                  mph: float = 3.0) -> DataFrame:
    """Walk minutes along a street grid from zones that no edge is near to the stops around them, up to the cutoff."""
    remote = beyond_distance_of_lines(zones.select(zone, zx, zy), edges, zx, zy, tolerance, zone)
    near = within_distance(remote, stops.select(stop, sx, sy), zx, zy, sx, sy, radius)
    minutes = walk_minutes(grid_distance(F.col(sx), F.col(sy), F.col(zx), F.col(zy), meters_per_unit), mph)
    return near.select(F.col(zone).alias("OName"), F.col(stop).alias("DName"), minutes.alias("Minutes")).where(
        F.col("Minutes") <= float(cutoff))


def results_by_year(results: DataFrame, version_by_year: Mapping[int, str], version: str = "version") -> DataFrame:
    """Results of each network version repeated for the years that use it."""
    entries = [F.struct(F.lit(v).alias("v"), F.lit(int(y)).alias("y")) for y, v in version_by_year.items()]
    years = F.transform(F.filter(F.array(*entries), lambda e: e["v"] == F.col(version)), lambda e: e["y"])
    return results.withColumn("Year", F.explode(years))

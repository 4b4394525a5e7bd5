"""Shortest paths, reach, components and cells against plain Python."""

import collections
import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealens.functions import geometry as g
from arealens.operators import network, raster
from conftest import rows


def dijkstra(edges, origin, cutoff):
    out, done, queue = collections.defaultdict(list), {}, [(0.0, origin)]
    for a, b, c in edges:
        out[a].append((b, c))
    while queue:
        cost, node = heapq.heappop(queue)
        if node in done or cost > cutoff:
            continue
        done[node] = cost
        for b, c in out[node]:
            heapq.heappush(queue, (cost + c, b))
    return done


@pytest.fixture(scope="module")
def streets():
    rng = np.random.default_rng(4)
    ring = [(i, (i + 1) % 50, float(1 + i % 4)) for i in range(50)]
    # a third of the edges leave one node
    hub = [(7, int(b), float(c)) for b, c in zip(rng.integers(0, 50, 40), rng.integers(2, 9, 40))]
    return ring + hub + [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(0, 50, 30), rng.integers(0, 50, 30), rng.integers(1, 9, 30))]


@pytest.mark.parametrize("forced", [False, True])
def test_od_cost(spark, request, streets, forced):
    if forced:
        request.getfixturevalue("force_split")
    cutoff = 6.0 if forced else 12.0
    edges = spark.createDataFrame(streets, "src long, dst long, cost double")
    got = {(r["origin"], r["node"]): r["cost"] for r in network.od_cost(edges, spark.range(50), cutoff).collect()}
    expect = {(o, n): c for o in range(50) for n, c in dijkstra(streets, o, cutoff).items()}
    assert got == expect
    if not forced:
        # the way over a third node is never shorter
        for (a, b), c in got.items():
            for m in range(0, 50, 7):
                if (a, m) in got and (m, b) in got:
                    assert c <= got[a, m] + got[m, b]


def test_od_cost_carries_other_costs_along_the_path(spark):
    edges = spark.createDataFrame([(1, 2, 1.0, 5.0), (2, 3, 1.0, 5.0), (1, 3, 2.0, 1.0), (1, 3, 4.0, 0.0)], "src int, dst int, cost double, len double")
    out = network.od_cost(edges, spark.createDataFrame([(1,)], "n int"), 10.0, carry=["len"])
    assert rows(out) == [(1, 1, 0.0, 0.0), (1, 2, 1.0, 5.0), (1, 3, 2.0, 1.0)]


@pytest.mark.parametrize("width", [0.5, 2.0, 5.0, 100.0])
def test_od_cost_does_not_depend_on_the_width_of_slots(spark, width):
    rng = np.random.default_rng(9)
    pairs = [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(0, 40, 160), rng.integers(0, 40, 160), rng.integers(0, 6, 160))]
    edges = spark.createDataFrame(pairs + [(None, 1, 1.0), (1, None, 1.0), (3, 4, None)], "src long, dst long, cost double")
    out = network.od_cost(edges, spark.range(0, 40, 3), 7.0, width=width)
    assert {(r.origin, r.node): r.cost for r in out.collect()} == {(o, n): c for o in range(0, 40, 3) for n, c in dijkstra(pairs, o, 7.0).items()}


def test_od_cost_writes_each_path_about_once(spark, monkeypatch):
    from arealens.operators import paths

    places = []
    made = paths.PathFiles.__init__
    monkeypatch.setattr(paths.PathFiles, "__init__", lambda self, first: (made(self, first), places.append(self))[0])
    chain = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1.0).alias("cost"))
    out = network.od_cost(chain, spark.range(301), 12.0, width=3.0)
    pairs = sum(min(12, 300 - i) + 1 for i in range(301))
    assert out.count() == pairs
    written = spark.read.parquet(places[0].path)
    # A chain reaches each pair by one path, so each is written once; the state of earlier rounds is never written again.
    assert written.count() == pairs and written.select("step").distinct().count() == 13
    # The findings are the only rows shuffled; paths known already are read bucket by bucket.
    assert not spark.catalog.tableExists(places[0].name)


def test_known_paths_are_not_shuffled(spark):
    from arealens.operators import paths

    files = paths.PathFiles(spark.range(50).select(F.col("id").alias("origin"), F.col("id").alias("node"), F.lit(0.0).alias("path")))
    found = spark.range(80).select(F.col("id").alias("origin"), F.col("id").alias("node"), F.lit(1.0).alias("path")).groupBy("origin", "node").agg(
        F.min("path").alias("path")).where("path is not null")
    better = files.better(found)
    plan = better._jdf.queryExecution().executedPlan().toString()
    # Only the findings are shuffled, on both sides of the comparison, which at run time is one shuffle read twice.
    assert plan.count("Exchange hashpartitioning") == 2 and "SelectedBucketsCount" in plan
    assert sorted(r.origin for r in better.collect()) == list(range(50, 80))
    files.best()


def test_tasks_of_a_search_follow_the_edges(spark, monkeypatch):
    from arealens.operators import paths

    places = []
    made = paths.PathFiles.__init__
    monkeypatch.setattr(paths.PathFiles, "__init__", lambda self, first: (made(self, first), places.append(self))[0])
    monkeypatch.setattr(paths, "BUCKET_EDGES", 10)
    joins = []
    joined = paths.spread_join
    monkeypatch.setattr(paths, "spread_join", lambda *a, parts=None, **k: (joins.append(parts), joined(*a, parts=parts, **k))[1])
    monkeypatch.setattr(paths, "TASK_ROWS", 15)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b), 1.0) for a, b in sorted(set(zip(rng.integers(0, 60, 300).tolist(), rng.integers(0, 60, 300).tolist())))]
    out = network.od_cost(spark.createDataFrame(pairs, "src long, dst long, cost double"), spark.range(60), 3.0, destinations=spark.range(0, 60, 2))
    assert {(r.origin, r.node): r.cost for r in out.collect()} == {(o, n): c for o in range(60) for n, c in dijkstra(pairs, o, 3.0).items() if n % 2 == 0}
    # A bucket for ten edges, and a task for fifteen paths that a round looks at.
    buckets = {f.rsplit("_", 1)[1].split(".")[0] for r in spark.read.parquet(places[0].path).select(F.input_file_name().alias("f")).distinct().collect() for f in [r.f]}
    assert max(map(int, buckets)) >= 20 and max(p or 0 for p in joins) > len(pairs) // 10
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_od_cost_to_destinations(spark, streets):
    edges = spark.createDataFrame(streets, "src long, dst long, cost double")
    out = network.od_cost(edges, spark.range(1), 12.0, destinations=spark.range(5, 9))
    assert rows(out) == sorted(((0, n, c) for n, c in dijkstra(streets, 0, 12.0).items() if 5 <= n < 9), key=lambda t: str(t))


def test_full_skim(spark):
    ride = spark.createDataFrame([(100, 101, 5.0, 1), (100, 101, 3.0, 2)], "OName long, DName long, Minutes double, seq int")
    walk = spark.createDataFrame([(1, 100, 2.0, 1), (2, 101, 4.0, 1)], "OName long, DName long, Minutes double, seq int")
    zones = spark.createDataFrame([(1,), (2,), (3,)], "z long")
    # the later ride row wins; zone 3 is not in the network
    assert rows(network.full_skim(ride, walk, zones, zones, 60.0, ["seq"])) == [(1, 1, 0.0), (1, 2, 9.0), (2, 2, 0.0)]


def test_reach(spark):
    edges = spark.createDataFrame([(1, 2, 4.0), (2, 3, 4.0), (5, 3, 1.0), (2, 5, 2.0)], "src int, dst int, cost double")
    stops = spark.createDataFrame([(3,), (5,)], "n int")
    over = rows(network.reach_edges(edges, stops, 6.0))
    assert (3, 2, 3, 0.0, 4.0) in over and (3, 1, 2, 3.0, 6.0) in over and (5, 1, 2, 2.0, 6.0) in over
    single = rows(network.reach_edges(edges, stops, 6.0, overlap=False), "src", "dst", "facility", "from_cost")
    assert single == [(1, 2, 5, 2.0), (2, 3, 3, 0.0), (2, 5, 5, 0.0), (5, 3, 3, 0.0)]
    rings = rows(network.reach_rings(edges, stops, [2.0, 6.0]), "node", "cost", "ring")
    assert rings == [(1, 6.0, 6.0), (2, 2.0, 2.0), (3, 0.0, 2.0), (5, 0.0, 2.0)]


def test_centrality(spark):
    paths = spark.createDataFrame([(1, 9, 0.0), (2, 9, 4.0), (3, 9, 6.0), (4, 8, 0.0)], "o int, d int, len double")
    assert rows(network.centrality_of(paths, "d", "len")) == [(8, 1, None, None, None), (9, 3, 0.2, 5.0, pytest.approx(0.6))]


@pytest.mark.parametrize("forced", [False, True])
def test_components(spark, request, forced):
    if forced:
        request.getfixturevalue("force_split")
    chain = [(i + 1, i) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 150)]
    pairs = chain + star + [(2000, 2001), (3000, 3000)]
    edges = spark.createDataFrame(pairs, "src long, dst long").orderBy(F.xxhash64("src", "dst"))
    labels = {r["node"]: r["component"] for r in network.components(edges).collect()}
    assert labels == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(150)}, 2000: 2000, 2001: 2000, 3000: 3000}
    assert network.trim_components(edges, 2).count() == 200 + 149


def test_two_way_and_restrictions(spark):
    edges = spark.createDataFrame([(1, 2, 1, 3), (3, 4, 0, 1)], "src int, dst int, oneway int, lts int")
    assert rows(network.two_way(edges, oneway="oneway"), "src", "dst") == [(1, 2), (3, 4), (4, 3)]
    assert rows(network.allowed_edges(edges, "lts", (1, 2)), "src") == [(3,)]


def test_skim_edges_last_row_wins(spark):
    skim = spark.createDataFrame([(1, 2, 5.0, 1), (2, 1, 6.0, 2), (3, 3, 1.0, 1)], "o int, d int, t double, n int")
    assert rows(network.skim_edges(skim, "o", "d", ["t"], ["n"])) == [(1, 2, 5.0), (2, 1, 6.0), (3, 3, 1.0)]
    assert rows(network.skim_edges(skim, "o", "d", ["t"], ["n"], directed=False)) == [(1, 2, 6.0), (2, 1, 6.0), (3, 3, 1.0)]


def test_results_by_year(spark):
    solved = spark.createDataFrame([(1, "a"), (2, "b")], "node int, version string")
    assert rows(network.results_by_year(solved, {2014: "a", 2015: "a"})) == [(1, "a", 2014), (1, "a", 2015)]


# --- cells ----------------------------------------------------------------

@pytest.mark.parametrize("weights,total", [
    # 6 x 6 block: 4 corners, 16 sides, 16 inside
    ("rook", (4 * 3 + 16 * 4 + 16 * 5) / 36), ("queen", (4 * 6 + 16 * 9 + 16 * 13) / 36), ("nn", (4 * 4 + 16 * 6 + 16 * 9) / 36)])
def test_contiguity_of_a_block(spark, weights, total):
    cells = spark.createDataFrame([(r, c, 1) for r in range(6) for c in range(6)], "row long, col long, p int")
    top = sum(raster.neighbour_weights(weights).values())
    out = raster.contiguity(cells, "p", weights).first()
    assert out["Contiguity"] == pytest.approx((total - 1) / (top - 1))
    assert out["Developable_Area"] == pytest.approx(36 * 1600 / 43560)


def test_contiguity_looks_at_one_part_and_one_chunk(spark):
    cells = spark.createDataFrame([(0, 0, 1, 1), (0, 1, 1, 2), (0, 2, 2, 2)], "row long, col long, p int, ch int")
    assert rows(raster.contiguity(cells, "p"), "p", "Contiguity") == [(1, pytest.approx(1 / 8)), (2, 0.0)]
    assert rows(raster.contiguity(cells, "p", chunk="ch"), "p", "ch", "Contiguity") == [(1, 1, 0.0), (1, 2, 0.0), (2, 2, 0.0)]


def test_custom_weights(spark):
    full = {k: 0 for k in raster.POSITIONS} | {"self": 1, "top_left": 3}
    cells = spark.createDataFrame([(0, 0, 1), (1, 1, 1)], "row long, col long, p int")
    assert raster.contiguity(cells, "p", full).first()["Contiguity"] == pytest.approx((2.5 - 1) / 3)
    with pytest.raises(ValueError):
        raster.neighbour_weights({"self": 1})
    with pytest.raises(ValueError):
        raster.neighbour_weights("bishop")


def test_parts_and_pipeline(spark):
    c = F.col
    lots = spark.createDataFrame([(1, 0.0, 0.0, 60.0), (2, 100.0, 0.0, 20.0)], "folio int, x0 double, y0 double, w double")
    shaped = lots.select("folio", (c("x0") + c("w") / 2).alias("x"), (c("y0") + c("w") / 2).alias("y"),
                         F.array(g.box_ring(c("x0"), c("y0"), c("x0") + c("w"), c("y0") + c("w"))).alias("rings"))
    cells = raster.rasterise(shaped, "folio", "rings", 10.0)
    assert rows(cells.groupBy("folio").count()) == [(1, 36), (2, 4)]
    mask = spark.createDataFrame([(r, 2) for r in range(6)] + [(r, k) for r in range(2) for k in (10, 11)], "row long, col long")
    parts = raster.developable_parts(cells, mask, "folio")
    assert rows(parts.groupBy("folio", "part").count(), "folio", "count") == [(1, 12), (1, 18)]
    out = {r["folio"]: r for r in raster.contiguity_by_parcel(shaped, mask, "folio", "rings", "x", "y", 10.0, chunks=4).collect()}
    assert out[2]["Developable_Area"] == 0.0 and out[2]["Max_Contiguity"] == 0.0
    assert out[1]["Developable_Area"] == pytest.approx(30 * 100 / 43560)
    assert 0 < out[1]["Min_Contiguity"] <= out[1]["Median_Contiguity"] <= out[1]["Max_Contiguity"] <= 1


@pytest.mark.parametrize("rows_held", [1, 40, 200_000])
def test_parts_over_tiles(spark, monkeypatch, rows_held):
    """Parts within and across tiles, whatever a task holds at a time; cells of two parcels join those, repeated and null cells stay as they were."""
    monkeypatch.setattr(raster, "TILE", 4)
    monkeypatch.setattr(raster, "TILE_ROWS", rows_held)
    draw = random.Random(5)
    cells = [(r, c, draw.choice("ab")) for r in range(-9, 14) for c in range(-6, 17) if draw.random() < 0.75]
    cells += draw.sample(cells, 20) + [(r, c, "z") for r, c, _ in draw.sample(cells, 8)] + [(3, 3, None), (None, 2, "a"), (2, None, "b")]
    hidden = set(draw.sample(sorted({(r, c) for r, c, _ in cells if r is not None and c is not None}), 30))
    kept = [x for x in cells if x[0] is not None and x[1] is not None and x[:2] not in hidden]
    name = {x[:2]: (x[0] << 32) + x[1] + (1 << 31) for x in kept}
    owners = {}
    for r, c, parcel in kept:
        if parcel is not None:
            owners.setdefault((r, c), set()).add(parcel)
    changed = True
    while changed:
        changed = False
        for (r, c), own in owners.items():
            for other in ((r, c + 1), (r + 1, c)):
                if own & owners.get(other, set()) and name[r, c] != name[other]:
                    name[r, c] = name[other] = min(name[r, c], name[other])
                    changed = True
    got = raster.developable_parts(spark.createDataFrame(cells, "row long, col int, folio string"), spark.createDataFrame(sorted(hidden), "row long, col int"), "folio")
    assert got.columns == ["row", "col", "folio", "part"]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter((*x, name[x[:2]]) for x in kept)


def test_parts_link_few_cells(spark, monkeypatch):
    """Links over the whole table are between parts of tiles, not between cells."""
    linked = []
    monkeypatch.setattr(raster, "components", lambda links: linked.append(links.count()) or network.components(links))
    cells = spark.range(40 * 40).select((F.col("id") / 40).cast("long").alias("row"), (F.col("id") % 40).alias("col"), F.lit(1).alias("folio"))
    parts = raster.developable_parts(cells, spark.createDataFrame([], "row long, col long"), "folio")
    assert parts.select("part").distinct().count() == 1 and linked == [0]


@pytest.mark.parametrize("width,height,shape", [(10, 10, (4, 5)), (100, 10, (2, 10)), (10, 100, (10, 2)), (1000, 1, (1, 20))])
def test_grid_shape(width, height, shape):
    r, c = raster.grid_shape(width, height)
    best = min(abs(i / (20 // i) - height / width) for i in (1, 2, 4, 5, 10, 20))
    assert r * c == 20 and abs(r / c - height / width) == best
    if (width, height) != (10, 10):
        assert abs(r / c - height / width) <= abs(shape[0] / shape[1] - height / width)


def test_long_chain_is_followed_to_its_end(spark):
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(24)], "src int, dst int, cost double")
    far = network.od_cost(chain, spark.createDataFrame([(0,)], "node int"), 100.0)
    assert sorted((r.node, r.cost) for r in far.collect()) == [(i, float(i)) for i in range(25)]
    assert {r.component for r in network.components(chain).collect()} == {0}
    assert not hasattr(network, "MAX_ROUNDS")

"""Membership, distance, nearest and clipping against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealens.operators import areas, spatial
from conftest import rows

SIDE = 100.0


def ring(*points):
    return [[(float(x), float(y)) for x, y in points]]


POLYGONS = "poly int, rings array<array<struct<x:double,y:double>>>"
ELL = ring((0, 0), (60, 0), (60, 20), (20, 20), (20, 60), (0, 60), (0, 0))
BOX = ring((10, 10), (90, 10), (90, 90), (10, 90), (10, 10))


def in_ell(x, y):
    return (0 <= x < 60 and 0 <= y < 20) or (0 <= x < 20 and 0 <= y < 60)


def in_box(x, y):
    return 10 <= x < 90 and 10 <= y < 90


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    spread = rng.random((250, 2)) * SIDE
    # a third of the points in one small place
    return np.concatenate([spread, 40 + rng.random((125, 2)) * 0.5])


@pytest.fixture(scope="module")
def targets():
    rng = np.random.default_rng(6)
    return np.concatenate([rng.random((60, 2)) * SIDE, 70 + rng.random((60, 2)) * 0.01, [[70.0, 70.0], [70.0, 70.0]]])


def frame(spark, array, schema):
    return spark.createDataFrame([(i, *[float(v) for v in r]) for i, r in enumerate(array)], schema)


@pytest.mark.parametrize("forced", [False, True])
def test_point_in_polygon(spark, request, cloud, forced):
    if forced:
        request.getfixturevalue("force_split")
    points = frame(spark, cloud, "id long, x double, y double")
    polygons = spark.createDataFrame([(1, ELL), (2, BOX)], POLYGONS)
    got = rows(spatial.point_in_polygon(points, polygons, "x", "y", "rings"), "id", "poly")
    expect = [(i, 1) for i, (x, y) in enumerate(cloud) if in_ell(x, y)] + [(i, 2) for i, (x, y) in enumerate(cloud) if in_box(x, y)]
    assert sorted(got) == sorted(expect)


def test_points_on_shared_edges_belong_once(spark):
    grid = [(i * 3 + j, ring((i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j))) for i in range(3) for j in range(3)]
    points = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate([(1, 1), (1, 0.5), (0.5, 1), (2, 2), (0, 0)])], "id int, x double, y double")
    hits = spatial.point_in_polygon(points, spark.createDataFrame(grid, POLYGONS), "x", "y", "rings")
    assert rows(hits.groupBy("id").count()) == [(i, 1) for i in range(5)]


def test_hole_is_outside(spark):
    shape = [(1, [BOX[0], [(30.0, 30.0), (50.0, 30.0), (50.0, 50.0), (30.0, 50.0), (30.0, 30.0)]])]
    points = spark.createDataFrame([(1, 40.0, 40.0), (2, 60.0, 60.0)], "id int, x double, y double")
    hits = spatial.point_in_polygon(points, spark.createDataFrame(shape, POLYGONS), "x", "y", "rings")
    assert rows(hits, "id") == [(2,)]


@pytest.mark.parametrize("forced", [False, True])
def test_within_distance(spark, request, cloud, targets, forced):
    if forced:
        request.getfixturevalue("force_split")
    d = np.sqrt(((cloud[:, None] - targets[None]) ** 2).sum(-1))
    got = spatial.within_distance(frame(spark, cloud, "id long, x double, y double"), frame(spark, targets, "t long, tx double, ty double"), "x", "y", "tx", "ty", 6.0)
    assert sorted(rows(got, "id", "t")) == sorted((int(i), int(j)) for i, j in zip(*np.nonzero(d <= 6.0)))


def test_within_distance_keeps_all_points(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 50.0)], "id int, x double, y double")
    one = spark.createDataFrame([(9, 3.0, 4.0)], "t int, tx double, ty double")
    assert rows(spatial.within_distance(points, one, "x", "y", "tx", "ty", 5.0, how="left", key="id"), "id", "t", "dist") == [(1, 9, 5.0), (2, None, None)]


@pytest.mark.parametrize("radius", [None, 4.0])
def test_nearest(spark, cloud, targets, radius):
    d = np.sqrt(((cloud[:, None] - targets[None]) ** 2).sum(-1))
    got = spatial.nearest(frame(spark, cloud, "id long, x double, y double"), frame(spark, targets, "t long, tx double, ty double"), "id", "x", "y", "tx", "ty", "t", radius=radius)
    found = {r["id"]: (r["t"], r["dist"]) for r in got.collect()}
    expect = {i: int(row.argmin()) for i, row in enumerate(d) if radius is None or row.min() <= radius}
    assert set(found) == set(expect)
    for i, t in expect.items():
        assert found[i][1] == pytest.approx(d[i, t], abs=1e-12)
        assert found[i][0] == t


def test_nearest_within_groups(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, "a"), (2, 0.0, 0.0, "b"), (3, 0.0, 0.0, "c")], "id int, x double, y double, g string")
    items = spark.createDataFrame([(7, 1.0, 0.0, "b"), (8, 2.0, 0.0, "a"), (9, 2.0, 0.0, "a")], "t int, tx double, ty double, g string")
    assert rows(spatial.nearest(points, items, "id", "x", "y", "tx", "ty", "t", by=["g"]), "id", "t", "dist") == [(1, 8, 2.0), (2, 7, 1.0)]


def segment_distance(p, s):
    a, b = np.array(s[:2]), np.array(s[2:])
    t = np.clip(((p - a) @ (b - a)) / ((b - a) @ (b - a)), 0, 1)
    return float(np.linalg.norm(p - (a + t * (b - a))))


def test_snapping_and_anti_join(spark, cloud):
    rng = np.random.default_rng(8)
    lines = np.concatenate([rng.random((80, 4)) * SIDE, [[0, 0, 50, 50], [0, 50, 50, 0]]])
    d = np.array([[segment_distance(p, s) for s in lines] for p in cloud])
    points, edges = frame(spark, cloud, "id long, x double, y double"), frame(spark, lines, "e long, x1 double, y1 double, x2 double, y2 double")
    found = {r["id"]: r["e"] for r in spatial.snap_to_edges(points, edges, "id", "x", "y", "e", tolerance=1.5).collect()}
    assert found == {i: int(row.argmin()) for i, row in enumerate(d) if row.min() <= 1.5}
    far = rows(spatial.beyond_distance_of_lines(points, edges, "x", "y", 1.5, "id"), "id")
    assert sorted(far) == sorted((i,) for i, row in enumerate(d) if row.min() > 1.5)


def test_adjacency_finds_corners_and_partial_sides(spark):
    shapes = [(i * 3 + j, ring((i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j))) for i in range(3) for j in range(3)]
    shapes.append((50, ring((3, 0.5), (4, 0.5), (4, 2.5), (3, 2.5), (3, 0.5))))
    shapes.append((60, ring((9, 9), (10, 9), (10, 10), (9, 10), (9, 9))))
    pairs = rows(spatial.adjacency(spark.createDataFrame(shapes, POLYGONS), "poly", "rings"))
    assert (0, 4) in pairs and (4, 0) in pairs and (0, 8) not in pairs
    assert {b for a, b in pairs if a == 50} == {6, 7, 8}
    assert not any(60 in p for p in pairs)


def test_line_length_in_polygons(spark):
    rng = np.random.default_rng(9)
    lines = rng.random((40, 4)) * SIDE
    got = {(r["e"], r["poly"]): r["inside"] for r in spatial.line_length_in_polygons(
        frame(spark, lines, "e long, x1 double, y1 double, x2 double, y2 double"), spark.createDataFrame([(1, ELL), (2, BOX)], POLYGONS), "rings").collect()}
    for e, s in enumerate(lines):
        a, b = s[:2], s[2:]
        steps = [a + (k + 0.5) / 4000 * (b - a) for k in range(4000)]
        for poly, inside in ((1, in_ell), (2, in_box)):
            expect = sum(inside(*p) for p in steps) / 4000 * np.linalg.norm(b - a)
            assert got.get((e, poly), 0.0) == pytest.approx(expect, abs=0.2)


def test_inside_boundary(spark, cloud):
    bends = spark.createDataFrame([(50.0, -5.0, 30.0, 50.0), (30.0, 50.0, 70.0, 120.0)], "x1 double, y1 double, x2 double, y2 double")
    out = spatial.inside_boundary(frame(spark, cloud, "id long, x double, y double"), bends, "x", "y").collect()
    assert len(out) == len(cloud)
    for r in out:
        line = 50 - (r["y"] + 5) / 55 * 20 if r["y"] < 50 else 30 + (r["y"] - 50) / 70 * 40
        assert r["IN_UDB"] == int(r["x"] >= line)


def test_summary_areas_and_members(spark):
    stations = spark.createDataFrame(
        [(1, "North", "Open", 1, 0, 0.0, 0.0), (1, "North", "Open", 1, 0, 2.0, 0.0), (2, "South", "Plan", 1, 1, 10.0, 0.0)],
        "Id int, Name string, Status string, Green int, EastWest int, x double, y double")
    long = areas.stations_long(stations, ["Id", "Name", "Status"], ["Green", "EastWest"], "x", "y", {"EastWest": "East-West"})
    assert rows(long, "Id", "Corridor", "x") == [(1, "Green", 1.0), (2, "East-West", 10.0), (2, "Green", 10.0)]
    table = areas.summary_areas(long.select("Corridor"), long)
    listed = [(r["SummID"], r["STN_ID"], r["Corridor"]) for r in table.orderBy("SummID").collect()]
    assert listed == [(1, -1, "East-West"), (2, -1, "Green"), (3, 2, "East-West"), (4, 1, "Green"), (5, 2, "Green"),
                      (6, -2, "East-West"), (7, -3, "East-West"), (8, -2, "Green"), (9, -3, "Green")]
    in_corridor = spark.createDataFrame([("p", "Green"), ("q", "Green"), ("q", "East-West")], "f string, Corridor string")
    in_station = spark.createDataFrame([("p", 1), ("q", 2)], "f string, s int")
    got = rows(areas.summary_members(table, in_corridor, in_station, "f"))
    assert sorted(got) == [(1, "q"), (2, "p"), (2, "q"), (3, "q"), (4, "p"), (5, "q"), (6, "q"), (8, "p"), (8, "q")]


@pytest.mark.parametrize("sent", [True, False])
def test_summary_members_write_no_station_pairs(spark, monkeypatch, sent):
    """Pairs of features and stations, the longest table here, are not written while the areas can be sent to all tasks."""
    written = []

    def noted(write):
        return lambda df: written.append(df.count()) or write(df)

    for name in ("cut", "shelved"):
        if hasattr(areas, name):
            monkeypatch.setattr(areas, name, noted(getattr(areas, name)))
    if not sent:
        monkeypatch.setattr(areas, "MOST_SENT", 1)
    table = spark.createDataFrame([(1, -1, "A"), (2, 0, "A"), (3, 1, "A"), (4, 1, "B"), (5, 2, "B"), (6, -2, "A"), (7, -3, "A"), (8, -2, "B"), (9, -3, "B")], "SummID long, STN_ID long, Corridor string")
    pairs = [(f, f * k % 4) for f in range(40) for k in range(1, 9)] + [(None, 1), (3, None)]
    within = [(f, c) for f in range(0, 50, 3) for c in "AB"] + [(None, "A")]
    got = areas.summary_members(table, spark.createDataFrame(within, "f long, Corridor string"), spark.createDataFrame(pairs, "f long, s long"), "f")
    of = {0: [(2, "A")], 1: [(3, "A"), (4, "B")], 2: [(5, "B")]}
    near = {(f, c) for f, s in pairs for _, c in of.get(s, [])}
    want = [(a, f) for f, s in pairs for a, _ in of.get(s, [])] + [(1, f) for f, c in within if c == "A"]
    want += [({"A": 6, "B": 8}[c], f) for f, c in near] + [({"A": 7, "B": 9}[c], f) for f, c in within if f is None or (f, c) not in near]
    assert sorted(map(str, rows(got))) == sorted(map(str, want))
    assert (max(written) < len(pairs)) == sent


def test_preset_areas_replace_buffers(spark):
    default = spark.createDataFrame([("p", 1), ("q", 2)], "f string, a int")
    preset = spark.createDataFrame([("z", 2)], "f string, a int")
    assert rows(areas.override_members(default, preset, "a").select("f", "a")) == [("p", 1), ("z", 2)]


def test_walk_times(spark):
    from arealens.operators import network

    features = spark.createDataFrame([(1, 0.0, 0.0), (2, 90.0, 90.0)], "f int, x double, y double")
    lines = spark.createDataFrame([("A", 4.0, 0.0, 1.0, 5.0, 1.0), ("A", 8.0, 1.0, 0.0, 1.0, 5.0), ("B", 6.0, 0.0, 2.0, 5.0, 2.0)], "n string, t double, x1 double, y1 double, x2 double, y2 double")
    out = network.feature_walk_times(features, lines, "f", "x", "y", "n", "t", "stn", 3.0)
    assert rows(out, "f", "nearest_stn", "min_time_stn", "n_stn", "bin_stn") == [(1, "A", 6.0, 2, "5 to 10 minutes"), (2, None, None, 0, "")]
    stops = spark.createDataFrame([("S", 0.0, 804.672)], "n string, tx double, ty double")
    ideal = network.ideal_walk_times(features, stops, "f", "x", "y", "n", "tx", "ty", "stn", 900.0)
    assert rows(ideal, "f", "nearest_stn", "min_time_stn")[0][:2] == (1, "S")
    assert rows(ideal, "f", "min_time_stn")[0][1] == pytest.approx(10.0)
    remote = network.grid_fallback(features, stops.withColumn("ty", F.lit(20.0)), lines.select("x1", "y1", "x2", "y2"), "f", "x", "y", "n", "tx", "ty", 10.0, 500.0, 15.0)
    assert [(r["OName"], r["DName"]) for r in remote.collect()] == [(2, "S")]
    assert remote.first()["Minutes"] == pytest.approx((90 + 70) * 60 / (3 * 1609.344))
    assert math.isfinite(remote.first()["Minutes"])


@pytest.mark.parametrize("radius", [0.0, 3.0, 40.0])
def test_ideal_walk_times_list_no_pairs(spark, monkeypatch, radius):
    """Ties, several places of a feature or a target, repeated rows, null keys, names and places."""
    from arealens.operators import network

    def refuse(*args, **kwargs):
        raise AssertionError("pairs are listed")

    monkeypatch.setattr(network, "within_distance", refuse)
    rng = random.Random(9)
    place = lambda: (float(rng.randint(0, 30)), float(rng.randint(0, 30)))
    features = [(n % 50, *place()) for n in range(70)] + [(7, 1.0, 1.0)] * 3 + [(None, 5.0, 5.0), (None, 6.0, 6.0), (90, None, 5.0), (91, 500.0, 500.0), (92, math.nan, 1.0)]
    targets = [(f"s{n % 30}", *place()) for n in range(45)] + [("s1", 1.0, 2.0)] * 2 + [(None, 2.0, 1.0), ("far", 9000.0, 9000.0), ("odd", None, 1.0), ("nan", math.nan, 1.0)]
    out = network.ideal_walk_times(spark.createDataFrame(features, "f long, x double, y double"), spark.createDataFrame(targets, "n string, tx double, ty double"),
                                   "f", "x", "y", "n", "tx", "ty", "stn", radius, meters_per_unit=10.0)
    assert out.columns == ["f", "nearest_stn", "min_time_stn", "n_stn", "bin_stn"]
    want = {}
    for f, x, y in features:
        for n, tx, ty in targets:
            if None not in (x, tx) and math.hypot(x - tx, y - ty) <= radius:
                want.setdefault(f, []).append((math.sqrt((x - tx) ** 2 + (y - ty) ** 2), n is not None, n or ""))
    got = {r.f: (r.min_time_stn, r.nearest_stn, r.n_stn) for r in out.collect()}
    assert set(got) == set(want) and (want or radius == 0)
    for f, found in want.items():
        dist, named, name = min(found)
        assert got[f] == (pytest.approx(dist * 10.0 * 60 / (3.0 * 1609.344)), name if named else None, len(found))


@pytest.mark.parametrize("forced", [False, True])
def test_very_long_line_against_tiny_polygons(spark, request, forced):
    if forced:
        request.getfixturevalue("force_split")
    boxes = [(i, [[(i * 10.0, i * 10.0), (i * 10.0 + 0.5, i * 10.0), (i * 10.0 + 0.5, i * 10.0 + 0.5), (i * 10.0, i * 10.0 + 0.5), (i * 10.0, i * 10.0)]]) for i in range(40)]
    lines = spark.createDataFrame([(1, -5.0, -5.0, 1e6, 1e6), (2, 0.1, 0.1, 0.2, 0.1), (3, 900.0, 0.0, 901.0, 0.0)], "line int, x1 double, y1 double, x2 double, y2 double")
    got = spatial.line_length_in_polygons(lines, spark.createDataFrame(boxes, POLYGONS), "rings")
    found = {(r["line"], r["poly"]): r["inside"] for r in got.collect()}
    assert set(found) == {(1, i) for i in range(40)} | {(2, 0)}
    assert found[2, 0] == pytest.approx(0.1)
    assert all(v == pytest.approx(0.5 * 2 ** 0.5, rel=1e-6) for (line, _), v in found.items() if line == 1)


def test_polygons_of_no_size_meet_long_lines(spark):
    lines = spark.createDataFrame([(1, 0.0, 0.0, 1e5, 1e5)], "line int, x1 double, y1 double, x2 double, y2 double")
    places = spark.createDataFrame([(i, float(i), float(i)) for i in range(30)], "id int, px double, py double")
    got = spatial.box_join(lines, ("x1", "y1", "x2", "y2"), places, ("px", "py", "px", "py"))
    assert rows(got, "line", "id") == [(1, i) for i in sorted(range(30), key=str)]


def test_nearest_by_group_with_a_hot_group_and_equal_points(spark, force_split):
    points = spark.range(300).select("id", F.lit(5.0).alias("x"), F.lit(5.0).alias("y"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"))
    items = spark.createDataFrame([(7, 1.0, 5.0, "b"), (8, 5.0, 8.0, "a"), (9, 90.0, 8.0, "a")], "t int, tx double, ty double, g string")
    got = spatial.nearest(points, items, "id", "x", "y", "tx", "ty", "t", by=["g"])
    assert rows(got.groupBy("t", "dist").count()) == [(7, 4.0, 200), (8, 3.0, 100)]


def outline(n, seed, spikes=0.6):
    rng = np.random.default_rng(seed)
    turn = np.sort(rng.uniform(0, 2 * np.pi, n))
    far = rng.uniform(1 - spikes, 1, n) * 100
    return [(float(x), float(y)) for x, y in zip(50 + far * np.cos(turn), 50 + far * np.sin(turn))]


def odd_crossings(x, y, rings):
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            n += (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1)
    return n % 2 == 1


SHAPES = {1: [outline(400, 1)], 2: [outline(30, 2), outline(25, 3, 0.2)], 3: [[(0.0, 0.0), (60.0, 0.0), (60.0, 40.0), (0.0, 40.0)]],
            4: [[(10.0, 10.0), (20.0, 10.0)]]}


def closed(spark, name="poly"):
    data = [(k, [[{"x": x, "y": y} for x, y in ring + ring[:1]] for ring in rings]) for k, rings in SHAPES.items()]
    return spark.createDataFrame(data, f"{name} int, rings array<array<struct<x:double,y:double>>>")


@pytest.mark.parametrize("limit,forced", [(10_000, False), (100, False), (0, False), (0, True)])
def test_point_in_polygon_by_slabs(spark, request, monkeypatch, limit, forced):
    if forced:
        request.getfixturevalue("force_split")
    monkeypatch.setattr(spatial, "LONG_EDGES", limit)
    rng = np.random.default_rng(5)
    places = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-60, 160, (150 if forced else 600, 2)))]
    places += [(1000, 0.0, 0.0), (1001, 60.0, 40.0), (1002, 30.0, 40.0), (1002, 30.0, 0.0), (1003, 12.0, 10.0), (1004, None, 1.0)] + [(2000 + i, 20.0, 20.0) for i in range(20)]
    pts = spark.createDataFrame(places, "id int, x double, y double")
    got = spatial.point_in_polygon(pts, closed(spark).withColumn("label", F.lit("z")), "x", "y", "rings")
    assert got.columns == ["id", "x", "y", "poly", "label"]
    want = sorted((i, x, y, k) for i, x, y in places if x is not None for k, rings in SHAPES.items() if odd_crossings(x, y, rings))
    assert sorted((r.id, r.x, r.y, r.poly) for r in got.collect()) == want


def test_slabs_hold_two_rows_an_edge_at_most(spark):
    ring = outline(3000, 8)
    edges = spark.createDataFrame([(1, *a, *b) for a, b in zip(ring, ring[1:] + ring[:1])], "k int, x1 double, y1 double, x2 double, y2 double")
    slabs, shapes = spatial.edge_slabs(edges, "k")
    assert shapes.count() == 1 and slabs.count() <= 2 * 3000 + 2
    # Nowhere in the plan is an edge in an array.
    inside = spatial.point_in_edges(spark.range(500).select(F.col("id"), (F.col("id") % 25 * 8.0 - 50).alias("x"), (F.floor(F.col("id") / 25) * 10.0 - 50).alias("y")), edges, "x", "y", "k")
    assert sorted(r.id for r in inside.collect()) == [i for i in range(500) if odd_crossings(i % 25 * 8.0 - 50, i // 25 * 10.0 - 50, [ring])]
    assert "array<struct" not in str(slabs.schema.simpleString())


def test_rasterise_by_crossings(spark):
    from arealens.operators import raster

    got = {(r.poly, r.row, r.col) for r in raster.rasterise(closed(spark), "poly", "rings", 7.0).collect()}
    want = {}
    for row in range(-12, 30):
        for col in range(-12, 30):
            inside = [k for k, rings in SHAPES.items() if odd_crossings((col + 0.5) * 7, (row + 0.5) * 7, rings)]
            if inside:
                want[row, col] = max(inside)
    assert got == {(k, r, c) for (r, c), k in want.items()}
    assert raster.rasterise(closed(spark).limit(0), "poly", "rings", 7.0).count() == 0


@pytest.mark.parametrize("radius,fine,forced", [(25.0, 16, False), (25.0, 1, False), (3.0, 4, False), (400.0, 32, False), (25.0, 5, True)])
def test_floating_sums_equal_the_list_of_pairs(spark, request, radius, fine, forced):
    if forced:
        request.getfixturevalue("force_split")
    rng = np.random.default_rng(int(radius) + fine)
    spots = [(i, float(x), float(y), float(i % 9), "abc"[i % 3]) for i, (x, y) in enumerate(rng.uniform(-50, 50, (40 if forced else 200, 2)))]
    # Many at one place, some exactly on the edge, on cell borders, and without a place.
    spots += [(1000 + i, 10.0, 10.0, 1.0, "a") for i in range(30)] + [(2000, 10.0 + radius, 10.0, 2.0, "b"), (2001, 10.0, 10.0 - radius, 3.0, None), (2002, 0.0, 0.0, None, "c")]
    df = spark.createDataFrame(spots + [(3000, None, 1.0, 5.0, "a")], "id int, x double, y double, w double, cls string")
    zones = df.where("id % 4 = 0 or id >= 2000").select(F.col("id").alias("z"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    got = {(r.zone, r.cls): (r.w, r.n) for r in areas.floating_sums(df, zones, "z", "cx", "cy", "x", "y", radius, ["w"], ["cls"], fine=fine).collect()}
    want = {}
    for z, zx, zy, *_ in spots:
        if z % 4 == 0 or z >= 2000:
            for _, x, y, w, cls in spots:
                if math.sqrt((x - zx) ** 2 + (y - zy) ** 2) <= radius:
                    total, n = want.get((z, cls), (None, 0))
                    want[z, cls] = (total if w is None else (total or 0) + w, n + 1)
    assert set(got) == set(want)
    for k, (w, n) in want.items():
        assert got[k][1] == n and got[k][0] == (pytest.approx(w) if w is not None else None)


def test_few_features_are_measured(spark):
    """Of a dense square, only features in cells on the edge of a circle are measured one by one."""
    df = spark.range(40_000).select((F.col("id") % 200 + 0.5).alias("x"), (F.floor(F.col("id") / 200) + 0.5).alias("y"))
    zone = spark.createDataFrame([(1, 100.0, 100.0)], "zone int, zx double, zy double")
    cover = areas._cover(zone, 90.0, 90.0 / 32, 5).collect()
    edge = [r for r in cover if not r.inner]
    assert len(cover) < 1000 and len(edge) * (90 / 32) ** 2 < 0.15 * math.pi * 90 ** 2
    assert areas.floating_sums(df, zone, "zone", "zx", "zy", "x", "y", 90.0, [], fine=32).first()["n"] == sum(
        (i + 0.5 - 100) ** 2 + (j + 0.5 - 100) ** 2 <= 8100 for i in range(200) for j in range(200))


def by_hand(points, targets, radius):
    return sorted((i, t) for i, x, y in points for t, tx, ty in targets if math.sqrt((x - tx) ** 2 + (y - ty) ** 2) <= radius)


@pytest.mark.parametrize("small", [True, False])
def test_dense_pairs_go_to_many_tasks(spark, monkeypatch, small):
    """A table of few bytes that makes many pairs is spread, on cells finer than a box, and never by an unforeseen broadcast."""
    from arealens import skew

    monkeypatch.setattr(spatial, "TASK_PAIRS", 2_000)
    if not small:
        monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    rng = np.random.default_rng(11)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-60, 60, (600, 2)))] + [(900, None, 1.0), (901, -16.0, 16.0)]
    targets = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-60, 60, (120, 2)))] + [(500, 0.0, 16.0), (501, 1.0, None)]
    met, counted = [], spatial.pairs_met
    monkeypatch.setattr(spatial, "pairs_met", lambda *a: met.append(counted(*a)) or met[-1])
    left = spark.createDataFrame(points, "id int, x double, y double").coalesce(1)
    got = spatial.within_distance(left, spark.createDataFrame(targets, "t int, tx double, ty double"), "x", "y", "tx", "ty", 16.0)
    assert rows(got, "id", "t") == sorted(by_hand([p for p in points if p[1] is not None], [t for t in targets if t[2] is not None], 16.0), key=lambda r: tuple((False, str(v)) for v in r))
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    assert met[0] > 2_000 and ("Broadcast" in got._jdf.queryExecution().sparkPlan().toString()) == small


def test_points_at_one_place_are_tested_once(spark, monkeypatch):
    met, counted = [], spatial.pairs_met
    monkeypatch.setattr(spatial, "pairs_met", lambda *a: met.append(counted(*a)) or met[-1])
    edges = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 0.0), (1, 9.0, 0.0, 9.0, 9.0), (1, 9.0, 9.0, 0.0, 9.0), (1, 0.0, 9.0, 0.0, 0.0)],
                                  "k int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(i, 4.0 + 9 * (i % 2), 4.0) for i in range(400)] + [(0, 4.0, 4.0), (500, None, 4.0)], "id int, x double, y double")
    got = spatial.point_in_edges(points, edges, "x", "y", "k")
    assert got.columns == ["id", "x", "y", "k"] and sorted(r.id for r in got.collect()) == list(range(0, 400, 2))
    assert max(met) <= 2 * 8


def test_nearest_of_repeated_places_and_keys(spark):
    points = spark.createDataFrame([(i, 5.0, 5.0, 1) for i in range(300)] + [(1, 0.0, 0.0, 1), (None, 1.0, 0.0, 1), (None, 5.0, 5.0, 2), (400, None, 5.0, 1), (401, 5.0, 5.0, None)],
                                   "id int, x double, y double, g int")
    targets = spark.createDataFrame([(1, 0.0, 0.5, 1), (2, 5.0, 7.0, 1), (3, 5.0, 7.0, 1), (4, 5.0, 6.0, 2)], "t int, tx double, ty double, g int")
    got = {(r.id, r.t, r.dist) for r in spatial.nearest(points, targets, "id", "x", "y", "tx", "ty", "t", by=["g"]).collect()}
    assert got == {(i, 2, 2.0) for i in range(300) if i != 1} | {(1, 1, 0.5), (None, 4, 1.0)}


def test_station_pairs_are_made_unique_only_where_they_repeat(spark):
    features = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 0.0), (2, 5.0, 0.0), (None, 0.0, 0.0)], "f int, x double, y double")
    stations = spark.createDataFrame([(7, 0.0, 1.0), (7, 0.0, 1.0), (8, 5.0, 1.0)], "s int, sx double, sy double")
    single = areas.station_members(features, stations, "f", "x", "y", "s", "sx", "sy", 2.0)
    assert rows(single) == sorted([(1, 7), (2, 8), (None, 7)], key=lambda t: tuple((v is None, str(v)) for v in t))
    assert "Aggregate" not in single._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    wide = stations.unionByName(spark.createDataFrame([(7, 1.0, 0.0)], stations.schema))
    assert rows(areas.station_members(features, wide, "f", "x", "y", "s", "sx", "sy", 2.0)) == rows(single)


def test_zones_at_one_place_are_made_up_once(spark, monkeypatch):
    seen, cover = [], areas._cover
    monkeypatch.setattr(areas, "_cover", lambda zones, *a: seen.append(zones.count()) or cover(zones, *a))
    df = spark.createDataFrame([(i % 90, 10.0 * (i % 3), 0.0, 1.0) for i in range(120)], "id int, x double, y double, w double")
    got = {(r.zone, r.w, r.n) for r in areas.floating_sums(df, df, "id", "x", "y", "x", "y", 10.0, ["w"]).collect()}
    around = {0: 80, 1: 120, 2: 80}
    assert got == {(i, float(around[i % 3] * k), around[i % 3] * k) for i in range(90) for k in [2 if i < 30 else 1]}
    assert seen == [3]

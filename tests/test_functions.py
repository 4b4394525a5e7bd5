"""Scalar, geometry and indicator builders with answers worked out by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealens.functions import geometry as g
from arealens.functions import indicators as ind
from arealens.functions import scalar as s
from arealens.predicates import And, Comp, Or, area_criteria, span


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def text(v):
    return F.lit(v).cast("string")


def num(v):
    return F.lit(v).cast("double")


@pytest.mark.parametrize("value,width,expect", [("12", 4, "0012"), ("123456", 4, "123456"), ("1234", 4, "1234"), (None, 4, None)])
def test_zero_pad(spark, value, width, expect):
    assert one(spark, s.zero_pad(text(value), width)) == expect


@pytest.mark.parametrize("value,expect", [("$ 1,234.50", 1234.5), ("$7", 7.0), (None, None)])
def test_money(spark, value, expect):
    assert one(spark, s.money(text(value))) == expect


def test_text_pieces(spark):
    a, b = s.split_once(F.lit("12 - 7 - 9"))
    assert one(spark, F.array(a, b)) == ["12", "7 - 9"]
    assert one(spark, s.split_once(F.lit("12"))[1]) is None
    assert one(spark, s.drop_suffix_if(F.lit("710-00PD"), "PD")) == "710-00"
    assert one(spark, s.drop_suffix_if(F.lit("710-00"), "PD")) == "710-00"
    assert one(spark, s.code_text(F.lit("Q"), {"C": "Collected"})) is None
    assert one(spark, s.geoid(F.lit("12"), F.lit("086"))) == "12086"


def test_field_arithmetic(spark):
    df = spark.createDataFrame([(87120.0,)], "LND_SQFOOT double")
    assert df.select(s.field_arithmetic("LND_SQFOOT / 43560")).first()[0] == 2.0
    assert df.select(s.field_arithmetic("LND_SQFOOT")).first()[0] == 87120.0
    with pytest.raises(ValueError):
        s.field_arithmetic("__import__('os')")


def test_unix_dates_use_ten_digits(spark):
    for stamp in ("1609459200", "1609459200000"):
        ts = s.date_from_unix(F.lit(stamp))
        assert one(spark, F.array(*[c for c in s.date_parts(ts).values()])) == [1, 1, 2021]


def test_null_rules_of_folds_and_division(spark):
    null = F.lit(None).cast("double")
    assert one(spark, s.row_mean(num(4), null)) == 4.0
    assert one(spark, s.row_mean(null, null)) is None
    assert one(spark, s.row_sum(null, num(2))) == 2.0
    assert one(spark, s.sum_or_zero(num(3), null)) == 0.0
    assert one(spark, s.row_min(num(3), null)) == 3.0
    assert one(spark, s.divide(num(1), num(0))) is None
    assert one(spark, s.density(num(1), num(0), 10)) is None
    assert one(spark, s.density(num(4), num(87120), s.SQFT_PER_ACRE)) == 2.0
    assert one(spark, s.percent(num(1), num(4))) == 25.0
    assert one(spark, s.clip_zero(num(-3))) == 0.0
    assert one(spark, s.clip_zero(null)) is None
    assert one(spark, s.infinite_to_zero(num(float("inf")))) == 0.0
    assert one(spark, s.finite(num(float("nan")))) is None


@pytest.mark.parametrize("value,expect", [(0, "15Min"), (14.99, "15Min"), (15, "30Min"), (59.9, "60Min"), (60, "60Minp"), (None, "60Minp")])
def test_access_bins(spark, value, expect):
    assert one(spark, s.bin_label(num(value), (15, 30, 45, 60))) == expect


@pytest.mark.parametrize("value,expect", [(0, "0 to 5 minutes"), (5, "0 to 5 minutes"), (5.1, "5 to 10 minutes"), (30, "25 to 30 minutes"), (31, "over 30 minutes"), (None, "")])
def test_walk_bins(spark, value, expect):
    assert one(spark, s.walk_time_bin(num(value))) == expect


def test_previous_break(spark):
    assert [one(spark, s.previous_break(F.lit(b), (15, 30, 45))) for b in (15, 30, 45)] == [0, 15, 30]


@pytest.mark.parametrize("kind,lts,cycle", [("trunk", 1, 0), ("secondary_link", 2, 0), ("cycleway", 4, 1), ("tertiary", 3, 0), ("living_street", 4, 0), ("primary cycleway", 4, 1), ("footpath", 4, 0)])
def test_street_classes(spark, kind, lts, cycle):
    assert one(spark, s.bikeability(F.lit(kind))) == lts
    assert one(spark, s.cycleway(F.lit(kind))) == cycle


def ring(*points):
    return F.array(*[F.struct(num(x).alias("x"), num(y).alias("y")) for x, y in points])


def test_polygon_area_and_centroid(spark):
    ell = ring((0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3), (0, 0))
    hole = ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))
    square = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    assert one(spark, g.ring_area(ell)) == 6.0
    assert one(spark, g.polygon_area(F.array(square, hole))) == 15.0
    c = one(spark, g.ring_centroid(ell))
    assert (c["x"], c["y"]) == (pytest.approx(1.5), pytest.approx(1.0))
    assert one(spark, g.line_length(ell)) == 14.0
    assert one(spark, g.line_length(ring((1, 1)))) == 0.0


def test_known_map_points(spark):
    # a degree of a meridian, and the origin of the state plane zone
    degree = ring((-80.2, 25.0), (-80.2, 26.0))
    assert one(spark, g.geodesic_miles(degree)) == pytest.approx(110780.40 / 1609.344, rel=1e-6)
    p = one(spark, g.project(num(-81.0), num(24 + 20 / 60), 6437))
    assert (p["x"], p["y"]) == (pytest.approx(200000.0), pytest.approx(0.0, abs=1e-6))
    feet = one(spark, g.project(num(-80.0), num(26.0), 2881))
    metres = one(spark, g.project(num(-80.0), num(26.0), 6437))
    assert feet["x"] == pytest.approx(metres["x"] * 3937 / 1200)
    # one degree of longitude east of the central meridian, near 26 north, is about 100.1 km
    assert metres["x"] - 200000 == pytest.approx(100_100, abs=150)
    merc = one(spark, g.project(num(180.0), num(0.0), 3857))
    assert merc["x"] == pytest.approx(20037508.3428, abs=1e-3)


def test_bounding_box(spark):
    assert one(spark, g.box_is_valid(num(26), num(25), num(-80), num(-81))) is True
    assert one(spark, g.box_is_valid(num(90), num(25), num(-80), num(-81))) is False


@pytest.mark.parametrize("walk,ideal,expect", [(5, None, -1), (5, 0, 1), (None, 2, -2), (0, 2, 1), (1, 2, 1), (6, 4, 1.5), (None, None, -1), (None, 0, 1)])
def test_directness(spark, walk, ideal, expect):
    assert one(spark, ind.directness(num(walk), num(ideal))) == expect


def test_indicators_keep_their_null_rules(spark):
    null = F.lit(None).cast("double")
    assert one(spark, ind.area_if_active(num(10), null)) == 0.0
    assert one(spark, ind.area_if_active(num(10), num(2))) == 10.0
    assert one(spark, ind.area_if_vacant(num(10), F.lit("Vacant/Undeveloped"))) == 10.0
    assert one(spark, ind.within(null)) == 0
    assert one(spark, ind.within(num(15))) == 1
    assert one(spark, ind.non_auto_share(num(1), null, num(1), num(4))) == 0.0
    assert one(spark, ind.non_auto_share(num(1), num(1), num(1), num(0))) == 0.0
    assert one(spark, ind.non_auto_share(num(1), num(1), num(1), num(6))) == 50.0
    assert one(spark, ind.grid_density(num(2), num(43560.0 * 640))) == 2.0
    assert one(spark, ind.value_index(num(4), num(2), num(10), num(10))) == 2.0
    parts = {"A": num(2), "B": num(6)}
    assert one(spark, ind.class_floor_share(F.lit("B"), parts, num(8))) == 0.75
    assert one(spark, ind.class_floor_share(F.lit("B"), {"A": null, "B": num(6)}, num(8))) == 0.0
    assert one(spark, ind.class_floor_share(F.lit("B"), parts, num(0))) == 0.0


def test_predicates(spark):
    v = F.lit(5)
    assert one(spark, Comp(">=", 5).on(v)) is True
    assert one(spark, And([Comp(">", 1), Comp("<", 5)]).on(v)) is False
    assert one(spark, And([Comp(">", 1), Comp("<", 5)]).on(v, F.lit(4))) is True
    assert one(spark, Or([span(7, 9), Comp("==", 5)]).on(v)) is True
    assert len(area_criteria()) == 21
    with pytest.raises(KeyError):
        Comp("~", 1)
    with pytest.raises(TypeError):
        And([span(1, 2)])


def test_dates_from_text(spark):
    texts = ["2019-03-07", "3/7/2019", " 03/07/2019 14:05:00", "2019/3/7", "7-Mar-2019", "Mar 7, 2019", "2019-03-07T01:02:03", "no date", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", *[c.alias(n) for n, c in s.date_parts(s.date_from_text(F.col("t"))).items()])
    assert [tuple(r)[1:] for r in got.orderBy("i").collect()] == [(7, 3, 2019)] * 7 + [(None, None, None)] * 3


# Lines whose length is published or follows from the ellipsoid's quarter meridian (10001965.729 m) and radius (6378137 m).
WGS84 = 1 / 298.257223563
LINES = [
    (144 + 25 / 60 + 29.52440 / 3600, -(37 + 57 / 60 + 3.72030 / 3600), 143 + 55 / 60 + 35.38390 / 3600, -(37 + 39 / 60 + 10.15610 / 3600), None, 54972.271),
    (0.0, 0.0, 0.0, 90.0, None, 10001965.729), (20.0, 90.0, -110.0, -90.0, None, 20003931.459), (0.0, 0.0, 180.0, 0.0, None, 20003931.459),
    (10.0, 0.0, 11.0, 0.0, None, 6378137 * math.pi / 180), (-170.0, 0.0, 170.0, 0.0, None, 6378137 * math.pi / 9), (5.0, 12.0, 5.0, 12.0, None, 0.0),
    (0.0, -30.0, 179.8, 29.9, WGS84, 19989832.827610), (0.0, -30.0, 180.0, 30.0, None, 20003931.459), (0.0, 40.0, 180.0, 50.0, None, 2 * 10001965.729 - 4429529.030 - 5540847.042),
    (0.0, 0.0, 179.0, 0.0, None, 6378137 * math.pi * 179 / 180), (-73.8, 40.6, -0.5, 51.6, WGS84, 5551759.400),
]


@pytest.mark.parametrize("turned", [False, True])
def test_geodesic_lines_to_a_millimetre(spark, turned):
    data = [(i, *((x2, y2, x1, y1) if turned else (x1, y1, x2, y2)), f is not None) for i, (x1, y1, x2, y2, f, _) in enumerate(LINES)]
    df = spark.createDataFrame(data + [(99, None, 1.0, 2.0, 3.0, False)], "i int, x1 double, y1 double, x2 double, y2 double, wgs boolean")
    ends = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    got = {r.i: r.m for r in df.select("i", F.when(F.col("wgs"), g.geodesic_metres(*ends, flattening=WGS84)).otherwise(g.geodesic_metres(*ends)).alias("m")).collect()}
    assert got.pop(99) is None
    for i, (*_, metres) in enumerate(LINES):
        assert got[i] == pytest.approx(metres, abs=2e-3 if i == 9 else 1e-3), LINES[i]


def test_geodesics_add_up_along_a_line_and_keep_the_triangle(spark):
    rng = np.random.default_rng(4)
    pts = rng.uniform((-180, -89, -180, -89, -180, -89), (180, 89, 180, 89, 180, 89), (150, 6)).tolist()
    df = spark.createDataFrame(pts, "ax double, ay double, bx double, by double, cx double, cy double")
    legs = [g.geodesic_metres(*[F.col(c) for c in cs]).alias(n) for n, cs in (("ab", ("ax", "ay", "bx", "by")), ("bc", ("bx", "by", "cx", "cy")), ("ac", ("ax", "ay", "cx", "cy")), ("ba", ("bx", "by", "ax", "ay")))]
    for r in df.select(*legs).collect():
        assert r.ab == pytest.approx(r.ba, abs=1e-4) and r.ac <= r.ab + r.bc + 1e-3 and 0 < r.ab <= 20003931.46


def test_any_system_into_any_other(spark):
    from arealens.functions.geometry import project, reproject, unproject

    rng = np.random.default_rng(6)
    df = spark.createDataFrame(rng.uniform((-82.5, 24.5), (-79.5, 31.0), (60, 2)).tolist() + [[None, 25.0]], "lon double, lat double")
    for here in (4326, 3857, 6437, 2881):
        for there in (4326, 3857, 6437, 2881):
            out = df.select("lon", "lat", project(F.col("lon"), F.col("lat"), here).alias("a")).select("*", reproject(F.col("a.x"), F.col("a.y"), here, there).alias("b"))
            out = out.select("lon", "a", "b", unproject(F.col("b.x"), F.col("b.y"), there).alias("d"), reproject(F.col("b.x"), F.col("b.y"), there, here).alias("c"), "lat").collect()
            close = 1e-6 if here != 4326 else 1e-11
            for r in out:
                if r.lon is not None:
                    assert r.c.x == pytest.approx(r.a.x, abs=close, rel=0) and r.c.y == pytest.approx(r.a.y, abs=close, rel=0)
                    assert r.d.x == pytest.approx(r.lon, abs=1e-11, rel=0) and r.d.y == pytest.approx(r.lat, abs=1e-11, rel=0)
    with pytest.raises(ValueError):
        reproject(F.col("lon"), F.col("lat"), 4326, 9999)


def test_many_places_are_unprojected_in_batches(spark):
    from arealens.functions.geometry import project, unproject

    df = spark.range(40_000).select("id", (F.col("id") % 300 / 100 - 82.5).alias("lon"), (F.col("id") % 641 / 100 + 24.5).alias("lat"))
    back = df.select("lon", "lat", project(F.col("lon"), F.col("lat"), 2881).alias("p")).select("lon", "lat", unproject(F.col("p.x"), F.col("p.y"), 2881).alias("d"))
    # A fold over rounds is interpreted, at about a millisecond a place.
    assert "aggregate(" not in back._jdf.queryExecution().optimizedPlan().toString()
    worst = back.agg(F.max(F.abs(F.col("d.x") - F.col("lon"))).alias("x"), F.max(F.abs(F.col("d.y") - F.col("lat"))).alias("y")).first()
    assert worst.x < 1e-11 and worst.y < 1e-11
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (1e300, float("inf"))], "a double, b double").select(unproject(F.col("a"), F.col("b"), 6437).alias("d")).collect()
    assert odd[0].d is None and math.isnan(odd[1].d.x)

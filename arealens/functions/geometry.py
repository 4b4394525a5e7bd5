"""Geometry as plain columns: points are x, y; lines and rings are arrays of struct<x, y>."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Functions that run in tasks are sent by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRES_PER_MILE = 1609.344


def _pairs(line: Column) -> Column:
    """Consecutive vertex pairs of a line."""
    n = F.size(line)
    return F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda i: F.struct(F.element_at(line, i).alias("a"), F.element_at(line, i + 1).alias("b")),
    )


def vertex_pairs(line: Column) -> Column:
    """Consecutive vertex pairs; empty for a line of fewer than two vertices."""
    return F.when(F.size(line) >= 2, _pairs(line)).otherwise(F.slice(_pairs_of_two(line), 1, 0))


def _pairs_of_two(line: Column) -> Column:
    first = F.element_at(line, 1)
    return F.array(F.struct(first.alias("a"), first.alias("b")))


def _fold_pairs(line: Column, term) -> Column:
    return F.aggregate(vertex_pairs(line), F.lit(0.0), lambda acc, p: acc + term(p["a"], p["b"]))


def line_length(line: Column) -> Column:
    return _fold_pairs(line, lambda a, b: F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def _lag(line: Column, flattening: float) -> Column:
    """How far the longitude a line gains on the ellipsoid lags behind that on the auxiliary sphere."""
    c = F.lit(flattening / 16) * line["cos2"] * (4 + F.lit(flattening) * (4 - 3 * line["cos2"]))

    def lag(v: Column) -> Column:
        rest = v["mid"] + v["c"] * F.cos(line["arc"]) * (2 * v["mid"] * v["mid"] - 1)
        return (1 - v["c"]) * F.lit(flattening) * line["sin"] * (line["arc"] + v["c"] * F.sin(line["arc"]) * rest)

    return let(F.struct(c.alias("c"), F.cos(line["twice"]).alias("mid")), lag)


def _metres(line: Column, flattening: float) -> Column:
    """Metres along a line, given its arc on the auxiliary sphere."""
    polar = GRS80_A * (1 - flattening)
    u2 = line["cos2"] * F.lit((GRS80_A ** 2 - polar ** 2) / polar ** 2)

    def length(v: Column) -> Column:
        big = 1 + v["u2"] / 16384 * (4096 + v["u2"] * (v["u2"] * (320 - 175 * v["u2"]) - 768))
        small = v["u2"] / 1024 * (256 + v["u2"] * (v["u2"] * (74 - 47 * v["u2"]) - 128))
        twice = 2 * v["mid"] * v["mid"] - 1
        less = small * v["sin"] * (v["mid"] + small / 4 * (v["cos"] * twice - small / 6 * v["mid"] * (4 * v["sin"] * v["sin"] - 3) * (2 * twice - 1)))
        return F.lit(polar) * big * (line["arc"] - less)

    return let(F.struct(u2.alias("u2"), F.cos(line["twice"]).alias("mid"), F.sin(line["arc"]).alias("sin"), F.cos(line["arc"]).alias("cos")), length)


def _line(sine: Column, first: Column, arc: Column) -> Column:
    """A line by the sine of its bearing at the equator, the arc from there to its start, and its own arc."""
    return F.struct(sine.alias("sin"), ((1 - sine) * (1 + sine)).alias("cos2"), (2 * first + arc).alias("twice"), arc.alias("arc"))


def _around(p: Column, w: Column, then: Callable[[Column], Column]) -> Column:
    """The line between two latitudes that gains the longitude `w` on the auxiliary sphere."""
    def placed(q: Column) -> Column:
        size = F.greatest(F.sqrt(q["east"] * q["east"] + q["north"] * q["north"]), F.lit(1e-300))
        bearing = F.struct((q["east"] / size).alias("sin"), (q["north"] / size).alias("cos"), F.atan2(size, q["dot"]).alias("arc"))
        return let(bearing, lambda r: let(_line(r["sin"] * p["c1"], F.atan2(p["s1"], r["cos"] * p["c1"]), r["arc"]), then))

    return let(F.struct((p["c2"] * F.sin(w)).alias("east"), (p["c1"] * p["s2"] - p["s1"] * p["c2"] * F.cos(w)).alias("north"),
                        (p["s1"] * p["s2"] + p["c1"] * p["c2"] * F.cos(w)).alias("dot")), placed)


def _leaving(p: Column, v: Column, then: Callable[[Column, Column], Column]) -> Column:
    """The line that leaves `v` south of due east and ends at the second latitude, and the longitude it gains on the auxiliary sphere."""
    def ended(q: Column) -> Column:
        first = F.atan2(p["s1"], q["cos"])
        gained = F.atan2(q["sin"] * p["s2"], q["end"]) - F.atan2(q["sin"] * p["s1"], q["cos"])
        return let(_line(q["sin"], first, F.atan2(p["s2"], q["end"]) - first), lambda line: then(line, gained))

    north = -F.sin(v) * p["c1"]
    end = F.sqrt(F.pow(F.sin(v) * p["c1"], 2) + (p["s1"] - p["s2"]) * (p["s1"] + p["s2"]))
    return let(F.struct((F.cos(v) * p["c1"]).alias("sin"), north.alias("cos"), end.alias("end")), ended)


def geodesic_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column, flattening: float | None = None) -> Column:
    """Length in metres of the shortest line on the ellipsoid between two places in degrees; null where one is null.

    The starting bearing is iterated on the auxiliary sphere. Nearly opposite places, where
    that does not settle, are solved by halving the range of bearings: from the place nearer
    to a pole, the longitude that a line gains grows as its bearing turns from north to south.
    """
    f = GRS80_F if flattening is None else flattening
    # The place farther from the equator comes first, south of it; lines stay as long under such turns.
    swap = F.abs(lat1) < F.abs(lat2)
    far, near = F.when(swap, lat2).otherwise(lat1), F.when(swap, lat1).otherwise(lat2)
    flip = F.when(far > 0, -1.0).otherwise(1.0)
    turn = F.radians(F.abs(F.pmod(lon2 - lon1 + 180.0, F.lit(360.0)) - 180.0))
    # A first place on the equator is moved south by a millionth of a metre, so that bearings order the lines.
    b1 = F.least(F.atan(F.lit(1 - f) * F.tan(F.radians(far * flip))), F.lit(-1.5e-13))
    b2 = F.atan(F.lit(1 - f) * F.tan(F.radians(near * flip)))
    given = F.struct(F.sin(b1).alias("s1"), F.cos(b1).alias("c1"), F.sin(b2).alias("s2"), F.cos(b2).alias("c2"), turn.alias("turn"))

    def settled(p: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            new = _around(p, acc["w"], lambda line: p["turn"] + _lag(line, f))
            return let(new, lambda w: F.struct(w.alias("w"), F.abs(w - acc["w"]).alias("change")))

        return F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.struct(p["turn"].alias("w"), F.lit(1.0).alias("change")), step)

    def halved(p: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            middle = (acc["low"] + acc["high"]) / 2
            over = _leaving(p, middle, lambda line, gained: gained - _lag(line, f)) > p["turn"]
            return F.when(over, F.struct(acc["low"].alias("low"), middle.alias("high"))).otherwise(F.struct(middle.alias("low"), acc["high"].alias("high")))

        ends = F.struct(F.lit(-math.pi / 2).alias("low"), F.lit(math.pi / 2).alias("high"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(110)), ends, step, lambda acc: (acc["low"] + acc["high"]) / 2)

    def solve(p: Column) -> Column:
        def finish(found: Column) -> Column:
            opposite = let(halved(p), lambda v: _leaving(p, v, lambda line, _: _metres(line, f)))
            return F.when((found["change"] < 1e-12) & (found["w"] <= math.pi), _around(p, found["w"], lambda line: _metres(line, f))).otherwise(opposite)

        return let(settled(p), finish)

    known = lon1.isNotNull() & lat1.isNotNull() & lon2.isNotNull() & lat2.isNotNull()
    return F.when(known, let(given, solve))


def geodesic_miles(line: Column) -> Column:
    """Length in miles, on the ellipsoid, of a line whose vertices are x = longitude, y = latitude."""
    return _fold_pairs(line, lambda a, b: geodesic_metres(a["x"], a["y"], b["x"], b["y"]) / METRES_PER_MILE)


def ring_cross(ring: Column) -> Column:
    """Twice the signed area of a closed ring."""
    return _fold_pairs(ring, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])


def ring_area(ring: Column) -> Column:
    return F.abs(ring_cross(ring)) / 2


def polygon_area(rings: Column) -> Column:
    """Outer ring minus holes: the first ring is the outer one."""
    return F.aggregate(
        F.slice(rings, 2, F.greatest(F.size(rings), F.lit(1))),
        ring_area(F.element_at(rings, 1)),
        lambda acc, hole: acc - ring_area(hole),
    )


def ring_centroid(ring: Column) -> Column:
    """Centroid of a closed ring as struct<x, y>."""
    six = ring_cross(ring) * 3
    cx = _fold_pairs(ring, lambda a, b: (a["x"] + b["x"]) * (a["x"] * b["y"] - b["x"] * a["y"]))
    cy = _fold_pairs(ring, lambda a, b: (a["y"] + b["y"]) * (a["x"] * b["y"] - b["x"] * a["y"]))
    return F.struct(F.try_divide(cx, six).alias("x"), F.try_divide(cy, six).alias("y"))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Closed ring of a rectangle."""
    def corner(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(corner(xmin, ymin), corner(xmax, ymin), corner(xmax, ymax), corner(xmin, ymax), corner(xmin, ymin))


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance from a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    squared = dx * dx + dy * dy
    t = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, squared), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def straight_line_pieces(x1: Column, y1: Column, x2: Column, y2: Column, edges: Column, inside) -> Column:
    """Share of a segment that lies inside a polygon given by its edges; `inside(x, y, edges)` tests one point."""
    dx, dy = x2 - x1, y2 - y1

    def meets(e: Column) -> Column:
        a, b = e["a"], e["b"]
        ex, ey = b["x"] - a["x"], b["y"] - a["y"]
        cross = dx * ey - dy * ex
        t = F.try_divide((a["x"] - x1) * ey - (a["y"] - y1) * ex, cross)
        u = F.try_divide((a["x"] - x1) * dy - (a["y"] - y1) * dx, cross)
        return F.when((t > 0) & (t < 1) & (u >= 0) & (u <= 1), t)

    cuts = F.array_sort(F.concat(
        F.array(F.lit(0.0), F.lit(1.0)),
        F.filter(F.transform(edges, meets), lambda t: t.isNotNull()),
    ))
    spans = F.transform(
        F.sequence(F.lit(1), F.size(cuts) - 1),
        lambda i: F.struct(F.element_at(cuts, i).alias("s"), F.element_at(cuts, i + 1).alias("e")),
    )

    def piece(p: Column) -> Column:
        middle = (p["s"] + p["e"]) / 2
        return F.when(inside(x1 + middle * dx, y1 + middle * dy, edges), p["e"] - p["s"]).otherwise(F.lit(0.0))

    return F.aggregate(spans, F.lit(0.0), lambda acc, p: acc + piece(p))


# --- map projections ------------------------------------------------------

# Ellipsoid and Florida East zone (metres) of NAD83; feet variant by scale.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
FLORIDA_EAST = {"lon0": -81.0, "lat0": 24.0 + 20.0 / 60.0, "k0": 0.999941177, "fe": 200000.0, "fn": 0.0}
US_FOOT = 1200.0 / 3937.0


def _meridian(lat, e2: float, sin):
    """Distance along the meridian from the equator, to the eighth power of the eccentricity."""
    e4, e6, e8 = e2 * e2, e2 ** 3, e2 ** 4
    return GRS80_A * (
        (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256 - 175 * e8 / 16384) * lat
        - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024 + 105 * e8 / 4096) * sin(2 * lat)
        + (15 * e4 / 256 + 45 * e6 / 1024 + 525 * e8 / 16384) * sin(4 * lat)
        - (35 * e6 / 3072 + 175 * e8 / 12288) * sin(6 * lat)
        + (315 * e8 / 131072) * sin(8 * lat)
    )


def _radii(lat, f):
    """Radii of curvature along the meridian and across it; `f` has the functions, Spark's or numpy's."""
    e2 = GRS80_F * (2 - GRS80_F)
    w = 1 - e2 * f.pow(f.sin(lat), 2)
    return GRS80_A * (1 - e2) / f.pow(w, 1.5), GRS80_A / f.sqrt(w)


def _on_grid(lon, lat, lon0: float, lat0: float, k0: float, fe: float, fn: float, f) -> tuple:
    """Metres x, y from degrees, by the series in the longitude to its eighth power."""
    e2 = GRS80_F * (2 - GRS80_F)
    phi, w = f.radians(lat), f.radians(lon) - math.radians(lon0)
    rho, nu = _radii(phi, f)
    psi, t2 = nu / rho, f.pow(f.tan(phi), 2)
    t4, t6, a2 = t2 * t2, t2 * t2 * t2, f.pow(w * f.cos(phi), 2)
    m = _meridian(phi, e2, f.sin)
    m0 = _meridian(math.radians(lat0), e2, math.sin)
    x = k0 * nu * w * f.cos(phi) * (
        1 + a2 / 6 * (psi - t2)
        + a2 * a2 / 120 * (4 * f.pow(psi, 3) * (1 - 6 * t2) + f.pow(psi, 2) * (1 + 8 * t2) - 2 * psi * t2 + t4)
        + f.pow(a2, 3) / 5040 * (61 - 479 * t2 + 179 * t4 - t6)
    )
    y = k0 * (
        m - m0
        + nu * f.tan(phi) * a2 / 2 * (
            1 + a2 / 12 * (4 * psi * psi + psi - t2)
            + a2 * a2 / 360 * (8 * f.pow(psi, 4) * (11 - 24 * t2) - 28 * f.pow(psi, 3) * (1 - 6 * t2) + f.pow(psi, 2) * (1 - 32 * t2) - 2 * psi * t2 + t4)
            + f.pow(a2, 3) / 20160 * (1385 - 3111 * t2 + 543 * t4 - t6)
        )
    )
    return x + fe, y + fn


def transverse_mercator(lon: Column, lat: Column, lon0: float, lat0: float, k0: float, fe: float, fn: float) -> Column:
    """Projected struct<x, y> in metres from degrees, by the series in the longitude to its eighth power."""
    x, y = _on_grid(lon, lat, lon0, lat0, k0, fe, fn, F)
    return F.struct(x.alias("x"), y.alias("y"))


def inverse_transverse_mercator(x: Column, y: Column, lon0: float, lat0: float, k0: float, fe: float, fn: float) -> Column:
    """Degrees struct<x, y> of a projected place in metres.

    The projection itself is corrected until it meets the place: each round moves the
    degrees by what is left, over the local scale, which takes two digits off the rest.
    The rounds run on whole batches of places, since a fold is interpreted value by value.
    """
    @F.arrow_udf("x double, y double")
    def corrected(px: pa.Array, py: pa.Array) -> pa.Array:
        px, py = (p.to_numpy(zero_copy_only=False).astype(float) for p in (px, py))
        with np.errstate(all="ignore"):
            lat = lat0 + np.degrees((py - fn) / (k0 * GRS80_A))
            lon = lon0 + np.degrees((px - fe) / (k0 * GRS80_A * np.cos(np.radians(lat))))
            for _ in range(10):
                mx, my = _on_grid(lon, lat, lon0, lat0, k0, fe, fn, np)
                rho, nu = _radii(np.radians(lat), np)
                # The grid is turned against the meridian by the convergence; the rest is turned back before it is taken off.
                bend = np.radians(lon - lon0) * np.sin(np.radians(lat))
                dx, dy = px - mx, py - my
                lon, lat = (lon + np.degrees((dx * np.cos(bend) - dy * np.sin(bend)) / (k0 * nu * np.cos(np.radians(lat)))),
                            lat + np.degrees((dx * np.sin(bend) + dy * np.cos(bend)) / (k0 * rho)))
        return pa.StructArray.from_arrays([pa.array(lon), pa.array(lat)], ["x", "y"])

    return F.when(x.isNotNull() & y.isNotNull(), corrected(x.cast("double"), y.cast("double")))


def project(lon: Column, lat: Column, epsg: int) -> Column:
    """Point from degrees in one of the known reference systems: 4326, 3857, 6437 (metres), 2881 (US feet)."""
    if epsg == 4326:
        return F.struct(lon.alias("x"), lat.alias("y"))
    if epsg == 3857:
        x = F.radians(lon) * F.lit(GRS80_A)
        y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(GRS80_A)
        return F.struct(x.alias("x"), y.alias("y"))
    if epsg in (6437, 2881):
        p = transverse_mercator(lon, lat, **FLORIDA_EAST)
        scale = 1.0 if epsg == 6437 else 1.0 / US_FOOT
        return F.struct((p["x"] * scale).alias("x"), (p["y"] * scale).alias("y"))
    raise ValueError(f"unknown reference system {epsg}")


def unproject(x: Column, y: Column, epsg: int) -> Column:
    """Degrees struct<x, y> of a point in one of the known reference systems."""
    if epsg == 4326:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    if epsg == 3857:
        lat = 2 * F.atan(F.exp(y / F.lit(GRS80_A))) - F.lit(math.pi / 2)
        return F.struct(F.degrees(x / F.lit(GRS80_A)).alias("x"), F.degrees(lat).alias("y"))
    if epsg in (6437, 2881):
        scale = 1.0 if epsg == 6437 else US_FOOT
        return inverse_transverse_mercator(x * F.lit(scale), y * F.lit(scale), **FLORIDA_EAST)
    raise ValueError(f"unknown reference system {epsg}")


def reproject(x: Column, y: Column, from_epsg: int, to_epsg: int) -> Column:
    """Point of one known reference system in another."""
    if from_epsg == to_epsg:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    if from_epsg == 4326:
        return project(x, y, to_epsg)
    return let(unproject(x, y, from_epsg), lambda p: project(p["x"], p["y"], to_epsg))


# --- bounding boxes -------------------------------------------------------

STUDY_GROWTH = 1609.34  # about a mile, so that networks are whole at the edge of a study area


def box_is_valid(north: Column, south: Column, east: Column, west: Column) -> Column:
    """North and south inside (-90, 90), east and west inside (-180, 180), ends left out."""
    def inside(c: Column, limit: float) -> Column:
        return (c > -limit) & (c < limit)

    return inside(north, 90) & inside(south, 90) & inside(east, 180) & inside(west, 180)


def grown_box(north: Column, south: Column, east: Column, west: Column, by: float = STUDY_GROWTH) -> dict[str, Column]:
    """A box in degrees grown by a distance in the metres of web Mercator, again in degrees."""
    def lon(c: Column, step: float) -> Column:
        return F.degrees((F.radians(c) * F.lit(GRS80_A) + F.lit(step)) / F.lit(GRS80_A))

    def lat(c: Column, step: float) -> Column:
        y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(c) / 2)) * F.lit(GRS80_A) + F.lit(step)
        return F.degrees(2 * F.atan(F.exp(y / F.lit(GRS80_A))) - F.lit(math.pi / 2))

    return {"north": lat(north, by), "south": lat(south, -by), "east": lon(east, by), "west": lon(west, -by)}

"""Summary areas as membership tables: who lies in which station area, corridor or zone."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.operators.joins import merge_layers
from arealens.operators.spatial import LEAST_LEVEL, centre_in_area, pairs_met, tasks_for, within_distance, within_distance_of_lines
from arealens.session import cut, shelved
from arealens.skew import JoinAdvice, advise, is_small, number_rows, spread_join

# Names and ids of the areas that are not single stations.
ALL_CORRIDORS = "(All corridors)"
ENTIRE = (-1, "(Entire corridor)")
ALL_STATIONS = (-2, "(All stations)")
OUTSIDE = (-3, "(Outside station areas)")
NO_STATUS = "NA"
MOST_SENT = 2_000_000  # areas of single stations that are sent to all tasks, if they take no more than skew.SMALL_BYTES


def station_members(features: DataFrame, stations: DataFrame, key: str, x: str, y: str, station: str, sx: str, sy: str,
                    radius: float) -> DataFrame:
    """(feature, station) for features within the radius of any point of a station."""
    places, stops = features.select(key, x, y).distinct(), stations.select(station, sx, sy).distinct()
    near = within_distance(places, stops, x, y, sx, sy, radius).select(key, station)

    def repeats(df: DataFrame, column: str) -> bool:
        return not df.groupBy(column).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).isEmpty()

    # A pair comes twice only if its feature or its station has several places.
    return near.distinct() if repeats(places, key) or repeats(stops, station) else near


def corridor_members(features: DataFrame, alignments: DataFrame, key: str, x: str, y: str, corridor: str, radius: float,
                     ends: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2")) -> DataFrame:
    """(feature, corridor) for features within the radius of the corridor's line, and all of them as one corridor."""
    near = within_distance_of_lines(features.select(key, x, y), alignments.select(corridor, *ends), x, y, radius, ends)
    single = shelved(near.select(key, corridor).distinct())
    return single.unionByName(single.select(key, F.lit(ALL_CORRIDORS).alias(corridor)).distinct())


def override_members(default: DataFrame, preset: DataFrame, area: str) -> DataFrame:
    """Membership in which areas that have a preset shape use it instead of their buffer."""
    kept = default.join(preset.select(area).distinct(), area, "left_anti")
    return kept.unionByName(preset.select(*kept.columns))


def floating_zones(features: DataFrame, key: str, x: str, y: str, radius: float) -> DataFrame:
    """Each feature's own zone: (zone, member) for features within the radius of it."""
    zones = features.select(F.col(key).alias("zone"), F.col(x).alias("zx"), F.col(y).alias("zy"))
    members = features.select(F.col(key).alias("member"), F.col(x).alias("mx"), F.col(y).alias("my"))
    return within_distance(members, zones, "mx", "my", "zx", "zy", radius).select("zone", "member", "dist")


def _cover(zones: DataFrame, radius: float, side: float, depth: int) -> DataFrame:
    """Cells that make up each zone's circle: (columns of zones, level, cx, cy, inner). Cells inside it are as large as can be, those on its
    edge are of the finest level. `side` is that level's; every level above doubles it."""
    wide = side * 2 ** depth

    def span(centre: str) -> Column:
        return F.explode(F.sequence(F.floor((F.col(centre) - radius) / wide), F.floor((F.col(centre) + radius) / wide)))

    def state(own: Column, place: str, cell: str) -> tuple[Column, Column]:
        """Least and greatest distance from the centre to a cell, along one axis."""
        low, high = F.col(cell) * own - F.col(place), (F.col(cell) + 1) * own - F.col(place)
        return F.greatest(low, -high, F.lit(0.0)), F.greatest(F.abs(low), F.abs(high))

    rows = zones.withColumn("cx", span("zx")).withColumn("cy", span("zy")).withColumns({"level": F.lit(depth), "inner": F.lit(False)})
    # A hair's breadth for rounding: cells that close to the edge are looked into.
    inside, outside = radius * radius * (1 - 1e-9), radius * radius * (1 + 1e-9)
    for level in range(depth, -1, -1):
        own = F.lit(side) * F.pow(F.lit(2.0), F.col("level"))
        (near_x, far_x), (near_y, far_y) = state(own, "zx", "cx"), state(own, "zy", "cy")
        rows = rows.where(F.col("inner") | (near_x * near_x + near_y * near_y <= outside)).withColumn(
            "inner", F.col("inner") | (far_x * far_x + far_y * far_y <= inside))
        if level:
            cell = F.struct("level", "cx", "cy")
            parts = F.array(*[F.struct((F.col("level") - 1).alias("level"), (F.col("cx") * 2 + i).alias("cx"), (F.col("cy") * 2 + j).alias("cy"))
                              for i in (0, 1) for j in (0, 1)])
            rows = rows.withColumn("__c", F.explode(F.when(F.col("inner"), F.array(cell)).otherwise(parts))).withColumns(
                {c: F.col("__c")[c] for c in ("level", "cx", "cy")}).drop("__c")
    return rows


def floating_sums(features: DataFrame, zones: DataFrame, zone: str, zx: str, zy: str, x: str, y: str, radius: float, measures: Sequence[str],
                  by: Sequence[str] = (), count: str = "n", fine: int = 16) -> DataFrame:
    """Sums of the features within the radius of each zone's centre: (zone, by, measures, count), without a list of pairs.

    Features are summed once per cell, on a pyramid of cells each twice as wide as those below. A
    circle is made up of large cells inside it, whose sums are taken as they are, and of
    cells of a `fine`-th of the radius on its edge, whose features alone are measured.
    So a zone costs a few hundred cells, however many features it holds, and `fine` trades
    cells against measured features without changing the result. Features without a place count
    nowhere; zones that hold nothing have no row.
    """
    side, depth = max(float(radius), 2.0 ** LEAST_LEVEL) / fine, max(int(math.log2(fine)), 0)
    keys, sums = list(by), [F.sum(F.col(m)).alias(m) for m in measures]
    placed = features.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"), *keys, *measures)
    # Features at one place are one row; the finest cells are sums of those, the others sums of cells.
    spots = placed.groupBy("__x", "__y", *keys).agg(*sums, F.count(F.lit(1)).alias("__n"))
    spots = cut(spots.withColumns({"cx": F.floor(F.col("__x") / side), "cy": F.floor(F.col("__y") / side)}))
    totals = [*sums, F.sum("__n").alias("__n")]
    cells = spots.groupBy("cx", "cy", *keys).agg(*totals)
    pyramid = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumns(
        {c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level"))) for c in ("cx", "cy")})
    pyramid = cut(pyramid.groupBy("level", "cx", "cy", *keys).agg(*totals))

    centres = zones.where(F.col(zx).isNotNull() & F.col(zy).isNotNull()).select(
        F.col(zone).alias("zone"), F.col(zx).cast("double").alias("zx"), F.col(zy).cast("double").alias("zy"))
    # Zones at one place hold the same; their circle is made up once. A circle takes about as many cells as its edge is long.
    places = cut(centres.select("zx", "zy").distinct())
    cover = _cover(places.repartition(tasks_for(places.count() * 24.0 * fine) or 1), float(radius), side, depth)
    whole, edge = cover.where("inner").select("zx", "zy", "level", "cx", "cy"), cover.where("not inner").select("zx", "zy", "cx", "cy")

    def met(cells: DataFrame, sums_of: DataFrame, on: list[str]) -> DataFrame:
        return spread_join(cells, sums_of, on, advice=advise(cells, sums_of, on, unique=False), parts=tasks_for(pairs_met(cells, sums_of, on)))

    inside, tested = met(whole, pyramid, ["level", "cx", "cy"]), met(edge, spots, ["cx", "cy"])
    dx, dy = F.col("__x") - F.col("zx"), F.col("__y") - F.col("zy")
    tested = tested.where(F.sqrt(dx * dx + dy * dy) <= float(radius))
    columns = ["zx", "zy", *keys, *measures, "__n"]
    held = cut(inside.select(*columns).unionByName(tested.select(*columns)).groupBy("zx", "zy", *keys).agg(*totals))
    each = spread_join(centres, held, ["zx", "zy"], advice=advise(centres, held, ["zx", "zy"], unique=False))
    return each.groupBy("zone", *keys).agg(*totals).withColumnRenamed("__n", count)


def stations_long(stations: DataFrame, ids: Sequence[str], corridors: Sequence[str], x: str, y: str,
                  renames: Mapping[str, str] | None = None, out: str = "Corridor") -> DataFrame:
    """One row per station and corridor it lies on: flags by maximum, mean place, flags not 0, labels renamed."""
    labels = dict(renames or {})
    one = stations.groupBy(*ids).agg(
        *[F.max(c).alias(c) for c in corridors], F.avg(x).alias(x), F.avg(y).alias(y))
    flags = F.array(*[F.struct(F.lit(labels.get(c, c)).alias(out), F.col(c).alias("InCor")) for c in corridors])
    return one.select(*ids, x, y, F.explode(flags).alias("__f")).select(*ids, x, y, "__f.*").where(F.col("InCor") != 0)


def summary_areas(corridors: DataFrame, stations: DataFrame, corridor: str = "Corridor", station: str = "Id",
                  name: str = "Name", status: str = "Status", out: str = "SummID") -> DataFrame:
    """The table of summary areas with running ids.

    Order: whole corridors by name; stations by corridor and id; then, per corridor with
    stations, all stations together and the rest of the corridor.
    """
    def block(df: DataFrame, rank: int, code, label, state) -> DataFrame:
        return df.select(F.lit(rank).alias("__rank"), code.alias("STN_ID"), label.alias(name), state.alias(status), corridor)

    def fixed(df: DataFrame, rank: int, entry: tuple[int, str]) -> DataFrame:
        return block(df, rank, F.lit(entry[0]).cast("bigint"), F.lit(entry[1]), F.lit(NO_STATUS))

    served = stations.select(corridor).distinct()
    rows = (
        fixed(corridors.select(corridor).distinct(), 1, ENTIRE)
        .unionByName(block(stations, 2, F.col(station).cast("bigint"), F.col(name), F.col(status)))
        .unionByName(fixed(served, 3, ALL_STATIONS))
        .unionByName(fixed(served, 3, OUTSIDE))
    )
    order = [F.col("__rank"), F.col(corridor), F.when(F.col("__rank") == 3, -F.col("STN_ID")).otherwise(F.col("STN_ID")), F.col(name)]
    return number_rows(rows, order, out, start=1).drop("__rank")


def summary_members(areas: DataFrame, in_corridor: DataFrame, in_station: DataFrame, key: str, corridor: str = "Corridor",
                    station: str = "STN_ID", out: str = "SummID") -> DataFrame:
    """(area, feature) for every summary area. Areas overlap on purpose, so a feature has several rows.

    `in_corridor` is (feature, corridor), `in_station` is (feature, station id).
    """
    areas, in_corridor = cut(areas), shelved(in_corridor)
    single = areas.where(F.col(station) >= 0).select(out, station, corridor)
    # Pairs of features and stations may be far more than either, so they are read twice and neither written nor shuffled
    # while the stations' areas can be sent to all tasks.
    sent = is_small(single, MOST_SENT)
    if not sent:
        in_station = shelved(in_station)
    # The corridor of all corridors holds every member, so joins on stations and corridors split hot keys.
    pairs = in_station.withColumnRenamed(in_station.columns[1], station)
    advice = JoinAdvice(small=True) if sent else advise(pairs, single, station)
    by_station = spread_join(pairs, single.select(station, out), station, advice=advice).select(out, key)
    near_stop = shelved(spread_join(pairs, single.select(station, corridor).distinct(), station, advice=advice).select(key, corridor).distinct())
    rest = in_corridor.join(near_stop, [key, corridor], "left_anti")

    def members(kind: int, features: DataFrame) -> DataFrame:
        return spread_join(features, areas.where(F.col(station) == kind).select(out, corridor), corridor).select(out, key)

    whole, every, outside = members(ENTIRE[0], in_corridor), members(ALL_STATIONS[0], near_stop), members(OUTSIDE[0], rest)
    return by_station.unionByName(whole).unionByName(every).unionByName(outside)


def merge_subset(layers: Mapping[str, DataFrame], areas: DataFrame, key: str, x: str = "x", y: str = "y",
                 rings: str = "rings", tag: str | None = None) -> DataFrame:
    """Layers cut down to the features with their centre in an area, then stacked."""
    return merge_layers({n: centre_in_area(df, areas, x, y, rings, key) for n, df in layers.items()}, tag)


def zones_by_year(zones: DataFrame, county: DataFrame | None, years: Sequence[int], key: str, x: str = "x", y: str = "y",
                  rings: str = "rings") -> DataFrame:
    """Zones with their centre in the county (all zones without one), once per year."""
    kept = zones if county is None else centre_in_area(zones, county, x, y, rings, key)
    return kept.withColumn("Year", F.explode(F.array(*[F.lit(int(v)) for v in years])))


def single_parts(df: DataFrame, parts: str, rings: str = "rings", part: str = "part") -> DataFrame:
    """Features of several polygons as one row per polygon, numbered from 1; rows without polygons are left out."""
    others = [c for c in df.columns if c != parts]
    opened = df.select(*others, F.posexplode(parts).alias("__pos", rings))
    return opened.where(F.col(rings).isNotNull()).withColumn(part, F.col("__pos") + 1).drop("__pos")

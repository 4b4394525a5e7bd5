"""Accessibility, travel statistics and skim tables."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealens.functions.scalar import bin_label, bin_labels, divide, finite, infinite_to_zero, recode, row_mean, row_min
from arealens.operators.joins import merge_many, merge_outer
from arealens.operators.spatial import MOST_TASKS, TASK_PAIRS, pairs_met, tasks_for
from arealens.session import cut
from arealens.skew import JoinAdvice, advise, is_small, number_rows, spread_join

TIME_BREAKS = (15, 30, 45, 60)
LEAVE_ROWS = 4_000_000  # last legs a task holds
RUN_CELLS = 1 << 22  # pairs of zones kept at once, or those of one origin
RUN_PATHS = 1 << 20

# What runs in tasks is sent by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def access_summary(skim: DataFrame, zones: DataFrame, origin: str, destination: str, impedance: str, zone: str,
                   activities: Sequence[str], breaks: Sequence[int] = TIME_BREAKS, units: str = "Min",
                   join_by: str = "D", advice: JoinAdvice | None = None) -> DataFrame:
    """Activities within reach by time bin, and the activity-weighted mean time, per zone.

    `join_by` "D" joins activities at the destination and reports by origin; "O" the other
    way round. Bins that a zone does not use are null. Rows whose impedance is infinite
    stay in the overflow bin and take no part in the mean.
    """
    if join_by not in ("D", "O"):
        raise ValueError(f"join_by must be 'D' or 'O', got {join_by!r}")
    joined_end, report = (destination, origin) if join_by == "D" else (origin, destination)
    acts = zones.select(F.col(zone).alias(joined_end), *[F.col(a).cast("double").alias(a) for a in activities])
    # The zone table repeats no key; hot zones of the skim are split across tasks.
    rows = spread_join(skim.select(origin, destination, impedance), acts, joined_end, "inner", advice)
    rows = rows.withColumn("__bin", bin_label(F.col(impedance), breaks, units))
    time = F.col(impedance).cast("double")
    usable = time.isNull() | finite(time).isNotNull()
    aggs = []
    for a in activities:
        aggs += [F.sum(F.when(F.col("__bin") == label, F.col(a))).alias(f"{a}{label}") for label in bin_labels(breaks, units)]
    for a in activities:
        weighted = F.sum(finite(time) * F.col(a))
        aggs.append(divide(weighted, F.sum(F.when(usable, F.col(a)))).alias(f"Avg{units}{a}"))
    return rows.groupBy(report).agg(*aggs)


def access_by_zone(skim: DataFrame, zones: DataFrame, origin: str, destination: str, impedance: str, zone: str,
                   by_destination: Sequence[str], by_origin: Sequence[str], breaks: Sequence[int] = TIME_BREAKS,
                   units: str = "Min") -> DataFrame:
    """Access to destinations and from origins, one row per zone."""
    # One check of the zone table's size serves both joins; a long one needs the hot keys of each end.
    small = JoinAdvice(small=True) if is_small(zones) else None
    to = access_summary(skim, zones, origin, destination, impedance, zone, by_destination, breaks, units, "D", small)
    fro = access_summary(skim, zones, origin, destination, impedance, zone, by_origin, breaks, units, "O", small)
    return merge_outer(to.withColumnRenamed(origin, zone), fro.withColumnRenamed(destination, zone), zone)


def travel_stats(od: DataFrame, zones: DataFrame, origin: str, destination: str, trips: str, time: str, dist: str,
                 zone: str, households: str, jobs: str) -> DataFrame:
    """Trip lengths, times and rates per unit of activity, by origin (_FROM) and destination (_TO)."""
    clean = od.select(
        origin, destination,
        *[infinite_to_zero(F.col(c).cast("double")).alias(n) for c, n in ((trips, "__t"), (time, "__m"), (dist, "__d"))],
    )
    activity = zones.select(F.col(zone), (F.col(households) + F.col(jobs)).cast("double").alias("__act"))

    def one_end(end: str) -> DataFrame:
        sums = clean.groupBy(F.col(end).alias(zone)).agg(
            F.sum("__t").alias("__t"),
            F.sum(F.col("__t") * F.col("__d")).alias("__vmt"),
            F.sum(F.col("__t") * F.col("__m")).alias("__vht"),
        ).join(activity, zone, "left")
        act = F.coalesce(F.col("__act"), F.lit(0.0))

        def rate(c: str):
            return F.when(act == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(c), act))

        return sums.select(
            zone,
            divide(F.col("__vmt"), F.col("__t")).alias("AVG_DIST"), divide(F.col("__vht"), F.col("__t")).alias("AVG_TIME"),
            rate("__vmt").alias("VMT_PER_ACT"), rate("__t").alias("TRIPS_PER_ACT"),
        )

    return merge_outer(one_end(origin), one_end(destination), zone, ("_FROM", "_TO"))


def load_rates(rates: DataFrame, zones: DataFrame, zone: str, households: str, jobs: str) -> DataFrame:
    """Vehicle miles of a year's zones from rates: rate times activity, and the mean of both ends."""
    activity = F.col(households).cast("double") + F.col(jobs).cast("double")
    joined = rates.join(zones.select(zone, activity.alias("__act")), zone)
    joined = joined.withColumns({
        "VMT_FROM": F.col("VMT_PER_ACT_FROM") * F.col("__act"), "VMT_TO": F.col("VMT_PER_ACT_TO") * F.col("__act"),
    })
    return joined.withColumn("VMT_ALL", row_mean(F.col("VMT_FROM"), F.col("VMT_TO"))).drop("__act")


def clean_skim(skim: DataFrame, impedance: str, drop_value: float = 0, renames: Mapping[str, str] | None = None,
               nodes: Sequence[str] = (), offset: int = 0) -> DataFrame:
    """Skim without the rows of the drop value, nodes renumbered by an offset. Names are the new ones."""
    out = skim.withColumnsRenamed(dict(renames or {}))
    out = out.where(F.col(impedance).isNull() | (F.col(impedance) != drop_value))
    return out.withColumns({n: F.col(n) + F.lit(offset) for n in nodes}) if nodes else out


def best_transit_time(auto: DataFrame, local: DataFrame, premium: DataFrame, trips: DataFrame, keys: Sequence[str],
                      time: str = "TIME") -> DataFrame:
    """Auto, local and premium skims with trips; the better transit time, where 0 means no connection."""
    skims = merge_many([auto, local, premium], keys, ("_AU", "_LOC", "_PRM"), "full")
    joined = merge_many([skims, trips], keys, None, "full")
    never = float("inf")
    for c in (f"{time}_LOC", f"{time}_PRM"):
        joined = joined.withColumn(c, recode(F.col(c).cast("double"), 0.0, never))
    return joined.withColumn(f"{time}_TR", row_min(F.col(f"{time}_LOC"), F.col(f"{time}_PRM")))


def join_legs(access: DataFrame, ride: DataFrame, origin: str = "OName", destination: str = "DName",
              time: str = "Minutes", cutoff: float | None = None, origins: DataFrame | None = None,
              destinations: DataFrame | None = None) -> DataFrame:
    """Zone-to-zone times by walking to a stop, riding and walking on: the best per pair within the cutoff.

    Each leg is cut off and the two first legs are reduced to their best per (origin,
    alighting stop) before the last join, so paths of the same pair do not multiply. With a
    cutoff the last leg is joined and reduced origin by origin, see `_last_legs`.
    """
    def legs(df: DataFrame, a: str, b: str, t: str) -> DataFrame:
        out = df.select(F.col(origin).alias(a), F.col(destination).alias(b), F.col(time).cast("double").alias(t))
        return out.where(F.col(t) <= cutoff) if cutoff is not None else out

    # Written once: both ends, the rides and the advice read them, and a skim may come from a long plan.
    walks = cut(legs(access, "__o", "__board", "__t1").where("__board is not null"))
    enter, leave = walks, walks.toDF("__d", "__alight", "__t3")
    if origins is not None:
        enter = enter.join(origins.select(F.col(origins.columns[0]).alias("__o")), "__o", "left_semi")
    if destinations is not None:
        leave = leave.join(destinations.select(F.col(destinations.columns[0]).alias("__d")), "__d", "left_semi")
    # Busy stops may hold much of either table, so their rows are split on both sides.
    rides = cut(legs(ride, "__board", "__alight", "__t2").where("__board is not null"))
    if cutoff is not None:
        # Stops that walks leave from are numbered: they lie in arrays later on.
        leave = leave.groupBy("__alight", "__d").agg(F.min("__t3").alias("__t3"))
        stops = cut(number_rows(leave.select("__alight").distinct(), [F.col("__alight")], "__stop"))
        rides = cut(spread_join(rides, stops, "__alight").select("__board", F.col("__stop").alias("__alight"), "__t2"))
        leave = cut(spread_join(leave, stops, "__alight").select("__stop", "__d", "__t3"))
    met = pairs_met(enter, rides, ["__board"])
    aboard = spread_join(enter, rides, "__board", advice=advise(enter, rides, "__board", unique=False), parts=tasks_for(met))
    both = F.col("__t1") + F.col("__t2")
    if cutoff is not None:
        aboard = aboard.where(both <= cutoff)
    best = aboard.groupBy("__o", "__alight").agg(F.min(both).alias("__t12"))
    if cutoff is not None:
        return _last_legs(best, leave, met, float(cutoff)).toDF(origin, destination, time)
    off = advise(rides.select("__alight"), leave, "__alight", unique=False)
    through = spread_join(best, leave, "__alight", advice=off).select("__o", "__d", (F.col("__t12") + F.col("__t3")).alias(time))
    return through.groupBy(F.col("__o").alias(origin), F.col("__d").alias(destination)).agg(F.min(time).alias(time))


def _last_legs(best: DataFrame, leave: DataFrame, rows: float, cutoff: float) -> DataFrame:
    """(__o, __d, time) of the best paths within the cutoff, from times (__o, __alight, __t12) and last legs (__stop, __d, __t3).

    Paths are far more than legs, so they are neither written nor shuffled. Origins go into
    blocks by their hash, destinations into blocks of about LEAVE_ROWS last legs. A task holds
    the legs of a block of destinations in arrays and reads its origins one after another, so
    it sees all paths of its pairs. Legs are sent to each block of origins, times to each block of
    destinations; `rows` is about how many times there are.
    """
    legs = leave.count()
    n_to = max(-(-legs // LEAVE_ROWS), 1)
    # Large enough that the legs sent stay about as many as the times.
    n_from = min(int(rows / max(TASK_PAIRS, 2 * legs)) + 1, MOST_TASKS)

    def block(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    o, d = best.schema["__o"].dataType, leave.schema["__d"].dataType
    sent = leave.select(block("__d", n_to).alias("__to"), F.lit(None).cast(o).alias("__o"), F.col("__stop").cast("long"), "__d", F.col("__t3").alias("__t"))
    sent = sent.withColumn("__from", every(n_from)).withColumn("__time", F.lit(False))
    asked = best.select(block("__o", n_from).alias("__from"), "__o", F.col("__alight").cast("long").alias("__stop"), F.lit(None).cast(d).alias("__d"),
                        F.col("__t12").alias("__t"))
    asked = asked.withColumn("__to", every(n_to)).withColumn("__time", F.lit(True))
    task = F.col("__from") * n_to + F.col("__to")
    columns = [task.alias("__task"), "__time", "__o", "__stop", "__d", "__t"]
    laid = sent.select(*columns).unionByName(asked.select(*columns)).repartitionById(n_from * n_to, F.col("__task"))
    schema = T.StructType([T.StructField("__o", o), T.StructField("__d", d), T.StructField("__t", T.DoubleType())])
    return laid.sortWithinPartitions("__task", "__time", "__o").mapInArrow(_paths(cutoff), schema)


def _paths(cutoff: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reader of sorted rows (__task, __time, __o, __stop, __d, __t): of each task the last legs first, then times by origin."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, bool], pa.RecordBatch]]:
        """Batches of one task and kind of row each."""
        for batch in batches:
            kind = 2 * batch["__task"].to_numpy().astype(np.int64) + batch["__time"].to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(kind)]
            for low, high in zip(edges, edges[1:]):
                if low < high:
                    yield (int(kind[low]) >> 1, bool(kind[low] & 1)), batch.slice(low, high - low)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in itertools.groupby(pieces(batches), key=lambda p: p[0][0]):
            legs, ahead = [], None
            for (_, is_time), piece in group:
                if is_time:
                    ahead = piece
                    break
                legs.append(piece.select(["__stop", "__d", "__t"]))
            if legs and ahead is not None:
                table = pa.Table.from_batches(legs)
                legs.clear()
                yield from _Legs(table, cutoff).paths(itertools.chain([ahead], (p for _, p in group)))

    return read


class _Legs:
    """Last legs of a block of destinations in arrays, by stop."""

    def __init__(self, table: pa.Table, cutoff: float) -> None:
        stops = table["__stop"].to_numpy()
        order = np.argsort(stops, kind="stable")
        names = table["__d"].combine_chunks().dictionary_encode(null_encoding="encode")
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        self.cutoff, self.names = cutoff, names.dictionary
        self.place, self.time = names.indices.to_numpy()[order].astype(np.int64), table["__t"].to_numpy()[order]
        self.starts = np.searchsorted(stops[order], np.arange(int(stops.max()) + 2))
        # Best time and number of each (origin, destination) of the origins looked at together.
        self.wide = max(RUN_CELLS // len(self.names), 1)
        self.least = np.full(self.wide * len(self.names), np.inf)
        self.seen, self.last = np.zeros(len(self.least), bool), np.zeros(len(self.least), np.int32)

    def paths(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]).select(["__o", "__stop", "__t"])
            rows = rows if held is None else pa.concat_tables([held, rows])
            codes = rows["__o"].combine_chunks().dictionary_encode(null_encoding="encode")
            codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
            # The last origin may go on in the next batch.
            whole = int(np.searchsorted(codes, codes[-1])) if (np.diff(codes) >= 0).all() else 0
            yield from self.of_rows(rows.slice(0, whole))
            held = rows.slice(whole)
        if held is not None:
            yield from self.of_rows(held)

    def of_rows(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Paths of all rows of some origins."""
        if not rows.num_rows:
            return
        named = rows["__o"].combine_chunks().dictionary_encode(null_encoding="encode")
        named = named.combine_chunks() if isinstance(named, pa.ChunkedArray) else named
        codes, stops, times = named.indices.to_numpy().astype(np.int64), rows["__stop"].to_numpy(), rows["__t"].to_numpy()
        known = stops < len(self.starts) - 1
        codes, stops, times = codes[known], stops[known], times[known]
        for low in range(0, len(named.dictionary), self.wide):
            a, b = np.searchsorted(codes, [low, low + self.wide])
            found = [self.reached(codes[s] - low, stops[s], times[s]) for s in self.slabs(stops, int(a), int(b))]
            found = np.concatenate(found) if found else np.zeros(0, np.int64)
            if len(found):
                at, place = np.divmod(found, len(self.names))
                yield pa.RecordBatch.from_arrays([named.dictionary.take(pa.array(at + low)), self.names.take(pa.array(place)), pa.array(self.least[found])], ["__o", "__d", "__t"])
                self.least[found], self.seen[found] = np.inf, False

    def slabs(self, stops: np.ndarray, low: int, high: int) -> list[slice]:
        """Runs of rows with about RUN_PATHS paths each."""
        ends = np.cumsum(self.starts[stops[low:high] + 1] - self.starts[stops[low:high]])
        edges = [low, *(low + 1 + np.flatnonzero(np.diff(ends // RUN_PATHS))).tolist(), high]
        return [slice(i, j) for i, j in zip(edges, edges[1:]) if i < j]

    def reached(self, codes: np.ndarray, stops: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Cells (origin, destination) that these rows reach first; their best times are kept."""
        counts = self.starts[stops + 1] - self.starts[stops]
        row = np.repeat(np.arange(len(stops)), counts)
        leg = np.arange(len(row)) + np.repeat(self.starts[stops] - np.cumsum(counts) + counts, counts)
        total = times[row] + self.time[leg]
        fits = total <= self.cutoff
        cell, total = codes[row[fits]] * len(self.names) + self.place[leg[fits]], total[fits]
        np.minimum.at(self.least, cell, total)
        new = cell[~self.seen[cell]]
        self.seen[new] = True
        self.last[new] = np.arange(len(new), dtype=np.int32)
        return new[self.last[new] == np.arange(len(new))]


def access_columns(activities: Sequence[str], breaks: Sequence[int], mode: str, averages: bool = True) -> dict[str, str]:
    """Access columns of a mode: plain name to name with the mode's initial."""
    out: dict[str, str] = {}
    for a in activities:
        for b in breaks:
            out[f"{a}{b}Min"] = f"{a}{b}Min{mode[0]}"
        if averages:
            out[f"AvgMin{a}"] = f"AvgMin{a}{mode[0]}"
    return out


def long_access(df: DataFrame, ids: Sequence[str], activities: Sequence[str], breaks: Sequence[int], mode: str,
                year: int | None = None) -> DataFrame:
    """Wide access columns of a mode as rows of activity, time bin, the bin's lower end and value."""
    lows = [0, *breaks[:-1]]
    cells = F.array(*[
        F.struct(F.lit(a).alias("Activity"), F.lit(b).alias("TimeBin"), F.lit(lo).alias("from_time"),
                 F.coalesce(F.col(f"{a}{b}Min{mode[0]}").cast("double"), F.lit(0.0)).alias("value"))
        for a in activities for b, lo in zip(breaks, lows)
    ])
    out = df.select(*ids, F.explode(cells).alias("__c")).select(*ids, "__c.*")
    return out if year is None else out.withColumn("Year", F.lit(year))

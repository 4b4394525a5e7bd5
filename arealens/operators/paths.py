"""Least costs from many origins by delta-stepping, on a table of paths that is only ever added to.

Costs fall into slots of equal width, and slots are settled from the cheapest up, so a path
is seldom extended before it is known to be the best. Every improvement of an (origin, node)
pair is written once, into files bucketed by the pair. A round shuffles the paths it just
found, and nothing else: the paths known already are scanned where they lie, bucket against
bucket, to see which findings they beat. No round writes a path again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from arealens.session import TASK_ROWS, checkpoint_dir, cut, tasks_for
from arealens.skew import JoinAdvice, hot_keys, is_small, spread_join

PAIR = ["origin", "node"]
SLOTS = 4
# A bucket of paths for this many edges: pairs in reach are many times the edges, and a round's findings in a bucket are held in memory.
BUCKET_EDGES = 50_000


class PathFiles:
    """Improvements of pairs: (origin, node, path, slot, step). Added step by step, bucketed by pair, in the shared checkpoint folder."""

    def __init__(self, first: DataFrame):
        self.spark = first.sparkSession
        token = uuid.uuid4().hex
        self.name = f"arealens_paths_{token}"
        self.path = f"{checkpoint_dir(self.spark).rstrip('/')}/paths-{token}"
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)
        placed = first.select(*PAIR, "path", F.lit(0).cast("long").alias("slot"), F.lit(0).alias("step"))
        placed.write.format("parquet").option("path", self.path).partitionBy("step").bucketBy(buckets, *PAIR).saveAsTable(self.name)
        self.step = 0

    def append(self, rows: DataFrame, slot: int) -> int:
        """Write the next step's rows and tell how many lie in a slot. They are in buckets already, so nothing is shuffled for it."""
        self.step += 1
        seen = Observation()
        placed = rows.select(*PAIR, "path", "slot", F.lit(self.step).alias("step"))
        placed.observe(seen, F.count_if(F.col("slot") == slot).alias("n")).write.insertInto(self.name)
        return seen.get["n"]

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def last(self, slot: int) -> DataFrame:
        """Rows of the last step that lie in a slot."""
        return self.rows.where((F.col("step") == self.step) & (F.col("slot") == slot)).select(*PAIR, "path")

    def next_slot(self, slot: int) -> tuple[int | None, int]:
        """The next slot that has rows, and how many."""
        found = self.rows.where(F.col("slot") > slot).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).agg(F.min(F.struct("slot", "n"))).first()[0]
        return (None, 0) if found is None else (found["slot"], found["n"])

    def opened(self, slot: int) -> DataFrame:
        """Best paths of the pairs that reach a slot first: none of their paths lies in an earlier one."""
        here = self.rows.where(F.col("slot") == slot).groupBy(*PAIR).agg(F.min("path").alias("path"))
        earlier = self.rows.where(F.col("slot") < slot).select(*PAIR)
        return here.join(earlier.join(here.select(*PAIR).hint("shuffle_hash"), PAIR, "left_semi"), PAIR, "left_anti")

    def better(self, found: DataFrame) -> DataFrame:
        """Findings, one a pair, that no known path beats or equals."""
        known = self.rows.select(*PAIR, F.col("path").alias("__known"))
        beaten = known.join(found.hint("shuffle_hash"), PAIR).where(F.col("__known") <= F.col("path")).select(*PAIR)
        return found.join(beaten, PAIR, "left_anti")

    def best(self, ends: DataFrame | None = None) -> DataFrame:
        """The best path of every pair, or of those that end in `ends`, written from the buckets without a shuffle. Ends the table."""
        rows = self.rows.select(*PAIR, "path")
        if ends is not None:
            rows = rows.join(ends, "node", "left_semi")
        out = cut(rows.groupBy(*PAIR).agg(F.min("path").alias("path")))
        self.spark.sql(f"DROP TABLE {self.name}")
        return out


def _path(sums: Sequence[str], value: Callable[[str], Column]) -> Column:
    """Totals of a path: a number if there is one, which hash aggregates can hold, else a struct."""
    return value(sums[0]).alias("path") if len(sums) == 1 else F.struct(*[value(c).alias(c) for c in sums]).alias("path")


def total(sums: Sequence[str], name: str) -> Column:
    """One total of the column `path`."""
    return F.col("path") if len(sums) == 1 else F.col("path")[name]


def least_paths(edges: DataFrame, origins: DataFrame, cutoff: float, sums: Sequence[str], src: str, dst: str,
                width: float | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Best path from each origin to each node in reach: (origin, node, path), `path` holding the totals of `sums` (see `total`).

    `ends`, a table of distinct values of `node`, keeps the paths that end there.
    Paths are compared by the first total, ties by the others. `width` is the cost covered by a
    slot; by default a quarter of the cutoff, but no less than twice the mean cost of an edge.
    """
    cutoff = float(cutoff)
    parts = {c: F.col(c).cast("double") for c in sums}
    steps = edges.select(F.col(src).alias("__from"), F.col(dst).alias("__to"), _path(sums, parts.get)).where(total(sums, sums[0]) <= cutoff)
    # Of parallel edges only the best can lie on a least-cost path.
    steps = cut(steps.where("__from is not null and __to is not null").groupBy("__from", "__to").agg(F.min("path").alias("path")))
    few = is_small(steps)
    # How many edges leave a node, as an edge's end sees it.
    out = steps.groupBy("__from").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
    count, degree = (out[0], out[1] / out[0]) if out[0] else (0, 0.0)
    # Hubs are split by the edge table. Nodes that many origins reach at once are split at run time by adaptive skew joins.
    advice = JoinAdvice(few, (), () if few else tuple(hot_keys(steps, ["__from"])))
    if width is None:
        mean = steps.agg(F.avg(total(sums, sums[0]))).first()[0] or 0.0
        width = 2 * mean if cutoff == float("inf") else max(cutoff / SLOTS, 2 * mean)
    width = float(width) if width > 0 else 1.0
    edge = steps.select("__from", "__to", *[total(sums, c).alias(f"__e_{c}") for c in sums])

    start = origins.select(F.col(origins.columns[0]).alias("origin")).where("origin is not null").distinct()
    first = start.select("origin", F.col("origin").alias("node"), _path(sums, lambda c: F.lit(0.0)))
    spark = edges.sparkSession
    with tasks_for(spark, count, BUCKET_EDGES):
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return _searched(PathFiles(first), edge, cutoff, sums, width, advice, degree, tasks, ends)


def _searched(files: PathFiles, edge: DataFrame, cutoff: float, sums: Sequence[str], width: float, advice: JoinAdvice, degree: float, tasks: int,
              ends: DataFrame | None) -> DataFrame:
    """Slot by slot, until no path is left to extend. `degree` and the number of rows to extend tell how many paths a round looks at."""
    slot: int | None = 0
    frontier, size = files.last(0), 0
    while slot is not None:
        while True:
            # A join's tasks go by the bytes of its sides, which say nothing of what it finds.
            parts = -(-int(size * degree) // TASK_ROWS)
            # The filters for nulls are said outright, so that both uses of the findings are one shuffle.
            moved = spread_join(frontier.where("origin is not null and node is not null and path is not null").withColumnRenamed("node", "__from"),
                                edge, "__from", "inner", advice, parts=parts if parts > tasks else None)
            moved = moved.select("origin", F.col("__to").alias("node"), _path(sums, lambda c: total(sums, c) + F.col(f"__e_{c}")))
            found = moved.where(total(sums, sums[0]) <= cutoff).groupBy(*PAIR).agg(F.min("path").alias("path")).where("path is not null")
            better = files.better(found).withColumn("slot", F.floor(total(sums, sums[0]) / F.lit(width)).cast("long"))
            size = files.append(better, slot)
            if size == 0:
                break
            frontier = files.last(slot)
        slot, size = files.next_slot(slot)
        if slot is not None:
            frontier = files.opened(slot)
    return files.best(ends)

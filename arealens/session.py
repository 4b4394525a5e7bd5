"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


TASK_ROWS = 500_000


def build_session(app: str = "arealens", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on. On a cluster, leave `master` and the partition count to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the session's `spark.checkpoint.dir`.

    A temporary folder is used only where the setting is absent and Spark runs in
    one process, as in tests; several processes need not share one, so there it is an error.
    """
    context = spark.sparkContext
    stated = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if stated:
        if current is None:
            context.setCheckpointDir(stated)
        return stated
    if current:
        return current
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can read")
    folder = tempfile.mkdtemp(prefix="arealens-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def tasks_for(spark: SparkSession, rows: int, each: int = TASK_ROWS) -> Iterator[None]:
    """Within it, what is run shuffles into a task for every `each` of some rows, and into no fewer tasks than before.

    Adaptive execution joins small partitions but does not split large ones, so a fixed
    number of them lets a task's rows grow with the table.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), -(-rows // each))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and return it without its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shelved(df: DataFrame) -> DataFrame:
    """The same, written as Parquet: readers of few columns of a wide table read only those."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/shelf-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

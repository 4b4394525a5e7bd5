"""Helpers shared by the text operators: written tables, blocks of documents, word hashes, components.

Blocks and shards. Several operators need, for each document, facts about all documents
(how often a word occurs, which document has a window first). Sending every occurrence
through a shuffle would move many times the text. Instead documents are laid in blocks of
a few MB, each block asks about its *distinct* keys only, the questions go to shards by
the key's hash, and the shards answer the blocks. A key in a third of all rows costs one
entry per block, so no shard or block grows with a hot key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.session import checkpoint_dir

BLOCK_BYTES = 4 << 20
SPACE_BYTES = rb"\x20\x09-\x0D"


def stored(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet into the shared checkpoint folder and read it back without its lineage."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(table: pa.Table) -> bytes:
    """A table as one compressed value, so that a shuffle moves a block as a row."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def raw(column: pa.Array | pa.ChunkedArray) -> list:
    """Text values as bytes, null as None; bytes that are not UTF-8 pass through unchanged."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def chunked(batches: Iterable[pa.RecordBatch], text: int = 1, limit: int = BLOCK_BYTES) -> Iterator[list[list]]:
    """Columns of consecutive rows with at most `limit` bytes of text, or of one longer row."""
    held: list[list] | None = None
    size = 0
    for batch in batches:
        columns = [raw(c) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            n = len(row[text] or b"")
            if held is not None and size + n > limit:
                yield held
                held = None
            if held is None:
                held, size = [[] for _ in row], 0
            size += n
            for column, value in zip(held, row):
                column.append(value)
    if held is not None:
        yield held


def to_blocks(docs: DataFrame, id_col: str, text_col: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """Documents as a written table of blocks (block, body): packed tables of (id, text as bytes).

    Written once, so that a block holds the same documents each time it is read, also
    after an executor is lost. Long documents are blocks of their own.
    """

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for n, (ids, texts) in enumerate(chunked(batches, 1, limit)):
            body = pack(pa.table({"id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())}))
            yield pa.RecordBatch.from_pydict({"block": [(part << 32) | n], "body": [body]},
                                             schema=pa.schema([("block", pa.int64()), ("body", pa.binary())]))

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(slim.mapInArrow(fold, "block long, body binary"))


def word_table(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of some texts: number of words per text, each word's place in the vocabulary, the vocabulary.

    bytes.split() without an argument splits at exactly the six bytes 0x20 and 0x09 to 0x0D, and
    bytes.lower() changes A to Z only.
    """
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            found = (text.lower() if lower else text).split()
            counts[i] = len(found)
            words += found
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return counts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b), longs: (node, root), root the smallest node of each.

    Each round points a node's larger neighbours, then its smaller ones, at the smallest
    node it knows; the rounds grow with the logarithm of the graph. Minima combine before
    the shuffle, and the joins' long sides can be split by adaptive execution.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stored(around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    tops = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return roots.unionByName(tops).groupBy("node").agg(F.min("root").alias("root"))

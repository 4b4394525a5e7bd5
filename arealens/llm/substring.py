"""Substring dedup: words in runs that an earlier document has already are removed.

Method: count-min prefilter. Each block of documents makes a sparse sketch of its distinct
windows; the sketches are added up per shard of the hash range, and every window whose
estimate stays below two blocks is settled. Estimates are never too low, so no repeat is
lost. Only the other windows take part in a second pass that groups them exactly, by 96
bits of hash, and finds the smallest document of each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.llm.common import pack, stored, to_blocks, unpack, word_table

WINDOW = 13
SHARD_WINDOWS = 1 << 20
CODE_BITS = 24
ROW_BITS = 22
LAST = np.iinfo(np.int64).max
ROWS = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("body", pa.binary())])
ROWS_SQL = "block long, shard int, body binary"
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class _Windows:
    """The windows of one block: where each starts, and its distinct hashes with their smallest document."""

    def __init__(self, body: bytes, window: int, shards: int):
        import xxhash

        table = unpack(body)
        self.ids = table["id"]
        self.texts = table["text"].to_pylist()
        self.counts, words, vocabulary = word_table(self.texts)
        hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in vocabulary), ">u8").astype(np.uint64).reshape(-1, 2)
        self.ends = np.cumsum(self.counts)
        docs = np.repeat(np.arange(len(self.counts)), self.counts)
        last = len(words) - window + 1
        starts = np.flatnonzero(np.arange(max(last, 0)) + window <= self.ends[docs[:max(last, 0)]])
        keys = []
        for column, factor in enumerate(FACTORS):
            h = np.zeros(max(last, 0), np.uint64)
            own = hashes[words, column] if len(words) else np.zeros(0, np.uint64)
            for j in range(window if last > 0 else 0):
                h = h * factor + own[j:j + last]
            h ^= h >> np.uint64(29)
            keys.append(h[starts] * FACTORS[1 - column])
        high, low = keys[0], (keys[1] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((low, high))
        ids = np.array([LAST if i is None else i for i in self.ids.to_pylist()], np.int64)
        owner = ids[docs[starts]][order]
        high, low = high[order], low[order]
        first = np.ones(len(order), bool)
        first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        heads = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        self.high, self.low = high[heads], low[heads]
        self.least = np.minimum.reduceat(owner, heads) if len(heads) else owner
        self.starts, self.owner, self.group = starts[order], owner, group
        # A shard is a range of hashes, so sorted hashes are sorted by shard.
        self.shard = ((self.high >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)

    def by_shard(self, keep: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, places of its distinct windows) in order; `keep` leaves some out."""
        places = np.arange(len(self.high)) if keep is None else np.flatnonzero(keep)
        cuts = np.flatnonzero(np.diff(self.shard[places])) + 1
        for part in np.split(places, cuts):
            if len(part):
                yield int(self.shard[part[0]]), part

    def flags(self, answers: dict[int, bytes], keep: np.ndarray | None = None) -> np.ndarray:
        """Answers of the shards, one bit per window asked about, as a mask of the distinct windows."""
        out = np.zeros(len(self.high), bool)
        for shard, part in self.by_shard(keep):
            if shard in answers:
                out[part] = np.unpackbits(np.frombuffer(answers[shard], np.uint8), count=len(part)).astype(bool)
        return out


def _codes(high: np.ndarray) -> np.ndarray:
    return (high & np.uint64((1 << CODE_BITS) - 1)).astype(np.uint32)


def _cells(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a window in the two rows of the sketch."""
    codes = codes.astype(np.uint64)
    mixed = (codes * FACTORS[0]) >> np.uint64(64 - ROW_BITS)
    return (codes >> np.uint64(CODE_BITS - ROW_BITS)).astype(np.int64), mixed.astype(np.int64)


def _deltas(codes: np.ndarray) -> bytes:
    """Sorted codes as steps of two bytes; a step beyond that is preceded by full ones."""
    steps = np.diff(codes.astype(np.int64), prepend=0)
    more = steps // 0xFFFF
    if not more.any():
        return steps.astype("<u2").tobytes()
    at = np.cumsum(more + 1) - 1
    out = np.full(int(at[-1]) + 1, 0xFFFF, "<u2")
    out[at] = steps % 0xFFFF
    return out.tobytes()


def _undeltas(body: bytes) -> np.ndarray:
    steps = np.frombuffer(body, "<u2").astype(np.int64)
    return np.cumsum(steps)[steps != 0xFFFF]


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "shard": pa.array([r[1] for r in rows], pa.int32()),
                     "body": pa.array([r[2] for r in rows], pa.binary())}, schema=ROWS)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove each word covered by a window of `window` words that also starts in a document with a smaller id.

    Returns (doc_id, n_words, n_removed, kept): the words left, joined by one space. Words are
    `[^\\x20\\x09-\\x0D]+`; windows are judged on the input. Null and empty texts have no words; a
    null id counts as larger than any other, and rows that share an id do not repeat each
    other. One row per input row; an empty table gives an empty table. Other columns are ignored.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0
    shards = max(1, -(-size // (6 * SHARD_WINDOWS)))
    blocks = to_blocks(docs, id_col, text_col)

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch["block"].to_pylist(), batch["body"]):
                own = _Windows(body.as_py(), window, shards)
                out = [(block, shard, _deltas(np.sort(_codes(own.high[part])))) for shard, part in own.by_shard()]
                yield from _rows(out).to_batches()

    def estimate(table: pa.Table) -> pa.Table:
        """Adds up the sketches of a shard, as far as two, and tells each block which of its codes may be repeated."""
        asked = [(b, s, _undeltas(x).astype(np.uint32)) for b, s, x in zip(*(table[c].to_pylist() for c in ("block", "shard", "body")))]
        # Only whether a cell was met twice matters, so two flags a cell do for its count.
        twice = [np.zeros(1 << ROW_BITS, bool) for _ in range(2)]
        for row, met in enumerate(twice):
            once = np.zeros(1 << ROW_BITS, bool)
            for _, _, codes in asked:
                cells, n = np.unique(_cells(codes)[row], return_counts=True)
                met[cells[once[cells] | (n > 1)]] = True
                once[cells] = True
        out = []
        for block, shard, codes in asked:
            a, b = _cells(codes)
            repeated = twice[0][a] & twice[1][b]
            if repeated.any():
                out.append((block, shard, np.packbits(repeated).tobytes()))
        return _rows(out)

    def maybe(own: _Windows, answers: dict[int, bytes]) -> np.ndarray:
        """Windows whose estimate is two or more. Answers are in the order of the sorted codes."""
        out = np.zeros(len(own.high), bool)
        for shard, part in own.by_shard():
            if shard in answers:
                order = np.argsort(_codes(own.high[part]), kind="stable")
                out[part[order]] = np.unpackbits(np.frombuffer(answers[shard], np.uint8), count=len(part)).astype(bool)
        return out

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if right.num_rows:
            answers = dict(zip(right["shard"].to_pylist(), right["body"].to_pylist()))
            for block, body in zip(left["block"].to_pylist(), left["body"].to_pylist()):
                own = _Windows(body, window, shards)
                keep = maybe(own, answers)
                for shard, part in own.by_shard(keep):
                    high = np.diff(own.high[part], prepend=np.uint64(0))
                    out.append((block, shard, pack(pa.table({"high": high, "low": own.low[part], "least": own.least[part]}))))
        return _rows(out)

    def settle(table: pa.Table) -> pa.Table:
        """Groups the windows of a shard exactly; a block learns which of its windows start in a smaller document elsewhere."""
        asked = []
        for block, shard, body in zip(*(table[c].to_pylist() for c in ("block", "shard", "body"))):
            t = unpack(body)
            asked.append((block, shard, np.cumsum(t["high"].to_numpy()), t["low"].to_numpy(), t["least"].to_numpy()))
        high, low, least = (np.concatenate([a[i] for a in asked]) for i in (2, 3, 4))
        order = np.lexsort((low, high))
        head = np.ones(len(order), bool)
        head[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
        smallest = np.empty(len(order), np.int64)
        smallest[order] = np.minimum.reduceat(least[order], np.flatnonzero(head))[np.cumsum(head) - 1]
        smaller = smallest < least
        out, at = [], 0
        for block, shard, own, _, _ in asked:
            bits = smaller[at:at + len(own)]
            at += len(own)
            if bits.any():
                out.append((block, shard, np.packbits(bits).tobytes()))
        return _rows(out)

    def cover(left: pa.Table, right: pa.Table) -> pa.Table:
        first: dict[int, bytes] = {}
        second: dict[int, bytes] = {}
        for shard, body, final in zip(right["shard"].to_pylist(), right["body"].to_pylist(), right["final"].to_pylist()):
            (second if final else first)[shard] = body
        ids, words, removed, kept = [], [], [], []
        for body in left["body"].to_pylist():
            own = _Windows(body, window, shards)
            elsewhere = own.flags(second, maybe(own, first)) if second else np.zeros(len(own.high), bool)
            bad = own.starts[elsewhere[own.group] | (own.least[own.group] < own.owner)]
            total = int(own.counts.sum())
            edges = np.zeros(total + 1, np.int64)
            np.add.at(edges, bad, 1)
            np.add.at(edges, bad + window, -1)
            gone = np.cumsum(edges[:-1]) > 0
            ids += own.ids.to_pylist()
            for text, n, end in zip(own.texts, own.counts.tolist(), own.ends.tolist()):
                mask = gone[end - n:end]
                out = int(mask.sum())
                pieces = (text or b"").split()
                kept.append(b" ".join(pieces if out == 0 else [w for w, g in zip(pieces, mask.tolist()) if not g]))
                words.append(n)
                removed.append(out)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(words, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary())})

    sketches = blocks.mapInArrow(sketch, ROWS_SQL)
    repeated = stored(sketches.groupBy("shard").applyInArrow(estimate, ROWS_SQL))
    questions = blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(ask, ROWS_SQL)
    earlier = questions.groupBy("shard").applyInArrow(settle, ROWS_SQL)
    answers = repeated.withColumn("final", F.lit(False)).unionByName(earlier.withColumn("final", F.lit(True)))
    out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        cover, "doc_id long, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))

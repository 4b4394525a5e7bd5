"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Method: large-item matching. Pieces above a third of the capacity share a sequence with one
other such piece at most, so they are matched greedily, the largest with the largest that
fits; the smaller ones then fill the remaining gaps, largest first, each in the tightest gap.

Only lengths matter for the plan, and there are no more of them than the capacity. The plan
is made on the histogram of lengths: sequences of one pattern are kept as one class with a
count. Pieces then find their place by their rank within their length, so nothing larger
than the histogram and the plan, both bounded by the capacity, comes to the driver.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealens.llm.common import chunked, stored

CAPACITY = 2048
PLAIN = re.compile("[\\t-\\r -~\u00a1-\u024f]*").fullmatch
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Places for `histogram[length]` pieces of each length, and the number of sequences.

    A place is (first rank, first sequence, pieces per sequence, offset): of the pieces of a
    length, rank r from the place's first rank on goes to sequence first + (r - first rank) //
    per, at offset + ((r - first rank) % per) * length.
    """
    left = {s: n for s, n in histogram.items() if n > 0 and 0 < s <= capacity}
    places: dict[int, list[tuple[int, int, int, int]]] = {s: [] for s in left}
    used = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> classes (first sequence, number) of sequences with that gap
    open_gaps: list[int] = []
    total = 0

    def put(size: int, sequences: int, first: int, per: int, offset: int, pieces: int | None = None) -> None:
        places[size].append((used[size], first, per, offset))
        used[size] += pieces if pieces is not None else sequences * per
        left[size] -= pieces if pieces is not None else sequences * per

    def leave(gap: int, first: int, n: int) -> None:
        if n and gap:
            if not gaps.get(gap):
                insort(open_gaps, gap)
            gaps.setdefault(gap, []).append((first, n))

    large = sorted(s for s in left if 3 * s > capacity)
    for size in reversed(large):
        while left[size]:
            fits = [b for b in large[:np.searchsorted(large, capacity - size, "right")] if left[b] - (b == size) > 0]
            partner = fits[-1] if fits else None
            if partner is None:
                n = left[size]
                put(size, n, total, 1, 0)
                leave(capacity - size, total, n)
            elif partner == size:
                n = left[size] // 2
                put(size, n, total, 2, 0)
                leave(capacity - 2 * size, total, n)
            else:
                n = min(left[size], left[partner])
                put(size, n, total, 1, 0)
                put(partner, n, total, 1, size)
                leave(capacity - size - partner, total, n)
            total += n
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(open_gaps, size)
            if at == len(open_gaps):
                per = capacity // size
                n = -(-left[size] // per)
                leave(capacity, total, n)
                total += n
                continue
            gap = open_gaps[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                open_gaps.pop(at)
            per = gap // size
            full = min(n, left[size] // per)
            if full:
                put(size, full, first, per, capacity - gap)
                leave(gap - per * size, first, full)
            if full < n:
                rest = left[size]
                if rest and rest < per:
                    put(size, 1, first + full, rest, capacity - gap, rest)
                    leave(gap - rest * size, first + full, 1)
                    full += 1
                leave(gap, first + full, n - full)
    return places, total


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Encoder:
    """Token ids of texts by a byte-level vocabulary file.

    Texts of ASCII and Latin letters, which both libraries class alike, go through the faster
    of the two over the same vocabulary; any other text, and any that spells a special token,
    goes through the one the file is for, as it is.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.spellings = [token.content for token in special.values()]
        shown = _byte_letters()
        ranks = {bytes(shown[c] for c in token): i for token, i in self.tokenizer.get_vocab().items() if i not in special}
        self.twin = tiktoken.Encoding("twin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, no special tokens added to it, as little-endian unsigned 32-bit numbers."""
        if PLAIN(text) and not any(s in text for s in self.spellings):
            return np.array(self.twin.encode_ordinary(text), "<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


def pieces_of(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int) -> DataFrame:
    """Documents as pieces with their length, checksum and rank among the pieces of one task with that length."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = Encoder(path)
        seen: dict[int, int] = {}
        for ids, texts in chunked(batches):
            rows = []
            for doc, text in zip(ids, texts):
                tokens = np.append(encoder.encode((text or b"").decode("utf-8", "replace")), np.zeros(1, "<u4"))
                number = -(-len(tokens) // capacity)
                cuts = [0] + [len(tokens) - (number - k) * capacity for k in range(1, number + 1)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rank = seen.get(b - a, 0)
                    seen[b - a] = rank + 1
                    rows.append((doc, piece, a, b - a, zlib.crc32(tokens[a:b].tobytes()), part, rank))
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank")
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(slim.mapInArrow(cut, PIECES))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A
    document is its token ids and a closing 0, so null and empty texts are one token; one
    longer than a sequence is cut into full pieces, of which the first may be shorter. Rows
    that share an id, also a null one, are packed separately. An empty table gives an empty
    table; other columns are ignored.
    """
    pieces = pieces_of(docs, id_col, text_col, tokenizer_path, capacity)
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places, _ = plan(histogram, capacity)
    lookup = {s: tuple(np.array(c) for c in zip(*rows)) for s, rows in places.items()}
    # One row per task and length.
    sizes = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = batch["rank"].to_numpy() + batch["before"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    size = int(length[rows[0]])
                    lo, first, per, at = lookup[size]
                    k = np.searchsorted(lo, rank[rows], "right") - 1
                    nth = rank[rows] - lo[k]
                    sequence[rows] = first[k] + nth // per[k]
                    offset[rows] = at[k] + nth % per[k] * size
            keep = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return pieces.join(before, ["part", "length"]).mapInArrow(
        settle, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

"""Benchmark decontamination: documents that hold a benchmark passage, exactly or with some edits.

Method: q-gram lemma filtering. A region of a document that is an item of length n with at
most e edits shares at least n - q + 1 - q * e character q-grams with it, all on diagonals
(document position less item position) within 2e of each other. Shared q-grams are counted
in overlapping bands of diagonals; bands that meet the bound are verified by a banded
alignment of the whole item. Grams are of ten characters; an item too short for its bound
to be met with those takes the longest grams that leave one to share, and an item shorter
than ten characters is one gram, found as it stands between word borders.

The items are normalised and put into an index of sorted q-gram hashes. Items are handled in
slices of at most `SLICE_CHARS` characters, one pass over the documents each, so what is
sent to the executors is bounded whatever the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.llm.common import chunked

Q = 10
EDIT_SHARE = 0.08
SLICE_CHARS = 4_000_000
FILTER_BITS = 22
FACTOR = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD6E8FEB86659FD93)
HITS = "doc_id long, item_id long, start long, end long, edits int"


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a text in lower case with runs of anything but letters and digits as one space, and their places in it."""
    # Lowering may change a text's length; such characters stay as they are.
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    small = points < 128
    word = ~small | ((points >= 97) & (points <= 122)) | ((points >= 48) & (points <= 57))
    word &= ~((points >= 0x80) & (points <= 0xBF)) & ~((points >= 0x2000) & (points <= 0x206F)) & (points != 0x3000)
    keep = word.copy()
    keep[1:] |= word[:-1]
    first = int(np.argmax(word)) if word.any() else len(word)
    keep[:first] = False
    places = np.flatnonzero(keep)
    out = np.where(word, points, 32)[places]
    if len(out) and out[-1] == 32:
        out, places = out[:-1], places[:-1]
    return out.astype(np.uint32), places


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of the q-grams at each position."""
    n = len(points) - q + 1
    h = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        wide = points.astype(np.uint64)
        for j in range(q):
            h = h * FACTOR + wide[j:j + n]
    return h * ODD


def gram_size(size: int, q: int, share: float) -> int:
    """The longest grams of at most `q` characters of which an item with all its edits still shares one."""
    return max(1, min(q, size // (int(share * size) + 1)))


def edits_within(item: np.ndarray, text: np.ndarray, centre: int, band: int, most: int) -> tuple[int, int, int] | None:
    """Least edits that turn `item` into a piece of `text`, on diagonals within `band` of `centre`: (edits, start, end).

    Free start and end in the text. None if more than `most`. Of pieces with as many edits
    the first end counts.
    """
    n, width = len(item), 2 * band + 1
    big = np.int32(1 << 28)
    at = np.arange(width) + centre - band  # text position before the first letter, by diagonal
    cost = np.where((at >= 0) & (at <= len(text)), 0, big).astype(np.int32)
    start = at.copy()
    steps = np.arange(width, dtype=np.int32)
    for i in range(n):
        pos = at + i  # text letter met by item letter i
        inside = (pos >= 0) & (pos < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[pos[inside]] == item[i]
        diagonal = np.where(inside, cost + ~same, big).astype(np.int32)
        down = np.append(cost[1:], big) + 1  # item letter left out: the diagonal falls by one
        origin = np.where(diagonal <= down, start, np.append(start[1:], 0))
        best = np.minimum(diagonal, down)
        # Text letters put in: along increasing diagonals.
        run = np.minimum.accumulate(best - steps)
        source = np.maximum.accumulate(np.where(best - steps == run, steps, -1))
        cost = np.minimum(run + steps, big).astype(np.int32)
        start = origin[source]
        if cost.min() > most:
            return None
    ends = at + n
    cost = np.where((ends >= 0) & (ends <= len(text)), cost, big)
    k = int(np.argmin(cost))
    return (int(cost[k]), int(start[k]), int(ends[k])) if cost[k] <= most else None


class Index:
    """Normalised items by the size of their grams."""

    def __init__(self, ids: list[int], items: list[np.ndarray], q: int, share: float):
        self.ids, self.items = ids, items
        sizes = np.array([gram_size(len(x), q, share) for x in items], int)
        self.parts = []
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size).tolist()
            self.parts.append((at, Grams([items[k] for k in at], size, share, q)))

    def search(self, points: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, start, end, edits) of each item found in a normalised text, its best place only."""
        for at, part in self.parts:
            for k, start, end, edits in part.search(points):
                yield at[k], start, end, edits


@dataclass
class Grams:
    """Items with grams of one size: the sorted hashes of the grams with item and position, and a bit filter over the hashes."""

    items: list[np.ndarray]
    q: int
    share: float
    whole_words: int  # items shorter than this are found between word borders only

    def __post_init__(self) -> None:
        hashes = [grams(x, self.q) for x in self.items]
        item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, int)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hash, self.item, self.place = flat[order], item[order], place[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[flat >> np.uint64(64 - FILTER_BITS)] = True
        size = np.array([len(x) for x in self.items])
        self.size = size
        self.most = np.floor(self.share * size).astype(int)
        self.need = size - self.q + 1 - self.q * self.most  # at least one, by the choice of q

    def exact(self, k: int, whole: bytes) -> tuple[int, int, int] | None:
        """The first place of an item without edits, which no alignment can better."""
        body = self.items[k].tobytes()
        space, bare = b" \0\0\0", len(self.items[k]) < self.whole_words

        def inside_word(at: int) -> bool:
            end = at + len(body)
            return bare and (whole[max(at - 4, 0):at] not in (b"", space) or whole[end:end + 4] not in (b"", space))

        at = whole.find(body)
        while at >= 0 and (at % 4 or inside_word(at)):
            at = whole.find(body, at + 1)
        return None if at < 0 else (0, at // 4, at // 4 + len(self.items[k]))

    def search(self, points: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, start, end, edits) of each item found in a normalised text, its best place only."""
        own = grams(points, self.q)
        at = np.flatnonzero(self.maybe[own >> np.uint64(64 - FILTER_BITS)])
        if len(at) < self.need.min(initial=1 << 30):
            return
        # A region spans at most an item and its edits, so q-grams without enough others near cannot count.
        span = int((self.size + self.most).max())
        near = np.searchsorted(at, at + span, "right") - np.searchsorted(at, at - span, "left")
        at = at[near >= self.need.min()]
        low, high = np.searchsorted(self.hash, own[at], "left"), np.searchsorted(self.hash, own[at], "right")
        times = high - low
        if not times.sum():
            return
        pos = np.repeat(at, times)
        entry = np.arange(len(pos)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        item, place = self.item[entry], self.place[entry]
        # Items with too few shared q-grams in the whole text are out at once.
        total = np.bincount(item, minlength=len(self.items))
        keep = total[item] >= self.need[item]
        item, place, pos = item[keep], place[keep], pos[keep]
        # Bands of 4e + 2 diagonals every 2e + 1, so any 2e + 1 diagonals lie in one band. A q-gram
        # of the item counts once in a band, however often the text repeats it.
        band = np.floor_divide(pos - place, 2 * self.most[item] + 1)
        item, place, band = np.tile(item, 2), np.tile(place, 2), np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item))
        item, place, band = item[order], place[order], band[order]
        new_band = np.ones(len(item), bool)
        new_band[1:] = (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        new = new_band.copy()
        new[1:] |= place[1:] != place[:-1]
        heads = np.flatnonzero(new_band)
        counts = np.add.reduceat(new.astype(int), heads) if len(heads) else heads
        best: dict[int, tuple[int, int, int]] = {}
        whole = points.tobytes()
        for at in heads[counts >= self.need[item[heads]]].tolist():
            k, b = int(item[at]), int(band[at])
            most = int(self.most[k])
            step = 2 * most + 1
            if best.get(k, (1,))[0] == 0:
                continue
            found = self.exact(k, whole)
            if not found and self.size[k] >= self.whole_words:
                found = edits_within(self.items[k], points, b * step + step, step + most, most)
            if found and (k not in best or found < best[k]):
                best[k] = found
        for k, (edits, start, end) in sorted(best.items()):
            yield k, start, end, edits


def slices(benchmark: DataFrame, id_col: str, text_col: str, q: int, share: float, limit: int = SLICE_CHARS) -> Iterator[Index]:
    """Indexes over the items, each of at most `limit` characters or of one longer item."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    ids: list[int] = []
    items: list[np.ndarray] = []
    for row in rows.distinct().orderBy("id", "text").toLocalIterator():
        points, _ = normalise(row["text"])
        if not len(points):
            continue
        if items and sum(map(len, items)) + len(points) > limit:
            yield Index(ids, items, q, share)
            ids, items = [], []
        ids.append(row["id"])
        items.append(points)
    if items:
        yield Index(ids, items, q, share)


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", q: int = Q, share: float = EDIT_SHARE) -> DataFrame:
    """Benchmark items that documents hold with at most `share` of their length in edits.

    Returns (doc_id, item_id, start, end, edits), one row per row of `docs` and item found: the
    best place, in code points of the text, end exclusive. Texts are compared in lower case
    with runs of spaces and punctuation as one space. Null and empty texts hold nothing, and
    null items and those without a letter or digit are in no text; items shorter than `q`
    characters are found whole, between word borders; repeated items count once; rows that
    share an id are searched each. Empty tables give an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for index in slices(benchmark, item_col, item_text_col, q, share):
        sent = spark.sparkContext.broadcast((index.ids, index.items, q, share))  # at most SLICE_CHARS characters, or one item

        def search(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own = Index(*sent.value)
            for ids, texts in chunked(batches):
                rows = []
                for doc, text in zip(ids, texts):
                    points, places = normalise((text or b"").decode("utf-8", "replace"))
                    rows += [(doc, own.ids[k], int(places[a]), int(places[b - 1]) + 1, e) for k, a, b, e in own.search(points) if b > a]
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                                 ["doc_id", "item_id", "start", "end", "edits"])

        part = slim.mapInArrow(search, HITS)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], HITS) if found is None else found


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  q: int = Q, share: float = EDIT_SHARE) -> DataFrame:
    """The rows of `docs`, all columns, that hold no benchmark item.

    Rows are judged by their own text, so of rows that share an id, or have none, those without
    an item stay. Null and empty texts stay; an empty benchmark takes nothing out.
    """
    for index in slices(benchmark, item_col, item_text_col, q, share):
        sent = docs.sparkSession.sparkContext.broadcast((index.ids, index.items, q, share))  # at most SLICE_CHARS characters, or one item

        @F.pandas_udf("boolean")
        def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = Index(*sent.value)  # noqa: B023
            for column in texts:
                yield pd.Series([next(own.search(normalise(t or "")[0]), None) is None for t in column], dtype="bool")

        docs = docs.where(clean(F.col(text_col).cast("string")))
    return docs

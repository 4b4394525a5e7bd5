"""Target-distribution importance resampling: documents drawn by how much their features resemble a target's.

Method: hashed features of all documents and of the target are counted once; the gain of a
bucket is the logarithm of the ratio of their smoothed shares. The gains are one dense array,
bounded by the number of buckets, that tasks index to score documents. A Gumbel draw is added
to each weight, so the highest scores are a sample without replacement. The k-th score is
found by distributed quickselect: random keys of the open range are pivots, one aggregate
counts the rows below, at and above each, and the range closes around the k-th key. Only
the rows up to it are sorted and ranked.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from arealens.llm.common import chunked, stored
from arealens.skew import number_rows

BUCKETS = 10_000
RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 15

#: A to Z in lower case; every other ASCII byte but digits and letters separates words, as do no bytes beyond ASCII.
FOLD = bytes(ord(chr(c).lower()) if chr(c).isascii() and chr(c).isalnum() else c if c > 127 else 32 for c in range(256))


def features(texts: list[bytes | None], run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: number of words of each, number of features of each, and the features' buckets, text by text."""
    words: list[bytes] = []
    n_words = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            found = text.translate(FOLD).split()
            n_words[i] = len(found)
            words += found
    coded = pa.array(words, pa.binary()).dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), n_words)
    left = np.repeat(np.cumsum(n_words), n_words) - np.arange(len(codes))  # words from here to the end of the text
    gram, crcs = codes, [zlib.crc32(w) for w in vocabulary]
    owners, found = [owner], [np.array(crcs, np.int64)[gram] % buckets if len(gram) else gram]
    for size in range(2, run + 1):
        at = np.flatnonzero(left >= size)
        # A longer run is the run one word shorter and its last word; CRCs go on from the shorter run's.
        pairs, back = np.unique(gram[at] * max(len(vocabulary), 1) + codes[at + size - 1], return_inverse=True)
        crcs = [zlib.crc32(b" " + vocabulary[p % len(vocabulary)], crcs[p // len(vocabulary)]) for p in pairs.tolist()]
        gram = np.zeros(len(codes), np.int64)
        gram[at] = back
        owners.append(owner[at])
        found.append(np.array(crcs, np.int64)[back] % buckets if len(at) else at)
    owners, every = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    return n_words, np.bincount(owners, minlength=len(texts)), every[order]


def bucket_counts(df: DataFrame, text_col: str, run: int, buckets: int) -> np.ndarray:
    """How often features of a table fall into each bucket. A task sends at most one row per bucket."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in chunked(batches):
            total += np.bincount(features(texts, run, buckets)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    slim = df.select(F.lit(0).alias("id"), F.col(text_col).cast("string").alias("text"))
    sums = slim.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in sums:
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths: the logarithm of its smoothed share of the target over that of the source."""
    s_all, t_all, size = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def draw_noise(doc: int | None, seed: int) -> int:
    """A Gumbel number in thousandths that depends on the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, run: int, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, place), written; `place` numbers the rows, so that keys never tie."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 40
        for ids, texts in chunked(batches):
            n_words, n, found = features(texts, run, len(gain))
            sums = np.concatenate([[0], np.cumsum(gain[found])])
            ends = np.cumsum(n)
            weight = np.where(n > 0, (sums[ends] - sums[ends - n]) // np.maximum(n, 1), 0)
            total = weight + np.array([draw_noise(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n_words": n_words, "n_features": n.astype(np.int64), "weight": weight, "score": total,
                "place": place + np.arange(len(ids))})
            place += len(ids)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(slim.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long, place long"))


KEY = ("score", "doc_id", "place")


def _compare(row: Row) -> tuple[Column, Column]:
    """Whether a key comes before, and whether it is, a given one: higher scores, smaller ids (null last), smaller places first."""
    score, doc, place = F.col("score"), F.col("doc_id"), F.col("place")
    same_score = score == row["score"]
    if row["doc_id"] is None:
        id_before, same_id = doc.isNotNull(), doc.isNull()
    else:
        id_before, same_id = F.coalesce(doc < row["doc_id"], F.lit(False)), doc.eqNullSafe(F.lit(row["doc_id"]))
    before = (score > row["score"]) | (same_score & (id_before | (same_id & (place < row["place"]))))
    return before, same_score & same_id & (place == row["place"])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> Row:
    """The k-th key (from 1) of a written table, by quickselect over its partitions.

    Each round draws `pivots` random keys of the open range, by a hash of the row's place and
    the round, and counts the range's rows before each. Nothing but pivots and counts reaches
    the driver, and the open range shrinks by about the number of pivots in every round.
    """
    open_range, before, turn = rows.select(*KEY), 0, 0
    low = high = None
    while True:
        turn += 1
        drawn = open_range.orderBy(F.xxhash64(F.lit(turn), "place"), "place").limit(pivots).collect()
        compared = [_compare(p) for p in drawn]
        counts = open_range.agg(*[F.count_if(c).alias(f"{n}{i}") for i, pair in enumerate(compared) for n, c in zip("be", pair)]).first()
        below = above = None
        for i, pivot in enumerate(drawn):
            less, same = before + counts[f"b{i}"], counts[f"e{i}"]
            if less < k <= less + same:
                return pivot
            if less + same < k and (below is None or less + same > below[0]):
                below = (less + same, pivot)
            if k <= less and (above is None or less < above[0]):
                above = (less, pivot)
        if below:
            before, low = below
        if above:
            high = above[1]
        open_range = rows.select(*KEY)
        # The bounds on the score alone reach the scan; the rest of the key decides at the ends.
        if low is not None:
            is_before, same = _compare(low)
            open_range = open_range.where(F.col("score") <= low["score"]).where(~is_before & ~same)
        if high is not None:
            open_range = open_range.where(F.col("score") >= high["score"]).where(_compare(high)[0])


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             run: int = RUN, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Draw `percent` of the documents with at least `least_words` words, preferring those like the target.

    Returns one row per input row: doc_id, n_features, weight, score and, for drawn rows, rank
    (from 1, by score descending; ties to the smaller id, null ids last, then by place in the
    scored table, so repeated rows are drawn one by one). Features are runs of 1 to `run`
    words. Null and empty texts have no features and weight 0. An empty target leaves only the
    smoothed shares; an empty table gives an empty table. Other columns are ignored.
    """
    if run < 1 or buckets < 1 or not 0 <= percent <= 100:
        raise ValueError("run and buckets are at least 1, percent is between 0 and 100")
    gain = gains(bucket_counts(docs, text_col, run, buckets), bucket_counts(target, target_text_col, run, buckets))
    scored = weigh(docs, gain, id_col, text_col, run, seed)
    fit = F.col("n_words") >= least_words
    k = percent * scored.where(fit).count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if k == 0:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    before, same = _compare(kth_key(scored.where(fit), k))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")]
    ranked = number_rows(scored.where(fit & (before | same)), order, "rank", 1)
    rest = scored.where(~(fit & (before | same))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*out, F.col("rank").cast("long")).unionByName(rest.select(*out, "rank"))

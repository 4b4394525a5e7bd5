"""SimHash near-duplicates: documents whose fingerprints differ in few bits, as connected components.

Method: pigeonring. A fingerprint's 64 bits are a ring of eight segments of a byte. If two
fingerprints differ in at most 2 bits, there is a segment from which on every chain of l
segments differs in at most l * 2/8 bits: none in the first three, one in the first seven,
two in all eight. So candidates agree in three consecutive bytes and, as the next four
differ in one bit at most, also in two more on one side or the other: a key of five bytes,
at sixteen places. Pairs with a key in common pass the chain's budgets before the full
Hamming distance is computed.

Copies share a fingerprint and are one node. Buckets of more than `BUCKET` fingerprints are
not paired: their members are linked through every fingerprint one bit away, a star per
such middle, which finds the same links (two fingerprints at most two bits apart share a
middle, and all fingerprints that share one are at most two bits apart).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.llm.common import chunked, components, stored

BITS = 2
SHINGLE = 3
SEED = 42
BUCKET = 64
SEGMENTS = 8


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of a text as a signed 64-bit number: bit set where it is set in over half the shingles' hashes."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(g, seed) for g in grams]), np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[at:at + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED,
                 extra: Column | None = None) -> DataFrame:
    """(doc_id, fp, h) of every row; null, empty and blank texts have fingerprint 0. h is `extra`, a long, or null."""

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, more in chunked(batches):
            prints = [fingerprint(t, shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, prints, more)], ["doc_id", "fp", "h"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       (F.lit(None) if extra is None else extra).cast("long").alias("h"))
    return slim.mapInArrow(mark, "doc_id long, fp long, h long")


def _components_of(prints: DataFrame) -> DataFrame:
    """(fp, least, root) of distinct fingerprints with their smallest id `least`; equal roots are one component."""
    roots = stored(components(links(prints)))
    return prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def _ring(fp: Column, start: int) -> Column:
    """The fingerprint turned so that segment `start` comes first, at the high end."""
    turn = 8 * start
    return fp if turn == 0 else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))


def _keys(fp: Column) -> Column:
    """The sixteen keys: the place, three segments, and the upper or lower half of the next four."""
    out = []
    for start in range(SEGMENTS):
        turned = _ring(fp, start)
        head = F.shiftrightunsigned(turned, 40)
        for half in (0, 1):
            tail = F.shiftrightunsigned(turned, 24 if half == 0 else 8).bitwiseAND(F.lit(0xFFFF))
            place = F.lit((2 * start + half) << 40)
            out.append(place.bitwiseOR(F.shiftleft(head, 16).bitwiseOR(tail)))
    return F.array(*out)


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct fingerprints `fp` at most two bits apart."""
    keyed = prints.select("fp", F.posexplode(_keys(F.col("fp"))).alias("place", "key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(keyed.join(sizes, "key"))
    some = shared.where(F.col("n") <= bucket).select("key", "place", "fp")
    other = some.select("key", F.col("fp").alias("fp2"))
    diff = F.col("fp").bitwiseXOR(F.col("fp2"))
    # Differences from segment `start` on: rotate, then keep the first l segments.
    turned = F.expr("(shiftleft(fp ^ fp2, cast(8 * (place div 2) as int)) | IF(place < 2, 0L, shiftrightunsigned(fp ^ fp2, cast(64 - 8 * (place div 2) as int))))")
    chain = [F.bit_count(F.shiftrightunsigned(turned, 64 - 8 * n)) <= n * BITS // SEGMENTS for n in range(4, SEGMENTS)]
    budget = chain[0]
    for c in chain[1:]:
        budget = budget & c
    pairs = some.join(other, "key").where((F.col("fp") < F.col("fp2")) & budget & (F.bit_count(diff) <= BITS))
    close = pairs.select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    crowd = shared.where(F.col("n") > bucket).select("fp").distinct()
    middles = crowd.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])).alias("middle"))
    hubs = middles.groupBy("middle").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = middles.join(hubs, "middle").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return close.unionByName(stars).distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: Column | None = None) -> DataFrame:
    """(doc_id, h, root) of every row: rows of equal root are one component. h is `extra`, a long, or null."""
    marked = stored(fingerprints(docs, id_col, text_col, extra=extra))
    named = _components_of(stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least"))))
    return marked.join(named.select("fp", "root"), "fp").select("doc_id", "h", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Fingerprint and component of every document: (doc_id, fp, component_id).

    Fingerprints link at two or fewer differing bits; a component is named by its smallest
    id. Letters A to Z are lowered; words are `[^\\x20\\x09-\\x0D]+`; fewer words than a shingle
    are one shingle; no words give fingerprint 0, linked like any other. One row per input
    row, repeated rows included. Null ids are kept and name a component only if it has no
    other, then with null. An empty table gives an empty table; other columns are ignored.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle, seed))
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    named = _components_of(prints)
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(names, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that are the smallest of their component: least id, null last, then least hash of the text.

    Of rows that share id and text one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("h").alias("h"))
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    marked = stored(fingerprints(slim, "doc_id", "text", extra=F.xxhash64("text")))
    prints = stored(marked.groupBy("fp").agg(F.min(key).alias("least")))
    first = _components_of(prints).groupBy("root").agg(F.min("least").alias("least"))
    first = first.select(F.col("least.id").alias("__id"), F.col("least.h").alias("__h"))
    own = docs.withColumn("__hash", F.xxhash64(text))
    kept = own.join(first, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h")), "left_semi")
    return kept.dropDuplicates([id_col, "__hash"]).select(*docs.columns)

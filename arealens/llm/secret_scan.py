"""Secret scans: passwords, keys and tokens in texts.

Method: one Aho-Corasick automaton over all keywords passes over a text once. A kind without
a keyword (hex runs) is prefiltered by its shape instead: a run of the class as long as
its least match. Regular expressions are tried only at the places of such hits, anchored
there, from left to right, which gives the same matches as a search of the whole text,
since every match starts with a keyword or a run. Kinds with an embedded checksum are kept only
where it holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.llm.common import chunked

SPAN = "array<struct<kind:string,start:long,end:long>>"

# Alphabets of the two checksummed encodings, and the check polynomial of the second.
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = b"QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_token(match: re.Match[bytes]) -> bool:
    """Thirty random characters, then their CRC-32 as six digits to the base 62."""
    body = match[1]
    if len(body) != 36:
        return False
    value = 0
    for c in body[30:]:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body[:30])


def bech32_key(match: re.Match[bytes]) -> bool:
    """An encoded key of 58 characters whose last six are the checksum over the readable part and the rest."""
    if len(match[1]) != 58 or any(c not in BECH32 for c in match[1]):
        return False
    human = match[0][:match.start(1) - match.start() - 1].lower()
    values = [c >> 5 for c in human] + [0] + [c & 31 for c in human] + [BECH32.index(c) for c in match[1]]
    check = 1
    for v in values:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ v
        for i, step in enumerate(BECH32_STEPS):
            if top >> i & 1:
                check ^= step
    return check == 1


@dataclass(frozen=True)
class Kind:
    """A kind of secret: keywords in lower case, or a class of bytes and its shortest run; a pattern; a check of its match."""

    name: str
    pattern: bytes
    keep: Callable[[re.Match[bytes]], bool]
    keywords: tuple[str, ...] = ()
    run: tuple[bytes, int] | None = None
    any_case: bool = False


BASE = (
    Kind("assign", rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8,
         ("password", "passwd", "secret", "token", "apikey", "api_key"), any_case=True),
    Kind("access", rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16, ("akia",)),
    Kind("hex", rb"[0-9a-f]+", lambda m: len(m[0]) >= 32, run=(b"0123456789abcdef", 32)),
)
ADDED = (
    Kind("hosting", rb"gh[pousr]_([0-9A-Za-z]+)", crc_token, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Kind("registry", rb"npm_([0-9A-Za-z]+)", crc_token, ("npm_",)),
    Kind("agekey", rb"AGE-SECRET-KEY-1([0-9A-Z]+)", bech32_key, ("age-secret-key-1",)),
)


class Scanner:
    """Finds all kinds in texts, given as bytes; built once per task."""

    def __init__(self, kinds: tuple[Kind, ...]):
        import ahocorasick

        self.kinds = kinds
        self.patterns = [re.compile(k.pattern, re.I if k.any_case else 0) for k in kinds]
        owners: dict[str, list[int]] = {}
        for i, kind in enumerate(kinds):
            for word in kind.keywords:
                owners.setdefault(word, []).append(i)
        self.automaton = ahocorasick.Automaton() if owners else None
        for word, own in owners.items():
            self.automaton.add_word(word, (len(word), own))
        if owners:
            self.automaton.make_automaton()
        self.shapes = []
        for i, kind in enumerate(kinds):
            if kind.run:
                marks = bytes(1 if c in kind.run[0] else 0 for c in range(256))
                self.shapes.append((i, marks, b"\1" * kind.run[1]))

    def hits(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place, kind) where a match may start, ascending for each kind."""
        if self.automaton:
            # One character per byte, so that places are places in the bytes.
            found = [(end - size + 1, i) for end, (size, own) in self.automaton.iter(text.lower().decode("latin-1")) for i in own]
            yield from sorted(found)
        for i, marks, run in self.shapes:
            shape = text.translate(marks)
            at = shape.find(run)
            while at >= 0:
                yield at, i
                end = shape.find(b"\0", at)
                at = shape.find(run, end) if end >= 0 else -1

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, kind, end) in bytes, sorted: leftmost matches of each kind that do not overlap, less those that fail their check."""
        free = [0] * len(self.kinds)
        out = []
        for at, i in self.hits(text):
            if at < free[i]:
                continue
            match = self.patterns[i].match(text, at)
            if match:
                free[i] = match.end()
                if self.kinds[i].keep(match):
                    out.append((at, i, match.end()))
        return sorted(out)


def code_points(text: bytes, places: list[int]) -> list[int]:
    """Places in UTF-8 bytes as places in code points."""
    if not places or text.isascii():
        return places
    heads = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return [int(heads[p - 1]) if p else 0 for p in places]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Kind, ...] = BASE,
                 added: tuple[Kind, ...] = ADDED) -> DataFrame:
    """Secrets in each text: (doc_id, base, spans), arrays of (kind, start, end) in code points, end exclusive.

    `base` holds the spans of the base kinds, `spans` those of all kinds, both by start, then
    by the order of the kinds. Spans of different kinds may overlap. Null and empty texts give
    empty arrays. One row per input row, so repeated rows and rows sharing an id each get
    theirs; ids may be null. An empty table gives an empty table; other columns are ignored.
    A task holds one text and its places at a time, besides an Arrow batch.
    """
    kinds = (*base, *added)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(kinds)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(kind)), ("spans", pa.list_(kind))])
        for ids, texts in chunked(batches):
            first, every = [], []
            for text in texts:
                found = scanner.spans(text) if text else []
                places = code_points(text or b"", [p for start, _, end in found for p in (start, end)])
                rows = [{"kind": kinds[i].name, "start": a, "end": b} for (_, i, _), a, b in zip(found, places[::2], places[1::2])]
                every.append(rows)
                first.append([r for r, (_, i, _) in zip(rows, found) if i < len(base)])
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "base": first, "spans": every}, schema=schema)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(scan, f"doc_id long, base {SPAN}, spans {SPAN}")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kinds: tuple[Kind, ...]) -> DataFrame:
    """(doc_id, text) with each maximal run of overlapping secrets replaced by `[secret]`; null texts stay null."""
    chosen = (*kinds.get("base", BASE), *kinds.get("added", ADDED))

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for ids, texts in chunked(batches):
            out = []
            for text in texts:
                pieces, at = [], 0
                for start, _, end in scanner.spans(text) if text else []:
                    if start >= at:
                        pieces += [text[at:start], b"[secret]"]
                    at = max(at, end)
                out.append(None if text is None else b"".join([*pieces, text[at:]]))
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(out, pa.binary())})

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(clean, "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))

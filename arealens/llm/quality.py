"""Quality classifier learnt from trusted positives and unlabelled web text.

Method: positive-unlabelled learning. A first model tells the trusted positives from the
unlabelled; the class prior is the least ratio, over thresholds, of the share of unlabelled
to the share of positive rows above it. The final model minimises the non-negative unbiased
risk: the prior times the positives' loss as positive, plus the unlabelled rows' loss as
negative less the prior times the positives' loss as negative, where a term below zero is
turned round. Scores are calibrated by the ratio of positive to unlabelled rows at a score.
Rows labelled 0 are never used as such.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.llm.common import chunked

POSITIVES = 5_000
UNLABELLED = 10_000
SHAPES = 512
BINS = 12
FOLDS = 5
THRESHOLD = 0.3

#: Letters of a word's shape: upper, lower, digit, a byte of a longer letter, else the byte itself.
SHAPE_OF = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else 32 if b in b" \t\n\v\f\r" else b
                 for b in range(256))
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
UPPER, DIGITS, SPACES = bytes(range(65, 91)), bytes(range(48, 58)), b" \t\n\v\f\r"
STATS = 9
CROSS = 4


def measures(text: bytes | None) -> tuple[list[float], dict[int, float]]:
    """A text's statistics and the shares of its word shapes, hashed into `SHAPES` places."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * STATS, {}
    size = len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = size - len(text.translate(None, LETTERS))
    upper = size - len(text.translate(None, UPPER))
    digits = size - len(text.translate(None, DIGITS))
    blank = size - len(text.translate(None, SPACES))
    times = Counter(words)
    beside = sum(map(bytes.__eq__, words, words[1:]))
    stats = [
        np.log(n), len(times) / n ** 0.75, max(times.values()) / n, beside / n, upper / max(letters, 1), digits / size,
        (size - letters - digits - blank) / size, letters / n, 1 - len(set(lines)) / max(len(lines), 1),
    ]
    shape = np.frombuffer(text.translate(SHAPE_OF), np.uint8)
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    shares: dict[int, float] = {}
    for word, count in Counter(shape[keep].tobytes().split()).items():
        place = zlib.crc32(word) % SHAPES
        shares[place] = shares.get(place, 0.0) + count / n
    return [float(s) for s in stats], shares


@dataclass(frozen=True)
class Model:
    """Edges of the statistics' bins, weights of bins and shapes, bias, estimated prior, and the calibration's knots."""

    edges: np.ndarray
    bins: np.ndarray
    shapes: np.ndarray
    bias: float
    prior: float
    knots: np.ndarray
    chances: np.ndarray

    def score(self, text: bytes | None) -> float:
        """Chance of a positive: mostly the calibrated one, a little the logistic one, which orders rows between knots."""
        z = self.logit(text)
        return float(0.98 * np.interp(z, self.knots, self.chances) + 0.02 * _sigmoid(z))

    def logit(self, text: bytes | None) -> float:
        stats, shares = measures(text)
        z = self.bias
        for i, value in enumerate(stats):
            z += self.bins[i, np.searchsorted(self.edges[i], value, "right")]
        for place, share in shares.items():
            z += self.shapes[place] * share ** 0.5
        return float(z)


def _descend(x: np.ndarray, risk: object, steps: int, rate: float = 0.05, decay: float = 3e-4) -> np.ndarray:
    """Weights after Adam steps along `risk`, which maps scores to the gradient by score."""
    w = np.zeros(x.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = x.T @ risk(x @ w) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.1) -> float:
    """Share of positives among the unlabelled: least ratio of the shares above a threshold that `least` of the positives pass."""
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 91))
    above_p = np.array([(positive >= c).mean() for c in cuts])
    above_u = np.array([(unlabelled >= c).mean() for c in cuts])
    slack = 1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled))
    return float(np.clip(((above_u + 0.5 * slack) / above_p).min(), 0.02, 0.98))


def calibrate(positive: np.ndarray, unlabelled: np.ndarray, prior: float, bins: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Chance of a positive by score: prior times the ratio of the rows' shares in bins of equal unlabelled share, made monotone."""
    cuts = np.quantile(unlabelled, np.linspace(0, 1, bins + 1))
    inner = cuts[1:-1]
    of_u = np.bincount(np.searchsorted(inner, unlabelled, "right"), minlength=bins) / max(len(unlabelled), 1)
    of_p = np.bincount(np.searchsorted(inner, positive, "right"), minlength=bins) / max(len(positive), 1)
    pools: list[list[float]] = []  # positive mass, unlabelled mass, bins
    for a, b in zip(prior * of_p, of_u):
        pools.append([a, b, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            top = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], top)]
    chances = np.concatenate([np.full(int(n), min(a / b, 1.0) if b else float(a > 0)) for a, b, n in pools])
    return (cuts[:-1] + cuts[1:]) / 2, chances


def fit(stats: np.ndarray, shares: list[dict[int, float]], positive: np.ndarray, ids: np.ndarray, steps: int = 300) -> Model:
    """A model from a bounded sample in memory; `positive` marks the trusted rows, and a document may stand on both sides."""
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    x = np.zeros((len(stats), 1 + STATS * BINS + SHAPES))
    x[:, 0] = 1
    rows = np.arange(len(stats))
    for i in range(STATS):
        x[rows, 1 + i * BINS + np.searchsorted(edges[i], stats[:, i], "right")] = 1
    for r, own in enumerate(shares):
        for place, share in own.items():
            x[r, 1 + STATS * BINS + place] = share ** 0.5
    p, u = positive, ~positive
    np_, nu = max(p.sum(), 1), max(u.sum(), 1)

    # Each row is scored by a first model that has not seen it, lest trusted rows look apart for being known.
    first = np.zeros(len(x))
    fold = np.unique(ids, return_inverse=True)[1] % CROSS
    for k in range(CROSS):
        seen = fold != k
        weight = np.where(p, 0.5 / max((p & seen).sum(), 1), 0.5 / max((u & seen).sum(), 1))[seen]
        first[~seen] = x[~seen] @ _descend(x[seen], lambda z: (_sigmoid(z) - p[seen]) * weight, steps // 3, decay=1e-3)  # noqa: B023
    prior = estimate_prior(first[p], first[u])

    def risk(z: np.ndarray) -> np.ndarray:
        as_negative = np.logaddexp(0, z)
        rest = as_negative[u].mean() - prior * as_negative[p].mean()
        s = _sigmoid(z)
        as_positive = np.where(p, prior * (s - 1) / np_, 0)
        negative = np.where(u, s / nu, -prior * s / np_)
        return as_positive + negative if rest >= 0 else -negative

    w = _descend(x, risk, steps)
    z = x @ w
    return Model(edges, w[1:1 + STATS * BINS].reshape(STATS, BINS), w[1 + STATS * BINS:], float(w[0]), prior, *calibrate(z[p], z[u], prior))


def held_out(id_col: str, folds: int = FOLDS) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is divisible by `folds`. A null id is kept from it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % folds == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """Fit a model on a sample of at most `positives` rows labelled 1 and `unlabelled` rows of any or no label.

    The sample takes the rows with the smallest hashes of the id. Of several labels of one id
    the least counts; null labels are none. The unlabelled side is drawn from all training rows,
    so a trusted row may stand on both sides and nothing depends on how many rows lack a label.
    Without trusted positives there is no model: None.
    """
    learn = ~held_out(id_col)
    known = labels.where(F.col(label_col).isNotNull() & learn).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).alias("y"))
    ids = docs.where(learn).select(F.col(id_col).cast("long").alias("id"))
    mark = F.xxhash64("id")
    trusted = known.where("y = 1").select("id").join(ids, "id", "left_semi").orderBy(mark, "id").limit(positives)
    others = ids.orderBy(mark, "id").limit(unlabelled)
    sample = [(r["id"], True) for r in trusted.collect()]
    if not sample:
        return None
    chosen = set(sample) | {(r["id"], False) for r in others.collect()}
    # At most positives + unlabelled ids, so the broadcast is bounded by the parameters.
    wanted = docs.sparkSession.createDataFrame(sorted(chosen), "id long, trusted boolean")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for marks, texts, keys in chunked(batches, 1):
            found = [measures(t) for t in texts]
            yield pa.RecordBatch.from_pydict({
                "trusted": pa.array(marks, pa.bool_()), "id": pa.array(keys, pa.int64()), "stats": pa.array([f[0] for f in found], pa.list_(pa.float64())),
                "places": pa.array([list(f[1]) for f in found], pa.list_(pa.int32())),
                "shares": pa.array([list(f[1].values()) for f in found], pa.list_(pa.float64()))})

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = slim.join(F.broadcast(wanted), "id").select("trusted", "text", "id").mapInArrow(
        measure, "trusted boolean, id long, stats array<double>, places array<int>, shares array<double>")
    # Repeated rows of a sampled id must not grow the sample.
    rows = sorted(rows.dropDuplicates(["id", "trusted"]).collect(), key=lambda r: (r["id"], r["trusted"]))
    return fit(np.array([r["stats"] for r in rows]), [dict(zip(r["places"], r["shares"])) for r in rows],
               np.array([r["trusted"] for r in rows]), np.array([r["id"] for r in rows]))


def score(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add the score of each row's whole text, from 0 to 1, as column `out`, which replaces one of that name.

    Null, empty and blank texts are scored alike, as texts without words. Without a model
    every score is 0.5.
    """
    if model is None:
        return docs.withColumn(out, F.lit(0.5))

    @F.pandas_udf("double")
    def scored(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([model.score(t.encode("utf-8", "surrogatepass") if t else None) for t in texts], dtype="float64")

    return docs.withColumn(out, scored(F.col(text_col).cast("string")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Train and score: (doc_id, held_out, score, predicted), one row per input row."""
    scored = score(docs, train(docs, labels, id_col, text_col), text_col, "__score")
    return scored.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= threshold).cast("int").alias("predicted"))

"""Quality scores by Bradley-Terry pairwise ranking.

Labelled rows give preference pairs (a good text before a bad one). The score is
linear in the text's features; its weights minimise the logistic loss of the
feature differences over the pairs. The cut is the quantile of the scores of all
labelled rows at the share of bad labels, so the probability passes one half there.

The weights are fitted on at most ``sample`` labelled rows, chosen by the hash of
the id, and ``pairs`` random pairs of them, a good one before a bad one (documented
bounds: the rows' features, some forty numbers each, go to the driver). The cut
counts every labelled row, by a distributed sort. Scoring covers every row by its
text alone.

Defined results: a null text counts as empty; empty texts have features of zero
and a score like any other; labels other than 0 and 1, null ids and ids without
text don't teach; an id with several texts teaches by the one with the least
hash; with labels of one class only, scores rest on no weights and every text
gets that class. Repeated rows score alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, marked_texts, ordered, sigmoid, slices, text_bytes

SAMPLE = 20_000
PAIRS = 60_000

_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_STOP = b".,;:?'\"()-"
_SPACE = b" \t\n\v\f\r"
_HIGH = bytes(range(128, 256))
_OTHER = bytes(c for c in range(33, 127) if c not in _LOWER + _UPPER + _DIGIT + _STOP)
_LETTER = _LOWER + _UPPER + _HIGH
CLASSES = (_LOWER, _UPPER, _DIGIT, _STOP, _OTHER, _HIGH)


def features(text: bytes) -> list[float]:
    """Shape of a text: character classes, words, repetition, lines."""
    size = len(text)
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 19
    count = [size - len(text.translate(None, c)) for c in CLASSES]
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = text.count(b".") + text.count(b"?")
    per = 1.0 / size
    different = len(set(words))
    return [c * per for c in count] + [
        np.log1p(n), size / n, different / n, np.log(different) / np.log(n + 1.0), len(set(zip(words, words[1:]))) / n,
        sum(map(eq, words, words[1:])) / n, ends / n, len(lines) / n, len(set(lines)) / max(1, len(lines)),
        float(n < 20), len([w for w in words if w[-1] not in _LETTER]) / n,
        len([w for w in words if len(w) == 1]) / n, max(map(len, words)) / 20.0 if n else 0.0]


def expand(x: np.ndarray) -> np.ndarray:
    """Features with their square roots: shares near zero matter most."""
    return np.hstack([x, np.sqrt(np.maximum(x, 0.0))])


@dataclass
class Ranking:
    """Weights of standardised features and the cut between the classes."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((expand(x) - self.mean) / self.scale, -8.0, 8.0) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x) - self.cut)


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = 17) -> Ranking:
    """Bradley-Terry weights from labelled feature rows (Newton steps on the mean logistic loss of pair differences)."""
    z = expand(x) if len(x) else np.zeros((0, 38))
    mean, scale = (z.mean(axis=0), z.std(axis=0) + 1e-6) if len(z) else (np.zeros(z.shape[1]), np.ones(z.shape[1]))
    weights = np.zeros(z.shape[1])
    yes, no = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(yes) or not len(no):
        return Ranking(mean, scale, weights, -1.0 if len(yes) else 1.0)
    z = np.clip((z - mean) / scale, -8.0, 8.0)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(yes, pairs)] - z[rng.choice(no, pairs)]
    for _ in range(25):
        p = sigmoid(-(d @ weights))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(weights)), d.T @ p / pairs - ridge * weights)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    ranks = np.sort(z @ weights)
    k = len(no)                                              # the quantile at the share of bad labels
    cut = float((ranks[k - 1] + ranks[k]) / 2)
    return Ranking(mean, scale, weights, cut)


def features_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def shape(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in slices(texts):
            yield pa.array([features(b) for b in text_bytes(column)], pa.list_(pa.float64()))

    return shape(text)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", pairs: int = PAIRS) -> Ranking:
    """Weights from at most ``sample`` rows of ``labels`` (the smallest hashes of their ids), the cut from all of them."""
    marks = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    marked = durable(marked_texts(docs, marks, doc_id, text, features_column).withColumnRenamed("t", "x"))
    rows = marked.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "y").limit(sample).collect()
    rows.sort(key=lambda r: (r.id, r.y))
    x = np.asarray([r.x for r in rows], dtype=np.float64).reshape(len(rows), 19)
    model = fit_pairs(x, np.asarray([r.y == 1 for r in rows], dtype=bool), pairs)
    if not model.weights.any():
        return model
    bad = marked.where("y = 0").count()
    low, high = order_statistics(marked.select(raw_column(F.col("x"), model).alias("s")), [bad, bad + 1])
    return replace(model, cut=(low + high) / 2)


def order_statistics(scores: DataFrame, ranks: list[int]) -> list[float]:
    """The scores (column s) at ``ranks``, from 1: distinct scores sorted by ranges, one total per range to the driver."""
    rows = ordered(scores.groupBy("s").agg(F.count("*").alias("n")), "s")
    totals = sorted((r["_part"], r.n) for r in rows.groupBy("_part").agg(F.sum("n").alias("n")).collect())
    before, out = 0, {}
    for part, n in totals:
        inside = [r for r in ranks if before < r <= before + n]
        if inside:
            upto = F.sum("n").over(Window.partitionBy("_part").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)) + F.lit(before)
            run = rows.where(F.col("_part") == part).select("s", upto.alias("upto"))
            for r in inside:
                out[r] = run.where(F.col("upto") >= r).agg(F.min("s")).first()[0]
        before += n
    return [out[r] for r in ranks]


def raw_column(x: Column, model: Ranking) -> Column:
    """Raw scores of a column of features."""
    @F.arrow_udf("double")
    def ranked(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in slices(rows):
            yield pa.array(model.raw(np.asarray(column.to_pylist(), dtype=np.float64).reshape(len(column), 19)))

    return ranked(x)


def score(text: Column, model: Ranking) -> Column:
    """Score column, 0 to 1; one half and above means good."""
    @F.arrow_udf("double")
    def ranked(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in slices(texts):
            x = np.asarray([features(b) for b in text_bytes(column)], dtype=np.float64).reshape(len(column), 19)
            yield pa.array(model.score(x))

    return ranked(text)


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 when divided by 3 (a null id counts as the text '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1

"""Toxicity by a classifier chain.

The labels mark toxicity as a whole. Its categories are found in the labelled
rows: features (whole words and word beginnings) that mark toxic texts are
gathered into families around the ones that cover most of them, greedily; a text
belongs to a family if it is marked toxic and holds one of its features. The
chain predicts the families one after the other and toxicity as a whole at the
end; every link is a ridge logistic model on the feature counts and the
probabilities of all earlier links. Later links learn from out-of-fold
probabilities of the earlier ones, so they see them as they will be on new texts:
for each of ``FOLDS`` folds the ``CHOSEN`` features, the families and the links are
found in the other folds alone, and a fold's family stands for the family of the
whole with which it shares most features (one that has no such partner is
predicted to be absent).

Fitting uses at most ``sample`` labelled rows, chosen by the hash of the id (a
documented bound: their counts of the chosen features go to the driver). Scoring
covers every row, whole texts.

Defined results: a null text counts as empty; a text without any chosen feature
has the base probabilities; labels other than 0 and 1, null ids and ids without
text don't teach; an id with several texts teaches by the one with the least
hash; without a labelled toxic row there are no families and the
probability is that of the labels seen. Repeated rows score alike; extra columns
are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, marked_texts, sigmoid, slices, text_bytes

SAMPLE, CHOSEN, FAMILIES, FOLDS = 9000, 600, 5, 5
BEGINNINGS = (4, 5, 6)

_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased words: letters, digits and all non-ASCII."""
    return text.translate(_FOLD).split()


def features(word: bytes) -> list[bytes]:
    """A word as a whole and its beginnings."""
    return [b"=" + word, *(word[:k] for k in BEGINNINGS if len(word) > k)]


@dataclass
class Chain:
    """Chosen features, families and the links' weights (features, earlier probabilities, constant)."""

    chosen: list[bytes]
    families: list[list[bytes]] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        self.place = {f: i for i, f in enumerate(self.chosen)}
        short = BEGINNINGS[0]
        self.starts = {f[1:][:short] if f[:1] == b"=" else f[:short] for f in self.chosen}

    def counts(self, text: bytes) -> dict[int, int]:
        found: dict[int, int] = {}
        starts, place, short = self.starts, self.place, BEGINNINGS[0]
        for w in words(text):
            if w[:short] in starts:
                for f in features(w):
                    i = place.get(f)
                    if i is not None:
                        found[i] = found.get(i, 0) + 1
        return found

    def rows(self, counts: list[dict[int, int]]) -> np.ndarray:
        x = np.zeros((len(counts), len(self.chosen)))
        for r, c in enumerate(counts):
            for i, n in c.items():
                x[r, i] = np.log1p(n)
        return x

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(rows, links): the families' probabilities, then the whole's."""
        earlier = np.zeros((len(x), 0))
        for w in self.links:
            p = sigmoid(np.hstack([x, earlier]) @ w[:-1] + w[-1])
            earlier = np.hstack([earlier, p[:, None]])
        return earlier


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Ridge logistic weights by Newton steps; the constant comes last and is hardly held back.

    Equal rows (most texts hold none of the features) are one row with its number and its marks.
    """
    place: dict[bytes, int] = {}
    group = np.asarray([place.setdefault(r.tobytes(), len(place)) for r in np.ascontiguousarray(x)], dtype=np.int64)
    first = np.unique(group, return_index=True)[1] if len(x) else group
    a = np.hstack([x[first], np.ones((len(first), 1))])
    n, marks = np.bincount(group, minlength=len(a)).astype(float), np.bincount(group, weights=y, minlength=len(a))
    hold = np.full(a.shape[1], ridge)
    hold[-1] = 1e-2
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (n * (p * (1 - p) + 1e-6))[:, None]).T @ a + np.diag(hold), a.T @ (marks - n * p) - hold * w)
        w += step
        if np.abs(step).max() < 1e-5:
            break
    return w


def find_families(x: np.ndarray, y: np.ndarray, count: int, precision: float = 0.9, least: int = 3) -> list[list[int]]:
    """Families of feature places, around the features that cover most toxic rows not yet covered."""
    has = x > 0
    toxic = has[y == 1]
    support = toxic.sum(axis=0)
    sure = np.flatnonzero((support >= least) & (support >= precision * has.sum(axis=0)))
    seeds: list[int] = []
    open_ = np.ones(len(toxic), dtype=bool)
    while len(seeds) < count and len(sure):
        gain = toxic[open_][:, sure].sum(axis=0)
        if not len(gain) or gain.max() < max(least, 0.01 * len(toxic)):
            break
        seeds.append(int(sure[np.argmax(gain)]))
        open_ &= ~toxic[:, seeds[-1]]
    families: list[list[int]] = [[s] for s in seeds]
    for f in sure if seeds else []:
        if f not in seeds:
            both = (toxic[:, seeds] & toxic[:, [f]]).sum(axis=0)
            share = both / np.maximum(1, support[seeds] + support[f] - both)
            if share.max() > 0:
                families[int(np.argmax(share))].append(int(f))
    return families


def _partner(group: list[int], others: list[list[int]]) -> list[int]:
    """The family among ``others`` that shares the greatest part of its features with ``group``; none without a shared one."""
    mine = set(group)
    share = [len(mine & set(o)) / len(mine | set(o)) for o in others]
    return others[int(np.argmax(share))] if share and max(share) > 0 else []


def _marks(x: np.ndarray, y: np.ndarray, group: list[int]) -> np.ndarray:
    return y * (x[:, group] > 0).any(axis=1)


def fit_chain(chosen: list[bytes], counts: list[dict[int, int]], y: np.ndarray, fold: np.ndarray, families: int = FAMILIES,
              use: list[int] | None = None, inside: dict[int, list[int]] | None = None) -> Chain:
    """Links in order, each on features and the out-of-fold probabilities of the earlier links.

    ``counts`` go by places in ``chosen``; the chain reads the places in ``use`` and what a fold's
    models read is in ``inside`` (features chosen without that fold); both are all places by default.
    """
    x = Chain(chosen).rows(counts)
    use = list(range(len(chosen))) if use is None else use
    groups = [[use[i] for i in g] for g in find_families(x[:, use], y, families)] if len(y) else []
    chain = Chain([chosen[i] for i in use])
    chain.families = [[chosen[i] for i in g] for g in groups]
    out = np.zeros((len(y), len(groups) + 1))
    for f in np.unique(fold):
        rest, own = fold != f, use if inside is None else inside[int(f)]
        if not rest.any():                                  # all in one fold: there is nothing else to learn from
            rest = np.ones(len(y), dtype=bool)
        found = [[own[i] for i in g] for g in find_families(x[rest][:, own], y[rest], families)]
        given, mine = x[rest][:, own], x[fold == f][:, own]
        for k, target in enumerate([_marks(x[rest], y[rest], _partner(g, found)) for g in groups] + [y[rest]]):
            w = logistic(given, target)
            held = sigmoid(mine @ w[:-1] + w[-1])
            out[fold == f, k] = held
            given = np.hstack([given, sigmoid(given @ w[:-1] + w[-1])[:, None]])
            mine = np.hstack([mine, held[:, None]])
    for k, target in enumerate([_marks(x, y, g) for g in groups] + [y]):
        given = np.hstack([x[:, use], out[:, :k]])
        chain.links.append(logistic(given, target) if len(y) else np.zeros(given.shape[1] + 1))
    return chain


def choose_features(taught: DataFrame, count: int, folds: int = FOLDS) -> tuple[list[bytes], dict[int, list[bytes]]]:
    """The features whose presence tells most about the mark (log-likelihood ratio), leaning to toxic texts.

    Of all rows (y, t, fold), and for every fold of the rows outside it.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_, toxic = Counter(), Counter()
        for batch in batches:
            for y, text, fold in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                found = {(fold, f) for w in set(words(text)) for f in features(w)}
                all_.update(found)
                if y:
                    toxic.update(found)
        names = list(all_)
        for i in range(0, len(names), 50_000):
            some = names[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([f for _, f in some], pa.binary()), pa.array([n for n, _ in some], pa.int32()),
                                              pa.array([toxic[f] for f in some], pa.int64()), pa.array([all_[f] for f in some], pa.int64())],
                                             names=["f", "fold", "a", "k"])

    sizes = {r.fold: (r.n1, r.n) for r in taught.groupBy("fold").agg(F.sum("y").alias("n1"), F.count("*").alias("n")).collect()}
    seen = taught.select("y", "t", "fold").mapInArrow(counted, "f binary, fold int, a long, k long")
    per = [F.sum(F.when(F.col("fold") == j, F.col(c)).otherwise(0)).alias(f"{c}{j}") for j in range(folds) for c in ("a", "k")]
    seen = durable(seen.groupBy("f").agg(F.sum("a").alias("a"), F.sum("k").alias("k"), *per).where("a >= 3"))

    def best(left_out: int | None) -> list[bytes]:
        n1 = float(sum(v[0] for j, v in sizes.items() if j != left_out))
        n = float(sum(v[1] for j, v in sizes.items() if j != left_out))
        if not n1 or n1 == n:
            return []
        a, k = (F.col(c) if left_out is None else F.col(c) - F.col(f"{c}{left_out}") for c in ("a", "k"))
        part = lambda o, e: F.when(o > 0, o * F.ln(o / e)).otherwise(0.0)       # noqa: E731
        ratio = (part(a, k * n1 / n) + part(k - a, k * (n - n1) / n) + part(n1 - a, (n - k) * n1 / n)
                 + part(n - n1 - (k - a), (n - k) * (n - n1) / n))
        leaning = seen.where((a >= 3) & (a * n > k * n1))
        return [bytes(r.f) for r in leaning.select("f", ratio.alias("r")).orderBy(F.desc("r"), "f").limit(count).collect()]

    return best(None), {j: best(j) for j in sorted(sizes)}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Chain:
    """Learn from at most ``sample`` rows of ``labels`` (the smallest hashes of their ids) and one text each in ``docs``."""
    taken = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
             .orderBy(F.xxhash64(F.col("id").cast("string")), "id", "y").limit(sample))
    fold = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("fold")), F.lit(FOLDS)).cast("int")
    taught = durable(marked_texts(docs, F.broadcast(taken), doc_id, text).select("id", "y", "t", fold.alias("fold")))
    whole, without = choose_features(taught, CHOSEN)
    chosen = sorted(set(whole).union(*without.values()))
    lookup = Chain(chosen)

    @F.arrow_udf("map<int,int>")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in slices(texts):
            yield pa.array([list(lookup.counts(b).items()) for b in text_bytes(column)], pa.map_(pa.int32(), pa.int32()))

    rows = taught.select("id", "y", count("t").alias("c"), "fold").collect()
    rows.sort(key=lambda r: (r.id, r.y))
    places = {j: [lookup.place[f] for f in names] for j, names in without.items()}
    return fit_chain(chosen, [r.c for r in rows], np.asarray([r.y for r in rows], dtype=np.float64), np.asarray([r.fold for r in rows]),
                     use=[lookup.place[f] for f in whole], inside=places)


def score(text: Column, chain: Chain) -> Column:
    """Column of the chain's probabilities: one per family, toxicity as a whole last."""
    @F.arrow_udf("array<double>")
    def toxic(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in slices(texts):
            counts = [chain.counts(b) for b in text_bytes(column)]
            p = np.vstack([chain.probabilities(chain.rows(counts[i:i + 1024])) for i in range(0, len(counts), 1024)]) if counts else np.zeros((0, len(chain.links)))
            offsets = pa.array(np.arange(0, p.size + 1, p.shape[1] or 1, dtype=np.int32))
            yield pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(p).ravel()))

    return toxic(text)

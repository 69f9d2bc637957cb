"""What the classifiers' fits rest on, licence chains by brute force, vocabularies of one size."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm import license_scan, quality_rank, token_counts, toxicity
from riskframe.llm.common import marked_texts

from .conftest import frame

DOCS = "doc_id long, text string"


def test_one_text_per_labelled_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(2, None), (2, None), (None, "x"), (3, "")], DOCS)
    marks = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (2, 1), (9, 0)], "id long, y int")
    kept = lambda d: sorted(marked_texts(d, marks, "doc_id", "text").collect(), key=lambda r: (r.id, r.y))      # noqa: E731
    rows = kept(docs)
    assert sorted((r.id, r.y) for r in rows) == [(1, 0), (1, 1), (2, 1)]
    assert len({r.t for r in rows if r.id == 1}) == 1 and {r.t for r in rows if r.id == 2} == {None}
    assert rows == kept(docs.repartition(7, "text"))


def test_order_statistics(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.round(rng.normal(size=400), 1), np.full(300, 0.25), rng.normal(size=50)])
    scores = spark.createDataFrame([(float(v),) for v in values], "s double").repartition(5)
    ranks = [1, 2, 375, 376, 749, 750]
    assert quality_rank.order_statistics(scores, ranks) == [float(np.sort(values)[r - 1]) for r in ranks]


def test_cut_counts_all_labelled_rows(spark):
    rng = random.Random(2)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))      # noqa: E731
    good = [(i, " ".join(word(5) for _ in range(40)) + ".") for i in range(150)]
    bad = [(i, " ".join([word(2)] * 30)) for i in range(150, 220)]
    docs = spark.createDataFrame(good + bad, DOCS)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    model = quality_rank.fit(docs, labels, sample=40, pairs=2000)
    raw = np.sort(model.raw(np.asarray([quality_rank.features(t.encode()) for _, t in good + bad])))
    assert np.isclose(model.cut, (raw[69] + raw[70]) / 2, rtol=0, atol=1e-12)


def test_bradley_terry_minimum():
    """At the fitted weights the gradient of the pairs' mean logistic loss, with its ridge, is zero."""
    rng = np.random.default_rng(0)
    x, pairs, seed, ridge = rng.random((300, 19)), 4000, 17, 1e-3
    good = x[:, 3] + 0.5 * rng.random(300) > 0.7
    model = quality_rank.fit_pairs(x, good, pairs, ridge, seed)
    z = np.clip((quality_rank.expand(x) - model.mean) / model.scale, -8, 8)
    draw = np.random.default_rng(seed)
    d = z[draw.choice(np.flatnonzero(good), pairs)] - z[draw.choice(np.flatnonzero(~good), pairs)]
    slope = -(d * (1 / (1 + np.exp(d @ model.weights)))[:, None]).mean(axis=0) + ridge * model.weights
    assert np.abs(slope).max() < 1e-7


def test_links_are_logistic_minima():
    rng = np.random.default_rng(4)
    x = np.log1p(rng.poisson(0.4, (500, 6)))
    y = (x[:, 0] + 0.5 * rng.random(500) > 0.7).astype(float)
    w = toxicity.logistic(x, y, ridge=0.3)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.abs(x.T @ (y - p) - 0.3 * w[:-1]).max() < 1e-4 and abs((y - p).sum() - 1e-2 * w[-1]) < 1e-4


def test_features_are_chosen_outside_the_fold(spark):
    """A word that only one fold's toxic rows hold is no feature of the models that score that fold."""
    rows = [(1, f"bad thing {i}" + (" secretword" if i % 5 == 3 else ""), i % 5) for i in range(60)]
    rows += [(0, f"good thing {i}", i % 5) for i in range(90)]
    taught = spark.createDataFrame(rows, "y int, t string, fold int")
    whole, without = toxicity.choose_features(taught, 50)
    assert b"=secretword" in whole and b"=secretword" not in without[3] and sorted(without) == [0, 1, 2, 3, 4]
    assert all(b"=bad" in names and b"=secretword" in names for j, names in without.items() if j != 3)


def test_out_of_fold_families():
    """A fold's models see neither its rows' features nor its families."""
    rng = np.random.default_rng(1)
    chosen = [b"=a", b"=b", b"=c", b"=d"]
    counts = [{i: int(n) for i, n in enumerate(rng.poisson(0.5, 4)) if n} for _ in range(500)]
    y = np.asarray([float(0 in c or 1 in c) for c in counts])
    fold = np.arange(500) % 5
    inside = {j: [0, 1, 2] if j else [1, 2] for j in range(5)}
    chain = toxicity.fit_chain(chosen, counts, y, fold, use=[0, 1, 3], inside=inside)
    assert chain.chosen == [b"=a", b"=b", b"=d"] and {f for g in chain.families for f in g} <= set(chain.chosen)
    assert [len(w) for w in chain.links] == [3 + i + 1 for i in range(len(chain.links))]
    p = chain.probabilities(chain.rows([{0: 1}, {2: 1}, {}]))
    assert p[0, -1] > 0.5 > p[1, -1]
    assert toxicity._partner([1, 2], [[5], [2, 3], [1, 2, 9]]) == [1, 2, 9] and toxicity._partner([1], [[2]]) == []


def best_chain(run, length, skip):
    """Highest score over all chains, by trying every one."""
    best = 0.0

    def grow(k, value):
        nonlocal best
        best = max(best, value)
        for p in run[k + 1:]:
            q = run[k]
            new = p.end - p.start - max(0, q.end - p.start, q.t_end - p.t_start)
            if q.end < p.end and q.t_end < p.t_end and new > 0:
                grow(run.index(p), value + new - skip / length * max(0, p.start - q.end))

    for k, p in enumerate(run):
        grow(k, float(p.end - p.start))
    return best


def test_chains_score_best():
    rng = random.Random(8)
    for _ in range(150):
        templates = tuple((f"t{i}", " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 14)))) for i in range(3))
        library = license_scan.Library({}, templates, least=2, skip=4.0)
        text = [w for _ in range(4) for w in (*rng.choice(templates)[1].split()[rng.randint(0, 3):][:rng.randint(2, 7)], rng.choice("xya"))]
        seen = []
        library.chain = lambda m, keep=seen: keep.extend(m) or []
        library.scan(" ".join(text).encode())
        del library.chain
        spans = library.chain(seen)
        for t, run in library.pieces(seen).items():
            mine = [s for s in spans if s[0] == t]
            assert all(a[2] <= b[1] for a, b in zip(mine, mine[1:]))
            if len(set(run)) == len(run) <= 12:
                best = best_chain(run, library.lengths[t], library.skip)
                assert max(s[3] for s in mine) >= best - 1e-9
            for p in run:
                assert text[p.start:p.end] == templates[t][1].split()[p.t_start:p.t_end]


def test_foreign_and_repeated_words_leave_one_span():
    library = license_scan.Library(license_scan.PHRASES, license_scan.TEMPLATES)
    clause = license_scan.TEMPLATES[1][1].split()
    foreign = "nine words of another kind that stand right here".split()
    for text in (clause, clause[:26] + foreign + clause[26:], clause[:26] + clause[23:26] + clause[26:],
                 clause[:10] + foreign + clause[10:30] + ["x"] * 30 + clause[30:]):
        spans = [s for s in library.scan(" ".join(text).encode())[2] if s[3] / library.lengths[s[0]] >= library.cover]
        assert [library.labels[s[0]] for s in spans] == ["mit"] and spans[0][3] == library.lengths[spans[0][0]]
    twice = library.scan(" ".join(clause + ["z"] * 5 + clause).encode())[2]
    assert len(twice) == 2
    far = library.scan(" ".join(clause[:10] + ["z"] * 400 + clause[10:]).encode())[2]
    assert len(far) == 2


def test_vocabularies_of_one_size(spark):
    base = {bytes([b]): b for b in range(256)}
    one, two = {**base, b"ab": 256}, {**base, b"cd": 256}
    docs = frame(spark, [(1, "ab cd abab", "en", "a", 1)])
    count = lambda ranks: [(r.tokens,) for r in token_counts.attribute(docs, ranks, r"\S+|\s+").collect()]      # noqa: E731
    assert count(one) == [(7,)] and count(two) == [(9,)] and count(one) == [(7,)]

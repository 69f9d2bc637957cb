"""Quality ranking, toxicity chain and licence scan: brute force, held-out accuracy, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from riskframe.llm import license_scan, quality_rank, toxicity
from riskframe.llm.queries import QUERIES

from .conftest import clashing, frame

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def held_out_rows(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return QUERIES[query](spark, SF).where("held_out").join(labels, "doc_id").select("score", "predicted", F.col(label).alias("y")).toPandas()


def test_quality_on_held_out_rows(spark):
    r = held_out_rows(spark, "op6_quality", "quality")
    assert ((r.score >= 0.5).astype(int) == r.predicted).all() and r.score.between(0, 1).all()
    assert (r.predicted == r.y).mean() >= 0.97


def test_toxicity_on_held_out_rows(spark):
    """Few toxic rows at this size: clean rows stay clean, and toxic ones rank above them."""
    r = held_out_rows(spark, "op10_toxicity", "toxic")
    assert r.predicted[r.y == 0].mean() <= 0.01
    order = r.score.rank()
    n1, n0 = (r.y == 1).sum(), (r.y == 0).sum()
    assert (order[r.y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) >= 0.85


def test_pairs_learn_the_order():
    rng = np.random.default_rng(0)
    x = rng.random((400, 19))
    good = x[:, 3] + 0.2 * x[:, 5] > 0.5
    model = quality_rank.fit_pairs(x, good, pairs=5000)
    assert ((model.score(x) >= 0.5) == good).mean() > 0.95
    again = quality_rank.fit_pairs(x, good, pairs=5000)
    assert (again.weights == model.weights).all()
    assert (quality_rank.fit_pairs(x, np.ones(400, bool)).score(x) > 0.5).all()
    assert (quality_rank.fit_pairs(x[:0], good[:0]).score(x) < 0.5).all()


def test_models_on_odd_rows(spark, odd_docs):
    docs = clashing(frame(spark, odd_docs))
    labels = frame(spark, [(1, 1, 0), (2, 0, 1), (3, 0, None), (None, 1, 1), (5, None, 0), (5, 1, 1), (6, 7, 1), (99, 1, 1), (8, 0, 0)], LABELS)
    for given in (labels, labels.where("doc_id = 1"), labels.where("doc_id = -1")):
        model = quality_rank.fit(docs, given)
        chain = toxicity.fit(docs, given)
        rows = docs.select(quality_rank.score(F.col("text"), model).alias("q"), F.element_at(toxicity.score(F.col("text"), chain), -1).alias("t")).collect()
        assert len(rows) == len(odd_docs) and all(0 <= r.q <= 1 and 0 <= r.t <= 1 for r in rows)
    empty = docs.where("doc_id = -5")
    model, chain = quality_rank.fit(empty, labels), toxicity.fit(empty, labels)
    assert empty.select(quality_rank.score(F.col("text"), model), toxicity.score(F.col("text"), chain)).count() == 0


def test_chain_feeds_earlier_links():
    rng = np.random.default_rng(1)
    chosen = [b"=a", b"=b", b"=c"]
    counts = [{i: int(n) for i, n in enumerate(rng.poisson(0.5, 3)) if n} for _ in range(600)]
    y = np.asarray([float(0 in c or 1 in c) for c in counts])
    chain = toxicity.fit_chain(chosen, counts, y, np.arange(600) % 5)
    p = chain.probabilities(chain.rows(counts))
    assert len(chain.families) >= 1 and p.shape == (600, len(chain.families) + 1)
    assert [len(w) for w in chain.links] == [3 + i + 1 for i in range(len(chain.links))]
    assert ((p[:, -1] >= 0.5) == (y == 1)).mean() > 0.97


@pytest.fixture(scope="module")
def library():
    return license_scan.Library(license_scan.PHRASES, license_scan.TEMPLATES)


WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_places(text, phrases):
    w = brute_words(text)
    return sorted((k, i) for k, p in enumerate(phrases) for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def test_phrase_places(library):
    rng = random.Random(0)
    vocab = "gnu general public license apache cc by mit the of and this work is licensed under foo bar".split()
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += [" ".join(rng.choice([t for _, t in license_scan.TEMPLATES] + list(license_scan.PHRASES) + ["x"]) for _ in range(4)) for _ in range(200)]
    for t in texts:
        n, phrases, _ = library.scan(t.encode())
        assert n == len(brute_words(t)) and sorted(phrases) == brute_places(t, license_scan.PHRASES)
    nested = license_scan.Library({"b c": "x", "a b c": "y", "c": "z"}, (("t", "a b c d"),))
    for t in ("a b c d", "b c a b c", "c c b c", "d a b"):
        assert sorted(nested.scan(t.encode())[1]) == brute_places(t, nested.phrases)


def test_matching_statistics():
    rng = random.Random(3)
    templates = [[rng.choice("abc").encode() for _ in range(rng.randint(1, 12))] for _ in range(6)]
    machine = license_scan.Automaton(templates)
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for _ in range(200):
        text = [rng.choice("abcd").encode() for _ in range(30)]
        state = held = 0
        for i, w in enumerate(text):
            while state and w not in machine.next[state]:
                state = machine.link[state]
                held = machine.size[state]
            if w in machine.next[state]:
                state, held = machine.next[state][w], held + 1
            want = max((k for k in range(0, i + 2) if tuple(text[i + 1 - k:i + 1]) in runs), default=0)
            assert held == want
            for t, end in machine.ends[state]:
                assert not held or templates[t][end - held:end] == text[i + 1 - held:i + 1]


def test_spans_and_labels(spark, odd_docs, library):
    notice = license_scan.TEMPLATES[1][1]
    rows = [*odd_docs, (30, "x " * 50 + notice + " y", "en", "a", 1), (31, notice.replace("charge", "cost").replace("modify, ", ""), "en", "a", 1),
            (32, "the software and the license", "en", "a", 1), (33, "cc BY cc by", "en", "a", 1)]
    found = clashing(frame(spark, rows)).select("doc_id", "text", license_scan.scan(F.col("text"), library).alias("f"))
    got = {}
    for r in found.select("doc_id", "text", *[c.alias(n) for n, c in license_scan.digest(F.col("f"), library.cover).items()]).collect():
        places = brute_places(r.text, license_scan.PHRASES)
        starts = [i for _, i in places]
        assert r.n_words == len(brute_words(r.text)) and r.n_base == len(places)
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({list(license_scan.PHRASES.values())[k] for k, _ in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        got[r.doc_id] = r
    assert got[30].labels == "mit" and got[30].score == 1.0
    assert got[31].labels == "mit" and 0.8 < got[31].score < 1
    assert got[32].labels == "" and got[32].score < 0.5
    assert got[33].n_base == 2 and found.where("doc_id = -9").count() == 0

"""Distributed metrics vs brute-force loops, on random scores with many ties."""

from __future__ import annotations

import numpy as np
import pytest

import brute as B
from riskframe.operators import metrics as M


def _frame(spark, y, s, fold=None):
    rows = [(i, int(a), float(b), int(fold[i]) if fold is not None else 0) for i, (a, b) in enumerate(zip(y, s))]
    return spark.createDataFrame(rows, "row_id long, target int, score double, fold int")


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_ranking_metrics_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    n = 400
    s = np.round(rng.random(n), 1)             # 11 distinct values -> heavy ties
    y = (rng.random(n) < 0.3 + 0.4 * s).astype(int)
    df = _frame(spark, y, s)
    for nb in (1, 3, 16):
        m = M.ranking_metrics(df, n_buckets=nb).first()
        assert m.roc_auc == pytest.approx(B.roc_auc(y, s), abs=1e-12)
        assert m.average_precision == pytest.approx(B.average_precision(y, s), abs=1e-12)
        assert m.pr_auc == pytest.approx(B.pr_auc_trapezoid(y, s), abs=1e-12)
    f1 = M.best_f1(df).first()
    bf, bt = B.best_f1(y, s)
    assert f1.best_f1 == pytest.approx(bf) and f1.best_threshold == pytest.approx(bt)


def test_single_distinct_score_and_one_class(spark):
    df = _frame(spark, [0, 1, 1], [0.5, 0.5, 0.5])
    f1 = M.best_f1(df).first()
    assert (f1.best_f1, f1.best_threshold) == (0.0, 0.5)
    one = _frame(spark, [1, 1, 1], [0.1, 0.2, 0.3])
    m = M.ranking_metrics(one).first()
    assert m.roc_auc is None and m.average_precision == pytest.approx(1.0)


def test_fold_metrics_match_per_fold_bruteforce(spark):
    rng = np.random.default_rng(7)
    n = 300
    s, fold = np.round(rng.random(n), 2), rng.integers(0, 3, n)
    y = (rng.random(n) < s).astype(int)
    got = {r.fold: r for r in M.fold_metrics(_frame(spark, y, s, fold)).collect()}
    for f in range(3):
        m = fold == f
        assert got[f].roc_auc == pytest.approx(B.roc_auc(y[m], s[m]), abs=1e-12)
        assert got[f].average_precision == pytest.approx(B.average_precision(y[m], s[m]), abs=1e-12)


def test_calibration_table_and_quantiles(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(500), 3)
    y = (rng.random(500) < p).astype(int)
    df = _frame(spark, y, p)
    got = sorted((r.bin, r.pred_mean, r.obs_rate) for r in M.calibration_table(df).collect())
    exp = B.calibration(y, p)
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1]) and a[2] == pytest.approx(b[2])
    qs = [0.01, 0.1, 0.5, 0.9, 0.99]
    assert M.exact_quantiles(df, "score", qs, n_buckets=7) == pytest.approx(list(np.percentile(p, [q * 100 for q in qs])))


def test_collapsing_bins(spark):
    p = [0.2] * 50 + [0.7] * 50
    y = [0, 1] * 50
    got = M.calibration_table(_frame(spark, y, p)).collect()
    assert len(got) == len(B.calibration(y, p)) < 10


def test_roc_curve_endpoints(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(200), 1)
    y = (rng.random(200) < s).astype(int)
    pts = sorted((r.step, r.fpr, r.tpr) for r in M.roc_curve(_frame(spark, y, s)).collect())
    assert pts[0][1:] == (0.0, 0.0) and pts[-1][1:] == (1.0, 1.0)
    assert all(b[1] >= a[1] and b[2] >= a[2] for a, b in zip(pts, pts[1:]))

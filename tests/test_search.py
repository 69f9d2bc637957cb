"""The whole search (M4), its trials side by side in tasks."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskframe.operators import boost as B
from riskframe.operators import model as MD
from riskframe.operators import search as S
from riskframe.plans import modeling as ML

#: Gains that trees of this size reach.
SPACE = {**MD.LEAFWISE_SPACE, "min_gain_to_split": ("float", 0.0, 0.01), "min_data_in_leaf": ("int", 5, 20)}


def frame(spark, n=400, slots=4, seed=3, noise=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, slots))
    y = (x[:, 0] - x[:, 1] ** 2 + noise * rng.normal(size=n) > -0.5).astype(int)
    rows = [(i, int(y[i]), int(i % 7 % 3), *map(float, x[i])) for i in range(n)]
    names = [f"x{j}" for j in range(slots)]
    df = spark.createDataFrame(rows, "row_id long, label int, fold int, " + ", ".join(f"{c} double" for c in names))
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).drop(*names).coalesce(3)


def test_registered_search_is_the_whole_job(spark, tmp_path, monkeypatch):
    """50 trials of up to 5000 rounds with a patience of 200, as the tuning job has them."""
    seen = {}

    def search(given, **kw):
        seen.update(kw)
        return given.select("row_id"), {}

    monkeypatch.setattr(ML, "model_run", lambda *_: SimpleNamespace(frame=frame(spark, n=20), params=MD.GBTParams(scale_pos_weight=2.0)))
    monkeypatch.setattr(MD, "random_search", search)
    ML.search_trials(spark, str(tmp_path))
    assert (seen["n_trials"], seen["max_iter"], seen["patience"], seen["n_folds"]) == (50, 5000, 200, 5)


def test_trials_run_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(MD, "cross_validate_patient", lambda *a, **k: 1 / 0)
    trials, best = MD.random_search(frame(spark), n_trials=4, n_folds=3, max_iter=40, base_spw=1.0, patience=5, space=SPACE)
    rows = trials.orderBy("number").collect()
    assert [r.number for r in rows] == [0, 1, 2, 3] and {r.state for r in rows} == {"COMPLETE"}
    assert all(r.duration > 0 and r.datetime_complete >= r.datetime_start and 1 <= r.best_round <= 40 for r in rows)
    assert best["value"] == max(r.value for r in rows) and best["params"]["n_estimators"] == rows[best["number"]].best_round


@pytest.mark.parametrize("limits", [{}, {"min_instances_per_node": 25}, {"min_info_gain": 0.02}, {"max_bins": 9}])
def test_without_draws_a_trial_is_the_dealt_cross_validation(spark, limits):
    df = frame(spark)
    # nodes of some rows: few rows are often divided alike by several features, and rounding decides which the dealt one takes
    p = MD.GBTParams(**{"max_iter": 8, "max_depth": 3, "step_size": 0.3, "scale_pos_weight": 2.5, "min_instances_per_node": 10, **limits})
    (value, rnd, error, *_), = S.patient_trials(df, [p], n_folds=3, patience=8)
    warm = B.cross_validate_warm(df, p, n_folds=3, patience=8)
    assert error is None and rnd == warm.best_round and value == pytest.approx(warm.best_value, abs=1e-9)


def test_a_trial_stops_at_the_very_round(spark):
    """Without gain every round scores the same: the first one is best."""
    df = frame(spark, n=90)
    p = MD.GBTParams(max_iter=10**9, min_info_gain=100.0)
    (value, rnd, error, *_), = S.patient_trials(df, [p], n_folds=3, patience=30)
    share = [df.where(F.col("fold") == f).agg(F.avg("label")).first()[0] for f in range(3)]
    assert error is None and rnd == 1 and value == pytest.approx(np.mean(share))


def test_draws_follow_neither_partitions_nor_order(spark):
    p = MD.GBTParams(max_iter=30, max_depth=4, subsampling_rate=0.6, feature_subset_strategy="0.5")
    df = frame(spark)
    runs = [S.patient_trials(d, [p], n_folds=3, patience=9)[0][:3] for d in (df, df.repartition(7, "features"), df.orderBy(F.desc("row_id")))]
    assert runs[0] == runs[1] == runs[2] and runs[0][2] is None
    assert S.patient_trials(df, [MD.GBTParams(**{**p.__dict__, "seed": 7})], n_folds=3, patience=9)[0][:2] != runs[0][:2]


def test_nodes_split_by_drawn_features_alone():
    rng = np.random.default_rng(1)
    y = np.where(rng.random(300) < 0.5, 1.0, -1.0)
    x = np.stack([(y > 0).astype(np.uint8), rng.integers(0, 2, 300).astype(np.uint8)])
    bins = S.FoldBins(x, np.array([1, 1]), np.array([0, 1]), 2)
    root = lambda share, i: int(S.grow_tree(x, y, np.ones(300), bins, MD.GBTParams(max_depth=1, feature_subset_strategy=share), np.random.default_rng(i)).feature[0])
    assert {root("1.0", i) for i in range(20)} == {0}
    assert 25 < sum(root("0.5", i) for i in range(100)) < 75          # half the roots see the noise only


def test_like_features_count_once(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    df = frame(spark)
    v = vector_to_array("features")
    twice = df.withColumn("features", array_to_vector(F.concat(v, v)))
    p = MD.GBTParams(max_iter=10, max_depth=3)
    assert S.patient_trials(twice, [p], n_folds=3, patience=9)[0][:3] == S.patient_trials(df, [p], n_folds=3, patience=9)[0][:3]


def test_nodes_counted_in_parts_agree(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (6, 500)).astype(np.uint8)
    y = x[0] * 1.0 - x[1] + rng.normal(size=500)
    bins = S.FoldBins(x, np.full(6, 8), np.arange(6), 9)
    grow = lambda: S.grow_tree(x, y, np.ones(500), bins, MD.GBTParams(max_depth=5), np.random.default_rng(0))
    whole = grow()
    monkeypatch.setattr(S, "COUNTS", 400)
    monkeypatch.setattr(S, "CELLS", 700)
    parts = grow()
    assert len(whole.value) > 20 and np.array_equal(whole.feature, parts.feature) and np.allclose(whole.value, parts.value)


def test_frames_too_large_for_a_task_run_with_rows_dealt(spark, monkeypatch):
    ran = []
    monkeypatch.setattr(S, "TASK_BYTES", 100)
    monkeypatch.setattr(MD, "cross_validate_patient", lambda f, p, **kw: (ran.append((p.max_iter, kw["patience"])), SimpleNamespace(best_value=0.5, best_round=3))[1])
    trials, _ = MD.random_search(frame(spark, n=60), n_trials=3, n_folds=3, max_iter=77, base_spw=1.0, patience=8)
    assert ran == [(77, 8)] * 3 and trials.count() == 3


def test_a_search_without_training_rows_fails(spark):
    with pytest.raises(RuntimeError, match="all 2 trials failed"):
        MD.random_search(frame(spark, n=30).withColumn("fold", F.lit(0)), n_trials=2, n_folds=1, max_iter=5, base_spw=1.0, patience=2)


def test_odd_rows(spark):
    """Ids null or twice, one class, rows of no fold and without a label, missing numbers."""
    from pyspark.ml.functions import array_to_vector
    df = frame(spark, n=90).withColumn("row_id", F.when(F.col("row_id") > 5, F.col("row_id") % 40))
    df = df.withColumn("fold", F.when(F.col("row_id") == 7, -1).otherwise(F.col("fold"))).withColumn("label", F.when(F.col("row_id") != 8, F.col("label")))
    nan = array_to_vector(F.array(F.lit(float("nan")), *[F.lit(1.0 * k) for k in range(3)]))
    df = df.withColumn("features", F.when(F.col("row_id") == 9, nan).otherwise(F.col("features")))
    p = [MD.GBTParams(max_iter=5, max_depth=2), MD.GBTParams(max_iter=5, max_depth=8, scale_pos_weight=9.0)]
    assert all(r[2] is None and 0 < r[0] <= 1 for r in S.patient_trials(df, p, n_folds=3, patience=2))
    (value, rnd, error, *_), = S.patient_trials(df.withColumn("label", F.lit(0)), p[:1], n_folds=3, patience=2)
    assert (value, rnd, error) == (float("-inf"), 1, None)


def test_average_precision():
    assert S.average_precision(np.array([0.9, 0.8, 0.7]), np.array([1, 0, 1])) == pytest.approx((1 + 2 / 3) / 2)
    assert S.average_precision(np.array([0.5, 0.5, 0.5, 0.5]), np.array([1, 0, 0, 0])) == pytest.approx(0.25)       # ties are one step
    assert S.average_precision(np.array([0.5]), np.array([0])) is None

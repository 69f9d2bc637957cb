"""Searched depth = trained depth, no leaked label, empty and one-class inputs, NULL keys, storage safety."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskframe.operators import features as FE
from riskframe.operators import folds as FO
from riskframe.operators import metrics as M
from riskframe.operators import model as MD
from riskframe.operators import profile as PR
from riskframe.plans import modeling as ML

SF = "/root/testdata/sf0.001"


def toy(spark, n=120):
    from pyspark.ml.linalg import Vectors
    rows = [(i, int(i % 4 == 0), i % 3, Vectors.dense([float(i % 7), float((i * 13) % 11)])) for i in range(n)]
    return spark.createDataFrame(rows, ["row_id", "label", "fold", "features"])


def test_trials_record_the_trained_depth(spark, monkeypatch):
    seen = []
    real = MD.train_gbt
    monkeypatch.setattr(MD, "train_gbt", lambda frame, p, label="label": (seen.append(p.max_depth), real(frame, p, label))[1])
    for space in (MD.LEAFWISE_SPACE, MD.DEPTHWISE_SPACE):
        seen.clear()
        trials, best = MD.random_search(toy(spark), n_trials=2, n_folds=2, max_iter=2, base_spw=1.0, space=space)
        depths = [int(r.params_max_depth) for r in trials.orderBy("number").collect()]
        assert seen == [d for d in depths for _ in range(2)]
        assert MD.params_from_reference(best["params"]).max_depth == depths[best["number"]]


def test_all_trials_failing_raises(spark, monkeypatch):
    monkeypatch.setattr(MD, "cross_validate", lambda *a, **k: 1 / 0)
    with pytest.raises(RuntimeError, match="all 2 trials failed"):
        MD.random_search(toy(spark), n_trials=2, n_folds=2, max_iter=2, base_spw=1.0)


def test_every_round_is_scored(spark, monkeypatch):
    monkeypatch.setattr(MD, "ROUNDS_AT_ONCE", 2)
    res = MD.cross_validate(toy(spark), MD.GBTParams(max_iter=5, max_depth=2), n_folds=3)
    assert sorted(r["round"] for r in res.curve.collect()) == [1, 2, 3, 4, 5]
    assert res.oof.count() == 120


def test_no_model_input_gives_the_label_away(spark):
    from riskframe.plans.build import feature_table
    feats = feature_table(spark, "/root/testdata/sf0.01")
    frame, prep = ML.model_frame(feats.withColumn("fold", F.lit(1)).withColumn("row_id", F.col("SK_ID_CURR")), exclude=ML.LEAKY)
    assert not {"fold", "row_id", *ML.LEAKY} & set(prep.features)
    amounts = frame.select("label", *[f"_f_{c}" for c in prep.features])
    numbers = [c for c in amounts.columns if c != "label"][:25]
    for c in numbers:
        auc = M.roc_auc(amounts, c, "label").first()["roc_auc"]
        assert auc is None or max(auc, 1 - auc) < 0.9, c


def test_one_class_and_empty_inputs(spark):
    one = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.7, 0)], "score double, target int")
    assert all(r.tpr is None for r in M.roc_curve(one).collect() if r.step > 0)
    empty = spark.createDataFrame([], "SK_ID_CURR long, x double")
    assert [r.missing_rate for r in PR.missing_rates(empty).collect()] == [None, None]
    assert all(r.coverage_pct is None for r in PR.coverage(empty, {"child": empty}).collect())


def test_null_keys_belong_to_no_group(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 5.0), (1, 4.0)], "k long, v double")
    assert [tuple(r) for r in FE.agg_spec(df, "k", "P_", {"v": ["mean", "sum"]}).collect()] == [(1, 3.0, 6.0)]


def test_many_levels_are_encoded(spark):
    from riskframe.operators.encode import ordinal_encode
    df = spark.range(1500).select(F.format_string("l%05d", "id").alias("c"), "id")
    assert [r.c for r in ordinal_encode(df, ["c"]).orderBy("id").collect()] == list(range(1500))


def test_fold_map_join_and_sample(spark):
    feats = spark.range(50).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") * 2).alias("x"))
    folds = spark.createDataFrame([(i, i % 5) for i in range(40)], "row_id long, fold int")
    got = {r.SK_ID_CURR: r.fold for r in FO.join_folds(feats, folds).collect()}
    assert got == {i: (i % 5 if i < 40 else -1) for i in range(50)} and "row_id" not in FO.join_folds(feats, folds).columns
    big = spark.range(20000).withColumnRenamed("id", "SK_ID_CURR")
    want = [r[0] for r in big.orderBy(F.xxhash64("SK_ID_CURR", F.lit(42)), "SK_ID_CURR").limit(300).collect()]
    assert sorted(r[0] for r in FO.sample_n(big, 300).collect()) == sorted(want)
    assert FO.sample_n(feats, 500).count() == 50


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from riskframe import session

    class Cluster:
        sparkContext = type("Sc", (), {"master": "spark://host:7077"})()

    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())

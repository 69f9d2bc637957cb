"""Job round trips (B2-B4) and the streaming adapter."""

from __future__ import annotations

import dataclasses
import tempfile

from pyspark.sql import functions as F

from riskframe.operators import clean as C  # noqa: F401 (C.T used below)
from riskframe.plans import jobs
from riskframe.plans.build import feature_table, run_feature_job
from riskframe.sources import standins as S
from riskframe.streaming.rules import clean_stream

SF = "/root/testdata/sf0.001"


def run_to_memory(df, name: str, checkpoint: str):
    """Drive a stream to completion into a memory table."""
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_feature_job_round_trip(spark):
    out = tempfile.mkdtemp(prefix="rf-job-", dir="/tmp")
    info = run_feature_job(spark, SF, out)
    back = spark.read.parquet(f"{out}/train_features_tree.parquet")
    fresh = feature_table(spark, SF)
    assert back.count() == fresh.count() == info["rows"]
    assert sorted(back.columns) == sorted(fresh.columns)
    assert back.exceptAll(fresh.select(*back.columns)).count() == 0
    fm = spark.read.parquet(f"{out}/folds_by_id.parquet")
    assert fm.columns == ["row_id", "fold"] and fm.count() == info["rows"]
    oh = spark.read.parquet(f"{out}/train_features_onehot.parquet")
    assert "OCCUPATION_TYPE_BUILDING" in oh.columns and "row_id" not in oh.columns


def test_calibrate_and_evaluate_jobs(spark):
    d = tempfile.mkdtemp(prefix="rf-cal-", dir="/tmp")
    S.scored(spark, SF).select("row_id", "fold", F.col("score").alias("oof_pred"), "target") \
        .write.mode("overwrite").parquet(f"{d}/oof")
    res = jobs.calibrate_fit_job(spark, f"{d}/oof", f"{d}/cal", f"{d}/rep")
    assert res["calibrated_brier"] <= res["raw_brier"]
    jobs.calibrate_apply_job(spark, f"{d}/oof", "oof_pred", f"{d}/cal", f"{d}/applied")
    assert "oof_pred_calibrated" in spark.read.parquet(f"{d}/applied").columns
    ev = jobs.evaluate_job(spark, f"{d}/oof", f"{d}/eval")
    assert 0 <= ev["brier"] <= 1 and spark.read.option("header", True).csv(f"{d}/eval/calibration_table").count() > 0


def test_clean_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="rf-stream-", dir="/tmp")
    bureau = S.bureau(spark, SF)
    bureau.write.mode("overwrite").parquet(f"{d}/in")
    model = C.fit_clean(bureau, C.BUREAU)
    stream = spark.readStream.schema(bureau.schema).parquet(f"{d}/in")
    got = run_to_memory(clean_stream(stream, model), "rf_clean_stream", f"{d}/ckpt")
    batch = model.transform(bureau)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def test_raw_csv_scan_null_tokens(spark):
    from riskframe.sources.tables import read_raw_csv
    d = tempfile.mkdtemp(prefix="rf-csv-", dir="/tmp")
    with open(f"{d}/app.csv", "w") as f:
        f.write("SK_ID_CURR,AMT_CREDIT,NAME\n1,10.5,XNA\n2,,NA\n3,NaN,n/a\n4,7,ok\n")
    df = read_raw_csv(spark, f"{d}/app.csv", schema=C.T.StructType([
        C.T.StructField("SK_ID_CURR", C.T.LongType()), C.T.StructField("AMT_CREDIT", C.T.DoubleType()),
        C.T.StructField("NAME", C.T.StringType())]))
    rows = {r.SK_ID_CURR: r for r in df.collect()}
    assert rows[1].NAME == "XNA" and rows[2].AMT_CREDIT is None and rows[2].NAME is None
    assert rows[3].AMT_CREDIT is None and rows[3].NAME is None and rows[4].AMT_CREDIT == 7.0


def test_align_to_features_and_merge_importance(spark):
    from riskframe.operators.encode import align_to_features
    from riskframe.operators.model import merge_importance
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert align_to_features(df, ["c", "x", "a"]).columns == ["c", "a"]
    a = spark.createDataFrame([("f1", 2.0), ("f2", 1.0)], "feature string, gain double")
    b = spark.createDataFrame([("f2", 5.0), ("f3", 4.0)], "feature string, gain double")
    got = {r.feature: (r.a_gain, r.b_gain) for r in merge_importance(a, b).collect()}
    assert got == {"f1": (2.0, 0.0), "f2": (1.0, 5.0), "f3": (0.0, 4.0)}


def test_model_save_load_round_trip(spark):
    from pyspark.ml.feature import VectorAssembler
    from riskframe.operators import model as MD
    df = spark.createDataFrame([(i, float(i % 2), float(i), None if i % 5 == 0 else float(i % 7), "ab"[i % 2])
                                for i in range(60)], "row_id long, label double, x double, y double, s string")
    prep = MD.fit_prep(df, ["x", "y", "s"])
    frame = MD.apply_prep(df, prep, keep=["row_id", "label"])
    m = MD.train_gbt(frame, MD.GBTParams(max_iter=3, max_depth=2))
    d = tempfile.mkdtemp(prefix="rf-model-", dir="/tmp")
    MD.save_model(m, prep, d, {"best_round": 3})
    m2, prep2, meta = MD.load_model(d)
    # the saved model carries a copy of the dictionary: another path, the same rows
    assert prep2.dictionary.startswith(d) and dataclasses.replace(prep2, dictionary=prep.dictionary) == prep
    rows = [sorted(map(str, spark.read.parquet(p.dictionary).collect())) for p in (prep, prep2)]
    assert rows[0] == rows[1] and rows[0]
    assert meta["best_round"] == 3 and prep.indicators == ["y"]
    a = [r.score for r in MD.positive_probability(m, frame).orderBy("row_id").collect()]
    b = [r.score for r in MD.positive_probability(m2, MD.apply_prep(df, prep2, keep=["row_id", "label"]))
         .orderBy("row_id").collect()]
    assert a == b


def test_tune_job_writes_outputs(spark):
    from riskframe.plans.build import feature_table
    d = tempfile.mkdtemp(prefix="rf-tune-", dir="/tmp")
    feature_table(spark, SF).write.mode("overwrite").parquet(f"{d}/features")
    res = jobs.tune_job(spark, f"{d}/features", f"{d}/out", n_trials=1, max_iter=4, n_folds=3)
    assert res["best_round"] >= 1
    assert spark.read.option("header", True).csv(f"{d}/out/trials").count() == 1
    assert spark.read.parquet(f"{d}/out/oof").count() == spark.read.parquet(f"{d}/features").count()
    assert spark.read.option("header", True).csv(f"{d}/out/importance").count() > 0


def test_score_stream_equals_batch(spark):
    from riskframe.operators import model as MD
    from riskframe.streaming.rules import score_stream
    d = tempfile.mkdtemp(prefix="rf-score-", dir="/tmp")
    rows = [(i, float(i % 2), float(i), None if i % 5 == 0 else float(i % 7)) for i in range(80)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, label double, x double, y double")
    prep = MD.fit_prep(df, ["x", "y"])
    model = MD.train_gbt(MD.apply_prep(df.withColumnRenamed("SK_ID_CURR", "row_id"), prep,
                                       keep=["row_id", "label"]), MD.GBTParams(max_iter=3, max_depth=2))
    df.write.mode("overwrite").parquet(f"{d}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{d}/in")
    got = run_to_memory(score_stream(stream, prep, model), "rf_score_stream", f"{d}/ckpt")
    batch = score_stream(df, prep, model)
    assert got.count() == 80 and got.exceptAll(batch).count() == 0


def test_with_folds_view_is_partition_pruned(spark):
    out = tempfile.mkdtemp(prefix="rf-folds-", dir="/tmp")
    run_feature_job(spark, SF, out)
    wf = spark.read.parquet(f"{out}/train_with_folds_tree.parquet")
    plan = wf.where(F.col("fold") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan and wf.where(F.col("fold") == 2).count() > 0


def test_train_fits_applied_to_other_tables(spark):
    from riskframe.plans.build import fit_cleaners
    raw_train = {"app": S.application(spark, SF), **S.frames(spark, SF)}
    models = fit_cleaners(raw_train)
    ft = feature_table(spark, "/root/testdata/sf0.01", models=models)
    cap = models["app"].caps["AMT_CREDIT"]
    assert ft.agg(F.max("AMT_CREDIT")).first()[0] <= cap
    assert "FLAG_MOBIL" not in ft.columns and ft.count() == 1500


def test_score_job(spark):
    d = tempfile.mkdtemp(prefix="rf-score-job-", dir="/tmp")
    feature_table(spark, SF).write.mode("overwrite").parquet(f"{d}/features")
    jobs.tune_job(spark, f"{d}/features", f"{d}/out", n_trials=1, max_iter=3, n_folds=3)
    jobs.score_job(spark, f"{d}/features", f"{d}/out/model", f"{d}/scores")
    s = spark.read.parquet(f"{d}/scores")
    assert s.count() == 150 and s.where("score < 0 or score > 1").count() == 0

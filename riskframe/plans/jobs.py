"""The reference's command-line jobs as functions on paths.

Every job reads and writes through Spark (Parquet / CSV / JSON manifests on
the shared file system); nothing is collected beyond metric rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import calibrate as K
from riskframe.operators import metrics as M
from riskframe.operators.encode import align_to_features
from riskframe.sources import sinks


def _read(spark: SparkSession, path: str, *numeric: str) -> DataFrame:
    return sinks.read_csv(spark, path, numeric=numeric) if path.endswith(".csv") else spark.read.parquet(path)


def calibrate_fit_job(spark: SparkSession, oof_path: str, out_calibrator: str, report_dir: str,
                      pred: str = "oof_pred", target: str = "target", by_fold: bool = False) -> dict:
    """B3 ``fit``: isotonic calibrator from an OOF table; writes the model and
    a Brier report (raw vs calibrated) and the two calibration tables."""
    oof = _read(spark, oof_path, pred, target)
    fit = K.fit_from_oof(oof, pred, target, by_fold=by_fold)
    K.save_calibrator(fit.model, out_calibrator)
    spark.createDataFrame([(fit.raw_brier, fit.calibrated_brier)], "raw_brier double, calibrated_brier double") \
        .coalesce(1).write.mode("overwrite").option("header", True).csv(f"{report_dir}/brier_isotonic")
    cal = K.apply_calibrator(oof, fit.model, pred)
    sinks.write_csv(M.compare_raw_calibrated(cal, pred, f"{pred}_calibrated", target).coalesce(1),
                    f"{report_dir}/calibration_tables")
    return {"raw_brier": fit.raw_brier, "calibrated_brier": fit.calibrated_brier}


def calibrate_apply_job(spark: SparkSession, pred_in: str, pred_col: str, calibrator: str, pred_out: str) -> None:
    """B3 ``apply``: add ``<pred_col>_calibrated`` to a prediction table."""
    df = _read(spark, pred_in, pred_col)
    out = K.apply_calibrator(df, K.load_calibrator(calibrator), pred_col)
    if pred_out.endswith(".csv"):
        sinks.write_csv(out, pred_out)
    else:
        sinks.write_parquet(out, pred_out)


def evaluate_job(spark: SparkSession, scored_path: str, out_dir: str, pred: str = "oof_pred",
                 target: str = "target") -> dict:
    """Brier score and the 10-bin quantile calibration table of a scored table."""
    df = _read(spark, scored_path, pred, target)
    b = M.brier(df, pred, target).first()["brier"]
    spark.createDataFrame([(f"{b:.6f}",)], "v string").coalesce(1).write.mode("overwrite").text(f"{out_dir}/brier")
    tab = M.calibration_table(df, pred, target).orderBy("bin").select("pred_mean", "obs_rate")
    sinks.write_csv(tab.coalesce(1), f"{out_dir}/calibration_table")
    metrics = M.ranking_metrics(df, pred, target).first().asDict()
    return {"brier": b, **metrics}


def tune_job(spark: SparkSession, features_path: str, out_dir: str, n_trials: int = 50, max_iter: int = 5000,
             n_folds: int = 5, exclude: tuple[str, ...] = (), patience: int = 200) -> dict:
    """Every trial and the final fit stop after ``patience`` rounds without a better mean. M4 -> M5 -> M6 -> M8 -> X2: search, OOF of the best trial, refit,
    importance and the attribution summary, all written under ``out_dir``."""
    from riskframe.operators import explain as X
    from riskframe.operators import folds as FO
    from riskframe.operators import model as MD
    from riskframe.operators.features import class_ratio
    from riskframe.plans.modeling import model_frame

    feats = spark.read.parquet(features_path)
    frame, prep = model_frame(feats, n_folds=n_folds, exclude=exclude)
    spw = float(class_ratio(feats).first()["scale_pos_weight"])
    trials, best = MD.random_search(frame, n_trials=n_trials, n_folds=n_folds, max_iter=max_iter, base_spw=spw,
                                    patience=patience)
    sinks.write_csv(trials, f"{out_dir}/trials")
    params = MD.params_from_reference(best["params"])
    params.max_iter = max_iter
    cv = MD.cross_validate_patient(frame, params, n_folds=n_folds, patience=patience)
    sinks.write_parquet(cv.oof, f"{out_dir}/oof")
    sinks.write_csv(cv.curve.orderBy("round"), f"{out_dir}/cv_curve")
    params.max_iter = cv.best_round
    model = MD.train_gbt(frame, params)
    MD.save_model(model, prep, f"{out_dir}/model", {"best_round": cv.best_round, "params": best["params"]})
    sinks.write_csv(MD.feature_importance(model, prep.vector_names, spark), f"{out_dir}/importance")
    ens = X.load_ensemble(model, spark, len(prep.vector_names))
    slots = [f"_f_{c}" for c in prep.features] + [f"_f_{c}__isna" for c in prep.indicators]
    att = X.attributions(FO.sample_n(frame, 3000, 42, "row_id"), ens, slots, prep.vector_names)
    sinks.write_csv(X.summary(att), f"{out_dir}/attribution_summary")
    return {"best_trial": best.get("number"), "best_value": best.get("value"), "best_round": cv.best_round}


def score_job(spark: SparkSession, features_path: str, model_path: str, out_path: str,
              calibrator: str | None = None, id_col: str = "SK_ID_CURR") -> None:
    """M7 (+K11): score a feature table with a saved model (and calibrator)."""
    from riskframe.operators import model as MD
    model, prep, _meta = MD.load_model(model_path)
    feats = spark.read.parquet(features_path)
    # The training order of what exists; a feature the cleaner dropped here is missing, i.e. NULL
    given = align_to_features(feats.withColumnRenamed(id_col, "row_id"), ["row_id", *prep.features])
    given = given.select("*", *[F.lit(None).cast("double").alias(c) for c in prep.features if c not in given.columns])
    frame = MD.apply_prep(given, prep, keep=["row_id"])
    scored = MD.positive_probability(model, frame).select(F.col("row_id").alias(id_col), "score")
    if calibrator:
        scored = K.apply_calibrator(scored, K.load_calibrator(calibrator), "score")
    sinks.write_parquet(scored, out_path)

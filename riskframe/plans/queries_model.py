"""Registered model, calibration and attribution queries (rows-only checks:
GBT training, isotonic pooling and TreeSHAP are not SQL; their own tests
compare them with brute-force references and invariants)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators import calibrate as K
from riskframe.operators import explain as X
from riskframe.operators import folds as FO
from riskframe.operators import metrics as M
from riskframe.operators import model as MD
from riskframe.operators import profile as PR
from riskframe.plans import modeling as ML
from riskframe.plans import sqlgen as G
from riskframe.plans.compare import finish
from riskframe.plans.parallel import pmap
from riskframe.plans.queries import _with, register
from riskframe.plans.queries_more import _FOLDS
from riskframe.session import durable, intermediate_dir


@register("gbt_oof")
def q_gbt_oof(spark, sf):
    """M3 + M5 + U2: out-of-fold scores at the best CV round."""
    return finish(ML.model_run(spark, sf).cv.oof)


@register("cv_curve")
def q_cv_curve(spark, sf):
    """M3 + A15 + K13: per-round mean / std of fold average precision."""
    return finish(ML.model_run(spark, sf).cv.curve)


@register("oof_metrics")
def q_oof_metrics(spark, sf):
    """B4 on the OOF table: AUC, AP, PR-AUC, Brier and best F1 in one row."""
    oof = ML.model_run(spark, sf).cv.oof
    parts = [M.ranking_metrics(oof, "oof_pred", "target").select("roc_auc", "average_precision", "pr_auc"),
             M.brier(oof, "oof_pred", "target"), M.best_f1(oof, "oof_pred", "target")]
    cols = [c for p in parts for c in p.columns]
    # three one-row results stacked and folded into one row (no join)
    stacked = None
    for p in parts:
        q = p.select(*[F.col(c) if c in p.columns else F.lit(None).cast("double").alias(c) for c in cols])
        stacked = q if stacked is None else stacked.unionByName(q)
    return finish(stacked.agg(*[F.max(c).alias(c) for c in cols]))


@register("importance")
def q_importance(spark, sf):
    """M8 + D9: gain / split importance of the refit model, sorted by gain."""
    run = ML.model_run(spark, sf)
    return finish(MD.feature_importance(run.model, run.prep.vector_names, spark))


@register("refit_scores")
def q_refit_scores(spark, sf):
    """M6 + M7: every row scored by the model refit at the best round."""
    return finish(ML.refit_scores(ML.model_run(spark, sf)))


@register("isotonic_apply")
def q_isotonic_apply(spark, sf):
    """K10 + K11: isotonic calibrator fitted on the OOF scores, applied to them."""
    oof = ML.model_run(spark, sf).cv.oof
    model = K.fit_isotonic(oof, "oof_pred", "target")
    return finish(K.apply_calibrator(oof, model, "oof_pred"))


@register("calibration_compare")
def q_calibration_compare(spark, sf):
    """Brier and calibration table, raw vs calibrated OOF scores."""
    oof = ML.model_run(spark, sf).cv.oof
    model = K.fit_isotonic(oof, "oof_pred", "target")
    cal = K.apply_calibrator(oof, model, "oof_pred")
    return finish(M.compare_raw_calibrated(cal, "oof_pred", "oof_pred_calibrated", "target"))


@register("trials")
def q_trials(spark, sf):
    """M4 + S9: a seeded random search (50 trials, each a 5-fold CV of up to 5000 rounds with early stopping): the trials table."""
    return finish(ML.search_trials(spark, sf))


@register("trials_report")
def q_trials_report(spark, sf):
    """Trial counts by state, best value and median duration."""
    return finish(PR.trials_report(ML.search_trials(spark, sf)))


@register("attribution_summary")
def q_attribution_summary(spark, sf):
    """F4 + X1 + X2: mean |phi| per feature over a reproducible 3,000-row sample."""
    run = ML.model_run(spark, sf)
    rows = FO.sample_n(run.frame, 3000, 42, "row_id")
    return finish(X.summary(ML.explain_rows(spark, run, rows)))


@register("attribution_topk")
def q_attribution_topk(spark, sf):
    """D11 + X1 + X3: the 5 highest-risk rows, 20 largest contributions each."""
    run = ML.model_run(spark, sf)
    top = M.top_k(ML.refit_scores(run), 5, "score", "row_id").select("row_id")
    rows = run.frame.join(top, "row_id", "inner")
    return finish(X.top_contributions(ML.explain_rows(spark, run, rows), 20))


@register("dependence_pairs")
def q_dependence_pairs(spark, sf):
    """D9 + X4: (value, phi) pairs of the 4 highest-gain features on a 10,000-row sample."""
    run = ML.model_run(spark, sf)
    imp = MD.feature_importance(run.model, run.prep.vector_names, spark)
    top4 = [r["feature"] for r in imp.limit(4).collect()]
    rows = FO.sample_n(run.frame, 10000, 42, "row_id")
    return finish(X.dependence_pairs(ML.explain_rows(spark, run, rows, top4), top4))


_ALL = _with(G.views_prefix("application"))
_FOLDED = _with(G.views_prefix("application"), _FOLDS)
_BY_FOLD = """
SELECT CAST(fold AS DOUBLE) AS fold, CAST(count(*) AS DOUBLE) AS n, CAST(count(DISTINCT SK_ID_CURR) AS DOUBLE) AS ids,
       CAST(sum(TARGET) AS DOUBLE) AS positives, CAST(count(*) AS DOUBLE) AS scored, CAST(0 AS DOUBLE) AS outside FROM folded GROUP BY fold"""


def _oof_by_fold(oof):
    p = F.col("oof_pred")
    return finish(oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("ids"), F.sum("target").alias("positives"),
        F.count(p).alias("scored"), F.count_if((p < 0) | (p > 1) | F.isnan(p)).alias("outside")))


@register("oof_by_fold", _FOLDED + _BY_FOLD)
def q_oof_by_fold(spark, sf):
    """M5 + U2: what holds of any out-of-fold table: every applicant once, in their own fold, with a probability."""
    return _oof_by_fold(ML.model_run(spark, sf).cv.oof)


@register("gbt_patient_oof")
def q_gbt_patient_oof(spark, sf):
    """M3 + M5: out-of-fold scores at the round that early stopping finds."""
    return finish(ML.patient_run(spark, sf).oof)


@register("gbt_patient_curve")
def q_gbt_patient_curve(spark, sf):
    """M3 + K13: the learning curve of all rounds until patience ran out; ``bound`` is how far a mean may be off."""
    return finish(ML.patient_run(spark, sf).curve)


@register("patient_oof_by_fold", _FOLDED + _BY_FOLD)
def q_patient_oof_by_fold(spark, sf):
    """M5 + U2 of the early-stopped run: every applicant once, in their own fold, with a probability."""
    return _oof_by_fold(ML.patient_run(spark, sf).oof)


@register("attribution_additivity", _ALL + "\nSELECT CAST(SK_ID_CURR AS DOUBLE) AS row_id, 0.0 AS off FROM application")
def q_attribution_additivity(spark, sf):
    """For every row, how far the attributions and the base are from the margin of its score (to six decimals)."""
    run = ML.model_run(spark, sf)
    ens = X.load_ensemble(run.model, spark, len(run.prep.vector_names))
    phi = X.attributions(run.frame, ens, run.slots, run.prep.vector_names, long=False)
    total = phi.select("row_id", (F.aggregate("phi", F.lit(0.0), lambda a, v: a + v) + F.col("base")).alias("total"))
    p = F.col("score")
    margin = ML.refit_scores(run).select("row_id", (F.log(p / (1 - p)) / 2).alias("margin"))
    return finish(total.join(margin, "row_id").select("row_id", F.round(F.abs(F.col("total") - F.col("margin")), 6).alias("off")), plain=("off",))


@register("reloaded_scores", _ALL + "\nSELECT CAST(SK_ID_CURR AS DOUBLE) AS row_id, 0.0 AS off FROM application")
def q_reloaded_scores(spark, sf):
    """M7 + M9: the model saved with its dictionary and manifest, loaded again, scores every row as before."""
    run = ML.model_run(spark, sf)
    path = f"{intermediate_dir(spark)}/models/{uuid.uuid4().hex}"
    MD.save_model(run.model, run.prep, path)
    model, _, _ = MD.load_model(path)
    again = MD.positive_probability(model, run.frame.select("row_id", "features")).select("row_id", F.col("score").alias("again"))
    return finish(ML.refit_scores(run).join(again, "row_id").select("row_id", F.abs(F.col("score") - F.col("again")).alias("off")), plain=("off",))


@register("importance_totals", "SELECT 0.0 AS gain_off, 0.0 AS split_off")
def q_importance_totals(spark, sf):
    """M8: the importances' sums against the saved node table's, relative to them."""
    run = ML.model_run(spark, sf)
    inner = MD.node_table(run.model, spark).where("leftChild >= 0")
    nodes = inner.agg(F.sum(F.col("gain") * F.col("impurityStats")[0]).alias("gain"), F.count(F.lit(1)).alias("split")).first()
    both = MD.feature_importance(run.model, run.prep.vector_names, spark).agg(F.sum("gain").alias("gain"), F.sum("split").alias("split"))
    return finish(both.select(F.round(F.abs(F.col("gain") / F.lit(nodes["gain"]) - 1), 6).alias("gain_off"),
                              F.abs(F.col("split") - F.lit(nodes["split"])).cast("double").alias("split_off")), plain=("gain_off", "split_off"))


@register("onehot_cv_curve")
def q_onehot_cv_curve(spark, sf):
    """E2 + M3 + K3 + K13: CV of the one-hot view with PR-AUC (trapezoid) per round."""
    return finish(ML.onehot_cv(spark, sf).curve)


@register("signal_check_importance")
def q_signal_check_importance(spark, sf):
    """F2 + M1 + D9: the quick signal check - stratified 80/20 hold-out of the
    application table, 100 trees, top-15 features by gain, hold-out AUC."""
    from riskframe.sources import standins as S
    app = S.application(spark, sf).drop(*ML.LEAKY)
    # written: the fits' passes would each rank and split the table anew, in as many tasks as the shuffle has partitions
    train, test = pmap(durable, FO.split_holdout(app, ML.TARGET, 0.2, 42, ML.ID))
    feats = [c for c in app.columns if c not in (ML.ID, ML.TARGET)]
    prep = MD.fit_prep(train, feats)
    tr = durable(MD.apply_prep(train.withColumnRenamed(ML.TARGET, "label"), prep, keep=[ML.ID, "label"]).select(ML.ID, "label", "features"))
    te = MD.apply_prep(test.withColumnRenamed(ML.TARGET, "label"), prep, keep=[ML.ID, "label"])
    model = MD.train_gbt(tr, MD.GBTParams(max_iter=100, seed=42))
    auc = M.roc_auc(MD.positive_probability(model, te), "score", "label").first()["roc_auc"]
    top = MD.feature_importance(model, prep.vector_names, spark).limit(15)
    return finish(top.withColumn("holdout_auc", F.lit(auc).cast("double")))

"""Registered queries that run whole jobs (B2-B4) into a fresh folder and read their tables back,
distinct counts by merged bitmaps and the assembly from bucketed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import bitmaps as BM
from riskframe.operators import clean as C
from riskframe.plans import build, jobs
from riskframe.plans import sqlgen as G
from riskframe.plans.compare import finish
from riskframe.plans.queries import FEATURE_SQL_COLS, FEATURE_SQL_PARTS, _final_sql, _with, register
from riskframe.plans.queries_eval import _BIN, _EDGES
from riskframe.plans.queries_more import _FOLDS, _ISO, _folder
from riskframe.session import durable
from riskframe.sources import sinks
from riskframe.sources import standins as S

_FEATURES = _with(*FEATURE_SQL_PARTS) + f"\nSELECT {_final_sql(FEATURE_SQL_COLS)} FROM features"


# ---------------------------------------------------------------------------
# A14, J2

@register("distinct_merged_bitmaps", _with(G.views_prefix("previous")) + """
SELECT NAME_CONTRACT_STATUS AS status, CAST(count(DISTINCT SK_ID_CURR) AS DOUBLE) AS customers FROM previous GROUP BY NAME_CONTRACT_STATUS
UNION ALL SELECT 'all', CAST(count(DISTINCT SK_ID_CURR) AS DOUBLE) FROM previous""")
def q_distinct_merged_bitmaps(spark, sf):
    """Distinct applicants per status from a written bitmap table, and over all of them by merging it."""
    kept = durable(BM.id_bitmaps(S.previous(spark, sf).withColumnRenamed("NAME_CONTRACT_STATUS", "status"), "SK_ID_CURR", ["status"]))
    whole = BM.distinct_from_bitmaps(BM.merge_bitmaps([kept])).select(F.lit("all").alias("status"), "customers")
    return finish(BM.distinct_from_bitmaps(kept, ["status"]).unionByName(whole))


@register("feature_assembly_bucketed", _FEATURES)
def q_feature_assembly_bucketed(spark, sf):
    """The feature table from tables bucketed by applicant, joined without a shuffle."""
    frames = build.clean_frames(S.frames(spark, sf))
    return finish(build.bucketed_features(C.clean(S.application(spark, sf), C.APPLICATION), frames, _folder(spark)))


# ---------------------------------------------------------------------------
# B2: the feature job's tables

def _feature_job(spark, sf):
    out = _folder(spark)
    build.run_feature_job(spark, sf, out)
    return out


@register("feature_job_train", _FEATURES)
def q_feature_job_train(spark, sf):
    """B2: the written training features of the whole job."""
    return finish(spark.read.parquet(f"{_feature_job(spark, sf)}/train_features_tree.parquet"))


@register("feature_job_folds", _with(G.views_prefix("application"), _FOLDS) + """
SELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, CAST(TARGET AS DOUBLE) AS "TARGET", CAST(fold AS DOUBLE) AS fold FROM folded""")
def q_feature_job_folds(spark, sf):
    """B2: the written training table with its folds, three columns of it."""
    df = spark.read.parquet(f"{_feature_job(spark, sf)}/train_with_folds_tree.parquet")
    return finish(df.select("SK_ID_CURR", "TARGET", "fold"))


# ---------------------------------------------------------------------------
# B3, B4 on the scored stand-in

def _written_scores(spark, sf) -> str:
    out = _folder(spark)
    sinks.write_parquet(S.scored(spark, sf).select("row_id", "fold", F.col("score").alias("oof_pred"), "target"), f"{out}/oof")
    return out


@register("calibrate_jobs", _with(G.views_prefix("scored"), _ISO) + f"""
SELECT CAST(row_id AS DOUBLE) AS row_id, {G.r6("score")} AS oof_pred, {G.r6("cal")} AS oof_pred_calibrated FROM calibrated""")
def q_calibrate_jobs(spark, sf):
    """The fit job writes a calibrator, the apply job adds its column to a written prediction table."""
    out = _written_scores(spark, sf)
    jobs.calibrate_fit_job(spark, f"{out}/oof", f"{out}/calibrator", f"{out}/report")
    jobs.calibrate_apply_job(spark, f"{out}/oof", "oof_pred", f"{out}/calibrator", f"{out}/applied")
    return finish(spark.read.parquet(f"{out}/applied").select("row_id", "oof_pred", "oof_pred_calibrated"))


@register("evaluate_job", _with(G.views_prefix("scored"), f"q AS (SELECT {_EDGES} FROM scored)",
                                f"binned AS (SELECT ({_BIN}) AS bin, score, target FROM scored)") + f"""
SELECT {G.r6("avg(score)")} AS pred_mean, {G.r6("avg(target)")} AS obs_rate,
       {G.r6("(SELECT round(avg(pow(score - target, 2)), 6) FROM scored)")} AS brier
FROM binned GROUP BY bin""")
def q_evaluate_job(spark, sf):
    """The calibration table and the Brier score that the evaluation job wrote."""
    out = _written_scores(spark, sf)
    jobs.evaluate_job(spark, f"{out}/oof", f"{out}/report")
    brier = spark.read.text(f"{out}/report/brier").select(F.col("value").cast("double").alias("brier"))
    table = sinks.read_csv(spark, f"{out}/report/calibration_table", numeric=("pred_mean", "obs_rate"))
    return finish(table.withColumn("brier", F.lit(brier.first()["brier"])))

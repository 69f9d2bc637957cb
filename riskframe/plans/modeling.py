"""The tune -> OOF -> refit -> explain flow on the stand-in feature table.

``model_run`` builds the model frame once per (session, sf) and keeps it as a
table written under the checkpoint folder, so the registered model queries (OOF, curve, importance,
calibration, attributions) share one set of fits instead of retraining.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import explain as X
from riskframe.operators import folds as FO
from riskframe.operators import model as MD
from riskframe.operators.encode import feature_columns
from riskframe.operators.features import class_ratio
from riskframe.session import durable, table_state

# In the stand-in, TARGET is derived from the account balance, which also
# feeds the income and the three amounts; every column computed from any of
# them would leak the label.
LEAKY = ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_ANNUITY", "DEBT_TO_INCOME", "GOODS_TO_INCOME",
         "ANN_TO_INC_PC", "INC_PER_DEP", "DOWNPAY_SHARE", "IMPLIED_TERM")
ID, TARGET = "SK_ID_CURR", "TARGET"
N_FOLDS = 5
DEFAULT_PARAMS = dict(max_iter=30, max_depth=4, step_size=0.1)


@dataclass
class ModelRun:
    frame: DataFrame          # row_id, label, fold, features (+ slot columns)
    prep: MD.FramePrep
    params: MD.GBTParams
    cv: MD.CVResult
    model: object             # refit on all rows at the best round (M6)
    slots: list[str]


_RUNS: dict = {}


def model_frame(features: DataFrame, seed: int = 42, n_folds: int = N_FOLDS, exclude: tuple[str, ...] = ()
                ) -> tuple[DataFrame, MD.FramePrep]:
    """F1 folds + E3/E4 prep + vector, written under the checkpoint folder (durable lineage cut).
    Every column except ids, the target, a fold and ``exclude`` is a model input (E6)."""
    feats = [c for c in feature_columns(features, (TARGET, ID, "fold", "row_id")) if c not in exclude]
    prep = MD.fit_prep(features, feats)
    folds = durable(FO.fold_map(features, TARGET, n_folds, seed, ID))
    folded = FO.join_folds(features.select(ID, TARGET, *feats), folds, ID)
    src = folded.withColumnRenamed(ID, "row_id").withColumnRenamed(TARGET, "label")
    frame = MD.apply_prep(src, prep, keep=["row_id", "label", "fold"])
    return durable(frame), prep


def model_run(spark: SparkSession, sf: str, **params) -> ModelRun:
    key = (spark.sparkContext.applicationId, sf, table_state(spark, sf), tuple(sorted(params.items())))
    if key in _RUNS:
        return _RUNS[key]
    from riskframe.plans.build import feature_table
    feats = durable(feature_table(spark, sf))
    frame, prep = model_frame(feats, exclude=LEAKY)
    spw = class_ratio(feats, TARGET).first()["scale_pos_weight"]
    p = MD.GBTParams(**{**DEFAULT_PARAMS, **params}, scale_pos_weight=float(spw))
    cv = MD.cross_validate(frame, p, n_folds=N_FOLDS)
    refit = MD.GBTParams(**{**p.__dict__, "max_iter": cv.best_round})
    model = MD.train_gbt(frame, refit)
    slots = [f"_f_{c}" for c in prep.features] + [f"_f_{c}__isna" for c in prep.indicators]
    run = ModelRun(frame, prep, p, cv, model, slots)
    _RUNS[key] = run
    return run


def refit_scores(run: ModelRun) -> DataFrame:
    """M6 + M7: scores of the refit model for every row."""
    return MD.positive_probability(run.model, run.frame.select("row_id", "label", "features")) \
        .select("row_id", F.col("label").cast("int").alias("target"), "score")


def explain_rows(spark: SparkSession, run: ModelRun, rows: DataFrame, only: list[str] | None = None) -> DataFrame:
    """X1 on a set of rows of the model frame (by row_id), for all features or the named ones."""
    ens = X.load_ensemble(run.model, spark, len(run.prep.vector_names))
    return X.attributions(rows, ens, run.slots, run.prep.vector_names, only=only)


_PATIENT: dict = {}
#: The patient run's settings: the job's 5000 rounds at most, but a patience of 20 rounds instead of 200 (README has the time a round takes).
PATIENT = dict(max_iter=5000, patience=20)


def patient_run(spark: SparkSession, sf: str) -> MD.CVResult:
    """M3 + M5 with early stopping on the shared model frame: one tree a fold and round until patience runs out."""
    key = (spark.sparkContext.applicationId, sf, table_state(spark, sf))
    if key not in _PATIENT:
        run = model_run(spark, sf)
        p = MD.GBTParams(**{**run.params.__dict__, "max_iter": PATIENT["max_iter"]})
        _PATIENT[key] = MD.cross_validate_patient(run.frame, p, n_folds=N_FOLDS, patience=PATIENT["patience"])
    return _PATIENT[key]


_SEARCHES: dict = {}


#: The search's settings, the tuning job's: 50 trials of 5000 rounds at most, each stopped after 200 rounds without a better mean.
SEARCH = dict(n_trials=50, max_iter=5000, patience=200)


def search_trials(spark: SparkSession, sf: str, n_trials: int = SEARCH["n_trials"], max_iter: int = SEARCH["max_iter"],
                  patience: int = SEARCH["patience"]) -> DataFrame:
    """M4 on the shared model frame (memoised like ``model_run``)."""
    key = (spark.sparkContext.applicationId, sf, table_state(spark, sf), n_trials, max_iter, patience)
    if key not in _SEARCHES:
        run = model_run(spark, sf)
        trials, best = MD.random_search(run.frame, n_trials=n_trials, n_folds=N_FOLDS, max_iter=max_iter,
                                        base_spw=run.params.scale_pos_weight or 1.0, patience=patience)
        _SEARCHES[key] = (durable(trials), best)
    return _SEARCHES[key][0]


_ONEHOT: dict = {}


def onehot_cv(spark: SparkSession, sf: str) -> MD.CVResult:
    """The one-hot path: E2 view of the feature table, CV with the trapezoid
    PR-AUC (K3) as the per-round metric."""
    key = (spark.sparkContext.applicationId, sf, table_state(spark, sf))
    if key not in _ONEHOT:
        from riskframe.operators.encode import categorical_columns, one_hot
        from riskframe.plans.build import feature_table
        feats = durable(feature_table(spark, sf))
        oh = one_hot(feats, [c for c in categorical_columns(feats)])
        frame, _prep = model_frame(oh, exclude=LEAKY)
        spw = class_ratio(feats, TARGET).first()["scale_pos_weight"]
        p = MD.GBTParams(**DEFAULT_PARAMS, scale_pos_weight=float(spw))
        _ONEHOT[key] = MD.cross_validate(frame, p, n_folds=N_FOLDS, metric="pr_auc")
    return _ONEHOT[key]

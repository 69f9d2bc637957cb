"""Modelling jobs M1-M10 on Spark ML's gradient-boosted trees.

LightGBM / XGBoost are not Spark; the reference's protocol (folds, per-round
validation metric, best round, out-of-fold scores, refit, importance, search
over a parameter space) is rebuilt around ``GBTClassifier``:

* Missing values: Spark trees do not route NULLs, so every numeric feature
  with NULLs gets a fill below its minimum plus a 0/1 indicator column; string
  features become ordinal codes with NULL as its own code (E3). All fitted
  state (levels, fills) is a few numbers per column.
* Per-round metrics: one fit per fold at the largest round count; the margin
  after r trees is the running weighted sum of the individual tree
  predictions, so every round of the grid is scored from the same models.
* Everything that grows with the data stays distributed; only the metric
  rows, the best round and the tree node table (bounded by trees x nodes)
  come back to the driver.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import random
import re
import time
import uuid
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.clean import is_numeric
from riskframe.operators.encode import Dictionary, fit_dictionary, ordinal_encode
from riskframe.operators.metrics import argmax_first, cv_curve, ranking_metrics
from riskframe.plans.parallel import pmap
from riskframe.session import durable, intermediate_dir


# ---------------------------------------------------------------------------
# parameters

@dataclass
class GBTParams:
    max_iter: int = 50
    step_size: float = 0.1
    max_depth: int = 5
    min_instances_per_node: int = 1
    subsampling_rate: float = 1.0
    feature_subset_strategy: str = "all"
    min_info_gain: float = 0.0
    scale_pos_weight: float | None = None
    max_bins: int = 32
    seed: int = 42
    ignored: dict = field(default_factory=dict)

    def estimator(self, features_col: str = "features", label_col: str = "label",
                  weight_col: str | None = None) -> GBTClassifier:
        est = GBTClassifier(featuresCol=features_col, labelCol=label_col, maxIter=self.max_iter,
                            stepSize=self.step_size, maxDepth=self.max_depth,
                            minInstancesPerNode=self.min_instances_per_node,
                            subsamplingRate=self.subsampling_rate,
                            featureSubsetStrategy=self.feature_subset_strategy,
                            minInfoGain=self.min_info_gain, maxBins=self.max_bins, seed=self.seed)
        if weight_col:
            est.setWeightCol(weight_col)
        return est


# The parameter keys of the two boosting libraries, the field each maps to and its type.
PARAM_KEYS = {
    "n_estimators": ("max_iter", int), "num_boost_round": ("max_iter", int),
    "learning_rate": ("step_size", float), "eta": ("step_size", float),
    "max_depth": ("max_depth", lambda d: 5 if int(d) < 0 else min(int(d), 30)),     # negative: no limit there
    "min_data_in_leaf": ("min_instances_per_node", int),
    "bagging_fraction": ("subsampling_rate", float), "subsample": ("subsampling_rate", float),
    "feature_fraction": ("feature_subset_strategy", lambda v: str(float(v))),
    "colsample_bytree": ("feature_subset_strategy", lambda v: str(float(v))),
    "min_gain_to_split": ("min_info_gain", float), "gamma": ("min_info_gain", float),
    "scale_pos_weight": ("scale_pos_weight", float), "seed": ("seed", int),
}
BOOKKEEPING_KEYS = ("best_score", "best_value", "best_trial_number")


def params_from_reference(p: dict, default_rounds: int = 1000) -> GBTParams:
    """A LightGBM/XGBoost-style parameter dict (or one holding it under
    ``best_params``) -> ``GBTParams``.

    Of two keys of one field the first in ``PARAM_KEYS`` wins. Keys without a
    Spark equivalent are kept in ``ignored``; bookkeeping keys are dropped; the
    round count defaults to ``default_rounds`` (T20)."""
    given = p["best_params"] if "best_params" in p else p
    out = GBTParams(max_iter=default_rounds)
    for key in reversed(PARAM_KEYS):
        if key in given:
            name, kind = PARAM_KEYS[key]
            setattr(out, name, kind(given[key]))
    out.ignored = {k: v for k, v in given.items() if k not in PARAM_KEYS and k not in BOOKKEEPING_KEYS}
    return out


# ---------------------------------------------------------------------------
# model frame: codes, fills, indicators, vector

@dataclass
class FramePrep:
    features: list[str]                 # input feature columns (training order)
    levels: dict[str, int]              # categorical columns with their number of levels
    dictionary: str                     # folder of their levels and codes (``encode.Dictionary``)
    fills: dict[str, float]             # NULL fill per numeric column
    indicators: list[str]               # columns that get a missing indicator
    vector_names: list[str]             # names of the assembled vector's slots

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "FramePrep":
        return FramePrep(**json.loads(s))


#: Columns whose fills one aggregation finds: the code generated for more of them is too long for the JVM to compile.
PREP_COLUMNS = 16


def fit_prep(df: DataFrame, features: list[str]) -> FramePrep:
    """Fit the level dictionary and the NULL fills; only numbers per column reach the driver.

    ``df`` is read once a group of ``PREP_COLUMNS`` columns, of which a written table yields these alone."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cats = [c for c in features if isinstance(types[c], (T.StringType, T.BooleanType))]
    nums = [c for c in features if is_numeric(types[c])]
    levels = fit_dictionary(df, cats)
    fills, indicators = {}, []

    def lowest(some: list[str]) -> list[tuple]:
        row = df.agg(*[F.min(F.col(c).cast("double")) for c in some], *[F.count(F.when(F.col(c).isNull(), 1)) for c in some]).first()
        return list(zip(row[:len(some)], row[len(some):], strict=True))

    groups = [nums[i:i + PREP_COLUMNS] for i in range(0, len(nums), PREP_COLUMNS)]
    found = [r for rows in pmap(lowest, groups) for r in rows]
    for c, (mn, n_null) in zip(nums, found, strict=True):
        fills[c] = (mn - 1.0 - abs(mn)) if mn is not None else -1.0
        if n_null:
            indicators.append(c)
    names = [c for c in features if c in cats or c in nums] + [f"{c}__isna" for c in indicators]
    return FramePrep(features=[c for c in features if c in cats or c in nums], levels=levels.sizes, dictionary=levels.path, fills=fills,
                     indicators=indicators, vector_names=names)


def apply_prep(df: DataFrame, prep: FramePrep, keep: list[str] = (), out: str = "features") -> DataFrame:
    """Encode, fill, add indicators and assemble the feature vector."""
    cats = list(prep.levels)
    coded = ordinal_encode(df.select(*[c for c in dict.fromkeys([*keep, *prep.features]) if c in df.columns]),
                           cats, Dictionary(prep.dictionary, prep.levels), null_as_level=True) if cats else df
    cols = [F.col(c) for c in keep if c in coded.columns]
    slots = []
    for c in prep.features:
        if c in cats:
            slots.append(F.col(c).cast("double").alias(f"_f_{c}"))
        else:
            slots.append(F.coalesce(F.col(c).cast("double"), F.lit(prep.fills[c])).alias(f"_f_{c}"))
    for c in prep.indicators:
        slots.append(F.when(F.col(c).isNull(), 1.0).otherwise(0.0).alias(f"_f_{c}__isna"))
    x = coded.select(*cols, *slots)
    slot_names = [f"_f_{c}" for c in prep.features] + [f"_f_{c}__isna" for c in prep.indicators]
    va = VectorAssembler(inputCols=slot_names, outputCol=out, handleInvalid="keep")
    return va.transform(x)


def with_weight(df: DataFrame, label: str, scale_pos_weight: float | None, out: str = "weight") -> DataFrame:
    """M2: ``scale_pos_weight`` for positives, 1 for negatives."""
    w = F.lit(1.0) if scale_pos_weight is None else \
        F.when(F.col(label) == 1, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0))
    return df.withColumn(out, w)


# ---------------------------------------------------------------------------
# M1, M7: train and score

#: Least number of partitions that training rows are packed into.
LEAST_TASKS = 8


def most_tasks(spark: SparkSession) -> int:
    return max(LEAST_TASKS, spark.sparkContext.defaultParallelism)


def training_rows(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than the cluster has cores (but in ``LEAST_TASKS`` where it has that many).

    Every partition sends one histogram of all features and bins for each node of a level, and every level of every
    tree is a job of two tasks a partition: both follow the partitions, not the rows, so further partitions
    only add to what is shuffled, scheduled and reported to the driver. Without a shuffle; fewer partitions stay."""
    return df.coalesce(most_tasks(df.sparkSession))


def train_gbt(frame: DataFrame, params: GBTParams, label: str = "label") -> GBTClassificationModel:
    """M1 (+M2): fit on an assembled frame with a ``features`` vector."""
    src = training_rows(frame).withColumn("_label", F.col(label).cast("double"))
    weight = None
    if params.scale_pos_weight is not None:
        src, weight = with_weight(src, "_label", params.scale_pos_weight, "_w"), "_w"
    return params.estimator(label_col="_label", weight_col=weight).fit(src)


def positive_probability(model: GBTClassificationModel, frame: DataFrame, out: str = "score") -> DataFrame:
    """M7: probability of the positive class as a double column."""
    scored = model.transform(frame)
    return scored.withColumn(out, vector_to_array(F.col("probability"))[1]).drop(
        "rawPrediction", "probability", "prediction")


#: A line of Spark ML's printed trees: a split by a threshold or by categories (its left side), the other side of one, or a leaf.
_TREE_LINE = re.compile(r"If \(feature (\d+) (?:<= (\S+)|in \{(.*)\})\)|Else \(feature \d+ .*\)|Predict: (\S+)")


@dataclass
class TreeArrays:
    """A regression tree, an entry per node: a leaf leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray                   # (nodes, 2): left and right
    value: np.ndarray
    categories: dict[int, list[float]]  # of the nodes that split by them: those that go left
    depth: int


def tree_arrays(tree) -> TreeArrays:
    """A fitted Spark ML regression tree as arrays, from its printed form (doubles are printed so that they read back as they were)."""
    nodes, above, categories, depth = [], [], {}, 0     # above: the splits whose second side is not complete
    for line in tree.toDebugString.splitlines()[1:]:
        m = _TREE_LINE.fullmatch(line.strip())
        if m is None and line.strip():
            raise ValueError(f"not a line of a tree: {line.strip()}")
        if m is None or not (m[1] or m[4]):
            continue
        node = len(nodes)
        if above:
            nodes[above[-1]][2].append(node)
        if m[1]:
            above.append(node)
            depth = max(depth, len(above))
            nodes.append((int(m[1]), float(m[2]) if m[2] else math.nan, [], 0.0))
            if not m[2]:
                categories[node] = [float(v) for v in m[3].split(",")]
        else:
            nodes.append((0, math.inf, [node, node], float(m[4])))
            while above and len(nodes[above[-1]][2]) == 2:
                above.pop()
    feature, threshold, child, value = (np.array(c) for c in zip(*nodes, strict=True))
    return TreeArrays(feature, threshold, child, value, categories, depth)


def tree_nodes(x: np.ndarray, tree: TreeArrays) -> np.ndarray:
    """The node that every row of ``x`` ends in; as in Spark a row goes left where its number is at most the threshold."""
    rows, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
    for _ in range(tree.depth):
        seen = x[rows, tree.feature[node]]
        left = seen <= tree.threshold[node]
        for at, some in tree.categories.items():
            left |= (node == at) & np.isin(seen, some)
        node = tree.child[node, np.where(left, 0, 1)]
    return node


def tree_values(x: np.ndarray, tree: TreeArrays) -> np.ndarray:
    """The tree's value of every row of ``x``."""
    return tree.value[tree_nodes(x, tree)]


def tree_predictions(trees: list, weights: list[float] | None = None, rounds: list[int] | None = None) -> Column:
    """Array column of the trees' values of the ``features`` vector; with ``weights``, of their weighted running sums at ``rounds``.

    Each row's vector is unpacked once, whatever the number of trees: Spark ML's own ``transform`` unpacks it for every tree."""
    import sys

    from pyspark import cloudpickle
    # ship this module's numeric code by value: executors need no install of the package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    arrays = [tree_arrays(t) for t in trees]
    asked = set(rounds or [])

    def values(vectors: pd.Series) -> pd.Series:
        x = np.stack(vectors) if len(vectors) else np.zeros((0, 1))
        out, total = [], np.zeros(len(x))
        for i, tree in enumerate(arrays):
            found = tree_values(x, tree)
            if weights is None:
                out.append(found)
                continue
            total = total + found * weights[i]
            if i + 1 in asked:
                out.append(total)
        return pd.Series(list(np.stack(out, axis=1)))

    return F.pandas_udf(values, "array<double>")(vector_to_array("features"))


def margins_at(model: GBTClassificationModel, frame: DataFrame, rounds: list[int]) -> DataFrame:
    """Margin after the first r trees for every r in ``rounds`` (columns ``m_<r>``): the
    running sum of the weighted tree predictions, added tree by tree."""
    asked = sorted(set(rounds))
    cols = list(frame.columns)
    path = tree_predictions(model.trees[:asked[-1]], [float(w) for w in model.treeWeights], asked)
    return frame.select(*cols, path.alias("_p")).select(*cols, *[F.col("_p")[i].alias(f"m_{r}") for i, r in enumerate(asked)])


def margin_to_probability(m):
    """Spark's GBT log-loss link: p = 1 / (1 + exp(-2 m))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m))


# ---------------------------------------------------------------------------
# Cross-validation with out-of-fold scores

@dataclass
class CVResult:
    curve: DataFrame            # round, mean, std, lower, upper (K13)
    fold_round: DataFrame       # fold, round, metric (A15 input)
    best_round: int
    best_value: float
    oof: DataFrame              # row_id, fold, oof_pred, target (M5 / U2)


#: Rounds scored by one job: bounds the rows x rounds written at once; every round is scored.
ROUNDS_AT_ONCE = 50


def cross_validate(frame: DataFrame, params: GBTParams, *, n_folds: int, fold_col: str = "fold",
                   label: str = "label", id_col: str = "row_id", metric: str = "average_precision",
                   grid: list[int] | None = None, per_fold_best: bool = False) -> CVResult:
    """One model per fold at ``params.max_iter`` rounds; the validation margins
    at every grid round give the per-round metric (mean / std over folds), the
    best round (first maximum) and the out-of-fold scores at that round.

    ``per_fold_best`` scores each fold at the round that is best on that same
    fold instead, as early stopping on the scored fold does in the reference
    (T19, optimistic)."""
    grid = grid or list(range(1, params.max_iter + 1))

    def fit_fold(f: int):
        tr = frame.where((F.col(fold_col) >= 0) & (F.col(fold_col) != f))
        return train_gbt(tr, params, label)

    models = pmap(fit_fold, range(n_folds))          # independent fits, submitted together

    def scored(rounds_of) -> DataFrame:
        """Validation margins, long, at the rounds asked of each fold."""
        out = None
        for f, model in enumerate(models):
            rounds = rounds_of(f)
            va = frame.where(F.col(fold_col) == f)
            mv = margins_at(model, va.select(id_col, fold_col, label, "features"), rounds)
            part = (mv.select(id_col, fold_col, F.col(label).cast("int").alias("target"),
                              F.explode(F.array(*[F.struct(F.lit(r).alias("round"), F.col(f"m_{r}").alias("margin"))
                                                  for r in rounds])).alias("_rm"))
                    .select(id_col, fold_col, "target", "_rm.round", "_rm.margin"))
            out = part if out is None else out.unionByName(part)
        return out

    fr = None
    for i in range(0, len(grid), ROUNDS_AT_ONCE):
        some = grid[i:i + ROUNDS_AT_ONCE]
        long = scored(lambda f, some=some: some)                   # read once: the metric writes its counts per score
        part = durable(ranking_metrics(long, "margin", "target", by=[fold_col, "round"])
                       .select(fold_col, "round", F.col(metric).alias("metric")))
        fr = part if fr is None else fr.unionByName(part)
    curve = cv_curve(fr, "round", "metric")
    best = argmax_first(curve, "mean", "round").first()
    pick = {f: int(best["round"]) for f in range(n_folds)}
    if per_fold_best:
        w = Window.partitionBy(fold_col).orderBy(F.col("metric").desc(), F.col("round").asc())
        rows = fr.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(fold_col, "round").collect()
        pick.update({r[fold_col]: r["round"] for r in rows})        # one row per fold
    oof = durable(scored(lambda f: [pick[f]]).select(
        F.col(id_col).alias("row_id"), F.col(fold_col).alias("fold"),
        margin_to_probability(F.col("margin")).alias("oof_pred"), "target"))
    return CVResult(curve=curve, fold_round=fr, best_round=int(best["round"]), best_value=float(best["mean"]),
                    oof=oof)


def stopping_round(means: list[tuple[int, float]], patience: int) -> tuple[int, bool]:
    """The best round as early stopping on the mean metric finds it, and whether it
    stopped: the first maximum before ``patience`` rounds in a row bring no better one."""
    best, value = means[0]
    for rnd, mean in means:
        if mean > value:
            best, value = rnd, mean
        elif rnd - best >= patience:
            return best, True
    return best, False


def cross_validate_patient(frame: DataFrame, params: GBTParams, *, n_folds: int, patience: int, **kw) -> CVResult:
    """Cross-validation with early stopping: at most ``params.max_iter`` rounds, and no more than needed to
    see ``patience`` rounds without a better mean (``boost.cross_validate_warm``: each round adds one tree a fold)."""
    from riskframe.operators.boost import cross_validate_warm
    return cross_validate_warm(frame, params, n_folds=n_folds, patience=patience, **kw)


# ---------------------------------------------------------------------------
# M4: random search over the reference's parameter space

# The ranges of the two tuning scripts, for the keys that have a
# Spark equivalent. Depth is drawn from the part of the scripts' ranges (-1..16
# and 3..12) that level-wise trees can grow at any table size, 3..8: what is
# drawn is what is trained and refitted.
LEAFWISE_SPACE = {
    "learning_rate": ("log", 0.005, 0.1),
    "max_depth": ("int", 3, 8),
    "min_data_in_leaf": ("int", 10, 300),
    "feature_fraction": ("float", 0.5, 1.0),
    "bagging_fraction": ("float", 0.5, 1.0),
    "min_gain_to_split": ("float", 0.0, 2.0),
    "scale_pos_weight": ("log_rel", 0.5, 20.0),       # x base class ratio (A13)
}
DEPTHWISE_SPACE = {
    "eta": ("log", 0.005, 0.1),
    "max_depth": ("int", 3, 8),
    "subsample": ("float", 0.5, 1.0),
    "colsample_bytree": ("float", 0.5, 1.0),
    "gamma": ("float", 0.0, 5.0),
    "scale_pos_weight": ("log_rel", 0.5, 2.0),
}
SEARCH_SPACE = LEAFWISE_SPACE


def sample_params(rng: random.Random, base_spw: float, space: dict = SEARCH_SPACE) -> dict:
    out = {}
    for k, (kind, lo, hi) in space.items():
        if kind == "log":
            out[k] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        elif kind == "log_rel":
            out[k] = math.exp(rng.uniform(math.log(lo * base_spw), math.log(hi * base_spw)))
        elif kind == "int":
            out[k] = rng.randint(int(lo), int(hi))
        else:
            out[k] = rng.uniform(lo, hi)
    return out


def random_search(frame: DataFrame, *, n_trials: int, n_folds: int, max_iter: int, base_spw: float,
                  seed: int = 42, fold_col: str = "fold", label: str = "label", id_col: str = "row_id",
                  space: dict = SEARCH_SPACE, metric: str = "average_precision", patience: int | None = None) -> tuple[DataFrame, dict]:
    """M4: seeded random draws, each scored by ``cross_validate``; returns the
    trials table (number, value, state, params_*, datetime_start,
    datetime_complete, duration) and the best trial's parameters + round. With
    ``patience`` each trial stops early: a trial a task where a task holds the rows
    (``search.patient_trials``), else one after another (``cross_validate_patient``)."""
    rng = random.Random(seed)
    drawn = [sample_params(rng, base_spw, space) for _ in range(n_trials)]
    params = [params_from_reference({**raw, "n_estimators": max_iter, "seed": seed}) for raw in drawn]
    cols = dict(n_folds=n_folds, fold_col=fold_col, label=label, id_col=id_col)
    side_by_side = None
    if patience and params and metric == "average_precision":
        from riskframe.operators.search import patient_trials
        side_by_side = patient_trials(frame, params, patience=patience, **cols)
    rows, best, failure = [], None, None
    for t, (raw, p) in enumerate(zip(drawn, params, strict=True)):
        start = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        t0 = time.time()
        state, value, rnd = "COMPLETE", None, None
        try:
            if side_by_side:
                value, rnd, error, start, end, seconds = side_by_side[t]
                if error:
                    raise RuntimeError(error)
            else:
                res = cross_validate_patient(frame, p, patience=patience, metric=metric, **cols) if patience else cross_validate(frame, p, metric=metric, **cols)
                value, rnd = res.best_value, res.best_round
        except Exception as e:  # noqa: BLE001 - a failed trial is recorded, the search goes on
            state, failure = "FAIL", e
        if not side_by_side:
            end, seconds = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), time.time() - t0
        rows.append((t, value, state, *[float(raw[k]) for k in space], rnd, start, end, seconds))
        if value is not None and (best is None or value > best["value"]):
            best = {"number": t, "value": value, "params": {**raw, "n_estimators": rnd, "seed": seed}}
    if best is None and failure is not None:
        raise RuntimeError(f"all {n_trials} trials failed") from failure
    schema = ("number int, value double, state string, "
              + ", ".join(f"params_{k} double" for k in space)
              + ", best_round int, datetime_start timestamp_ntz, datetime_complete timestamp_ntz, duration double")
    return frame.sparkSession.createDataFrame(rows, schema), best or {}


# ---------------------------------------------------------------------------
# M6, M8, M9: refit, importance, persistence

def model_dir(spark: SparkSession, name: str | None = None) -> str:
    """A folder under the shared checkpoint location for saved models."""
    return f"{intermediate_dir(spark)}/models/{name or uuid.uuid4().hex}"


def node_table(model: GBTClassificationModel, spark: SparkSession, path: str | None = None) -> DataFrame:
    """The model's trees as saved by Spark ML: one row per node with treeID."""
    path = path or model_dir(spark)
    model.write().overwrite().save(path)
    nd = spark.read.parquet(f"{path}/data")
    return nd.select("treeID", "nodeData.*")


def feature_importance(model: GBTClassificationModel, names: list[str], spark: SparkSession) -> DataFrame:
    """M8: per feature the total gain (impurity decrease x node weight, summed
    over splits), the number of splits and the mean gain per split; sorted by gain."""
    nodes = node_table(model, spark).where(F.col("leftChild") >= 0)
    per = nodes.groupBy(F.col("split.featureIndex").alias("idx")).agg(
        F.sum(F.col("gain") * F.col("impurityStats")[0]).alias("gain"),
        F.count(F.lit(1)).alias("split"))
    name_df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "idx int, feature string")
    out = name_df.join(F.broadcast(per), "idx", "left").select(
        "feature", F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("split", F.lit(0)).cast("long")
        .alias("split"))
    return out.withColumn("gain_per_split", F.when(F.col("split") > 0, F.col("gain") / F.col("split"))
                          .otherwise(F.lit(0.0))).orderBy(F.col("gain").desc(), F.col("feature"))


def merge_importance(a: DataFrame, b: DataFrame, key: str = "feature") -> DataFrame:
    """Full outer merge of two importance tables, missing -> 0."""
    va = [c for c in a.columns if c != key]
    vb = [c for c in b.columns if c != key]
    j = a.select(key, *[F.col(c).alias(f"a_{c}") for c in va]).join(
        b.select(key, *[F.col(c).alias(f"b_{c}") for c in vb]), key, "full")
    return j.select(key, *[F.coalesce(F.col(f"a_{c}"), F.lit(0)).alias(f"a_{c}") for c in va],
                    *[F.coalesce(F.col(f"b_{c}"), F.lit(0)).alias(f"b_{c}") for c in vb])


def save_model(model: GBTClassificationModel, prep: FramePrep, path: str, extra: dict | None = None) -> None:
    """M9 + S7: the model, its level dictionary and a JSON manifest (feature order, fills, sizes)."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    Dictionary(prep.dictionary, prep.levels).save(spark, f"{path}/dictionary")
    meta = {"prep": {**asdict(prep), "dictionary": None}, **(extra or {})}
    spark.createDataFrame([(json.dumps(meta),)], "manifest string").coalesce(1).write.mode("overwrite") \
        .text(f"{path}/manifest")


def load_model(path: str) -> tuple[GBTClassificationModel, FramePrep, dict]:
    spark = SparkSession.getActiveSession()
    model = GBTClassificationModel.load(f"{path}/model")
    meta = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    prep = FramePrep(**{**meta.pop("prep"), "dictionary": f"{path}/dictionary"})     # the folder may have been moved
    return model, prep, meta

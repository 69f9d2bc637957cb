"""Ranking and calibration metrics on a scored table.

Input: a DataFrame with a score column and a 0/1 target (optionally a fold).
Rows are first reduced to one row per distinct score (positives, negatives),
so ties are handled exactly and a score shared by many rows is a single row.
Running sums over the distinct scores come from ``prefix.running_sums``
(range-bucketed windows), never from a one-task global window. Only the
final metric rows (a handful of numbers) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.prefix import running_sums
from riskframe.session import durable


def score_counts(df: DataFrame, score: str = "score", target: str = "target", by: list[str] | None = None
                 ) -> DataFrame:
    """One row per (group, distinct score): ``pos``, ``neg`` counts."""
    by = list(by or [])
    y = F.col(target).cast("long")
    return (df.where(F.col(score).isNotNull() & F.col(target).isNotNull())
            .groupBy(*by, F.col(score).alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def curve_table(df: DataFrame, score: str = "score", target: str = "target", by: list[str] | None = None,
                n_buckets: int | None = None) -> DataFrame:
    """Per distinct score, in descending score order: ``tp`` / ``fp`` when
    predicting positive for ``score >= threshold``, group totals ``P``/``N``,
    the number of distinct scores ``n_thr`` and ``rank`` (0 = highest score)."""
    by = list(by or [])
    # written once: splits, bucket totals and rows are all read from it, the scored table is not
    d = durable(score_counts(df, score, target, by))
    c = running_sums(d, "score", ["pos", "neg"], descending=True, by=by, n_buckets=n_buckets, rank_col="rank",
                     totals=True)
    return c.select(*by, "score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    F.col("tot_pos").alias("P"), F.col("tot_neg").alias("N"), F.col("tot_n").alias("n_thr"), "rank")


def _metric_terms(ct: DataFrame) -> DataFrame:
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    prec = tp / (tp + fp)
    tp0, fp0 = tp - pos, fp - neg
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
    return ct.select(
        "*",
        (neg * (tp0 + pos / 2.0)).alias("_auc_term"),                        # Mann-Whitney, ties half
        (pos * prec).alias("_ap_term"),                                      # step sum of dRecall * P
        (pos * (prec + prec0) / 2.0).alias("_tr_term"),                      # trapezoid from (0, 1)
    )


def ranking_metrics(df: DataFrame, score: str = "score", target: str = "target", by: list[str] | None = None,
                    n_buckets: int | None = None) -> DataFrame:
    """K1, K2, K3 (and K7 with ``by=["fold"]``): ``roc_auc``, ``average_precision``,
    ``pr_auc`` per group. AUC is NULL for a group with one class; AP and the
    trapezoid are NULL without positives."""
    by = list(by or [])
    t = _metric_terms(curve_table(df, score, target, by, n_buckets))
    g = t.groupBy(*by).agg(F.sum("_auc_term").alias("_a"), F.sum("_ap_term").alias("_p"),
                           F.sum("_tr_term").alias("_t"), F.first("P").alias("P"), F.first("N").alias("N"))
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    return g.select(*by,
                    F.when((P > 0) & (N > 0), F.col("_a") / (P * N)).alias("roc_auc"),
                    F.when(P > 0, F.col("_p") / P).alias("average_precision"),
                    F.when(P > 0, F.col("_t") / P).alias("pr_auc"),
                    F.col("P").alias("n_pos"), F.col("N").alias("n_neg"))


def roc_auc(df, score="score", target="target", by=None):
    return ranking_metrics(df, score, target, by).select(*(by or []), "roc_auc")


def average_precision(df, score="score", target="target", by=None):
    return ranking_metrics(df, score, target, by).select(*(by or []), "average_precision")


def pr_auc_trapezoid(df, score="score", target="target", by=None):
    return ranking_metrics(df, score, target, by).select(*(by or []), "pr_auc")


def fold_metrics(df: DataFrame, score: str = "score", target: str = "target", fold: str = "fold",
                 skip_single_class: bool = True) -> DataFrame:
    """K7: per-fold AUC / AP / PR-AUC; folds with one class are skipped."""
    m = ranking_metrics(df, score, target, [fold])
    if skip_single_class:
        m = m.where((F.col("n_pos") > 0) & (F.col("n_neg") > 0))
    return m


#: Consecutive ranks that one window holds.
RANK_BLOCK = 1 << 16


def roc_curve(df: DataFrame, score: str = "score", target: str = "target", drop_intermediate: bool = True
              ) -> DataFrame:
    """K4: ``(fpr, tpr, threshold)`` from highest threshold down, starting at
    (0, 0, +inf). With ``drop_intermediate`` collinear points are dropped: an
    inner point stays only if the next threshold adds a different number of
    positives or negatives than this one. With one class the other's rate is NULL."""
    ct = curve_table(df, score, target)
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    pts = ct.select("score", "rank", "tp", "fp", "pos", "neg", "P", "N", "n_thr")
    if drop_intermediate:
        # ranks are dense: blocks of them, each with the first row of the next one, hold every row's successor
        block = F.floor(F.col("rank") / RANK_BLOCK)
        border = (F.col("rank") % RANK_BLOCK == 0) & (F.col("rank") > 0)
        seen = pts.withColumn("_block", F.explode(F.when(border, F.array(block - 1, block)).otherwise(F.array(block))))
        after = Window.partitionBy("_block").orderBy("rank")
        pts = seen.select("*", F.lead("pos").over(after).alias("npos"), F.lead("neg").over(after).alias("nneg")).where(
            (F.col("_block") == block)
            & ((F.col("rank") == 0) | (F.col("rank") == F.col("n_thr") - 1)
               | (F.col("npos") != F.col("pos")) | (F.col("nneg") != F.col("neg"))))
    pts = pts.select((F.col("rank") + 1).alias("step"), F.try_divide(F.col("fp"), N).alias("fpr"),
                     F.try_divide(F.col("tp"), P).alias("tpr"), F.col("score").alias("threshold"))
    spark = df.sparkSession
    origin = spark.createDataFrame([(0, 0.0, 0.0, float("inf"))], "step long, fpr double, tpr double, "
                                                                   "threshold double")
    return origin.unionByName(pts)


def pr_curve(df: DataFrame, score: str = "score", target: str = "target") -> DataFrame:
    """K5: ``(precision, recall, threshold)`` for every distinct score, plus the
    end point (1, 0) without a threshold. Recall is 1 everywhere without positives."""
    ct = curve_table(df, score, target)
    tp, fp, P = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("P").cast("double")
    pts = ct.select(F.col("score").alias("threshold"),
                    F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
                    F.when(P > 0, tp / P).otherwise(F.lit(1.0)).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return pts.unionByName(end)


def best_f1(df: DataFrame, score: str = "score", target: str = "target") -> DataFrame:
    """K6: F1 of ``score >= t`` at every distinct score except the highest;
    the first maximum in ascending threshold order wins. With a single
    distinct score the answer is (0.0, 0.5), as in the reference (T15)."""
    ct = curve_table(df, score, target)
    tp, fp, P = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("P").cast("double")
    f1 = F.when(tp + fp + P > 0, 2 * tp / (tp + fp + P)).otherwise(F.lit(0.0))
    cand = ct.where(F.col("rank") > 0).select(f1.alias("best_f1"), F.col("score").alias("best_threshold"))
    best = cand.orderBy(F.col("best_f1").desc(), F.col("best_threshold").asc()).limit(1)
    fallback = df.sparkSession.createDataFrame([(0.0, 0.5)], "best_f1 double, best_threshold double")
    # exactly one row: the best candidate, or the fallback when there is none
    both = best.withColumn("_pri", F.lit(0)).unionByName(fallback.withColumn("_pri", F.lit(1)))
    return both.orderBy("_pri").limit(1).drop("_pri")


def brier(df: DataFrame, pred: str = "score", target: str = "target", by: list[str] | None = None) -> DataFrame:
    """K8: mean squared error of the probability."""
    by = list(by or [])
    e = F.pow(F.col(pred).cast("double") - F.col(target).cast("double"), 2)
    return df.groupBy(*by).agg(F.avg(e).alias("brier")) if by else df.agg(F.avg(e).alias("brier"))


def exact_quantiles(df: DataFrame, col: str, qs: list[float], n_buckets: int | None = None) -> list[float | None]:
    """Exact linear-interpolated quantiles (numpy's default) without a
    single-task sort or a value->count map: distinct values with counts get
    running counts (bucketed windows, which also carry the total), and only
    the <= 2 rows per quantile that hold the needed order statistics are
    fetched, in the same job."""
    d = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v"))
         .agg(F.count(F.lit(1)).alias("c")))
    c = running_sums(d, "v", ["c"], n_buckets=n_buckets, rank_col=None, totals=True)
    lo, hi, n = F.col("cum_c") - F.col("c"), F.col("cum_c"), F.col("tot_c")
    cond = F.lit(False)
    for q in qs:
        j = F.floor(F.lit(float(q)) * (n - 1))
        k = F.least(j + 1, n - 1)
        cond = cond | ((lo <= j) & (j < hi)) | ((lo <= k) & (k < hi))
    rows = c.where(cond).select("v", "c", "cum_c", "tot_c").collect()     # <= 2 rows per quantile
    if not rows:
        return [None for _ in qs]
    n_tot = int(rows[0]["tot_c"])
    spans = sorted((int(r["cum_c"]) - int(r["c"]), int(r["cum_c"]), float(r["v"])) for r in rows)

    def at(rank: int) -> float:
        for a, b, v in spans:
            if a <= rank < b:
                return v
        raise AssertionError(rank)

    out = []
    for q in qs:
        h = q * (n_tot - 1)
        j = int(h // 1)
        k = min(j + 1, n_tot - 1)
        a, b = at(j), at(k)
        out.append(a + (b - a) * (h - j))
    return out


def calibration_table(df: DataFrame, pred: str = "score", target: str = "target", n_bins: int = 10) -> DataFrame:
    """K9: quantile bins of the prediction; per non-empty bin the mean
    prediction and the observed rate. A row's bin is the number of interior
    edges strictly below its prediction."""
    edges = exact_quantiles(df, pred, [i / n_bins for i in range(1, n_bins)])
    p = F.col(pred).cast("double")
    if edges[0] is None:
        b = F.lit(0)
    else:
        b = sum((F.when(p > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return (df.where(p.isNotNull()).select(b.alias("bin"), p.alias("_p"), F.col(target).cast("double").alias("_y"))
            .groupBy("bin").agg(F.avg("_p").alias("pred_mean"), F.avg("_y").alias("obs_rate"),
                                F.count(F.lit(1)).alias("n")))


def top_k(df: DataFrame, k: int = 5, score: str = "score", id_col: str = "row_id") -> DataFrame:
    """The k highest scores (ties by id); a TakeOrdered, no full sort."""
    return df.orderBy(F.col(score).desc(), F.col(id_col).asc()).limit(k)


def argmax_first(df: DataFrame, metric: str, order: str) -> DataFrame:
    """The row with the highest metric; ties go to the smallest ``order``."""
    return df.orderBy(F.col(metric).desc(), F.col(order).asc()).limit(1)


def compare_raw_calibrated(df: DataFrame, raw: str, calibrated: str, target: str = "target") -> DataFrame:
    """Brier and calibration table for the raw and the calibrated score, labelled."""
    out = None
    for label, col in (("raw", raw), ("calibrated", calibrated)):
        b = brier(df, col, target).first()["brier"]
        t = calibration_table(df, col, target).withColumn("kind", F.lit(label)).withColumn("brier", F.lit(b))
        out = t if out is None else out.unionByName(t)
    return out


def cv_curve(per_round: DataFrame, round_col: str = "round", value: str = "value") -> DataFrame:
    """Per round the mean metric over folds and mean -/+ population std."""
    g = per_round.groupBy(round_col).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    return g.select(round_col, "mean", (F.col("mean") - F.col("std")).alias("lower"),
                    (F.col("mean") + F.col("std")).alias("upper"))

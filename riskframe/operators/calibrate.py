"""Isotonic calibration of scores.

The fit is the greatest convex minorant of the cumulative diagram of the targets
over the sorted distinct scores. Scores are combined to one row each, sorted over
range partitions, and every range pools its adjacent violators; the ranges' blocks
are pooled again in a reduction tree, ``FAN_IN`` neighbours at a time. Pooling a
part of the line first does not change the result, so the tree gives the exact
fit. No block passes through the driver; a task of the tree holds the blocks of
its ranges only, at the root those of the result.

A calibrator is a written table ``(x, y)`` of the blocks' ends: between two blocks
values are interpolated linearly, outside the fitted range they are the end
values. It is applied by a lookup in its arrays where they have at most
``BROADCAST_BOUNDARIES`` entries (their number is checked), and otherwise by an
as-of join over score ranges.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators.metrics import brier
from riskframe.operators.prefix import add_bucket, default_buckets, range_splits
from riskframe.session import durable, intermediate_dir

#: Neighbouring ranges that one task of the reduction tree pools.
FAN_IN = 16
#: Largest calibrator that is sent to the tasks (16 MB).
BROADCAST_BOUNDARIES = 1_000_000
_BLOCK = "part long, lo double, hi double, s double, w double"


@dataclass
class Calibrator:
    """A fitted calibrator: the folder of its boundary table, and their number."""

    path: str
    n: int

    def boundaries(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("x double, y double").parquet(self.path)


@dataclass
class CalibrationFit:
    model: Calibrator
    raw_brier: float
    calibrated_brier: float


def pool(lo: np.ndarray, hi: np.ndarray, s: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """Pool adjacent violators: blocks in order of score with target sum ``s`` and count ``w``; means come out increasing."""
    out: list[list[float]] = []
    for block in zip(lo.tolist(), hi.tolist(), s.tolist(), w.tolist(), strict=True):
        a, b, t, n = block
        while out and out[-1][2] * n >= t * out[-1][3]:
            first = out.pop()
            a, t, n = first[0], t + first[2], n + first[3]
        out.append([a, b, t, n])
    return list(np.asarray(out, dtype=float).reshape(-1, 4).T)


def isotonic_blocks(df: DataFrame, pred: str, target: str, n_ranges: int | None = None) -> DataFrame:
    """(part, lo, hi, s, w): the pooled blocks of the increasing fit, by the reduction tree."""
    counts = (df.where(F.col(pred).isNotNull() & F.col(target).isNotNull()).groupBy((F.col(pred).cast("double") + 0.0).alias("lo"))
              .agg(F.sum(F.col(target).cast("double")).alias("s"), F.count(F.lit(1)).cast("double").alias("w")))
    n_ranges = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def pool_range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        kept = [np.zeros(0)] * 4
        for pdf in batches:         # a range comes in order, in batches: its blocks so far and the next batch
            lo = pdf["lo"].to_numpy()
            kept = pool(*(np.concatenate([k, v]) for k, v in zip(kept, (lo, lo, pdf["s"].to_numpy(), pdf["w"].to_numpy()), strict=True)))
        yield pd.DataFrame({"part": TaskContext.get().partitionId(), "lo": kept[0], "hi": kept[1], "s": kept[2], "w": kept[3]})

    def pool_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        lo, hi, s, w = pool(*(pdf[c].to_numpy() for c in ("lo", "hi", "s", "w")))
        return pd.DataFrame({"part": pdf["part"].iloc[0] // FAN_IN, "lo": lo, "hi": hi, "s": s, "w": w})

    blocks = counts.repartitionByRange(n_ranges, "lo").sortWithinPartitions("lo").mapInPandas(pool_range, _BLOCK)
    while n_ranges > 1:
        blocks = blocks.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(pool_group, _BLOCK)
        n_ranges = -(-n_ranges // FAN_IN)
    return blocks


def fit_isotonic(df: DataFrame, pred: str = "oof_pred", target: str = "target") -> Calibrator:
    """Increasing isotonic fit of target on prediction, written as a table of block ends."""
    spark = df.sparkSession
    path = f"{intermediate_dir(spark)}/calibrators/{uuid.uuid4().hex}"
    value = F.col("s") / F.col("w")
    ends = F.array_distinct(F.array(F.struct(F.col("lo").alias("x"), value.alias("y")), F.struct(F.col("hi").alias("x"), value.alias("y"))))
    isotonic_blocks(df, pred, target).select(F.explode(ends).alias("e")).select("e.x", "e.y").write.mode("overwrite").parquet(path)
    return load_calibrator(path, spark)


def apply_calibrator(df: DataFrame, model: Calibrator, pred: str = "prediction", out: str | None = None) -> DataFrame:
    """Add ``<pred>_calibrated`` (clipped outside the fitted range; NULL stays NULL, and so does everything
    under a calibrator that was fitted on no rows)."""
    out = out or f"{pred}_calibrated"
    x = F.col(pred).cast("double")
    if model.n == 0:
        return df.withColumn(out, F.lit(None).cast("double"))
    if model.n > BROADCAST_BOUNDARIES:
        return _between(df, model.boundaries(df.sparkSession), x, out)
    rows = model.boundaries(df.sparkSession).toPandas().sort_values("x")      # bounded just above
    shared = df.sparkSession.sparkContext.broadcast((rows["x"].to_numpy(), rows["y"].to_numpy()))

    @F.pandas_udf("double")
    def interpolate(values: pd.Series) -> pd.Series:
        v = values.to_numpy(dtype=float, na_value=np.nan)
        return pd.Series(np.where(np.isnan(v), np.nan, np.interp(v, *shared.value)))

    return df.withColumn(out, F.nanvl(interpolate(x), F.lit(None).cast("double")))


def _between(df: DataFrame, boundaries: DataFrame, x, out: str) -> DataFrame:
    """Interpolate between the last boundary at or below and the first at or above each row, over score ranges."""
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_r"), x.alias("_x"), F.lit(None).cast("struct<x:double,y:double>").alias("_b"))
    ends = boundaries.select(F.lit(None).cast(rows.schema["_r"].dataType).alias("_r"), F.col("x").alias("_x"), F.struct("x", "y").alias("_b"))
    splits = range_splits(boundaries, "x", default_buckets(df))
    both = add_bucket(rows.unionByName(ends).where("_x IS NOT NULL"), "_x", splits, "_bucket")
    each = durable(add_bucket(boundaries, "x", splits, "_bucket").groupBy("_bucket").agg(F.min(F.struct("x", "y")).alias("least"), F.max(F.struct("x", "y")).alias("most")))
    spark = df.sparkSession
    order = Window.orderBy("_bucket")       # one row a range
    carried = (spark.range(len(splits) + 1).select(F.col("id").cast("int").alias("_bucket")).join(each, "_bucket", "left")
               .select("_bucket", F.last("most", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                       F.first("least", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after")))
    inside = Window.partitionBy("_bucket").orderBy("_x")
    a = F.coalesce(F.last("_b", ignorenulls=True).over(inside.rangeBetween(Window.unboundedPreceding, 0)), "_before")
    b = F.coalesce(F.first("_b", ignorenulls=True).over(inside.rangeBetween(0, Window.unboundedFollowing)), "_after")
    found = both.join(carried, "_bucket").select("_r", "_x", a.alias("a"), b.alias("b")).where("_r IS NOT NULL")
    share = (F.col("_x") - F.col("a.x")) / (F.col("b.x") - F.col("a.x"))
    y = (F.when(F.col("a").isNull(), F.col("b.y")).when(F.col("b").isNull(), F.col("a.y")).when(F.col("a.x") == F.col("b.x"), F.col("a.y"))
         .otherwise(F.col("a.y") + share * (F.col("b.y") - F.col("a.y"))))
    scored = found.select(*[F.col("_r")[c].alias(c) for c in df.columns], y.alias(out))
    return scored.unionByName(df.where(x.isNull()).withColumn(out, F.lit(None).cast("double")))


def fit_from_oof(oof: DataFrame, pred: str = "oof_pred", target: str = "target", by_fold: bool = False,
                 fold: str = "fold") -> CalibrationFit:
    """B3 fit: raw Brier, isotonic fit, Brier of the calibrated OOF scores.

    As in the reference the calibrator is scored on the rows it was fitted on
    (T14, optimistic); ``by_fold=True`` instead fits on the other folds for each
    fold and reports that honest Brier."""
    raw = brier(oof, pred, target).first()["brier"]
    model = fit_isotonic(oof, pred, target)
    if not by_fold:
        cal = apply_calibrator(oof, model, pred, "_c")
        cb = brier(cal, "_c", target).first()["brier"]
    else:
        folds = [r[0] for r in oof.select(fold).distinct().collect()]    # a handful of fold ids
        parts = None
        for f in folds:
            m = fit_isotonic(oof.where(F.col(fold) != f), pred, target)
            p = apply_calibrator(oof.where(F.col(fold) == f), m, pred, "_c")
            parts = p if parts is None else parts.unionByName(p)
        cb = brier(parts, "_c", target).first()["brier"]
    return CalibrationFit(model, float(raw), float(cb))


def save_calibrator(model: Calibrator, path: str) -> None:
    spark = SparkSession.getActiveSession()
    model.boundaries(spark).write.mode("overwrite").parquet(path)


def load_calibrator(path: str, spark: SparkSession | None = None) -> Calibrator:
    spark = spark or SparkSession.getActiveSession()
    return Calibrator(path, spark.read.schema("x double, y double").parquet(path).count())

"""Applying fitted, stateless steps to a streaming DataFrame.

The reference has no streaming; this module only shows that the fitted
artefacts are plain projections: a ``CleanModel`` (rules, caps, drops), the
model-frame preparation, a GBT model and an isotonic calibrator all apply
unchanged to ``spark.readStream`` input, with no state and no shuffle.
Fitting stays a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.operators.clean import CleanModel


def clean_stream(stream: DataFrame, model: CleanModel) -> DataFrame:
    """C2-C8 + drops of a fitted cleaner on a stream (C1 dedup is batch-only)."""
    from riskframe.operators.clean import _rule_expr
    spec = model.spec
    ruled = stream.select(*[_rule_expr(f.name, f.dataType, spec).alias(f.name) for f in stream.schema.fields])
    return model.apply(ruled)


def score_stream(stream: DataFrame, prep, gbt_model, calibrator=None, id_col: str = "SK_ID_CURR") -> DataFrame:
    """M7 (+K11) on a stream of feature rows: ``(id, score[, score_calibrated])``."""
    from riskframe.operators.calibrate import apply_calibrator
    from riskframe.operators.model import apply_prep, positive_probability
    frame = apply_prep(stream.withColumnRenamed(id_col, "row_id"), prep, keep=["row_id"])
    scored = positive_probability(gbt_model, frame).select("row_id", "score")
    if calibrator is not None:
        scored = apply_calibrator(scored, calibrator, "score")
    return scored.withColumnRenamed("row_id", id_col)


__all__ = ["clean_stream", "score_stream"]

"""Training rows in as many partitions as the cluster has cores, one summary a column, fills in groups of columns, bounded samples."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.operators import boost as B
from riskframe.operators import clean as C
from riskframe.operators import folds as FO
from riskframe.operators import model as MD
from riskframe.sources.tables import raw_rejects


def _frame(spark, n=240):
    rows = [(i, float(i % 3 == 0), i % 3, Vectors.dense([i % 7, (i * 37) % 11])) for i in range(n)]
    return spark.createDataFrame(rows, ["row_id", "label", "fold", "features"]).withColumn("fold", F.col("fold").cast("int"))


def test_training_tasks_do_not_grow_with_the_partitions(spark, monkeypatch):
    most = max(MD.LEAST_TASKS, spark.sparkContext.defaultParallelism)
    frame = _frame(spark).repartition(4 * most)
    seen = []

    class Estimator:
        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))

        def setWeightCol(self, _):
            return self

    monkeypatch.setattr(MD.GBTParams, "estimator", lambda self, **kw: Estimator())
    MD.train_gbt(frame, MD.GBTParams(scale_pos_weight=2.0))
    MD.train_gbt(frame.repartition(3), MD.GBTParams())
    assert seen == [(most, 240), (3, 240)]


def test_boosted_rounds_do_not_grow_with_the_partitions(spark, monkeypatch):
    most = max(MD.LEAST_TASKS, spark.sparkContext.defaultParallelism)
    seen = []
    real = B.next_round
    monkeypatch.setattr(B, "next_round", lambda state, *a: seen.append(state.rdd.getNumPartitions()) or real(state, *a))
    res = B.cross_validate_warm(_frame(spark).repartition(4 * most), MD.GBTParams(max_iter=2, max_depth=2), n_folds=3, patience=1)
    assert seen and max(seen) <= most and res.oof.count() == 240


def test_one_summary_a_winsorised_column(spark, monkeypatch):
    rows = [(i, float(i * 7919 % 1000), float(i % 2), 5.0 if i % 1000 else 6.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, AMT_A double, AMT_B double, AMT_C double").repartition(5)
    spec = C.CleanSpec("t", winsor_q=0.99, quasi_tol=0.99, protect=("SK_ID_CURR",))
    wide = C.winsor_columns(df, spec)
    made = []
    real = F.percentile_approx
    monkeypatch.setattr(C.F, "percentile_approx", lambda *a: made.append(a) or real(*a))
    apart = C.fit_ruled(df, spec)
    assert wide and len([a for a in made if "_ok" not in str(a[0])]) == len(wide)      # _ok: ranges of the running sums
    # C9 without winsorising finds the same columns from summaries of their own
    assert set(C.top_value_shares(df.select(*wide), tol=0.99)) <= set(apart.dropped) and "AMT_C" in apart.dropped
    data = sorted(r[1] for r in rows)
    h = 0.99 * (len(data) - 1)
    assert apart.caps["AMT_A"] == pytest.approx(data[int(h)] + (data[int(h) + 1] - data[int(h)]) * (h - int(h)))


def test_fills_in_groups_of_columns(spark, monkeypatch):
    rows = [tuple(None if (i + j) % 9 == 0 and j % 2 else float(i * j - 20) for j in range(20)) for i in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"c{j} double" for j in range(20)))
    monkeypatch.setattr(MD, "PREP_COLUMNS", 3)
    prep = MD.fit_prep(df, df.columns)
    low = {f"c{j}": min(r[j] for r in rows if r[j] is not None) for j in range(20)}
    assert prep.fills == {c: v - 1.0 - abs(v) for c, v in low.items()}
    assert prep.indicators == [f"c{j}" for j in range(20) if any(r[j] is None for r in rows)]
    assert MD.fit_prep(df.limit(0), ["c0"]).fills == {"c0": -1.0}


def test_sample_reads_wide_rows_below_the_last_hash_only(spark):
    df = spark.createDataFrame([(i % 50 if i % 7 else None, float(i), "x" * 10) for i in range(400)], "row_id long, a double, b string").repartition(6)
    got = [r.row_id for r in FO.sample_n(df, 25, id_col="row_id").collect()]
    keyed = sorted((r[1], r[0] is not None, r[0] or 0) for r in df.select("row_id", F.xxhash64("row_id", F.lit(42))).collect())
    assert got == [k if known else None for _, known, k in keyed[:25]]
    plan = FO.sample_n(df, 25, id_col="row_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "xxhash64" in plan.split("Filter", 1)[1]


def test_lines_are_counted_without_parsing(spark):
    path = tempfile.mkdtemp(prefix="riskframe-rejects-", dir="/tmp") + "/bureau.csv"
    with open(path, "w") as f:
        f.write("SK_ID_CURR,AMT_X\n1,2.5\n\n2,bad\n3\n4,5,6\n5,oops\n")
    out = raw_rejects(spark, path)
    got = sorted((r.line, r.column, r.text) for r in out.where("column is not null").collect())
    assert got == [(3, "AMT_X", "bad"), (6, "AMT_X", "oops")]
    assert sorted(r.line for r in out.where("column is null").collect()) == [4, 5]
    leaves = out._jdf.queryExecution().analyzed().collectLeaves()
    whole = [leaves.apply(i).relation().options().contains("columnPruning") for i in range(leaves.size())]
    assert sorted(whole) == [False, True]

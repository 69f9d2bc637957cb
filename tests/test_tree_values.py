"""Trees read from their printed form: the values of Spark's own transform, in one pass over each vector."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from riskframe.operators import boost as B
from riskframe.operators import model as MD


def _frame(spark, n=300):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        a, b, c = float(rng.normal() * 1e-7), float(i % 7), float(rng.integers(0, 2))
        x = Vectors.dense([a, b, c]) if i % 2 else Vectors.sparse(3, {1: b})
        rows.append((i, float(a > 0 or b > 4), i % 3, x))
    return spark.createDataFrame(rows, ["row_id", "label", "fold", "features"]).withColumn("fold", F.col("fold").cast("int"))


def _transformed(model, frame, rounds):
    """Running sums of the weighted predictions of Spark's own trees."""
    x = frame
    for i, tree in enumerate(model.trees):
        x = tree.setFeaturesCol("features").setPredictionCol(f"t{i}").transform(x)
    out = {}
    for r in x.collect():
        total, sums = 0.0, []
        for i, w in enumerate(model.treeWeights):
            total += r[f"t{i}"] * w
            sums.append(total)
        out[r["row_id"]] = [sums[k - 1] for k in rounds]
    return out


@pytest.mark.parametrize("depth", [1, 4])
def test_margins_are_those_of_transform(spark, depth):
    frame = _frame(spark)
    model = MD.train_gbt(frame, MD.GBTParams(max_iter=5, max_depth=depth, step_size=0.3))
    got = MD.margins_at(model, frame, [5, 2, 3])
    assert got.columns == [*frame.columns, "m_2", "m_3", "m_5"]
    assert {r.row_id: [r.m_2, r.m_3, r.m_5] for r in got.collect()} == _transformed(model, frame, [2, 3, 5])
    assert MD.margins_at(model, frame.limit(0), [1]).count() == 0


def test_categories_single_leaves_and_odd_numbers(spark):
    rows = [(i, "pqrs"[i % 4], float(i % 5), float(i % 4 in (0, 3)) + 0.1 * (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, kind string, b double, y double")
    df = StringIndexer(inputCol="kind", outputCol="k").fit(df).transform(df)
    df = VectorAssembler(inputCols=["k", "b"], outputCol="features").transform(df)
    tree = DecisionTreeRegressor(labelCol="y", maxDepth=3).fit(df)
    arrays = MD.tree_arrays(tree)
    assert arrays.categories and arrays.depth == tree.depth and len(arrays.value) == tree.numNodes
    both = tree.transform(df).select("prediction", MD.tree_predictions([tree])[0].alias("got")).collect()
    assert all(r.prediction == r.got for r in both)
    leaf = DecisionTreeRegressor(labelCol="y", maxDepth=0).fit(df)
    assert MD.tree_arrays(leaf).depth == 0 and set(MD.tree_values(np.zeros((4, 2)), MD.tree_arrays(leaf))) == {leaf.predict(Vectors.dense([0, 0]))}
    odd = np.array([[0.0, np.nan], [1.0, np.inf], [2.0, -np.inf], [3.0, -0.0]])
    assert MD.tree_values(odd, arrays).tolist() == [tree.predict(Vectors.dense(v)) for v in odd]


def test_rounds_unpack_each_vector_once(spark):
    """Neither the rounds of a model nor the folds' trees of a round add a pass of their own over the vectors."""
    frame = _frame(spark)
    model = MD.train_gbt(frame, MD.GBTParams(max_iter=4, max_depth=2))
    state = frame.select("row_id", "fold", F.col("label").cast("int").alias("target"), (2 * F.col("label") - 1).alias("_y"), F.lit(1.0).alias("_w"),
                         "features", F.array(*[F.lit(0.0)] * 3).alias("margins"), F.array().cast("array<double>").alias("path"))
    for df in (MD.margins_at(model, frame, [1, 2, 3, 4]), B.next_round(state, MD.GBTParams(max_iter=1, max_depth=2), 1, 3, "fold")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.count("UDF(features") == 1


def test_scores_of_all_rounds_are_not_written(spark, monkeypatch):
    """The rows x rounds are counted per score as they are made; only what is counted is written."""
    written = []
    real = MD.durable
    monkeypatch.setattr(MD, "durable", lambda df, *a: written.append(df.columns) or real(df, *a))
    res = MD.cross_validate(_frame(spark), MD.GBTParams(max_iter=3, max_depth=2), n_folds=3)
    assert res.curve.count() == 3 and not any("margin" in c for c in written)

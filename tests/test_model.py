"""TreeSHAP vs exact Shapley enumeration, isotonic vs a NumPy PAV, parameter mapping."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskframe.operators import calibrate as K
from riskframe.operators import explain as X
from riskframe.operators import model as MD


def _toy(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    y = ((x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + 0.1 * rng.random(n)) > 0.7).astype(float)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, label double, a double, b double, c double, d double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df), x


def _cond_exp(nodes, weights, xrow, S):
    """Path-dependent expectation of the margin with features S fixed to xrow."""
    total = 0.0
    for tid, g in nodes.groupby("treeID"):
        by = {int(r.id): r for r in g.itertuples(index=False)}

        def ev(i):
            r = by[i]
            if r.leftChild < 0:
                return r.prediction
            f, thr = int(r.split["featureIndex"]), float(r.split["leftCategoriesOrThreshold"][0])
            if f in S:
                return ev(r.leftChild if xrow[f] <= thr else r.rightChild)
            cl, cr, cn = by[r.leftChild].impurityStats[0], by[r.rightChild].impurityStats[0], r.impurityStats[0]
            return (cl * ev(r.leftChild) + cr * ev(r.rightChild)) / cn

        total += weights[int(tid)] * ev(0)
    return total


def test_treeshap_matches_exact_shapley(spark):
    df, x = _toy(spark)
    model = MD.GBTParams(max_iter=4, max_depth=3, seed=1).estimator(label_col="label").fit(df)
    nodes = MD.node_table(model, spark).toPandas()
    nodes["split"] = nodes["split"].apply(lambda s: s.asDict() if hasattr(s, "asDict") else s)
    ens = X.load_ensemble(model, spark, 4)
    names = ["a", "b", "c", "d"]
    wide = X.attributions(df.where("row_id < 8"), ens, names, names, long=False).orderBy("row_id").collect()
    phi = np.asarray([r.phi for r in wide])
    m = 4
    for r in range(8):
        exact = np.zeros(m)
        for i in range(m):
            others = [j for j in range(m) if j != i]
            for k in range(m):
                for S in itertools.combinations(others, k):
                    w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                    exact[i] += w * (_cond_exp(nodes, model.treeWeights, x[r], set(S) | {i})
                                     - _cond_exp(nodes, model.treeWeights, x[r], set(S)))
        assert phi[r] == pytest.approx(exact, abs=1e-9)
    assert ens.base == pytest.approx(_cond_exp(nodes, model.treeWeights, x[0], set()), abs=1e-12)


def test_chunks_patterns_and_asked_features(spark, monkeypatch):
    """The same attributions in many chunks, by the path recursion instead of pattern tables, and for asked features alone."""
    df, _ = _toy(spark, 40, 3)
    model = MD.GBTParams(max_iter=4, max_depth=4).estimator(label_col="label").fit(df)
    names = ["a", "b", "c", "d"]
    key = lambda att: {(r.row_id, r.feature): (r.value, round(r.phi, 12) + 0.0) for r in att.collect()}        # noqa: E731
    ens = X.load_ensemble(model, spark, 4)
    whole = key(X.attributions(df, ens, names, names))
    assert ens.n_chunks == 1 and len(whole) == 160
    asked = key(X.attributions(df, ens, names, names, only=["b", "d"]))
    assert asked == {k: v for k, v in whole.items() if k[1] in "bd"}
    monkeypatch.setattr(X, "CHUNK_CELLS", 50)
    small = X.load_ensemble(model, spark, 4)
    assert small.n_chunks > 3 and small.base == pytest.approx(ens.base, abs=1e-12) and key(X.attributions(df, small, names, names)) == whole
    monkeypatch.setattr(X, "PATTERN_FEATURES", 1)
    assert key(X.attributions(df, ens, names, names)) == whole
    assert X.attributions(df.limit(0), ens, names, names).count() == 0


def test_attributions_additive_in_spark(spark):
    df, _ = _toy(spark, 200, 3)
    model = MD.GBTParams(max_iter=5, max_depth=3).estimator(label_col="label").fit(df)
    ens = X.load_ensemble(model, spark, 4)
    att = X.attributions(df, ens, ["a", "b", "c", "d"], ["a", "b", "c", "d"])
    tot = att.groupBy("row_id").agg(F.sum("phi").alias("s"))
    mg = MD.margins_at(model, df, [5]).select("row_id", "m_5")
    d = tot.join(mg, "row_id").select(F.abs(F.col("s") + ens.base - F.col("m_5")).alias("d"))
    assert d.agg(F.max("d")).first()[0] < 1e-9


def _pav_predict(x, y, q):
    xs = np.unique(x)
    ys = np.array([y[x == v].mean() for v in xs])
    ws = np.array([np.sum(x == v) for v in xs], dtype=float)
    blocks = [[ys[0], ws[0], 1]]
    for v, w in zip(ys[1:], ws[1:]):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v2, w2, c2 = blocks.pop()
            v1, w1, c1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, c1 + c2])
    fitted = np.concatenate([[b[0]] * b[2] for b in blocks])
    return np.interp(q, xs, fitted)


def test_isotonic_matches_numpy_pav(spark):
    rng = np.random.default_rng(11)
    p = np.round(rng.random(300), 2)
    y = (rng.random(300) < p).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(p, y)], "oof_pred double, target double")
    model = K.fit_isotonic(df)
    q = np.array([-0.5, 0.0, 0.123, 0.5, 0.777, 1.0, 2.0])
    qdf = spark.createDataFrame([(float(v),) for v in q], "prediction double")
    got = [r.prediction_calibrated for r in K.apply_calibrator(qdf, model).collect()]
    assert got == pytest.approx(list(_pav_predict(p, y, q)), abs=1e-12)
    cal = K.apply_calibrator(df, model, "oof_pred").select("oof_pred_calibrated").collect()
    vals = [r[0] for r in cal]
    order = np.argsort(p, kind="stable")
    assert all(vals[order[i]] <= vals[order[i + 1]] + 1e-12 for i in range(len(order) - 1))


@pytest.mark.parametrize("n_ranges", [1, 3, 40])
def test_isotonic_reduction_tree(spark, n_ranges):
    """The blocks do not depend on the ranges; they are those of pooling the whole line."""
    rng = np.random.default_rng(n_ranges)
    p = np.round(rng.random(2000), 3)
    y = (rng.random(2000) < 0.3 + 0.3 * np.sin(6 * p)).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(p, y)], "p double, y double").repartition(5)
    got = sorted((r.lo, r.hi, r.s, r.w) for r in K.isotonic_blocks(df, "p", "y", n_ranges).collect())
    xs = np.unique(p)
    s, w = (np.array([f(y[p == v]) for v in xs]) for f in (np.sum, len))
    want = list(zip(*(x.tolist() for x in K.pool(xs, xs, s, w.astype(float))), strict=True))
    assert got == want and all(a[2] / a[3] < b[2] / b[3] for a, b in zip(want, want[1:]))


def test_calibrator_beyond_the_broadcast_bound(spark, monkeypatch, tmp_path):
    """The as-of join gives what the lookup gives; NULLs, ties, saved copies and empty fits are defined."""
    rng = np.random.default_rng(3)
    p = np.round(rng.random(400), 2)
    rows = [(i, float(a), float(rng.random() < a)) for i, a in enumerate(p)] + [(1000, None, 1.0), (1001, 0.5, None)]
    df = spark.createDataFrame(rows, "id long, oof_pred double, target double")
    model = K.fit_isotonic(df)
    ask = spark.createDataFrame([(i, v) for i, v in enumerate([None, -3.0, 0.0, 0.111, 0.5, 0.5, 0.999, 1.0, 9.0, *map(float, rng.random(50))])], "id long, prediction double")
    near = {r.id: r.prediction_calibrated for r in K.apply_calibrator(ask, model).collect()}
    K.save_calibrator(model, str(tmp_path / "c"))
    assert K.load_calibrator(str(tmp_path / "c")).n == model.n > 2
    monkeypatch.setattr(K, "BROADCAST_BOUNDARIES", 0)
    far = {r.id: r.prediction_calibrated for r in K.apply_calibrator(ask, model).collect()}
    assert far.keys() == near.keys() and far[0] is None and near[0] is None
    assert all(far[i] == pytest.approx(near[i], abs=1e-12) for i in far if i)
    none = K.fit_isotonic(df.limit(0))
    assert none.n == 0 and K.apply_calibrator(ask.limit(2), none).collect()[1].prediction_calibrated is None


def test_params_from_reference():
    p = MD.params_from_reference({"best_params": {"learning_rate": 0.03, "max_depth": -1, "min_data_in_leaf": 154,
                                                  "feature_fraction": 0.69, "bagging_fraction": 1.0,
                                                  "min_gain_to_split": 1.04, "scale_pos_weight": 6.0,
                                                  "num_leaves": 38, "seed": 42}})
    assert (p.max_iter, p.step_size, p.max_depth, p.min_instances_per_node) == (1000, 0.03, 5, 154)
    assert p.feature_subset_strategy == "0.69" and p.scale_pos_weight == 6.0 and "num_leaves" in p.ignored


def test_cross_validate_oof_and_per_fold_best(spark):
    df, _ = _toy(spark, 250, 9)
    frame = df.withColumn("fold", (F.col("row_id") % 3).cast("int"))
    p = MD.GBTParams(max_iter=6, max_depth=2)
    res = MD.cross_validate(frame, p, n_folds=3, grid=[2, 4, 6])
    oof = res.oof.collect()
    assert len(oof) == 250 and len({r.row_id for r in oof}) == 250
    assert res.best_round in (2, 4, 6) and res.curve.count() == 3
    alt = MD.cross_validate(frame, p, n_folds=3, grid=[2, 4, 6], per_fold_best=True).oof
    assert alt.count() == 250 and alt.select("row_id").distinct().count() == 250


def test_attributions_wide_matches_long(spark):
    df, _ = _toy(spark, 60, 5)
    model = MD.GBTParams(max_iter=3, max_depth=2).estimator(label_col="label").fit(df)
    ens = X.load_ensemble(model, spark, 4)
    names = ["a", "b", "c", "d"]
    wide = {r.row_id: r.phi for r in X.attributions(df, ens, names, names, long=False).collect()}
    long = X.attributions(df, ens, names, names).collect()
    for r in long:
        assert wide[r.row_id][names.index(r.feature)] == pytest.approx(r.phi, abs=1e-12)
    top = X.top_contributions(X.attributions(df, ens, names, names), k=2).collect()
    assert len(top) == 2 * 60 and {r["rank"] for r in top} == {1, 2}

"""Fold invariants, hold-out sizes, encoders and alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import encode as E
from riskframe.operators import folds as FO


def _data(spark, n=1003):
    return spark.createDataFrame([(i, int(i % 7 == 0), "abc"[i % 3] if i % 11 else None) for i in range(n)],
                                 "SK_ID_CURR long, TARGET int, cat string")


def test_folds_balanced_and_complete(spark):
    df = _data(spark)
    f = FO.add_cv_folds(df, "TARGET", 5, 42, "SK_ID_CURR")
    assert f.count() == df.count() and f.select("SK_ID_CURR").distinct().count() == df.count()
    counts = f.groupBy("TARGET", "fold").count().collect()
    for t in (0, 1):
        c = [r["count"] for r in counts if r.TARGET == t]
        assert len(c) == 5 and max(c) - min(c) <= 1


def test_folds_independent_of_partitioning(spark):
    df = _data(spark)
    a = {r.SK_ID_CURR: r.fold for r in FO.add_cv_folds(df.repartition(1), "TARGET").collect()}
    b = {r.SK_ID_CURR: r.fold for r in FO.add_cv_folds(df.repartition(13), "TARGET").collect()}
    c = {r.SK_ID_CURR: r.fold for r in FO.add_cv_folds(df, "TARGET", n_splits=5, seed=42).collect()}
    assert a == b == c


def test_positions_do_not_depend_on_the_bucket_count(spark):
    df = _data(spark)
    got = [{r.SK_ID_CURR: r._rank for r in FO.class_rank(df, "TARGET", "SK_ID_CURR", n_buckets=k).collect()} for k in (1, 16, 100)]
    assert got[0] == got[1] == got[2]
    fm = {r.row_id: r.fold for r in FO.fold_map(df).collect()}
    assert fm == {r.SK_ID_CURR: r.fold for r in FO.add_cv_folds(df).collect()}
    nulls = spark.createDataFrame([(None, 1), (None, 0), (3, None), (4, 1)], "SK_ID_CURR long, TARGET int")
    assert sorted(r.fold for r in FO.add_cv_folds(nulls).collect()) == [-1, 0, 0, 1]
    assert FO.add_cv_folds(nulls.limit(0)).count() == 0


def test_portable_sample(spark):
    df = _data(spark)
    want = [r[0] for r in df.orderBy(FO.id_hash("SK_ID_CURR", 42), "SK_ID_CURR").limit(50).collect()]
    assert [r.SK_ID_CURR for r in FO.sample_n(df, 50, portable=True).collect()] == want
    assert FO.sample_n(df, 5000, portable=True).count() == 1003


def test_holdout_sizes(spark):
    df = _data(spark)
    tr, te = FO.split_holdout(df, "TARGET", 0.2)
    n1 = df.where("TARGET = 1").count()
    assert te.where("TARGET = 1").count() == int(n1 * 0.2 + 0.5)
    assert tr.count() + te.count() == df.count()


def test_sample_reproducible(spark):
    df = _data(spark)
    a = [r.SK_ID_CURR for r in FO.sample_n(df, 50).collect()]
    b = [r.SK_ID_CURR for r in FO.sample_n(df.repartition(7), 50).collect()]
    assert a == b and len(set(a)) == 50


def test_one_hot_rows_and_nulls(spark):
    df = _data(spark, 100)
    oh = E.one_hot(df, ["cat"])
    assert [c for c in oh.columns if c.startswith("cat_")] == ["cat_a", "cat_b", "cat_c"]
    s = oh.select((F.col("cat_a") + F.col("cat_b") + F.col("cat_c")).alias("s"), "SK_ID_CURR")
    assert s.agg(F.max("s")).first()[0] == 1
    assert {r.s for r in s.where(F.col("SK_ID_CURR") % 11 == 0).collect()} == {0}


def test_ordinal_codes_and_null_level(spark):
    df = _data(spark, 30)
    e1 = {r.SK_ID_CURR: r.cat for r in E.ordinal_encode(df, ["cat"]).collect()}
    e3 = {r.SK_ID_CURR: r.cat for r in E.ordinal_encode(df, ["cat"], null_as_level=True).collect()}
    assert e1[1] == 1 and e1[0] is None and e3[0] == 3
    dims = E.ordinal_dims(E.ordinal_encode(df, ["cat"], null_as_level=True), ["cat"]).first()
    assert dims.cardinality == 4


def test_align_fills_missing_with_zero(spark):
    a = spark.createDataFrame([(1, 1, None)], "id long, x int, y int")
    b = spark.createDataFrame([(2, 5)], "id long, z int")
    a2, b2 = E.align_columns(a, b)
    assert a2.columns == b2.columns == ["id", "x", "y", "z"]
    ra, rb = a2.first(), b2.first()
    assert ra.y is None and ra.z == 0 and rb.x == 0 and rb.y == 0


def test_numeric_coercion(spark):
    df = spark.createDataFrame([(True, "3.5", "x", 2)], "b boolean, s string, t string, i int")
    r = E.numeric_coercion(df).first()
    assert (r.b, r.s, r.t, r.i) == (1.0, 3.5, None, 2.0)


def test_hot_key_operators(spark):
    """One key holds a third of the rows: results stay exact and the ranked
    class is spread over many window partitions."""
    from riskframe.operators import clean as C
    from riskframe.operators import features as FE
    from riskframe.operators.folds import class_rank
    n = 3000
    rows = [(0 if i % 3 == 0 else i, i, float(i % 17), int(i % 2 == 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, ROWID long, AMT_X double, TARGET int")
    d = {r.SK_ID_CURR: r.ROWID for r in C.dedup_first(df, "SK_ID_CURR", ["ROWID"]).collect()}
    assert d[0] == 0 and len(d) == 1 + (n - n // 3)
    a = {r.SK_ID_CURR: r for r in FE.agg_spec(df, "SK_ID_CURR", "X_", {"AMT_X": ["sum", "max", "nunique"]})
         .collect()}
    assert a[0].X_AMT_X_SUM == sum(float(i % 17) for i in range(0, n, 3)) and a[0].X_AMT_X_NUNIQUE == 17
    ranked = class_rank(df, "TARGET", "ROWID", n_buckets=16).withColumn("b", F.pmod(F.xxhash64("ROWID", F.lit(42)), F.lit(16)))
    sizes = [r["count"] for r in ranked.groupBy("TARGET", "b").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 3 * (n / 32)
    real = ranked.withColumn("b", FO.hash_bucket(FO.id_hash("ROWID", 42), 16)).groupBy("TARGET", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("_rank").alias("lo"), F.max("_rank").alias("hi")).orderBy("TARGET", "b").collect()
    assert len(real) == 32 and max(r.n for r in real) < 3 * (n / 32)
    assert all(a.hi + 1 == b.lo for a, b in zip(real, real[1:]) if a.TARGET == b.TARGET)     # bucket order is rank order
    per = {t: sorted(r._rank for r in ranked.where(F.col("TARGET") == t).collect()) for t in (0, 1)}
    assert per[0] == list(range(n // 2)) and per[1] == list(range(n // 2))

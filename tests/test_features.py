"""Ratios, aggregate semantics and the assembled table's invariants."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskframe.functions.expr import age_band, safe_div
from riskframe.operators import features as FE

SF = "/root/testdata/sf0.001"


def test_safe_div_edges(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (1e308, 1e-308), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, None, None, None, 1.5]


def test_age_band_double_floor(spark):
    df = spark.createDataFrame([(-9131,), (-7300,), (None,)], "d int")
    assert [r[0] for r in df.select(age_band("d")).collect()] == [30.0, 20.0, None]


def test_sum_of_all_null_group_is_zero_and_missing_child_is_null(spark):
    child = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "SK_ID_CURR long, PAYMENT_DIFF double")
    agg = FE.agg_spec(child, "SK_ID_CURR", "INS_", {"PAYMENT_DIFF": ["sum", "mean"]})
    app = spark.createDataFrame([(1,), (2,), (3,)], "SK_ID_CURR long")
    out = {r.SK_ID_CURR: r for r in app.join(agg, "SK_ID_CURR", "left").collect()}
    assert out[1].INS_PAYMENT_DIFF_SUM == 0 and out[1].INS_PAYMENT_DIFF_MEAN is None
    assert out[2].INS_PAYMENT_DIFF_SUM == 3.0 and out[3].INS_PAYMENT_DIFF_SUM is None


def test_status_pivot_ignores_null_and_missing_records(spark):
    bb = spark.createDataFrame([(10, "X"), (10, None), (10, "C"), (11, None)], "SK_ID_BUREAU long, STATUS string")
    bureau = spark.createDataFrame([(10, 1, 5.0), (11, 1, 1.0), (12, 2, 2.0)],
                                   "SK_ID_BUREAU long, SK_ID_CURR long, AMT_CREDIT_SUM double")
    out = {r.SK_ID_CURR: r for r in FE.aggregate_bureau(bureau, bb).collect()}
    assert out[1].BUREAU_BB_STATUS_X_SUM == 1 and out[1].BUREAU_BB_STATUS_C_SUM == 1
    assert out[2].BUREAU_BB_STATUS_X_SUM == 0


def test_prev_features_float_key_long(spark):
    prev = spark.createDataFrame([(2**40 + 1, 1.0, 2.0, "A")],
                                 "SK_ID_CURR long, AMT_APPLICATION double, AMT_CREDIT double, NAME_CONTRACT_STATUS string")
    out = FE.aggregate_prev(prev)
    types = dict(out.dtypes)
    assert types["SK_ID_CURR"] == "bigint" and types["PREV_AMT_CREDIT_MEAN"] == "float"
    assert out.first().SK_ID_CURR == 2**40 + 1


def test_feature_table_one_row_per_applicant(spark):
    from riskframe.plans.build import feature_table
    ft = feature_table(spark, SF)
    n = ft.count()
    assert n == ft.select("SK_ID_CURR").distinct().count() == spark.read.parquet(f"{SF}/customer.parquet").count()
    assert "FLAG_MOBIL" not in ft.columns and "BUREAU_BB_STATUS_A_SUM" in ft.columns


import pytest  # noqa: E402


@pytest.mark.parametrize("name", ["bureau_agg", "feature_assembly", "roc_auc", "calibration_table",
                                  "best_f1", "stratified_folds_counts"])
def test_same_result_with_1_and_8_shuffle_partitions(spark, name):
    from riskframe.plans.registry import QUERIES
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        a = sorted(map(tuple, QUERIES[name](spark, SF).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = sorted(map(tuple, QUERIES[name](spark, SF).collect()), key=repr)
    assert a == b


def test_fold_assignment_independent_of_shuffle_partitions(spark):
    from riskframe.operators.folds import add_cv_folds
    from riskframe.sources import standins as S
    app = S.application(spark, SF)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        a = {r.SK_ID_CURR: r.fold for r in add_cv_folds(app, "TARGET").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = {r.SK_ID_CURR: r.fold for r in add_cv_folds(app, "TARGET").collect()}
    assert a == b


def test_standin_schemas_match_oracle_declarations(spark):
    from riskframe.plans.sqlgen import STANDIN_SCHEMA
    from riskframe.sources import standins as S
    spark_kind = {"bigint": "long", "int": "int", "double": "double", "string": "string"}
    fns = {"application": S.application, "bureau": S.bureau, "bureau_balance": S.bureau_balance,
           "previous": S.previous, "installments": S.installments, "pos_cash": S.pos_cash,
           "credit_card": S.credit_card, "scored": S.scored}
    for view, fn in fns.items():
        got = [(n, spark_kind[t]) for n, t in fn(spark, SF).dtypes]
        assert got == STANDIN_SCHEMA[view], view

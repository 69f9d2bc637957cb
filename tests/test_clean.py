"""The reference's 25 cleaning assertions on the same fixtures, plus edge cases."""

from __future__ import annotations

from conftest import rows_by
from pyspark.sql import functions as F

from riskframe.operators import clean as C


def assert_all_null_or_absent(df, col):
    if col in df.columns:
        assert df.where(F.col(col).isNotNull()).count() == 0


# ----------------- application -----------------

def test_application_sentinel_to_null(tiny_app):
    out = rows_by(C.clean_application(tiny_app))
    assert out[0]["DAYS_EMPLOYED"] is None


def test_application_negative_money_to_null(tiny_app):
    out = rows_by(C.clean_application(tiny_app))
    assert out[0]["AMT_INCOME_TOTAL"] is None


def test_application_constant_drop(tiny_app):
    assert "FLAG_CONST" not in C.clean_application(tiny_app).columns


def test_application_binary_flags(tiny_app):
    out = C.clean_application(tiny_app)
    vals = {r[0] for r in out.select("FLAG_TEST").collect() if r[0] is not None}
    assert vals <= {0, 1}
    assert rows_by(out)[0]["FLAG_TEST"] == 1 and rows_by(out)[1]["FLAG_TEST"] == 0


def test_application_nonnegative_counts_to_null(tiny_app):
    out = rows_by(C.clean_application(tiny_app))
    assert out[0]["CNT_CHILDREN"] is None
    assert out[1]["CNT_FAM_MEMBERS"] is None


def test_application_nonpositive_days_enforced(tiny_app):
    out = rows_by(C.clean_application(tiny_app))
    assert out[0]["DAYS_LAST_PHONE_CHANGE"] is None
    assert out[1]["DAYS_ID_PUBLISH"] is None
    assert out[1]["DAYS_REGISTRATION"] == 0
    assert out[1]["DAYS_EMPLOYED"] == -100


def test_application_expected_table(tiny_app):
    out = rows_by(C.clean_application(tiny_app))
    assert out[0]["DAYS_ID_PUBLISH"] == 0 and out[0]["DAYS_REGISTRATION"] == -7
    assert out[1]["AMT_INCOME_TOTAL"] == 200000.0
    assert out[0]["XNA_COL"] == "XNA" and out[1]["XNA_COL"] == "XAP"
    assert out[1]["CNT_CHILDREN"] == 2 and out[0]["CNT_FAM_MEMBERS"] == 1


# ----------------- bureau -----------------

def test_bureau_negative_to_null(tiny_bureau):
    out = rows_by(C.clean_bureau(tiny_bureau))
    assert out[1]["AMT_CREDIT_SUM_OVERDUE"] is None
    assert out[2]["AMT_CREDIT_SUM_OVERDUE"] is None


def test_bureau_sentinel_replaced(tiny_bureau):
    assert rows_by(C.clean_bureau(tiny_bureau))[0]["DAYS_CREDIT"] is None


def test_bureau_winsorise_upper_cap(tiny_bureau):
    out = C.clean_bureau(tiny_bureau)
    money = [c for c in out.columns if c.startswith("AMT_")]
    caps = C.fit_caps(out, money, 0.99)
    for col in money:
        mx = out.agg(F.max(col)).first()[0]
        if mx is not None:
            assert mx <= caps[col] + abs(caps[col]) * 0.01


def test_bureau_nonpositive_days_enforced(tiny_bureau):
    out = rows_by(C.clean_bureau(tiny_bureau))
    assert out[0]["DAYS_CREDIT_ENDDATE"] is None
    assert out[0]["DAYS_ENDDATE_FACT"] is None
    assert out[1]["DAYS_CREDIT_ENDDATE"] == -10
    assert out[2]["DAYS_CREDIT_ENDDATE"] == 0


def test_bureau_no_constant(tiny_bureau):
    df = tiny_bureau.withColumn("ALWAYS_ONE", F.lit(1))
    assert "ALWAYS_ONE" not in C.clean_bureau(df).columns


def test_bureau_nonnegative_counts_to_null(tiny_bureau):
    out = rows_by(C.clean_bureau(tiny_bureau))
    assert out[0]["CNT_CREDIT_PROLONG"] is None
    assert out[0]["CREDIT_DAY_OVERDUE"] is None
    assert out[2]["CNT_CREDIT_PROLONG"] == 2


# ----------------- POS -----------------

def test_pos_sentinel_to_null(tiny_pos):
    assert rows_by(C.clean_pos(tiny_pos))[0]["MONTHS_BALANCE"] is None


def test_pos_nonnegative_counts_to_null(tiny_pos):
    out = rows_by(C.clean_pos(tiny_pos))
    for c in ("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"):
        assert out[0][c] is None
    assert out[1]["CNT_INSTALMENT"] == 5


def test_pos_constant_status_dropped(tiny_pos):
    assert "NAME_CONTRACT_STATUS" not in C.clean_pos(tiny_pos).columns


# ----------------- installments -----------------

def test_installments_sentinel_to_null_days_instalment(tiny_inst):
    out = rows_by(C.clean_installments(tiny_inst))
    assert out[0]["DAYS_INSTALMENT"] is None
    assert out[1]["DAYS_INSTALMENT"] == -30


def test_installments_entry_payment_may_be_dropped(tiny_inst):
    assert_all_null_or_absent(C.clean_installments(tiny_inst), "DAYS_ENTRY_PAYMENT")


def test_installments_negative_money_to_null(tiny_inst):
    out = rows_by(C.clean_installments(tiny_inst))
    assert out[1]["AMT_INSTALMENT"] is None
    assert out[0]["AMT_PAYMENT"] is None


def test_installments_nonnegative_counts_to_null(tiny_inst):
    out = rows_by(C.clean_installments(tiny_inst))
    assert out[0]["NUM_INSTALMENT_NUMBER"] is None
    assert out[0]["NUM_INSTALMENT_VERSION"] is None
    assert out[1]["NUM_INSTALMENT_NUMBER"] == 4


# ----------------- credit card -----------------

def test_cc_sentinel_to_null(tiny_cc):
    assert rows_by(C.clean_cc(tiny_cc))[0]["MONTHS_BALANCE"] is None


def test_cc_negative_money_to_null(tiny_cc):
    out = rows_by(C.clean_cc(tiny_cc))
    assert out[0]["AMT_BALANCE"] is None
    assert out[0]["AMT_CREDIT_LIMIT_ACTUAL"] is None


def test_cc_constant_dropped(tiny_cc):
    assert "NAME_CONTRACT_STATUS" not in C.clean_cc(tiny_cc).columns


def test_cc_nonnegative_counts_to_null(tiny_cc):
    out = rows_by(C.clean_cc(tiny_cc))
    assert out[0]["SK_DPD"] is None
    assert out[0]["SK_DPD_DEF"] is None
    assert out[1]["SK_DPD_DEF"] == 1


# ----------------- previous_application -----------------

def test_prev_negative_money_to_null(tiny_prev):
    assert rows_by(C.clean_prev(tiny_prev))[0]["AMT_CREDIT"] is None


def test_prev_binary_flags(tiny_prev):
    out = rows_by(C.clean_prev(tiny_prev))
    assert (out[0]["FLAG_TEST"], out[1]["FLAG_TEST"]) == (1, 0)
    assert (out[0]["NFLAG_TEST"], out[1]["NFLAG_TEST"]) == (1, 0)


def test_prev_nonpositive_days_enforced(tiny_prev):
    cleaned = C.clean_prev(tiny_prev)
    out = rows_by(cleaned)
    assert out[0]["DAYS_DECISION"] is None
    assert out[1]["DAYS_DECISION"] == -20
    assert out[0]["DAYS_FIRST_DRAWING"] == 0
    assert out[1]["DAYS_FIRST_DRAWING"] is None
    assert_all_null_or_absent(cleaned, "DAYS_LAST_DUE")
    for c in [c for c in cleaned.columns if c.startswith("DAYS_")]:
        assert cleaned.where(F.col(c) > 0).count() == 0


def test_prev_annuity_q99_cap_linear(tiny_prev):
    out = rows_by(C.clean_prev(tiny_prev))
    assert out[0]["AMT_ANNUITY"] == 500.0
    assert abs(out[1]["AMT_ANNUITY"] - 7925.0) < 1e-9


# ----------------- edge cases (FIXTURES.md §3) -----------------

def test_quasi_constant_exactly_at_tol(spark):
    rows = [(i, 1 if i < 99 else 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, v int")
    shares = C.top_value_shares(df, ["v"], 0.99)
    assert shares == {"v": 0.99}
    rows = [(i, 1 if i < 98 else 2) for i in range(100)]
    assert C.top_value_shares(spark.createDataFrame(rows, "id int, v int"), ["v"], 0.99) == {}


def test_quasi_constant_null_counts_as_value(spark):
    df = spark.createDataFrame([(i, None if i < 995 else "x") for i in range(1000)], "id int, s string")
    assert abs(C.top_value_shares(df, ["s"])["s"] - 0.995) < 1e-12


def test_quasi_constant_string_and_long(spark):
    rows = [(i, "a" if i % 200 else "b", 10**15 if i % 150 else 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, s string, big long")
    shares = C.top_value_shares(df, ["s", "big"], 0.99)
    assert abs(shares["s"] - 2985 / 3000) < 1e-12 and "big" in shares


def test_empty_table_drops_nothing(spark):
    df = spark.createDataFrame([], "SK_ID_CURR long, AMT_CREDIT double, FLAG_X string")
    out = C.clean(df, C.APPLICATION)
    assert out.columns == df.columns and out.count() == 0


def test_all_null_column_dropped(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "SK_ID_CURR long, AMT_X double")
    assert "AMT_X" not in C.clean(df, C.BUREAU).columns


def test_dedup_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 3.0), (2, None), (2, 1.0)], "k long, v double")
    out = {r.k: r.v for r in C.dedup_first(df, "k").collect()}
    assert out == {1: 3.0, 2: None}


def test_flag_numeric_strings(spark):
    from riskframe.functions.expr import binary_flag
    df = spark.createDataFrame([("1.0",), ("0",), ("true",), ("n",), ("maybe",), (None,)], "s string")
    assert [r[0] for r in df.select(binary_flag("s")).collect()] == [1, 0, 1, 0, None, None]


def test_fit_clean_cap_at_candidate(spark):
    """99.5 % zeros plus a few larger values: q99 = 0 = the median, so every
    value is capped to 0 and the column becomes constant after capping."""
    rows = [(i, 0.0 if i < 995 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, AMT_X double")
    m = C.fit_clean(df, C.BUREAU)
    assert m.caps["AMT_X"] == 0.0 and m.dropped == ["AMT_X"] and m.shares["AMT_X"] == 1.0


def test_exact_caps_bracket_and_fallback(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    vals = np.round(rng.lognormal(10, 1, 5000), 2)
    vals[:300] = vals[0]                                   # a heavy tie
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "SK_ID_CURR long, AMT_X double")
    exp = float(np.percentile(vals, 99))
    assert abs(C.fit_clean(df, C.BUREAU).caps["AMT_X"] - exp) < 1e-9 * exp
    # a bracket that misses the statistics takes the distributed exact quantile
    missed = C._bracket_exact(df, ["AMT_X"], 0.99, {"AMT_X": (5000, -2.0, -1.0, 0, 0)})
    assert abs(missed["AMT_X"] - exp) < 1e-9 * exp
    small = spark.createDataFrame([(i, float(i)) for i in range(2000)], "SK_ID_CURR long, AMT_X double")
    assert C.fit_clean(small, C.BUREAU).caps["AMT_X"] == 0.99 * 1999


def test_approximate_caps_option(spark):
    import numpy as np
    vals = np.arange(10000, dtype=float)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "SK_ID_CURR long, AMT_X double")
    exact = C.fit_clean(df, C.BUREAU).caps["AMT_X"]
    approx = C.fit_clean(df, C.BUREAU, accuracy=1000).caps["AMT_X"]
    assert exact == np.percentile(vals, 99) and abs(approx - exact) <= 10000 / 1000 + 1
    assert C.fit_caps(df, ["AMT_X"], 0.99) == {"AMT_X": exact}


def test_extreme_rows_and_histogram(spark):
    from riskframe.operators.profile import histogram
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5e6, 1e7, 2e7, 4e7, None])],
                               "SK_ID_CURR long, AMT_INCOME_TOTAL double")
    ext = C.extreme_rows(df)
    assert sorted(r.AMT_INCOME_TOTAL for r in ext.collect()) == [1e7, 2e7, 4e7]
    h = sorted((r.bin, r["count"]) for r in histogram(ext, "AMT_INCOME_TOTAL", 10).collect())
    assert h == [(b, int(b in (0, 3, 9))) for b in range(10)]           # empty bins count 0

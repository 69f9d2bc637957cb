"""Shared Spark session and the six tiny credit fixtures (FIXTURES.md §1)."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

S = 365243  # day sentinel


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s


def _df(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def tiny_app(spark):
    return _df(spark, "ROW int, SK_ID_CURR long, DAYS_EMPLOYED int, DAYS_LAST_PHONE_CHANGE int, DAYS_ID_PUBLISH int, "
                      "DAYS_REGISTRATION int, AMT_INCOME_TOTAL double, XNA_COL string, FLAG_CONST int, "
                      "FLAG_TEST string, CNT_CHILDREN int, CNT_FAM_MEMBERS int",
               [(0, 1, S, 5, 0, -7, 0.0, "XNA", 1, "1", -1, 1),
                (1, 2, -100, -3, 12, 0, 200000.0, "XAP", 1, "NO", 2, -3)])


@pytest.fixture
def tiny_bureau(spark):
    return _df(spark, "ROW int, SK_ID_BUREAU long, SK_ID_CURR long, AMT_CREDIT_SUM_OVERDUE double, DAYS_CREDIT int, "
                      "DAYS_CREDIT_ENDDATE int, DAYS_ENDDATE_FACT int, CREDIT_ACTIVE string, CNT_CREDIT_PROLONG int, "
                      "CREDIT_DAY_OVERDUE int",
               [(0, 10, 1, 1000.0, S, 15, 1, "Active", -1, -5),
                (1, 11, 2, -50.0, -200, -10, -1, "Closed", 0, 0),
                (2, 12, 3, 0.0, -400, 0, None, "Active", 2, 10)])


@pytest.fixture
def tiny_prev(spark):
    return _df(spark, "ROW int, SK_ID_CURR long, DAYS_DECISION int, DAYS_FIRST_DRAWING int, DAYS_FIRST_DUE int, "
                      "DAYS_LAST_DUE int, DAYS_TERMINATION int, AMT_CREDIT double, AMT_ANNUITY double, "
                      "NFLAG_TEST string, FLAG_TEST string",
               [(0, 1, 10, 0, -1, None, -100, -5000.0, 500.0, "Y", "YES"),
                (1, 2, -20, 5, 0, 2, 0, 250000.0, 8000.0, "NO", "FALSE")])


@pytest.fixture
def tiny_pos(spark):
    return _df(spark, "ROW int, SK_ID_CURR long, MONTHS_BALANCE int, NAME_CONTRACT_STATUS string, CNT_INSTALMENT int, "
                      "CNT_INSTALMENT_FUTURE int, SK_DPD int, SK_DPD_DEF int",
               [(0, 1, S, "Unknown", -1, -2, -1, -3),
                (1, 1, -1, "Unknown", 5, 3, 1, 0),
                (2, 2, 0, "Unknown", 2, 0, 2, 1)])


@pytest.fixture
def tiny_inst(spark):
    return _df(spark, "ROW int, SK_ID_CURR long, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT int, AMT_PAYMENT double, "
                      "AMT_INSTALMENT double, NUM_INSTALMENT_NUMBER int, NUM_INSTALMENT_VERSION int",
               [(0, 1, S, S, 0.0, 500.0, -1, -2),
                (1, 2, -30, 25, 1000.0, -10.0, 4, 1)])


@pytest.fixture
def tiny_cc(spark):
    return _df(spark, "ROW int, SK_ID_CURR long, MONTHS_BALANCE int, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double, "
                      "NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int",
               [(0, 1, S, -1.0, 0.0, "Foo", -4, -2),
                (1, 2, -3, 20000.0, 50000.0, "Foo", 0, 1)])


def rows_by(df, key="ROW"):
    """Collect a small result as {row id: Row}."""
    return {r[key]: r for r in df.collect()}

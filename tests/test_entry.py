"""Driver contract: entry() on sf0.001 and every registered query runs; oracle spot checks."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from riskframe.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "SK_ID_CURR" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["clean_bureau", "bureau_agg", "roc_auc", "calibration_table", "coverage",
                                  "stratified_folds_counts", "ordinal_codes"])
def test_oracle_spot_checks(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    a = E.queries()[name](spark, SF).toPandas()
    b = con.execute(E.oracle_sql()[name]).df()
    assert sorted(a.columns) == sorted(b.columns) and len(a) == len(b)
    cols = sorted(a.columns)
    ka = sorted(map(tuple, a[cols].astype(object).where(a[cols].notna(), None).values.tolist()), key=repr)
    kb = sorted(map(tuple, b[cols].astype(object).where(b[cols].notna(), None).values.tolist()), key=repr)
    assert ka == kb


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema and a.count() == b.count()

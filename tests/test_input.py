"""Raw input: rejects, rows in input order, samples in one scan."""

from __future__ import annotations

import os
import tempfile

import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.operators import clean as C
from riskframe.operators import folds as FO
from riskframe.operators import metrics as M
from riskframe.sources.tables import RAW_FILES, raw_rejects, read_raw_csv, read_raw_rejects


def _file(lines: list[str], name: str = "t.csv", folder: str | None = None) -> str:
    folder = folder or tempfile.mkdtemp(prefix="rf-csv-", dir="/tmp")
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_one_malformed_field_in_each_table(spark):
    folder = tempfile.mkdtemp(prefix="rf-raw-", dir="/tmp")
    for i, name in enumerate(RAW_FILES.values()):
        _file(["SK_ID_CURR,AMT_X,NAME_Y", "1,2.5,a", "2,NA,b", *["3,4,c"] * i, "4,4x5,d", "5,,NaN"], name, folder)
    got = {r["table"]: (os.path.basename(r.file), r.line, r["column"], r.text, r.reason) for r in read_raw_rejects(spark, folder).collect()}
    assert got == {t: (f, 4 + i, "AMT_X", "4x5", "not a double") for i, (t, f) in enumerate(RAW_FILES.items())}


def test_wrong_lines_and_whole_numbers(spark):
    path = _file(["SK_ID_CURR,AMT_X,NAME_Y", "1,2.5,a", "2,3", "7.5,1,b", "3,4,c,d", "x,y,z"])
    got = sorted((r.line, r["column"] or "", r.text, r.reason) for r in raw_rejects(spark, path).collect())
    assert [g for g in got if g[1]] == [(6, "AMT_X", "y", "not a double"), (6, "SK_ID_CURR", "x", "not a bigint")] or \
        [g for g in got if g[1]] == [(4, "SK_ID_CURR", "7.5", "not a bigint"), (6, "AMT_X", "y", "not a double"), (6, "SK_ID_CURR", "x", "not a bigint")]
    assert [(g[0], g[2], g[3]) for g in got if not g[1]] == [(3, "2,3", "not 3 fields"), (5, "3,4,c,d", "not 3 fields")]
    clean = _file(["SK_ID_CURR,AMT_X", "1,2"])
    assert raw_rejects(spark, clean).count() == 0 and raw_rejects(spark, _file(["SK_ID_CURR,AMT_X"])).count() == 0


def test_lines_of_a_split_file(spark):
    path = _file(["SK_ID_CURR,AMT_X", *[f"{i},{'bad' if i % 1000 == 500 else i}" for i in range(20000)]])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = raw_rejects(spark, path)
        assert sorted(r.line for r in got.collect()) == [i + 2 for i in range(20000) if i % 1000 == 500]
        raw = read_raw_csv(spark, path, strict=False, position=True)
        assert raw.rdd.getNumPartitions() > 5
        order = [r.SK_ID_CURR for r in raw.orderBy("_position").collect()]
        assert order == list(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_first_row_in_the_file_stays(spark):
    rows = [(k, v, n) for i in range(3000) for k, v, n in [((i * 7919) % 900, 5000 - i, f"n{i % 13}")]]
    path = _file(["SK_ID_CURR,AMT_X,NAME_Y", *[f"{k if k % 50 else ''},{v},{n}" for k, v, n in rows]])
    want = pd.read_csv(path).drop_duplicates(subset=["SK_ID_CURR"])
    df = C.dedup_first_read(read_raw_csv(spark, path, position=True), "SK_ID_CURR")
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
    key = lambda a, b, c: (-1 if a is None or a != a else int(a), float(b), c)       # noqa: E731
    assert sorted(key(r.SK_ID_CURR, r.AMT_X, r.NAME_Y) for r in df.collect()) == sorted(key(*r) for r in want.itertuples(index=False))
    ruled = C.apply_rules(read_raw_csv(spark, path, position=True), C.APPLICATION)
    assert "_position" not in ruled.columns and ruled.count() == len(want)


@pytest.mark.parametrize("n", [0, 1, 70, 5000])
def test_sample_in_one_scan(spark, n):
    df = spark.range(3000, numPartitions=7).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") % 5).alias("x"))
    want = [r[0] for r in df.orderBy(F.xxhash64("SK_ID_CURR", F.lit(42)), "SK_ID_CURR").limit(n).collect()]
    assert [r.SK_ID_CURR for r in FO.sample_n(df, n).collect()] == want
    plan = FO.sample_n(df, n)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Range (") == 1


def test_sample_of_vectors_and_empty_tables(spark):
    df = spark.createDataFrame([(i, Vectors.dense([i, 2.0])) for i in range(30)], ["row_id", "features"])
    got = FO.sample_n(df, 4, id_col="row_id").collect()
    assert len(got) == 4 and all(list(r.features) == [r.row_id, 2.0] for r in got)
    assert FO.sample_n(df.limit(0), 4, id_col="row_id").count() == 0


def test_roc_curve_over_rank_blocks(spark, monkeypatch):
    rows = [(i, (i * 37) % 101 / 10.0, int((i * i) % 7 < 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, score double, target int")
    whole = M.roc_curve(df).orderBy("step").collect()
    monkeypatch.setattr(M, "RANK_BLOCK", 3)
    curve = M.roc_curve(df)
    assert curve.orderBy("step").collect() == whole

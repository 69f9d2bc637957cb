"""Distinct counts by merged bitmaps, tables stored by buckets and their joins."""

from __future__ import annotations

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from riskframe.operators import bitmaps as BM
from riskframe.operators import clean as C
from riskframe.operators import profile as PR
from riskframe.plans import build
from riskframe.sources import standins as S
from riskframe.sources.bucketed import read_bucketed, write_bucketed

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ids(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}")


def test_counts_and_merges_are_exact(spark):
    rng = random.Random(1)
    days = [[rng.choice([rng.randint(-70_000, 70_000), 5, None, 2**62, -2**62, 32768, 0, -1]) for _ in range(400)] for _ in range(4)]
    tables = [BM.id_bitmaps(ids(spark, d).repartition(3), "k") for d in days]
    for d, t in zip(days, tables):
        assert BM.distinct_from_bitmaps(t).first().customers == len(set(d) - {None})
    merged = BM.merge_bitmaps(tables)
    assert BM.distinct_from_bitmaps(merged).first().customers == len(set().union(*days) - {None})
    assert BM.distinct_from_bitmaps(BM.merge_bitmaps([merged, *tables])).first().customers == len(set().union(*days) - {None})


def test_odd_ids(spark):
    for kind in ("long", "int", "short", "byte"):
        assert BM.distinct_ids(ids(spark, [1, 1, None, 100, -100], kind), "k").first().customers == 3
    assert BM.distinct_ids(ids(spark, ["a", "a", None, "b"], "string"), "k").first().customers == 2
    empty = ids(spark, [])
    assert BM.distinct_ids(empty, "k").first().customers == 0 and BM.id_bitmaps(empty, "k").count() == 0
    with pytest.raises(ValueError):
        BM.id_bitmaps(ids(spark, ["a"], "string"), "k")
    grouped = BM.id_bitmaps(spark.createDataFrame([("x", 1), ("x", 1), ("y", 1), (None, 7), ("y", None)], "g string, k long"), "k", ["g"])
    assert {r.g: r.customers for r in BM.distinct_from_bitmaps(grouped, ["g"]).collect()} == {"x": 1, "y": 1, None: 1}
    assert BM.distinct_from_bitmaps(BM.merge_bitmaps([grouped])).first().customers == 2


def test_coverage_expands_no_ids(spark):
    plan = plan_of(PR.coverage(S.application(spark, SF), {"previous": S.previous(spark, SF)}))
    assert "bitmap_construct_agg" in plan and "Expand" not in plan and "Cartesian" not in plan


def test_bucketed_join_has_no_exchange(spark):
    d = tempfile.mkdtemp(prefix="rf-bucket-", dir="/tmp")
    left = spark.createDataFrame([(i, i * 2) for i in range(300)] + [(None, 1)], "k long, a long")
    right = spark.createDataFrame([(i % 200, f"v{i % 200}") for i in range(200)], "k long, b string")
    write_bucketed(left, f"{d}/left", "k", 5)
    write_bucketed(right, f"{d}/right", "k", 5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = read_bucketed(spark, f"{d}/left").join(read_bucketed(spark, f"{d}/right"), "k", "left")
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert sorted(joined.collect(), key=str) == sorted(left.join(right, "k", "left").collect(), key=str)
        other = spark.newSession()                          # its catalog does not know the table yet
        other.catalog.setCurrentDatabase("default")
        assert read_bucketed(other, f"{d}/left").count() == 301
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    write_bucketed(left.where("k < 10"), f"{d}/left", "k", 3)      # written anew with another number
    assert read_bucketed(spark, f"{d}/left").count() == 10
    write_bucketed(left.where("k < 0"), f"{d}/none", "k", 3)
    assert read_bucketed(spark, f"{d}/none").count() == 0


def test_assembly_from_buckets_joins_without_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    frames = build.clean_frames(S.frames(spark, SF))
    app = C.clean(S.application(spark, SF), C.APPLICATION)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = build.bucketed_features(app, frames, tempfile.mkdtemp(prefix="rf-asm-", dir="/tmp"), 4)
        plan = plan_of(out)
        assert plan.count("SortMergeJoin") >= 5 and "Exchange" not in plan
        want = build.build_features(app, frames=frames)
        assert set(out.columns) == set(want.columns)
        show = [F.round(F.col(c), 6).alias(c) if t in ("double", "float") else F.col(c) for c, t in want.dtypes]
        assert out.count() == want.count() and out.select(show).exceptAll(want.select(show)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

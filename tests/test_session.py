"""Session helpers: the checkpoint folder comes from the session; durable cuts round-trip."""

from __future__ import annotations

from riskframe.session import checkpoint_dir, durable, ensure_checkpoint_dir


def test_checkpoint_dir_is_read_not_replaced(spark):
    d1 = ensure_checkpoint_dir(spark)
    assert d1 and checkpoint_dir(spark) == d1 and ensure_checkpoint_dir(spark) == d1


def test_durable_round_trip_under_checkpoint_dir(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS y")
    out = durable(df)
    files = out.inputFiles()
    root = ensure_checkpoint_dir(spark).split(":", 1)[-1].lstrip("/")
    assert files and all(f.split(":", 1)[-1].lstrip("/").startswith(root) for f in files)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))

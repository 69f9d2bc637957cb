"""The distributed running-sum / rank helper against NumPy, across bucket counts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators.prefix import global_rank, running_sums


@pytest.mark.parametrize("n_buckets", [1, 3, 17])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_grouped(spark, n_buckets, descending):
    rng = np.random.default_rng(n_buckets)
    rows = []
    for g in range(3):
        vals = rng.choice(1000, size=200, replace=False)           # distinct order values per group
        for v in vals:
            rows.append((g, float(v), int(rng.integers(0, 5))))
    df = spark.createDataFrame(rows, "g int, x double, w long")
    out = running_sums(df, "x", ["w"], descending=descending, by=["g"], n_buckets=n_buckets,
                       rank_col="r", totals=True).collect()
    for g in range(3):
        mine = sorted([r for r in out if r.g == g], key=lambda r: r.r)
        src = sorted([(x, w) for gg, x, w in rows if gg == g], key=lambda t: -t[0] if descending else t[0])
        assert [r.x for r in mine] == [x for x, _ in src]
        assert [r.cum_w for r in mine] == list(np.cumsum([w for _, w in src]))
        assert {r.tot_w for r in mine} == {sum(w for _, w in src)} and {r.tot_n for r in mine} == {200}


def test_global_rank_is_a_permutation(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 2).alias("k"))
    salt = F.pmod(F.xxhash64("id"), F.lit(32))
    out = global_rank(df, [F.xxhash64("id"), F.col("id")], by=["k"], n_buckets=32, salt_col=salt).collect()
    for k in (0, 1):
        assert sorted(r._rank for r in out if r.k == k) == list(range(2500))

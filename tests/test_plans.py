"""Plan-level guards: no cross joins anywhere, and scans read only what is used."""

from __future__ import annotations

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_joins(spark):
    bad = {}
    for name in E.oracle_sql():
        p = _plan(E.queries()[name](spark, SF))
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            bad[name] = p[:300]
    assert not bad, bad


def test_feature_table_scans_are_pruned(spark):
    from riskframe.plans.build import feature_table
    p = _plan(feature_table(spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p) or re.findall(r"ReadSchema: (struct<[^\n]*)", p)
    text = " ".join(schemas) if schemas else p
    for unused in ("c_name", "l_partkey", "l_suppkey", "l_tax", "l_quantity", "props", "o_orderpriority,o_orderstatus"):
        assert unused not in text, unused
    assert "PushedFilters: [IsNotNull(l_returnflag)" in p or "IsNotNull(l_returnflag)" in p


def test_model_queries_have_no_cross_joins(spark):
    names = ["gbt_oof", "cv_curve", "oof_metrics", "importance", "refit_scores", "isotonic_apply",
             "calibration_compare", "attribution_summary", "attribution_topk", "dependence_pairs", "sample_rows"]
    for name in names:
        p = _plan(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name

"""Registered queries for fold assignments, calibration, sinks, report tables and the small helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators import calibrate as K
from riskframe.operators import clean as C
from riskframe.operators import encode as E
from riskframe.operators import features as FE
from riskframe.operators import folds as FO
from riskframe.operators import metrics as M
from riskframe.operators import model as MD
from riskframe.operators import profile as PR
from riskframe.plans import sqlgen as G
from riskframe.plans.compare import finish
from riskframe.plans.parallel import pmap
from riskframe.plans.queries import ORACLE, QUERIES, _final_sql, _with, register
from riskframe.session import durable, intermediate_dir
from riskframe.sources import sinks
from riskframe.sources import standins as S
from riskframe.sources.tables import read_parquet, read_raw_csv, read_table


def _cols(view: str) -> str:
    return _final_sql([(n, n, k) for n, k in G.STANDIN_SCHEMA[view]])


def _folder(spark) -> str:
    """A fresh folder for a table that a query writes and reads back."""
    return f"{intermediate_dir(spark)}/sinks/{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# Assignments themselves, by a hash both engines compute

_HASH = "CAST('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || ':42'), 1, 15) AS BIGINT)"
_RANK = f"row_number() OVER (PARTITION BY TARGET ORDER BY {_HASH}, SK_ID_CURR) - 1"
_FOLDS = f"folded AS (SELECT *, ({_RANK}) % 5 AS fold FROM application)"


@register("fold_assignment", _with(G.views_prefix("application"), _FOLDS) + """
SELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, CAST(TARGET AS DOUBLE) AS TARGET, CAST(fold AS DOUBLE) AS fold FROM folded""")
def q_fold_assignment(spark, sf):
    """the fold of every applicant."""
    return finish(FO.add_cv_folds(S.application(spark, sf)).select("SK_ID_CURR", "TARGET", "fold"))


@register("holdout_assignment", _with(G.views_prefix("application"),
                                      f"r AS (SELECT *, {_RANK} AS rk, count(*) OVER (PARTITION BY TARGET) AS n FROM application)") + """
SELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, CASE WHEN rk < floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r""")
def q_holdout_assignment(spark, sf):
    """the side of every applicant."""
    train, test = FO.split_holdout(S.application(spark, sf))
    return finish(train.select("SK_ID_CURR", F.lit("train").alias("split")).unionByName(test.select("SK_ID_CURR", F.lit("test").alias("split"))))


@register("fold_pairs", _with(G.views_prefix("application"), _FOLDS, "p AS (SELECT unnest(range(5)) AS pair)") + """
SELECT CAST(pair AS DOUBLE) AS pair, CASE WHEN fold = pair THEN 'valid' ELSE 'train' END AS side,
       CAST(count(*) AS DOUBLE) AS n_rows, CAST(sum(SK_ID_CURR) AS DOUBLE) AS ids FROM folded, p GROUP BY ALL""")
def q_fold_pairs(spark, sf):
    """F3 + C16: rows and summed ids of the two sides of every train / validation pair."""
    folded = C.valid_folds(durable(FO.add_cv_folds(S.application(spark, sf)).select("SK_ID_CURR", "fold")))
    out = None
    for i, sides in enumerate(FO.fold_pairs(folded, 5)):
        for name, side in zip(("train", "valid"), sides):
            row = side.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("SK_ID_CURR").alias("ids")) \
                .select(F.lit(i).alias("pair"), F.lit(name).alias("side"), "n_rows", "ids")
            out = row if out is None else out.unionByName(row)
    return finish(out)


# the query stands in queries_eval; its order is by the same hash
ORACLE["sample_rows"] = _with(G.views_prefix("application")) + f"""
SELECT {_cols("application")} FROM (SELECT * FROM application ORDER BY {_HASH}, SK_ID_CURR LIMIT 500)"""
assert "sample_rows" in QUERIES


# ---------------------------------------------------------------------------
# K10-K12 on the scored stand-in: isotonic regression by the max-min formula over distinct scores

_ISO = """d AS (SELECT score, CAST(sum(target) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS w, row_number() OVER (ORDER BY score) AS i
      FROM scored WHERE score IS NOT NULL AND target IS NOT NULL GROUP BY score),
cum AS (SELECT score, i, sum(s) OVER (ORDER BY i) AS cs, sum(w) OVER (ORDER BY i) AS cw, s, w FROM d),
mean AS (SELECT a.i AS a, b.i AS b, (b.cs - a.cs + a.s) / (b.cw - a.cw + a.w) AS m FROM cum a JOIN cum b ON a.i <= b.i),
low AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM mean),
iso AS (SELECT d.score, max(low.m) AS cal FROM low JOIN d USING (i) GROUP BY d.score),
calibrated AS (SELECT scored.*, iso.cal FROM scored LEFT JOIN iso USING (score))"""


@register("isotonic_scored", _with(G.views_prefix("scored"), _ISO) + f"""
SELECT CAST(row_id AS DOUBLE) AS row_id, {G.r6("score")} AS score, {G.r6("cal")} AS score_calibrated FROM calibrated""")
def q_isotonic_scored(spark, sf):
    """K10 + K11: isotonic fit on the scored table, applied to it."""
    df = S.scored(spark, sf)
    return finish(K.apply_calibrator(df, K.fit_isotonic(df, "score"), "score").select("row_id", "score", "score_calibrated"))


@register("brier_raw_calibrated", _with(G.views_prefix("scored"), _ISO) + f"""
SELECT {G.r6("avg(pow(score - target, 2))")} AS raw_brier, {G.r6("avg(pow(cal - target, 2))")} AS calibrated_brier FROM calibrated""")
def q_brier_raw_calibrated(spark, sf):
    """B3 + K12: Brier score before and after isotonic calibration."""
    fit = K.fit_from_oof(durable(S.scored(spark, sf)), "score")
    return finish(spark.range(1).select(F.lit(fit.raw_brier).alias("raw_brier"), F.lit(fit.calibrated_brier).alias("calibrated_brier")))


# ---------------------------------------------------------------------------
# Report tables over per-group values of the driver's tables

_ROUNDS = "fr AS (SELECT l_linenumber AS round, l_suppkey % 5 AS fold, avg(l_discount) AS value FROM lineitem GROUP BY ALL)"
_CURVE = "curve AS (SELECT round, avg(value) AS mean, stddev_pop(value) AS std FROM fr GROUP BY round)"
_CURVE_COLS = f"CAST(round AS DOUBLE) AS round, {G.r6('mean')} AS mean, {G.r6('mean - std')} AS lower, {G.r6('mean + std')} AS upper"


def _rounds(spark, sf):
    li = S.read_table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_linenumber").alias("round"), (F.col("l_suppkey") % 5).alias("fold")).agg(F.avg("l_discount").alias("value"))


@register("cv_curve_table", _with(_ROUNDS, _CURVE) + f"\nSELECT {_CURVE_COLS} FROM curve")
def q_cv_curve_table(spark, sf):
    """K13 + A15: mean and spread over folds of a per-round value."""
    return finish(M.cv_curve(_rounds(spark, sf)))


@register("best_round", _with(_ROUNDS, _CURVE) + f"\nSELECT {_CURVE_COLS} FROM curve ORDER BY curve.mean DESC, curve.round LIMIT 1")
def q_best_round(spark, sf):
    """The first round with the highest mean."""
    return finish(M.argmax_first(M.cv_curve(_rounds(spark, sf)), "mean", "round"))


@register("trials_table_report", f"""
SELECT event_type AS state, CAST(count(*) AS DOUBLE) AS n_trials, {G.r6("max(value)")} AS best_value,
       {G.r6("quantile_cont(CAST(event_id % 997 AS DOUBLE), 0.5)")} AS median_duration FROM events GROUP BY event_type""")
def q_trials_table_report(spark, sf):
    """Counts, best value and median duration by state, events standing in for trials."""
    ev = S.read_table(spark, sf, "events")
    return finish(PR.trials_report(ev.select(F.col("event_type").alias("state"), "value", (F.col("event_id") % 997).cast("double").alias("duration"))))


_GAINS = """a AS (SELECT p_type AS feature, sum(p_retailprice) AS gain, count(*) AS split FROM part GROUP BY p_type),
b AS (SELECT p_type AS feature, sum(p_size) AS gain FROM part WHERE p_size > 40 GROUP BY p_type)"""


def _gains(spark, sf):
    part = S.read_table(spark, sf, "part")
    feature = F.col("p_type").alias("feature")
    return (part.groupBy(feature).agg(F.sum("p_retailprice").alias("gain"), F.count(F.lit(1)).alias("split")),
            part.where("p_size > 40").groupBy(feature).agg(F.sum("p_size").cast("double").alias("gain")))


@register("importance_merge", _with(_GAINS) + f"""
SELECT coalesce(a.feature, b.feature) AS feature, {G.r6("coalesce(a.gain, 0)")} AS a_gain, CAST(coalesce(a.split, 0) AS DOUBLE) AS a_split,
       {G.r6("coalesce(CAST(b.gain AS DOUBLE), 0)")} AS b_gain FROM a FULL JOIN b ON a.feature = b.feature""")
def q_importance_merge(spark, sf):
    """Two importance tables side by side."""
    return finish(MD.merge_importance(*_gains(spark, sf)))


@register("importance_top", _with(_GAINS) + f"\nSELECT feature, {G.r6('gain')} AS gain, CAST(split AS DOUBLE) AS split FROM a "
          "ORDER BY a.gain DESC, feature LIMIT 15")
def q_importance_top(spark, sf):
    """The 15 features with the highest gain."""
    return finish(M.top_k(_gains(spark, sf)[0], 15, "gain", "feature"))


@register("class_weights", _with(G.views_prefix("application"),
                                 "r AS (SELECT sum(CASE WHEN TARGET = 0 THEN 1.0 ELSE 0 END) / sum(TARGET) AS spw FROM application)") + f"""
SELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, {G.r6("CASE WHEN TARGET = 1 THEN (SELECT spw FROM r) ELSE 1 END")} AS weight FROM application""")
def q_class_weights(spark, sf):
    """M2 + A13: the weight of every row at the class ratio."""
    app = S.application(spark, sf)
    ratio = FE.class_ratio(app).first()["scale_pos_weight"]
    return finish(MD.with_weight(app, "TARGET", ratio).select("SK_ID_CURR", "weight"))


# ---------------------------------------------------------------------------
# C17-C19, P12, P13, E6, D3

@register("extreme_rows", _with(G.views_prefix("bureau")) + f"\nSELECT {_cols('bureau')} FROM bureau WHERE AMT_CREDIT_SUM >= 300000")
def q_extreme_rows(spark, sf):
    """C17: credits at or above a threshold."""
    return finish(C.extreme_rows(S.bureau(spark, sf), "AMT_CREDIT_SUM", 300000))


@register("prefixed_columns", _with(G.views_prefix("application")) + "\nSELECT "
          + _final_sql([(n, n, k) for n, k in G.STANDIN_SCHEMA["application"] if n[:4] in ("AMT_", "DAYS", "FLAG") and n != "FLAG_MOBIL"
                        and k != "string"]) + " FROM application")
def q_prefixed_columns(spark, sf):
    """C18 + C19: numeric columns of three prefixes, one column and an absent one dropped."""
    df = C.drop_if_present(S.application(spark, sf), "FLAG_MOBIL", "NOT_THERE")
    return finish(df.select(*C.columns_with_prefix(df, "AMT_", "DAYS_", "FLAG_", numeric_only=True)))


@register("previous_ratios", _with(G.views_prefix("previous")) + f"""
SELECT CAST(SK_ID_PREV AS DOUBLE) AS SK_ID_PREV, {G.r6(G.sdiv("AMT_APPLICATION", "AMT_CREDIT"))} AS APP_CREDIT_PERC,
       {G.r6(G.sdiv("AMT_GOODS_PRICE", "AMT_CREDIT"))} AS GOODS_CREDIT_PERC FROM previous""")
def q_previous_ratios(spark, sf):
    """P12 + P13."""
    return finish(FE.prev_derived(S.previous(spark, sf)).select("SK_ID_PREV", "APP_CREDIT_PERC", "GOODS_CREDIT_PERC"))


@register("model_inputs", _with(G.views_prefix("application")) + "\nSELECT "
          + _final_sql([(n, n, k) for n, k in G.STANDIN_SCHEMA["application"] if n not in ("SK_ID_CURR", "TARGET")]) + " FROM application")
def q_model_inputs(spark, sf):
    """The inputs of a table with target, id and fold."""
    df = S.application(spark, sf).withColumn("fold", F.lit(0))
    return finish(df.select(*E.feature_columns(df)))


_CHILDREN = {"bureau": S.bureau, "previous": S.previous, "pos_cash": S.pos_cash, "installments": S.installments, "credit_card": S.credit_card}


@register("coverage_train_test", _with(G.views_prefix("application", *_CHILDREN), "allc AS (SELECT (SELECT count(DISTINCT SK_ID_CURR) FROM application)"
                                       " + (SELECT count(DISTINCT s_suppkey) FROM supplier) AS n)") + "\n"
          + "\nUNION ALL\n".join(f"SELECT '{v}' AS \"table\", CAST(count(DISTINCT SK_ID_CURR) AS DOUBLE) AS customers, "
                                 f"{G.r6('count(DISTINCT SK_ID_CURR) * 100.0 / (SELECT n FROM allc)')} AS coverage_pct FROM {v}" for v in _CHILDREN)
          + "\nUNION ALL\nSELECT 'full_coverage', CAST((SELECT n FROM allc) AS DOUBLE), 100.0")
def q_coverage_train_test(spark, sf):
    """D3: coverage as a share of the train and test applicants together."""
    return finish(PR.coverage(S.application(spark, sf), {v: f(spark, sf) for v, f in _CHILDREN.items()}, test=S.application_test(spark, sf)))


# ---------------------------------------------------------------------------
# Tables written and read back

@register("raw_csv_scan", _with(G.views_prefix("previous")) + "\nSELECT "
          + _final_sql([(n, n, "string" if n in ("NAME_CONTRACT_STATUS", "FLAG_LAST_APPL_PER_CONTRACT") else
                         "double" if n.startswith("AMT_") else "long") for n, _ in G.STANDIN_SCHEMA["previous"]
                        if n != "NFLAG_INSURED_ON_APPROVAL"]) + " FROM previous")
def q_raw_csv_scan(spark, sf):
    """A raw CSV table scanned with the types its column names give."""
    path = _folder(spark)
    sinks.write_csv(S.previous(spark, sf).drop("NFLAG_INSURED_ON_APPROVAL"), path)
    return finish(read_raw_csv(spark, path))


@register("feature_sink", _with(G.views_prefix("previous")) + "\nSELECT "
          + _final_sql([("SK_ID_PREV", "SK_ID_PREV", "long"), ("AMT_CREDIT", "AMT_CREDIT", "double")]) + " FROM previous")
def q_feature_sink(spark, sf):
    """S2 + S3: a feature table written, two columns of it scanned."""
    path = _folder(spark)
    sinks.write_parquet(S.previous(spark, sf), path)
    return finish(read_parquet(spark, path, ["SK_ID_PREV", "AMT_CREDIT", "NOT_THERE"]))


@register("fold_map_sink", _with(G.views_prefix("application"), _FOLDS) + """
SELECT CAST(SK_ID_CURR AS DOUBLE) AS row_id, CAST(fold AS DOUBLE) AS fold FROM folded""")
def q_fold_map_sink(spark, sf):
    """The written fold map."""
    path = _folder(spark)
    FO.save_folds_table(FO.add_cv_folds(S.application(spark, sf)), path)
    return finish(spark.read.parquet(path))


@register("scored_sinks", _with(G.views_prefix("scored")) + f"\nSELECT {_cols('scored')} FROM scored")
def q_scored_sinks(spark, sf):
    """S5 + S6: the scored table written by fold as Parquet, from there as CSV, and read back."""
    path = _folder(spark)
    sinks.write_parquet(S.scored(spark, sf), f"{path}/oof", partition_by=["fold"])
    sinks.write_csv(spark.read.parquet(f"{path}/oof"), f"{path}/scored")
    return finish(sinks.read_csv(spark, f"{path}/scored", numeric=("row_id", "fold", "score", "target")))


@register("column_manifest", _with(G.views_prefix("application")) + """
SELECT CAST(row_number() OVER (ORDER BY l) - 1 AS DOUBLE) AS position, 'OCCUPATION_TYPE_' || l AS feature
FROM (SELECT DISTINCT OCCUPATION_TYPE AS l FROM application)""")
def q_column_manifest(spark, sf):
    """The manifest of a one-hot view's columns, written and read back."""
    path = _folder(spark)
    view = E.one_hot(S.application(spark, sf).select("OCCUPATION_TYPE"))
    sinks.write_manifest({"columns": view.columns}, path)
    return finish(spark.createDataFrame(list(enumerate(sinks.read_manifest(path)["columns"])), "position int, feature string"))


@register("report_sinks", _with(G.views_prefix("application")) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS feature, {G.r6(f'avg(CASE WHEN {n} IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing_rate FROM application"
    for n, _ in G.STANDIN_SCHEMA["application"]))
def q_report_sinks(spark, sf):
    """The missingness report written as CSV and read back."""
    path = _folder(spark)
    sinks.write_csv(PR.missing_rates(S.application(spark, sf)).coalesce(1), path)
    return finish(sinks.read_csv(spark, path, numeric=("missing_rate",)))


# ---------------------------------------------------------------------------
# E1, E2 over the written level dictionary: no level on the driver

@register("level_dictionary", """
SELECT feature, level, CAST(row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS DOUBLE) AS code FROM (
  SELECT DISTINCT 'c_name' AS feature, c_name AS level FROM customer UNION ALL
  SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM customer) WHERE level IS NOT NULL""")
def q_level_dictionary(spark, sf):
    """Levels and codes of a column with a level per row and of one with few, ranked in one pass."""
    found = E.fit_dictionary(read_table(spark, sf, "customer"), ["c_name", "c_mktsegment"])
    parts = [found.levels(spark, c).select(F.lit(c).alias("feature"), "level", "code") for c in found.sizes]
    return finish(parts[0].unionByName(parts[1]))


@register("onehot_positions", _with(G.views_prefix("application")) + """,
lv AS (SELECT c, l, row_number() OVER (ORDER BY c, l) - 1 AS position FROM (
  SELECT DISTINCT 0 AS c, OCCUPATION_TYPE AS l FROM application UNION ALL SELECT DISTINCT 1, FLAG_OWN_CAR FROM application) WHERE l IS NOT NULL),
cells AS (SELECT SK_ID_CURR, 0 AS c, OCCUPATION_TYPE AS l FROM application UNION ALL SELECT SK_ID_CURR, 1, FLAG_OWN_CAR FROM application)
SELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, CAST(position AS DOUBLE) AS position FROM cells JOIN lv USING (c, l)""")
def q_onehot_positions(spark, sf):
    """E2 without level names: every row's positions in the one-hot view of two columns."""
    app = S.application(spark, sf).select("SK_ID_CURR", "OCCUPATION_TYPE", "FLAG_OWN_CAR")
    return finish(E.one_hot_positions(app).select("SK_ID_CURR", F.explode("onehot").alias("position")))


@register("bureau_status_long", _with(G.views_prefix("bureau", "bureau_balance")) + """
SELECT CAST(b.SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, s.STATUS, CAST(count(*) AS DOUBLE) AS n
FROM bureau b JOIN bureau_balance s ON b.SK_ID_BUREAU = s.SK_ID_BUREAU WHERE s.STATUS IS NOT NULL AND b.SK_ID_CURR IS NOT NULL GROUP BY ALL""")
def q_bureau_status_long(spark, sf):
    """A1 + A3 for any number of levels: (applicant, status) counts, long instead of a column each."""
    return finish(FE.bureau_status_long(S.bureau(spark, sf), S.bureau_balance(spark, sf)))


# ---------------------------------------------------------------------------
# K12, S1, C1

def _calibration_sql(kind: str, col: str) -> str:
    edges = ", ".join(f"quantile_cont({col}, {i / 10}) AS e{i}" for i in range(1, 10))
    steps = " + ".join(f"CASE WHEN {col} > e{i} THEN 1 ELSE 0 END" for i in range(1, 10))
    return f"""SELECT '{kind}' AS kind, CAST(bin AS DOUBLE) AS bin, {G.r6("avg(p)")} AS pred_mean, {G.r6("avg(target)")} AS obs_rate,
  CAST(count(*) AS DOUBLE) AS n, {G.r6(f"(SELECT avg(pow({col} - target, 2)) FROM calibrated)")} AS brier
FROM (SELECT {steps} AS bin, {col} AS p, target FROM calibrated, (SELECT {edges} FROM calibrated)) GROUP BY bin"""


@register("calibration_pair", _with(G.views_prefix("scored"), _ISO) + "\n" + _calibration_sql("raw", "score")
          + "\nUNION ALL\n" + _calibration_sql("calibrated", "round(cal, 9)"))
def q_calibration_pair(spark, sf):
    """Brier score and calibration table of the raw and the isotonic score (of the latter to nine decimals, so that
    equal values of two engines meet equal bin edges)."""
    df = durable(S.scored(spark, sf))
    cal = K.apply_calibrator(df, K.fit_isotonic(df, "score"), "score").withColumn("score_calibrated", F.round("score_calibrated", 9))
    return finish(M.compare_raw_calibrated(cal, "score", "score_calibrated", "target").select("kind", "bin", "pred_mean", "obs_rate", "n", "brier"))


# Each raw table's stand-in, and one number column of it whose values the spoilt copy makes unreadable in some lines.
_SPOILT = {"app": ("application", "AMT_CREDIT"), "app_test": ("application", "DAYS_BIRTH"), "bureau": ("bureau", "AMT_CREDIT_SUM"),
           "bb": ("bureau_balance", "SK_ID_BUREAU"), "prev": ("previous", "DAYS_DECISION"), "pos": ("pos_cash", "SK_DPD"),
           "ins": ("installments", "AMT_PAYMENT"), "cc": ("credit_card", "AMT_BALANCE")}


def _spoilt_sql() -> str:
    parts = [f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS n FROM {v} WHERE {c} IS NOT NULL AND hash_of({c}) " for t, (v, c) in _SPOILT.items()]
    # every seventh whole value: a rule that both engines read off the value itself
    parts = [p.replace(f"hash_of({c}) ", f"CAST(floor(abs({c})) AS BIGINT) % 7 = 3") for p, (_, c) in zip(parts, _SPOILT.values())]
    views = dict.fromkeys(v for v, _ in _SPOILT.values())
    return _with(G.views_prefix(*views)) + "\nSELECT \"table\", \"column\", 'not a ' || CASE WHEN \"column\" LIKE 'SK_ID%' THEN 'bigint' ELSE 'double' END AS reason, " \
        "CAST(n AS DOUBLE) AS n FROM (\n" + "\nUNION ALL\n".join(parts) + ") WHERE n > 0"


@register("raw_rejects", _spoilt_sql())
def q_raw_rejects(spark, sf):
    """S1 for all eight raw tables: fields that are no numbers are found by table, column and reason, and counted."""
    from riskframe.sources.tables import RAW_FILES, read_raw_rejects
    folder = _folder(spark)

    def spoilt_copy(name: str) -> None:
        view, col = _SPOILT[name]
        given = getattr(S, view)(spark, sf)
        flags = [c for c in given.columns if c.startswith(("FLAG_", "NFLAG"))]        # text among numbers in the stand-in itself
        spoil = F.when(F.floor(F.abs(F.col(col))) % 7 == 3, F.concat(F.lit("?"), F.col(col).cast("string"))).otherwise(F.col(col).cast("string"))
        sinks.write_csv(given.drop(*[c for c in flags if c != col]).withColumn(col, spoil), f"{folder}/{RAW_FILES[name]}")

    pmap(spoilt_copy, _SPOILT)
    return finish(read_raw_rejects(spark, folder).groupBy("table", "column", "reason").agg(F.count(F.lit(1)).alias("n")))

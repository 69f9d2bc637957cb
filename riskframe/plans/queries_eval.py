"""Registered queries for encoders, folds, metrics and profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean as C
from riskframe.operators import encode as E
from riskframe.operators import features as FE
from riskframe.operators import folds as FO
from riskframe.operators import metrics as M
from riskframe.operators import profile as PR
from riskframe.plans import sqlgen as G
from riskframe.plans.compare import finish
from riskframe.plans.queries import FEATURE_SQL_COLS, FEATURE_SQL_PARTS, _final_sql, _with, register
from riskframe.sources import standins as S

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]   # c_mktsegment's domain


def _ruled_app(spark, sf):
    return C.apply_rules(S.application(spark, sf), C.APPLICATION)


_APP_R = f"app_r AS ({G.rules_cte('application', C.APPLICATION)})"


# ---------------------------------------------------------------------------
# K1-K9, D11 on the scored table

_CURVE = """d AS (SELECT score, CAST(sum(target) AS DOUBLE) AS pos, CAST(count(*) - sum(target) AS DOUBLE) AS neg
       FROM scored GROUP BY score),
c AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             row_number() OVER (ORDER BY score DESC) - 1 AS rk,
             lead(pos) OVER (ORDER BY score DESC) AS npos, lead(neg) OVER (ORDER BY score DESC) AS nneg
      FROM d),
t AS (SELECT sum(pos) AS P, sum(neg) AS N, count(*) AS n_thr FROM d)"""

_P = "(SELECT P FROM t)"
_N = "(SELECT N FROM t)"
_NT = "(SELECT n_thr FROM t)"


def _scored_with(*extra: str) -> str:
    return _with(G.views_prefix("scored"), _CURVE, *extra)


@register("roc_auc", _scored_with() + f"""
SELECT {G.r6(f"sum(neg * ((tp - pos) + pos / 2.0)) / ({_P} * {_N})")} AS roc_auc FROM c""")
def q_roc_auc(spark, sf):
    return finish(M.roc_auc(S.scored(spark, sf)))


@register("average_precision", _scored_with() + f"""
SELECT {G.r6(f"sum(pos * tp / (tp + fp)) / {_P}")} AS average_precision FROM c""")
def q_average_precision(spark, sf):
    return finish(M.average_precision(S.scored(spark, sf)))


_PREC0 = "CASE WHEN (tp - pos) + (fp - neg) > 0 THEN (tp - pos) / ((tp - pos) + (fp - neg)) ELSE 1.0 END"


@register("pr_auc_trapezoid", _scored_with() + f"""
SELECT {G.r6(f"sum(pos * (tp / (tp + fp) + {_PREC0}) / 2.0) / {_P}")} AS pr_auc FROM c""")
def q_pr_auc(spark, sf):
    return finish(M.pr_auc_trapezoid(S.scored(spark, sf)))


@register("roc_curve", _scored_with() + f"""
SELECT CAST(rk + 1 AS DOUBLE) AS step, {G.r6(f"fp / {_N}")} AS fpr, {G.r6(f"tp / {_P}")} AS tpr,
       {G.r6("score")} AS threshold
FROM c WHERE rk = 0 OR rk = {_NT} - 1 OR npos <> pos OR nneg <> neg
UNION ALL SELECT 0.0, 0.0, 0.0, CAST('inf' AS DOUBLE)""")
def q_roc_curve(spark, sf):
    return finish(M.roc_curve(S.scored(spark, sf)))


@register("pr_curve", _scored_with() + f"""
SELECT {G.r6("score")} AS threshold, {G.r6("tp / (tp + fp)")} AS precision, {G.r6(f"tp / {_P}")} AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_pr_curve(spark, sf):
    return finish(M.pr_curve(S.scored(spark, sf)))


@register("best_f1", _scored_with() + f"""
SELECT {G.r6("f1")} AS best_f1, {G.r6("score")} AS best_threshold FROM (
  SELECT CASE WHEN tp + fp + {_P} > 0 THEN 2.0 * tp / (tp + fp + {_P}) ELSE 0.0 END AS f1, score
  FROM c WHERE rk > 0) ORDER BY f1 DESC, score ASC LIMIT 1""")
def q_best_f1(spark, sf):
    return finish(M.best_f1(S.scored(spark, sf)))


_FOLD_CURVE = """fd AS (SELECT fold, score, CAST(sum(target) AS DOUBLE) AS pos,
              CAST(count(*) - sum(target) AS DOUBLE) AS neg FROM scored GROUP BY fold, score),
fc AS (SELECT fold, score, pos, neg,
              sum(pos) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                AS tp,
              sum(neg) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                AS fp,
              sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N FROM fd)"""


@register("fold_metrics", _with(G.views_prefix("scored"), _FOLD_CURVE) + f"""
SELECT CAST(fold AS DOUBLE) AS fold,
       {G.r6("sum(neg * ((tp - pos) + pos / 2.0)) / (max(P) * max(N))")} AS roc_auc,
       {G.r6("sum(pos * tp / (tp + fp)) / max(P)")} AS average_precision,
       {G.r6(f"sum(pos * (tp / (tp + fp) + {_PREC0}) / 2.0) / max(P)")} AS pr_auc,
       CAST(max(P) AS DOUBLE) AS n_pos, CAST(max(N) AS DOUBLE) AS n_neg
FROM fc GROUP BY fold HAVING max(P) > 0 AND max(N) > 0""")
def q_fold_metrics(spark, sf):
    return finish(M.fold_metrics(S.scored(spark, sf)))


@register("brier", _with(G.views_prefix("scored")) + f"""
SELECT {G.r6("avg(pow(score - target, 2))")} AS brier FROM scored""")
def q_brier(spark, sf):
    return finish(M.brier(S.scored(spark, sf)))


_EDGES = ", ".join(f"quantile_cont(score, {i / 10}) AS e{i}" for i in range(1, 10))
_BIN = " + ".join(f"CASE WHEN score > (SELECT e{i} FROM q) THEN 1 ELSE 0 END" for i in range(1, 10))


@register("calibration_table", _with(G.views_prefix("scored"), f"q AS (SELECT {_EDGES} FROM scored)") + f"""
SELECT CAST(bin AS DOUBLE) AS bin, {G.r6("avg(score)")} AS pred_mean, {G.r6("avg(target)")} AS obs_rate,
       CAST(count(*) AS DOUBLE) AS n
FROM (SELECT ({_BIN}) AS bin, score, target FROM scored) GROUP BY bin""")
def q_calibration_table(spark, sf):
    return finish(M.calibration_table(S.scored(spark, sf)))


@register("top_risk", _with(G.views_prefix("scored")) + f"""
SELECT CAST(row_id AS DOUBLE) AS row_id, {G.r6("score")} AS score, CAST(target AS DOUBLE) AS target
FROM scored ORDER BY score DESC, row_id ASC LIMIT 5""")
def q_top_risk(spark, sf):
    return finish(M.top_k(S.scored(spark, sf), 5).select("row_id", "score", "target"))


# ---------------------------------------------------------------------------
# D1-D10, A12-A14

_AUDIT_VIEWS = ["application", "bureau", "bureau_balance", "previous", "installments", "pos_cash", "credit_card"]
_AUDIT_FN = {"application": S.application, "bureau": S.bureau, "bureau_balance": S.bureau_balance,
             "previous": S.previous, "installments": S.installments, "pos_cash": S.pos_cash,
             "credit_card": S.credit_card}


def _audit_sql() -> str:
    parts = []
    for v in _AUDIT_VIEWS:
        cols = G.STANDIN_SCHEMA[v]
        k = len(cols)
        nulls = " + ".join(f"count(*) FILTER (WHERE {n} IS NULL)" for n, _ in cols)
        n_num = sum(1 for _, t in cols if t in ("int", "long", "double"))
        n_cat = sum(1 for _, t in cols if t == "string")
        parts.append(f"SELECT '{v}' AS dataset, CAST(count(*) AS DOUBLE) AS rows, {float(k)} AS cols, "
                     f"{float(n_num)} AS numeric, {float(n_cat)} AS categorical, "
                     f"{G.r6(f'CAST({nulls} AS DOUBLE) / (count(*) * {k}) * 100.0')} AS missing_pct_mean FROM {v}")
    return _with(G.views_prefix(*_AUDIT_VIEWS)) + "\n" + "\nUNION ALL\n".join(parts)


@register("table_audit", _audit_sql())
def q_table_audit(spark, sf):
    return finish(PR.table_audit({v: _AUDIT_FN[v](spark, sf) for v in _AUDIT_VIEWS}))


@register("target_distribution", _with(G.views_prefix("application")) + f"""
SELECT CAST(TARGET AS DOUBLE) AS TARGET, CAST(count(*) AS DOUBLE) AS count,
       {G.r6("count(*) * 100.0 / (SELECT count(*) FROM application)")} AS pct
FROM application GROUP BY TARGET""")
def q_target_distribution(spark, sf):
    return finish(PR.target_distribution(S.application(spark, sf)))


@register("class_ratio", _with(G.views_prefix("application")) + f"""
SELECT CAST(sum(TARGET) AS DOUBLE) AS pos, CAST(count(TARGET) - sum(TARGET) AS DOUBLE) AS neg,
       {G.r6("greatest((count(TARGET) - sum(TARGET)) / greatest(CAST(sum(TARGET) AS DOUBLE), 1.0), 1.0)")}
         AS scale_pos_weight
FROM application""")
def q_class_ratio(spark, sf):
    return finish(FE.class_ratio(S.application(spark, sf)))


_COV = ["bureau", "previous", "pos_cash", "installments", "credit_card"]


@register("coverage", _with(G.views_prefix("application", *_COV), "allc AS (SELECT count(DISTINCT SK_ID_CURR) AS n "
                                                               "FROM application)") + "\n"
          + "\nUNION ALL\n".join(
              f"SELECT '{v}' AS \"table\", CAST(count(DISTINCT SK_ID_CURR) AS DOUBLE) AS customers, "
              f"{G.r6('count(DISTINCT SK_ID_CURR) * 100.0 / (SELECT n FROM allc)')} AS coverage_pct FROM {v}"
              for v in _COV)
          + "\nUNION ALL\nSELECT 'full_coverage', CAST((SELECT n FROM allc) AS DOUBLE), 100.0")
def q_coverage(spark, sf):
    return finish(PR.coverage(S.application(spark, sf), {v: _AUDIT_FN[v](spark, sf) for v in _COV}))


def _missing_table_sql() -> str:
    parts = [f"SELECT '{n}' AS \"column\", count(*) FILTER (WHERE {n} IS NULL) AS m, count(*) AS n FROM app_r"
             for n, _ in G.STANDIN_SCHEMA["application"]]
    body = "\nUNION ALL\n".join(parts)
    return (_with(G.views_prefix("application"), _APP_R) + f"""
SELECT "column", CAST(m AS DOUBLE) AS missing_values, {G.r6("round(m * 100.0 / n, 1)")} AS percentage
FROM ({body}) WHERE m > 0 ORDER BY percentage DESC, "column" ASC LIMIT 15""")


@register("missing_table", _missing_table_sql())
def q_missing_table(spark, sf):
    return finish(PR.missing_table(_ruled_app(spark, sf), 15))


def _missing_rate_sql() -> str:
    parts = [f"SELECT '{a}' AS feature, CAST(count(*) FILTER (WHERE {a} IS NULL) AS DOUBLE) / count(*) AS r "
             f"FROM features" for a, _, _ in FEATURE_SQL_COLS if a not in ("SK_ID_CURR", "TARGET")]
    return _with(*FEATURE_SQL_PARTS) + "\nSELECT feature, " + G.r6("r") + " AS missing_rate FROM (\n" \
        + "\nUNION ALL\n".join(parts) + "\n)"


@register("missing_rate", _missing_rate_sql())
def q_missing_rate(spark, sf):
    from riskframe.plans.build import feature_table
    return finish(PR.missing_rates(feature_table(spark, sf).drop("SK_ID_CURR", "TARGET")))


@register("histogram_tenure", _with(G.views_prefix("application"), _APP_R,
                                    "x AS (SELECT abs(DAYS_EMPLOYED / 365.25::DOUBLE) AS v FROM app_r "
                                    "WHERE DAYS_EMPLOYED IS NOT NULL)",
                                    "mm AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 100 AS w FROM x)")
          + f"""
SELECT CAST(bin AS DOUBLE) AS bin, {G.r6("(SELECT lo FROM mm) + bin * (SELECT w FROM mm)")} AS lower,
       {G.r6("(SELECT lo FROM mm) + (bin + 1) * (SELECT w FROM mm)")} AS upper, CAST(count(v) AS DOUBLE) AS count
FROM (SELECT CAST(least(floor((v - (SELECT lo FROM mm)) / (SELECT w FROM mm)), 99) AS INTEGER) AS bin, v FROM x
      UNION ALL SELECT CAST(range AS INTEGER), NULL FROM range(100))
GROUP BY bin""")
def q_histogram_tenure(spark, sf):
    ruled = _ruled_app(spark, sf).select(FE.tenure_years().alias("TENURE_YEARS"))
    return finish(PR.histogram(ruled, "TENURE_YEARS", 100))


@register("age_band_rate", _with(G.views_prefix("application"), _APP_R) + f"""
SELECT AGE, {G.r6("avg(CAST(TARGET AS DOUBLE))")} AS rate, CAST(count(*) AS DOUBLE) AS count FROM (
  SELECT CAST(abs(floor(floor(DAYS_BIRTH / 365.25::DOUBLE) / 10.0) * 10.0) AS DOUBLE) AS AGE, TARGET FROM app_r)
WHERE AGE IS NOT NULL GROUP BY AGE""")
def q_age_band_rate(spark, sf):
    return finish(PR.age_band_rate(_ruled_app(spark, sf)))


@register("segment_rate", _with(G.views_prefix("application")) + f"""
SELECT OCCUPATION_TYPE, {G.r6("avg(CAST(TARGET AS DOUBLE))")} AS rate, CAST(count(*) AS DOUBLE) AS count
FROM application WHERE OCCUPATION_TYPE IS NOT NULL GROUP BY OCCUPATION_TYPE""")
def q_segment_rate(spark, sf):
    return finish(PR.segment_rate(S.application(spark, sf), "OCCUPATION_TYPE"))


def _profile_sql() -> str:
    feats = [(a, k) for a, _, k in FEATURE_SQL_COLS if a not in ("TARGET", "SK_ID_CURR")]
    n_num = sum(1 for _, k in feats if k in ("int", "long", "double", "float"))
    n_cat = sum(1 for _, k in feats if k == "string")
    return _with(*FEATURE_SQL_PARTS) + f"""
SELECT CAST(count(*) AS DOUBLE) AS n_rows, {float(len(feats))} AS n_features,
       {G.r6("avg(CAST(TARGET AS DOUBLE))")} AS positive_rate, {float(n_cat)} AS n_categorical,
       {float(n_num)} AS n_numeric FROM features"""


@register("data_profile", _profile_sql())
def q_data_profile(spark, sf):
    from riskframe.plans.build import feature_table
    return finish(PR.data_profile(feature_table(spark, sf)))


# ---------------------------------------------------------------------------
# E1-E5, J5

_OH = ", ".join(f"CASE WHEN OCCUPATION_TYPE = '{lv}' THEN 1.0 ELSE 0.0 END AS OCCUPATION_TYPE_{lv}" for lv in SEGMENTS)


@register("onehot_segment", _with(G.views_prefix("application"))
          + f"\nSELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, {_OH} FROM application")
def q_onehot_segment(spark, sf):
    app = S.application(spark, sf).select("SK_ID_CURR", "OCCUPATION_TYPE")
    return finish(E.one_hot(app, ["OCCUPATION_TYPE"]))


@register("ordinal_codes", _with(
    G.views_prefix("application"),
    "l1 AS (SELECT lv, dense_rank() OVER (ORDER BY lv) - 1 AS code FROM "
    "(SELECT DISTINCT OCCUPATION_TYPE AS lv FROM application WHERE OCCUPATION_TYPE IS NOT NULL))",
    "l2 AS (SELECT lv, dense_rank() OVER (ORDER BY lv) - 1 AS code FROM "
    "(SELECT DISTINCT FLAG_OWN_CAR AS lv FROM application WHERE FLAG_OWN_CAR IS NOT NULL))") + """
SELECT CAST(a.SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, CAST(l1.code AS DOUBLE) AS OCCUPATION_TYPE_CODE,
       CAST(coalesce(l2.code, (SELECT count(*) FROM l2)) AS DOUBLE) AS FLAG_OWN_CAR_CODE
FROM application a LEFT JOIN l1 ON a.OCCUPATION_TYPE = l1.lv LEFT JOIN l2 ON a.FLAG_OWN_CAR = l2.lv""")
def q_ordinal_codes(spark, sf):
    app = S.application(spark, sf).select("SK_ID_CURR", "OCCUPATION_TYPE", "FLAG_OWN_CAR")
    e1 = E.ordinal_encode(app, ["OCCUPATION_TYPE"], suffix="_CODE")
    e3 = E.ordinal_encode(e1, ["FLAG_OWN_CAR"], null_as_level=True, suffix="_CODE")
    return finish(e3)


_PART_A = SEGMENTS[:3]


def _align_sql() -> str:
    cols = ", ".join(
        f"CASE WHEN OCCUPATION_TYPE = '{lv}' THEN 1.0 ELSE 0.0 END AS OCCUPATION_TYPE_{lv}" for lv in SEGMENTS)
    in_a = ", ".join(f"'{x}'" for x in _PART_A)
    return (_with(G.views_prefix("application"))
            + f"\nSELECT CASE WHEN OCCUPATION_TYPE IN ({in_a}) THEN 'a' ELSE 'b' END AS part, "
              f"CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, {cols} FROM application")


@register("align_columns", _align_sql())
def q_align_columns(spark, sf):
    app = S.application(spark, sf).select("SK_ID_CURR", "OCCUPATION_TYPE")
    a = E.one_hot(app.where(F.col("OCCUPATION_TYPE").isin(*_PART_A)), ["OCCUPATION_TYPE"])
    b = E.one_hot(app.where(~F.col("OCCUPATION_TYPE").isin(*_PART_A)), ["OCCUPATION_TYPE"])
    a2, b2 = E.align_columns(a, b)
    return finish(a2.withColumn("part", F.lit("a")).unionByName(b2.withColumn("part", F.lit("b"))))


def _coercion_sql() -> str:
    cols = ", ".join(f"TRY_CAST({n} AS FLOAT) AS {n}" if k == "string" else f"CAST({n} AS FLOAT) AS {n}"
                     for n, k in G.STANDIN_SCHEMA["application"])
    return _with(G.views_prefix("application")) + f"\nSELECT {cols} FROM application"


@register("numeric_coercion", _coercion_sql())
def q_numeric_coercion(spark, sf):
    return finish(E.numeric_coercion(S.application(spark, sf)))


# ---------------------------------------------------------------------------
# F1, F2 (class counts are a closed form of the class sizes)

@register("stratified_folds_counts", _with(G.views_prefix("application"),
                                           "cls AS (SELECT TARGET, count(*) AS n FROM application GROUP BY TARGET)")
          + "\n" + "\nUNION ALL\n".join(
              f"SELECT CAST(TARGET AS DOUBLE) AS TARGET, {float(f)} AS fold, "
              f"CAST(n // 5 + CASE WHEN {f} < n % 5 THEN 1 ELSE 0 END AS DOUBLE) AS n_rows FROM cls"
              for f in range(5)))
def q_stratified_folds_counts(spark, sf):
    folded = FO.add_cv_folds(S.application(spark, sf), "TARGET", 5, 42, "SK_ID_CURR")
    return finish(folded.groupBy("TARGET", "fold").agg(F.count(F.lit(1)).alias("n_rows")))


@register("holdout_counts", _with(G.views_prefix("application"),
                                  "cls AS (SELECT TARGET, count(*) AS n, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT)"
                                  " AS t FROM application GROUP BY TARGET)") + """
SELECT CAST(TARGET AS DOUBLE) AS TARGET, 'train' AS split, CAST(n - t AS DOUBLE) AS n_rows FROM cls
UNION ALL SELECT CAST(TARGET AS DOUBLE), 'test', CAST(t AS DOUBLE) FROM cls""")
def q_holdout_counts(spark, sf):
    tr, te = FO.split_holdout(S.application(spark, sf), "TARGET", 0.2, 42, "SK_ID_CURR")
    c = (tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))
         .groupBy("TARGET", "split").agg(F.count(F.lit(1)).alias("n_rows")))
    return finish(c)


@register("sample_rows")
def q_sample_rows(spark, sf):
    """a reproducible 500-row sample (the size is the feature)."""
    return finish(FO.sample_n(S.application(spark, sf), 500, 42, "SK_ID_CURR", portable=True))


# ---------------------------------------------------------------------------
# A15 over K7, E5, C5/C7 on previous applications

@register("fold_metric_summary", _with(G.views_prefix("scored"), _FOLD_CURVE) + f"""
SELECT {G.r6("avg(auc)")} AS mean, {G.r6("stddev_pop(auc)")} AS std FROM (
  SELECT sum(neg * ((tp - pos) + pos / 2.0)) / (max(P) * max(N)) AS auc
  FROM fc GROUP BY fold HAVING max(P) > 0 AND max(N) > 0)""")
def q_fold_metric_summary(spark, sf):
    return finish(FE.mean_std(M.fold_metrics(S.scored(spark, sf)), "roc_auc"))


def _fill_zero_sql() -> str:
    cols = []
    for n, k in G.rules_kinds("application", C.APPLICATION):
        if k in ("int", "long", "double"):
            cols.append((n, f"coalesce({n}, 0)", k))
        else:
            cols.append((n, n, k))
    return _with(G.views_prefix("application"), _APP_R) + f"\nSELECT {_final_sql(cols)} FROM app_r"


@register("fill_zero", _fill_zero_sql())
def q_fill_zero(spark, sf):
    return finish(E.fill_zero(_ruled_app(spark, sf)))


def _prev_rules_sql() -> str:
    cols = [(n, n, k) for n, k in G.rules_kinds("previous", C.PREVIOUS)]
    return (_with(G.views_prefix("previous"), f"r AS ({G.rules_cte('previous', C.PREVIOUS)})")
            + f"\nSELECT {_final_sql(cols)} FROM r")


@register("clean_prev_rules", _prev_rules_sql())
def q_clean_prev_rules(spark, sf):
    return finish(C.apply_rules(S.previous(spark, sf), C.PREVIOUS))


@register("ordinal_dims", _with(G.views_prefix("application")) + """
SELECT 'OCCUPATION_TYPE' AS feature, 1.0 AS position,
       CAST(count(DISTINCT OCCUPATION_TYPE) + CASE WHEN count(*) > count(OCCUPATION_TYPE) THEN 1 ELSE 0 END
            AS DOUBLE) AS cardinality FROM application
UNION ALL
SELECT 'FLAG_OWN_CAR', 2.0,
       CAST(count(DISTINCT FLAG_OWN_CAR) + CASE WHEN count(*) > count(FLAG_OWN_CAR) THEN 1 ELSE 0 END AS DOUBLE)
FROM application""")
def q_ordinal_dims(spark, sf):
    """Positions and cardinalities (max code + 1) of the NULL-coded categoricals."""
    app = S.application(spark, sf).select("SK_ID_CURR", "OCCUPATION_TYPE", "FLAG_OWN_CAR")
    enc = E.ordinal_encode(app, ["OCCUPATION_TYPE", "FLAG_OWN_CAR"], null_as_level=True)
    return finish(E.ordinal_dims(enc, ["OCCUPATION_TYPE", "FLAG_OWN_CAR"]))


# ---------------------------------------------------------------------------
# J3, J6

@register("fold_map_join", _with(G.views_prefix("application")) + """
SELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, OCCUPATION_TYPE,
       CAST(CASE WHEN SK_ID_CURR % 10 = 3 THEN -1 ELSE SK_ID_CURR % 5 END AS DOUBLE) AS fold FROM application""")
def q_fold_map_join(spark, sf):
    """The written fold map (here by key, a tenth of the rows unmapped) joined to the features."""
    from riskframe.session import durable
    app = S.application(spark, sf).select("SK_ID_CURR", "OCCUPATION_TYPE")
    folds = durable(app.where("SK_ID_CURR % 10 <> 3").select(F.col("SK_ID_CURR").alias("row_id"), (F.col("SK_ID_CURR") % 5).cast("int").alias("fold")))
    return finish(FO.join_folds(app, folds))


@register("align_saved_order", _with(G.views_prefix("application"))
          + "\nSELECT CAST(CNT_CHILDREN AS DOUBLE) AS CNT_CHILDREN, CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, OCCUPATION_TYPE FROM application")
def q_align_saved_order(spark, sf):
    """The saved feature order, restricted to the columns that exist."""
    return finish(E.align_to_features(S.application(spark, sf), ["CNT_CHILDREN", "SK_ID_CURR", "NOT_THERE", "OCCUPATION_TYPE"]))

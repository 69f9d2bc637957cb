"""Registered queries: one per operator family of the survey's inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver's tables (via
the stand-in views) and has, where SQL can express it, an equivalent DuckDB
query in ``ORACLE``. Both ends apply the same comparison rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.operators import clean as C
from riskframe.operators import features as FE
from riskframe.plans import sqlgen as G
from riskframe.plans.compare import finish, is_money
from riskframe.sources import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _final_sql(cols: list[tuple[str, str, str]], money: tuple[str, ...] = ()) -> str:
    out = []
    for alias, expr, kind in cols:
        if kind == "double":
            expr = G.r2(expr) if is_money(alias, money) else G.r6(expr)
        elif kind in ("int", "long"):
            expr = f"CAST({expr} AS DOUBLE)"
        elif kind == "ts":
            expr = f"CAST({expr} AS VARCHAR)"
        out.append(f"{expr} AS {alias}")
    return ",\n       ".join(out)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p for p in parts if p)


# ---------------------------------------------------------------------------
# C1-C7

def _rules_sql(view: str, spec: C.CleanSpec) -> str:
    cols = [(n, n, k) for n, k in G.rules_kinds(view, spec)]
    return _with(G.views_prefix(view), f"r AS ({G.rules_cte(view, spec)})") + f"\nSELECT {_final_sql(cols)} FROM r"


@register("clean_orders_rules", _rules_sql("bureau", C.BUREAU))
def q_clean_orders_rules(spark, sf):
    return finish(C.apply_rules(S.bureau(spark, sf), C.BUREAU))


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_REST = [c for c in _LI_COLS if c not in ("l_orderkey", "l_linenumber")]
_LI_KINDS = [("l_orderkey", "long"), ("l_partkey", "long"), ("l_suppkey", "long"), ("l_linenumber", "int"),
             ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
             ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "ts")]


@register("clean_lineitem_dedup", f"""
SELECT {_final_sql([(n, n, k) for n, k in _LI_KINDS])} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _LI_REST)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_clean_lineitem_dedup(spark, sf):
    li = S.read_table(spark, sf, "lineitem")
    return finish(C.dedup_first(li, ["l_orderkey", "l_linenumber"]))


@register("clean_application_rules", _rules_sql("application", C.APPLICATION))
def q_clean_application_rules(spark, sf):
    return finish(C.apply_rules(S.application(spark, sf), C.APPLICATION))


# ---------------------------------------------------------------------------
# C8 / C9 / C10-C15

def _winsor_sql() -> str:
    ctes, _ = G.clean_ctes("application", C.APPLICATION, "app", drop=[])
    cols = [("SK_ID_CURR", "SK_ID_CURR", "long")] + [(c, c, "double") for c in G.winsor_cols("application",
                                                                                           C.APPLICATION)]
    return _with(G.views_prefix("application"), *ctes) + f"\nSELECT {_final_sql(cols)} FROM app"


@register("winsorise_customer", _winsor_sql())
def q_winsorise_customer(spark, sf):
    ruled = C.apply_rules(S.application(spark, sf), C.APPLICATION)
    cols = C.winsor_columns(ruled, C.APPLICATION)
    caps = C.fit_caps(ruled, cols, C.WINSOR_Q)
    return finish(ruled.select("SK_ID_CURR", *[C.cap_expr(c, caps[c]) for c in cols]))


_CLEAN_TABLES = [
    ("application", C.APPLICATION, S.application),
    ("bureau", C.BUREAU, S.bureau),
    ("previous", C.PREVIOUS, S.previous),
    ("pos_cash", C.POS_CASH, S.pos_cash),
    ("installments", C.INSTALLMENTS, S.installments),
    ("credit_card", C.CREDIT_CARD, S.credit_card),
]


def _quasi_sql() -> str:
    parts, unions = [G.views_prefix(*[v for v, _, _ in _CLEAN_TABLES])], []
    for view, spec, _ in _CLEAN_TABLES:
        ctes, kinds = G.clean_ctes(view, spec, f"{view}_qc", drop=[])
        parts.extend(ctes)
        for n, _k in kinds:
            if n in spec.protect:
                continue
            unions.append(
                f"SELECT '{view}' AS table_name, '{n}' AS column_name, "
                f"CAST((SELECT max(cnt) FROM (SELECT count(*) AS cnt FROM {view}_qc GROUP BY {n})) AS DOUBLE) "
                f"/ (SELECT count(*) FROM {view}_qc) AS top_share")
    body = "\nUNION ALL\n".join(unions)
    return _with(*parts) + f"\nSELECT table_name, column_name, {G.r6('top_share')} AS top_share FROM (\n{body}\n) " \
                           f"WHERE top_share >= {C.QUASI_CONSTANT_TOL}"


@register("quasi_constant_report", _quasi_sql())
def q_quasi_constant_report(spark, sf):
    from riskframe.plans.parallel import pmap
    models = pmap(lambda t: C.fit_clean(t[2](spark, sf), t[1]), _CLEAN_TABLES)
    rows = [(view, k, float(v)) for (view, _, _), m in zip(_CLEAN_TABLES, models) for k, v in sorted(m.shares.items())]
    df = spark.createDataFrame(rows, "table_name string, column_name string, top_share double")
    return finish(df)


def _clean_sql(view: str, spec: C.CleanSpec) -> str:
    ctes, kinds = G.clean_ctes(view, spec, "t")
    return _with(G.views_prefix(view), *ctes) + f"\nSELECT {_final_sql([(n, n, k) for n, k in kinds])} FROM t"


def _register_clean(view: str, spec: C.CleanSpec, fn, key: str):
    @register(key, _clean_sql(view, spec))
    def q(spark, sf):
        return finish(C.clean(fn(spark, sf), spec))
    return q


for _view, _spec, _fn in _CLEAN_TABLES:
    _register_clean(_view, _spec, _fn, {"application": "clean_application", "bureau": "clean_bureau",
                                        "previous": "clean_prev", "pos_cash": "clean_pos",
                                        "installments": "clean_installments",
                                        "credit_card": "clean_cc"}[_view])


# ---------------------------------------------------------------------------
# P1-P11, P18, P19

def _ratio_sql_cols() -> list[tuple[str, str, str]]:
    out = [("DAYS_BIRTH_YEARS", "CAST(-DAYS_BIRTH / 365.25::DOUBLE AS FLOAT)", "float"),
           ("DAYS_EMPLOYED_YEARS", "CAST(DAYS_EMPLOYED / 365.25::DOUBLE AS FLOAT)", "float"),
           ("DEBT_TO_INCOME", G.sdiv("AMT_CREDIT", "AMT_INCOME_TOTAL"), "double"),
           ("GOODS_TO_INCOME", G.sdiv("AMT_GOODS_PRICE", "AMT_INCOME_TOTAL"), "double"),
           ("ANN_TO_INC_PC", f"{G.sdiv('AMT_ANNUITY', 'AMT_INCOME_TOTAL')} * CNT_FAM_MEMBERS", "double")]
    dp = G.sdiv("AMT_GOODS_PRICE - AMT_CREDIT", "AMT_GOODS_PRICE")
    out += [("DOWNPAY_SHARE", f"CASE WHEN {dp} IS NOT NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, {dp})) END",
             "double"),
            ("IMPLIED_TERM", G.sdiv("AMT_CREDIT", "AMT_ANNUITY"), "double"),
            ("INC_PER_DEP", G.sdiv("AMT_INCOME_TOTAL", "CNT_CHILDREN + 1"), "double"),
            ("DOC_RECENCY_RATIO", G.sdiv("abs(DAYS_ID_PUBLISH)", "abs(DAYS_REGISTRATION)"), "double"),
            ("PHONE_RECENCY_RATIO", G.sdiv("abs(DAYS_LAST_PHONE_CHANGE)", "abs(DAYS_REGISTRATION)"), "double")]
    return out


def _app_ratios_sql() -> str:
    extra = [("AGE_BAND", "CAST(abs(floor(floor(DAYS_BIRTH / 365.25::DOUBLE) / 10.0) * 10.0) AS DOUBLE)", "double"),
             ("TENURE_YEARS", "abs(DAYS_EMPLOYED / 365.25::DOUBLE)", "double")]
    cols = [("SK_ID_CURR", "SK_ID_CURR", "long")] + _ratio_sql_cols() + extra
    return (_with(G.views_prefix("application"), f"r AS ({G.rules_cte('application', C.APPLICATION)})")
            + f"\nSELECT {_final_sql(cols)} FROM r")


@register("app_ratios", _app_ratios_sql())
def q_app_ratios(spark, sf):
    from riskframe.functions.expr import age_band
    ruled = C.apply_rules(S.application(spark, sf), C.APPLICATION)
    r = FE.compute_app_ratios(ruled)
    ratio_cols = [c for c in r.columns if c not in ruled.columns]
    return finish(r.select("SK_ID_CURR", *ratio_cols, age_band("DAYS_BIRTH").alias("AGE_BAND"),
                           FE.tenure_years().alias("TENURE_YEARS")))


# ---------------------------------------------------------------------------
# A1-A8 on the raw stand-ins

BB_LEVELS = ["A", "N", "R"]   # l_returnflag's domain
_BB_PIVOT_SQL = ", ".join(f"count(*) FILTER (WHERE STATUS = '{lv}') AS BB_STATUS_{lv}" for lv in BB_LEVELS)


@register("bureau_status_pivot", _with(G.views_prefix("bureau_balance"))
          + "\nSELECT CAST(SK_ID_BUREAU AS DOUBLE) AS SK_ID_BUREAU, "
          + ", ".join(f"CAST(BB_STATUS_{lv} AS DOUBLE) AS BB_STATUS_{lv}" for lv in BB_LEVELS)
          + f" FROM (SELECT SK_ID_BUREAU, {_BB_PIVOT_SQL} FROM bureau_balance WHERE STATUS IS NOT NULL "
            "GROUP BY SK_ID_BUREAU)")
def q_bureau_status_pivot(spark, sf):
    return finish(FE.bureau_status_counts(S.bureau_balance(spark, sf)))


def _bureau_agg_sql(bureau_src: str, bureau_kinds: dict[str, str]) -> tuple[str, list[tuple[str, str, str]]]:
    kinds = dict(bureau_kinds)
    kinds.update({f"BB_STATUS_{lv}": "long" for lv in BB_LEVELS})
    spec = dict(FE.BUREAU_SPEC)
    spec.update({f"BB_STATUS_{lv}": ["sum"] for lv in BB_LEVELS})
    cols = G.agg_sql(spec, kinds, "BUREAU_")
    sel = ", ".join(f"{e} AS {a}" for a, e, _ in cols)
    cte = (f"bb_counts AS (SELECT SK_ID_BUREAU, {_BB_PIVOT_SQL} FROM bureau_balance WHERE STATUS IS NOT NULL "
           f"GROUP BY SK_ID_BUREAU),\n"
           f"bureau_agg AS (SELECT b.SK_ID_CURR, {sel} FROM {bureau_src} b LEFT JOIN bb_counts c "
           f"ON b.SK_ID_BUREAU = c.SK_ID_BUREAU GROUP BY b.SK_ID_CURR)")
    return cte, [(a, a, k) for a, _, k in cols]


def _kinds(view: str) -> dict[str, str]:
    return dict(G.STANDIN_SCHEMA[view])


def _child_agg_sql(block: str, src: str, kinds: dict[str, str]) -> tuple[str, list[tuple[str, str, str]]]:
    """CTE ``<block>_agg`` for previous / install / pos / cc over ``src`` with ``kinds``."""
    k = dict(kinds)
    if block == "previous":
        derived = [(f"{G.sdiv('AMT_APPLICATION', 'AMT_CREDIT')}", "APP_CREDIT_PERC", "double")]
        spec, prefix, dtype = FE.PREV_SPEC, "PREV_", "float"
    elif block == "install":
        derived = [("AMT_PAYMENT - AMT_INSTALMENT", "PAYMENT_DIFF", "double"),
                   (G.sdiv("AMT_PAYMENT", "AMT_INSTALMENT"), "PAYMENT_PERC", "double"),
                   ("DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT", "LATE_DAYS", "int")]
        spec, prefix, dtype = FE.INS_SPEC, "INS_", None
    elif block == "pos":
        derived, spec, prefix, dtype = [], FE.POS_SPEC, "POS_", None
    else:
        derived = [(G.sdiv("AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL"), "DRAW_RATIO", "double")]
        spec, prefix, dtype = FE.CC_SPEC, "CC_", None
    for _, name, kind in derived:
        k[name] = kind
    cols = G.agg_sql(spec, k, prefix, dtype)
    dsel = "".join(f", {e} AS {n}" for e, n, _ in derived)
    sel = ", ".join(f"{e} AS {a}" for a, e, _ in cols)
    cte = (f"{block}_agg AS (SELECT SK_ID_CURR, {sel} FROM (SELECT *{dsel} FROM {src}) GROUP BY SK_ID_CURR)")
    return cte, [(a, a, kk) for a, _, kk in cols]


@register("bureau_agg", None)
def q_bureau_agg(spark, sf):
    return finish(FE.aggregate_bureau(S.bureau(spark, sf), S.bureau_balance(spark, sf)))


_cte, _cols = _bureau_agg_sql("bureau", _kinds("bureau"))
ORACLE["bureau_agg"] = (_with(G.views_prefix("bureau", "bureau_balance"), _cte)
                        + f"\nSELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, {_final_sql(_cols)} FROM bureau_agg")


def _register_child(key: str, block: str, view: str, spark_fn):
    cte, cols = _child_agg_sql(block, view, _kinds(view))
    sql = (_with(G.views_prefix(view), cte)
           + f"\nSELECT CAST(SK_ID_CURR AS DOUBLE) AS SK_ID_CURR, {_final_sql(cols)} FROM {block}_agg")

    @register(key, sql)
    def q(spark, sf):
        return finish(spark_fn(spark, sf))
    return q


_register_child("prev_agg", "previous", "previous", lambda sp, sf: FE.aggregate_prev(S.previous(sp, sf)))
_register_child("install_agg", "install", "installments",
                lambda sp, sf: FE.aggregate_installments(S.installments(sp, sf)))
_register_child("pos_agg", "pos", "pos_cash", lambda sp, sf: FE.aggregate_pos(S.pos_cash(sp, sf)))
_register_child("card_agg", "cc", "credit_card", lambda sp, sf: FE.aggregate_cc(S.credit_card(sp, sf)))


# ---------------------------------------------------------------------------
# The whole feature table (cleaning + ratios + five aggregates)

def _feature_sql() -> tuple[list[str], list[tuple[str, str, str]]]:
    """CTEs ending in ``features`` and the output (alias, expr, kind) list."""
    parts = [G.views_prefix("application", "bureau", "bureau_balance", "previous", "installments",
                            "pos_cash", "credit_card")]
    app_ctes, app_kinds = G.clean_ctes("application", C.APPLICATION, "app_c")
    parts += app_ctes
    child = {}
    for view, spec in (("bureau", C.BUREAU), ("previous", C.PREVIOUS), ("installments", C.INSTALLMENTS),
                       ("pos_cash", C.POS_CASH), ("credit_card", C.CREDIT_CARD)):
        ctes, kinds = G.clean_ctes(view, spec, f"{view}_c")
        parts += ctes
        child[view] = dict(kinds)
    bcte, bcols = _bureau_agg_sql("bureau_c", child["bureau"])
    parts.append(bcte)
    outs = [(n, f"a.{n}", k) for n, k in app_kinds]
    outs += [(a, f"r.{a}", k) for a, _, k in _ratio_sql_cols()]
    ratio_sel = ", ".join(f"{e} AS {a}" for a, e, _ in _ratio_sql_cols())
    parts.append(f"ratios AS (SELECT SK_ID_CURR, {ratio_sel} FROM app_c)")
    joins = ["LEFT JOIN ratios r ON a.SK_ID_CURR = r.SK_ID_CURR",
             "LEFT JOIN bureau_agg b ON a.SK_ID_CURR = b.SK_ID_CURR"]
    outs += [(a, f"b.{a}", k) for a, _, k in bcols]
    for block, view, alias in (("previous", "previous_c", "p"), ("install", "installments_c", "i"),
                               ("pos", "pos_cash_c", "o"), ("cc", "credit_card_c", "c")):
        src_kinds = child[{"previous_c": "previous", "installments_c": "installments", "pos_cash_c": "pos_cash",
                           "credit_card_c": "credit_card"}[view]]
        cte, cols = _child_agg_sql(block, view, src_kinds)
        parts.append(cte)
        joins.append(f"LEFT JOIN {block}_agg {alias} ON a.SK_ID_CURR = {alias}.SK_ID_CURR")
        outs += [(a, f"{alias}.{a}", k) for a, _, k in cols]
    sel = ", ".join(f"{e} AS {a}" for a, e, _ in outs)
    parts.append(f"features AS (SELECT {sel} FROM app_c a {' '.join(joins)})")
    return parts, [(a, a, k) for a, _, k in outs]


_fparts, _fcols = _feature_sql()
FEATURE_SQL_PARTS = _fparts
FEATURE_SQL_COLS = _fcols


@register("feature_assembly", _with(*_fparts) + f"\nSELECT {_final_sql(_fcols)} FROM features")
def q_feature_assembly(spark, sf):
    from riskframe.plans.build import feature_table
    return finish(feature_table(spark, sf))


__all__ = ["QUERIES", "ORACLE", "register"]

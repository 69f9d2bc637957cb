"""DuckDB SQL fragments for the oracle side of the query registry.

These build plain SQL text (CTEs and expressions) from the same declarative
specs the Spark operators use, so the oracle checks the *execution* of a
spec in Spark against an independent engine. Nothing here runs on Spark.
"""

from __future__ import annotations

from riskframe.operators.clean import SENTINEL_DAYS, CleanSpec
from riskframe.sources.standins import STANDIN_SQL

# Declared schemas of the stand-in views (kind: int, long, double, string).
STANDIN_SCHEMA: dict[str, list[tuple[str, str]]] = {
    "application": [
        ("SK_ID_CURR", "long"), ("TARGET", "int"), ("OCCUPATION_TYPE", "string"), ("REGION_NATION", "int"),
        ("AMT_INCOME_TOTAL", "double"), ("AMT_CREDIT", "double"), ("AMT_GOODS_PRICE", "double"),
        ("AMT_ANNUITY", "double"), ("DAYS_BIRTH", "int"), ("DAYS_EMPLOYED", "int"), ("DAYS_ID_PUBLISH", "int"),
        ("DAYS_REGISTRATION", "int"), ("DAYS_LAST_PHONE_CHANGE", "int"), ("CNT_CHILDREN", "int"),
        ("CNT_FAM_MEMBERS", "int"), ("FLAG_OWN_CAR", "string"), ("FLAG_OWN_REALTY", "string"),
        ("FLAG_MOBIL", "string"),
    ],
    "bureau": [
        ("SK_ID_BUREAU", "long"), ("SK_ID_CURR", "long"), ("CREDIT_ACTIVE", "string"),
        ("AMT_CREDIT_SUM", "double"), ("AMT_CREDIT_SUM_DEBT", "double"), ("AMT_CREDIT_SUM_OVERDUE", "double"),
        ("DAYS_CREDIT", "int"), ("DAYS_CREDIT_ENDDATE", "int"), ("DAYS_ENDDATE_FACT", "int"),
        ("CNT_CREDIT_PROLONG", "int"), ("CREDIT_DAY_OVERDUE", "int"),
    ],
    "bureau_balance": [("SK_ID_BUREAU", "long"), ("MONTHS_BALANCE", "int"), ("STATUS", "string")],
    "previous": [
        ("SK_ID_PREV", "long"), ("SK_ID_CURR", "long"), ("NAME_CONTRACT_STATUS", "string"),
        ("AMT_APPLICATION", "double"), ("AMT_CREDIT", "double"), ("AMT_ANNUITY", "double"),
        ("AMT_GOODS_PRICE", "double"), ("DAYS_DECISION", "int"), ("DAYS_FIRST_DUE", "int"),
        ("DAYS_TERMINATION", "int"), ("FLAG_LAST_APPL_PER_CONTRACT", "string"),
        ("NFLAG_INSURED_ON_APPROVAL", "string"),
    ],
    "installments": [
        ("SK_ID_PREV", "long"), ("SK_ID_CURR", "long"), ("NUM_INSTALMENT_VERSION", "int"),
        ("NUM_INSTALMENT_NUMBER", "int"), ("DAYS_INSTALMENT", "int"), ("DAYS_ENTRY_PAYMENT", "int"),
        ("AMT_INSTALMENT", "double"), ("AMT_PAYMENT", "double"),
    ],
    "pos_cash": [
        ("SK_ID_CURR", "long"), ("MONTHS_BALANCE", "int"), ("NAME_CONTRACT_STATUS", "string"),
        ("CNT_INSTALMENT", "int"), ("CNT_INSTALMENT_FUTURE", "int"), ("SK_DPD", "int"), ("SK_DPD_DEF", "int"),
    ],
    "credit_card": [
        ("SK_ID_CURR", "long"), ("MONTHS_BALANCE", "int"), ("AMT_BALANCE", "double"),
        ("AMT_CREDIT_LIMIT_ACTUAL", "double"), ("AMT_DRAWINGS_CURRENT", "double"),
        ("AMT_PAYMENT_TOTAL_CURRENT", "double"), ("SK_DPD", "int"), ("SK_DPD_DEF", "int"),
        ("NAME_CONTRACT_STATUS", "string"),
    ],
    "scored": [("row_id", "long"), ("fold", "int"), ("score", "double"), ("target", "int")],
}

# Columns that are constant by construction of the stand-ins (C9 drops them).
CONSTANT_BY_CONSTRUCTION = {"application": ["FLAG_MOBIL"], "credit_card": ["NAME_CONTRACT_STATUS"]}

SQL_TYPE = {"int": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR"}


def r6(x: str) -> str:
    """Comparison rounding for ratios/means (same expression on the Spark side)."""
    return f"(round(({x}) + 1e-9, 6) + 0.0)"


def r2(x: str) -> str:
    """Comparison rounding for money-scale values."""
    return f"(round(({x}) + 1e-6, 2) + 0.0)"


def sdiv(a: str, b: str) -> str:
    q = f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"
    return f"(CASE WHEN isfinite({q}) THEN {q} END)"


def flag_sql(x: str) -> str:
    s = f"regexp_replace(upper(CAST({x} AS VARCHAR)), '^([01])\\.0+$', '\\1')"
    return (f"CAST(CASE WHEN {s} IN ('1', 'Y', 'YES', 'TRUE') THEN 1 "
            f"WHEN {s} IN ('0', 'N', 'NO', 'FALSE') THEN 0 END AS INTEGER)")


def rule_sql(name: str, kind: str, spec: CleanSpec) -> str:
    if any(name.startswith(p) for p in spec.flag_prefixes):
        return flag_sql(name)
    if kind == "string":
        return name
    c = name
    if name in spec.sentinel_cols:
        c = f"CASE WHEN {c} <> {SENTINEL_DAYS} THEN {c} END"
    if name in spec.nonpos_day_cols:
        c = f"CASE WHEN ({c}) <= 0 THEN ({c}) END"
    for col, lo, hi in spec.range_rules:
        if col == name:
            c = f"CASE WHEN ({c}) BETWEEN {lo} AND {hi} THEN ({c}) END"
    if name in spec.money_cols:
        c = f"CASE WHEN ({c}) > 0 THEN ({c}) END"
    if name in spec.count_cols:
        c = f"CASE WHEN ({c}) >= 0 THEN ({c}) END"
    return f"CAST({c} AS {SQL_TYPE[kind]})"


def rules_kinds(view: str, spec: CleanSpec) -> list[tuple[str, str]]:
    out = []
    for n, k in STANDIN_SCHEMA[view]:
        if any(n.startswith(p) for p in spec.flag_prefixes):
            out.append((n, "int"))
        else:
            out.append((n, k))
    return out


def rules_cte(view: str, spec: CleanSpec, src: str | None = None) -> str:
    """SELECT applying C1-C7 to a stand-in view."""
    src = src or view
    cols = ",\n       ".join(f"{rule_sql(n, k, spec)} AS {n}" for n, k in STANDIN_SCHEMA[view])
    sql = f"SELECT {cols}\nFROM {src}"
    if spec.dedup_key:
        rest = [n for n, _ in STANDIN_SCHEMA[view] if n != spec.dedup_key]
        order = ", ".join(f"{n} ASC NULLS FIRST" for n in rest)
        sql = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {spec.dedup_key} ORDER BY {order}) AS __rn "
               f"FROM {src}) WHERE __rn = 1")
        sql = f"SELECT {cols}\nFROM ({sql})"
    return sql


def winsor_cols(view: str, spec: CleanSpec) -> list[str]:
    out = []
    for n, k in rules_kinds(view, spec):
        if k in ("int", "long", "double") and any(n.startswith(p) for p in spec.winsor_include) \
                and not any(n.startswith(p) for p in spec.winsor_exclude):
            out.append(n)
    return out


def clean_ctes(view: str, spec: CleanSpec, name: str | None = None, drop: list[str] | None = None
               ) -> tuple[list[str], list[tuple[str, str]]]:
    """CTEs for the fully cleaned view ``<name>`` (rules, caps, drop) and its kinds."""
    name = name or f"{view}_clean"
    drop = CONSTANT_BY_CONSTRUCTION.get(view, []) if drop is None else drop
    ctes = [f"{name}_r AS ({rules_cte(view, spec)})"]
    wcols = winsor_cols(view, spec)
    if wcols:
        caps = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {spec.winsor_q}) AS {c}" for c in wcols)
        ctes.append(f"{name}_caps AS (SELECT {caps} FROM {name}_r)")
    sel, kinds = [], []
    for n, k in rules_kinds(view, spec):
        if n in drop:
            continue
        if n in wcols:
            cap = f"(SELECT {n} FROM {name}_caps)"
            sel.append(f"CASE WHEN {n} IS NULL THEN NULL WHEN {cap} IS NULL THEN CAST({n} AS DOUBLE) "
                       f"ELSE least(CAST({n} AS DOUBLE), {cap}) END AS {n}")
            kinds.append((n, "double"))
        else:
            sel.append(n)
            kinds.append((n, k))
    ctes.append(f"{name} AS (SELECT {', '.join(sel)} FROM {name}_r)")
    return ctes, kinds


def agg_sql(spec: dict[str, list[str]], kinds: dict[str, str], prefix: str, dtype: str | None = None
            ) -> list[tuple[str, str, str]]:
    """(alias, expression, kind) for an aggregation spec (mirror of agg_spec)."""
    out = []
    for col, fns in spec.items():
        if col not in kinds:
            continue
        k = kinds[col]
        for fn in fns:
            if fn == "mean":
                e, ok = f"avg({col})", "double"
            elif fn == "sum":
                ok = "double" if k in ("double", "float") else "long"
                e = f"CAST(coalesce(sum({col}), 0) AS {SQL_TYPE[ok]})"
            elif fn in ("max", "min"):
                e, ok = f"{fn}({col})", k
            elif fn == "nunique":
                e, ok = f"count(DISTINCT {col})", "long"
            elif fn == "count":
                e, ok = f"count({col})", "long"
            else:
                raise ValueError(fn)
            if dtype is not None:
                e, ok = f"CAST({e} AS {SQL_TYPE[dtype]})", dtype
            out.append((f"{prefix}{col}_{fn}".upper(), e, ok))
    return out


def views_prefix(*names: str) -> str:
    return ",\n".join(f"{n} AS ({STANDIN_SQL[n]})" for n in names)

"""Credit-table views over the driver's tables.

The loan tables themselves are not available, so each one is a projection
(or one equi-join) of a driver table with the same shape: one row per
applicant for ``application``, many rows per applicant for the child tables.
Derived columns are deterministic functions of real columns, chosen so that
every cleaning rule has rows to act on (sentinels, negative money, positive
day offsets, string flags, constant columns).

``STANDIN_SQL`` holds the same views in DuckDB's dialect for the oracle; the
Spark side is built with the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.expr import datediff_days
from riskframe.sources.tables import read_table

# Fixed dates of the stand-ins: "today" for the order history (one day after
# the last order) and a mid-range decision date so that C5 has work to do.
ASOF = "2001-08-02"
MID_ASOF = "1998-06-01"
SENTINEL = 365243
TEST_KEYS_FROM = 1_000_000_000_000      # test applicants' keys are apart from the others'


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applicants(read_table(spark, sf_dir, "customer"), F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey"),
                       F.col("c_mktsegment"))


def application_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants without a target: the suppliers, with keys of their own and another set of levels."""
    k = F.col("s_suppkey") + F.lit(TEST_KEYS_FROM)
    return _applicants(read_table(spark, sf_dir, "supplier"), k, F.col("s_acctbal"), F.col("s_nationkey"),
                       F.when(F.col("s_nationkey") % 2 == 0, "BUILDING").otherwise("TRAVEL")).drop("TARGET")


def _applicants(c: DataFrame, k: Column, bal: Column, nk: Column, segment: Column) -> DataFrame:
    return c.select(
        k.alias("SK_ID_CURR"),
        F.when(bal <= 0, 1).otherwise(0).cast("int").alias("TARGET"),
        segment.alias("OCCUPATION_TYPE"),
        nk.alias("REGION_NATION"),
        bal.alias("AMT_INCOME_TOTAL"),
        (F.abs(bal) * (k % 7 + 1)).alias("AMT_CREDIT"),
        (F.abs(bal) * (k % 5 + 1)).alias("AMT_GOODS_PRICE"),
        F.when(k % 13 == 0, F.lit(0.0)).otherwise(F.abs(bal) / (k % 30 + 6)).alias("AMT_ANNUITY"),
        (-(F.lit(6000) + (k * 7919) % 31000)).cast("int").alias("DAYS_BIRTH"),
        F.when(k % 9 == 0, F.lit(SENTINEL)).otherwise(-((k * 104729) % 12000)).cast("int").alias("DAYS_EMPLOYED"),
        (F.lit(30) - (k * 31) % 5000).cast("int").alias("DAYS_ID_PUBLISH"),
        (-((k * 17) % 9000)).cast("int").alias("DAYS_REGISTRATION"),
        F.when(k % 11 == 0, F.lit(SENTINEL)).otherwise(F.lit(5) - (k * 13) % 4000).cast("int")
        .alias("DAYS_LAST_PHONE_CHANGE"),
        (k % 5 - 1).cast("int").alias("CNT_CHILDREN"),
        (nk % 6 - 1).cast("int").alias("CNT_FAM_MEMBERS"),
        F.when(k % 4 == 0, "Y").when(k % 4 == 1, "N").when(k % 4 == 2, "yes").otherwise("unknown")
        .alias("FLAG_OWN_CAR"),
        F.when(nk % 2 == 0, "1").otherwise("0").alias("FLAG_OWN_REALTY"),
        F.lit("1").alias("FLAG_MOBIL"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    dd = datediff_days("o_orderdate", ASOF)
    prio = F.substring("o_orderpriority", 1, 1).cast("int")
    st, tp, ok = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderkey")
    return o.select(
        ok.alias("SK_ID_BUREAU"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        st.alias("CREDIT_ACTIVE"),
        tp.alias("AMT_CREDIT_SUM"),
        F.when(st == "O", tp).when(st == "P", tp / 2).otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_DEBT"),
        (tp - F.lit(150000.0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.when(ok % 50 == 0, F.lit(SENTINEL)).otherwise(dd).cast("int").alias("DAYS_CREDIT"),
        (dd + prio * 400).cast("int").alias("DAYS_CREDIT_ENDDATE"),
        F.when(st == "F", dd + 30).cast("int").alias("DAYS_ENDDATE_FACT"),
        (prio - 2).cast("int").alias("CNT_CREDIT_PROLONG"),
        ((ok % 7) - 1).cast("int").alias("CREDIT_DAY_OVERDUE"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).cast("int").alias("MONTHS_BALANCE"),
        F.col("l_returnflag").alias("STATUS"),
    )


def previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    dd = datediff_days("o_orderdate", MID_ASOF)
    st, tp, ok = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderkey")
    return o.select(
        ok.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        st.alias("NAME_CONTRACT_STATUS"),
        (tp + ((ok % 5) - 2).cast("double") * F.lit(1000.0)).alias("AMT_APPLICATION"),
        tp.alias("AMT_CREDIT"),
        (tp / (ok % 30 + 6)).alias("AMT_ANNUITY"),
        (tp * F.lit(0.95)).alias("AMT_GOODS_PRICE"),
        dd.cast("int").alias("DAYS_DECISION"),
        (dd + 30).cast("int").alias("DAYS_FIRST_DUE"),
        F.when(st == "F", F.lit(SENTINEL)).otherwise(dd + 365).cast("int").alias("DAYS_TERMINATION"),
        F.when(ok % 10 == 0, "N").otherwise("Y").alias("FLAG_LAST_APPL_PER_CONTRACT"),
        F.when(ok % 3 == 0, "0").when(ok % 3 == 1, "1").otherwise("XNA").alias("NFLAG_INSURED_ON_APPROVAL"),
    )


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        ((F.col("l_linenumber") % 3) - 1).cast("int").alias("NUM_INSTALMENT_VERSION"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        datediff_days("o_orderdate", ASOF).cast("int").alias("DAYS_INSTALMENT"),
        datediff_days("l_shipdate", ASOF).cast("int").alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("AMT_PAYMENT"),
    )


def _events_months(ev) -> Column:
    return F.when(F.col("event_type") == "error", F.lit(SENTINEL)) \
        .otherwise(-(F.col("event_id") % 36)).cast("int")


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    v, eid = F.col("value"), F.col("event_id")
    return ev.select(
        F.col("user_id").alias("SK_ID_CURR"),
        _events_months(ev).alias("MONTHS_BALANCE"),
        F.col("event_type").alias("NAME_CONTRACT_STATUS"),
        (F.floor(v / 10).cast("int") - 1).alias("CNT_INSTALMENT"),
        (F.floor(v / 20).cast("int") - 2).alias("CNT_INSTALMENT_FUTURE"),
        ((eid % 5) - 1).cast("int").alias("SK_DPD"),
        ((eid % 3) - 1).cast("int").alias("SK_DPD_DEF"),
    )


def credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    v, eid, et = F.col("value"), F.col("event_id"), F.col("event_type")
    return ev.select(
        F.col("user_id").alias("SK_ID_CURR"),
        _events_months(ev).alias("MONTHS_BALANCE"),
        (v - F.lit(5.0)).alias("AMT_BALANCE"),
        F.when(et == "signup", F.lit(0.0)).otherwise(F.lit(500.0)).alias("AMT_CREDIT_LIMIT_ACTUAL"),
        F.when(et.isin("purchase", "click"), v).otherwise(F.lit(0.0)).alias("AMT_DRAWINGS_CURRENT"),
        F.when(et == "purchase", v).alias("AMT_PAYMENT_TOTAL_CURRENT"),
        ((eid % 4) - 1).cast("int").alias("SK_DPD"),
        ((eid % 6) - 2).cast("int").alias("SK_DPD_DEF"),
        F.lit("Active").alias("NAME_CONTRACT_STATUS"),
    )


def scored(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """Scored table ``(row_id, fold, score, target)``: documents joined to labels."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lb = read_table(spark, sf_dir, "labels").select("doc_id", F.col(target).alias("target"))
    n = F.col("n_chars").cast("double")
    return d.join(lb, "doc_id", "inner").select(
        F.col("doc_id").alias("row_id"),
        (F.col("doc_id") % 5).cast("int").alias("fold"),
        (n / (n + F.lit(1000.0))).alias("score"),
        F.col("target").cast("int").alias("target"),
    )


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw (uncleaned) table set keyed like the reference: bureau, bb, prev, pos, ins, cc."""
    return {
        "bureau": bureau(spark, sf_dir),
        "bb": bureau_balance(spark, sf_dir),
        "prev": previous(spark, sf_dir),
        "pos": pos_cash(spark, sf_dir),
        "ins": installments(spark, sf_dir),
        "cc": credit_card(spark, sf_dir),
    }


# ---------------------------------------------------------------------------
# The same views for the DuckDB oracle (tables are pre-registered by name).

def _dd(col: str, asof: str) -> str:
    return f"CAST(datediff('day', DATE '{asof}', CAST({col} AS DATE)) AS INTEGER)"


STANDIN_SQL = {
    "application": f"""
SELECT c_custkey AS SK_ID_CURR,
       CAST(CASE WHEN c_acctbal <= 0 THEN 1 ELSE 0 END AS INTEGER) AS TARGET,
       c_mktsegment AS OCCUPATION_TYPE,
       c_nationkey AS REGION_NATION,
       c_acctbal AS AMT_INCOME_TOTAL,
       abs(c_acctbal) * (c_custkey % 7 + 1) AS AMT_CREDIT,
       abs(c_acctbal) * (c_custkey % 5 + 1) AS AMT_GOODS_PRICE,
       CASE WHEN c_custkey % 13 = 0 THEN 0.0::DOUBLE ELSE abs(c_acctbal) / (c_custkey % 30 + 6) END AS AMT_ANNUITY,
       CAST(-(6000 + (c_custkey * 7919) % 31000) AS INTEGER) AS DAYS_BIRTH,
       CAST(CASE WHEN c_custkey % 9 = 0 THEN {SENTINEL} ELSE -((c_custkey * 104729) % 12000) END AS INTEGER) AS DAYS_EMPLOYED,
       CAST(30 - (c_custkey * 31) % 5000 AS INTEGER) AS DAYS_ID_PUBLISH,
       CAST(-((c_custkey * 17) % 9000) AS INTEGER) AS DAYS_REGISTRATION,
       CAST(CASE WHEN c_custkey % 11 = 0 THEN {SENTINEL} ELSE 5 - (c_custkey * 13) % 4000 END AS INTEGER) AS DAYS_LAST_PHONE_CHANGE,
       CAST(c_custkey % 5 - 1 AS INTEGER) AS CNT_CHILDREN,
       CAST(c_nationkey % 6 - 1 AS INTEGER) AS CNT_FAM_MEMBERS,
       CASE c_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'yes' ELSE 'unknown' END AS FLAG_OWN_CAR,
       CASE WHEN c_nationkey % 2 = 0 THEN '1' ELSE '0' END AS FLAG_OWN_REALTY,
       '1' AS FLAG_MOBIL
FROM customer""",
    "bureau": f"""
SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR, o_orderstatus AS CREDIT_ACTIVE,
       o_totalprice AS AMT_CREDIT_SUM,
       CASE o_orderstatus WHEN 'O' THEN o_totalprice WHEN 'P' THEN o_totalprice / 2 ELSE 0.0::DOUBLE END AS AMT_CREDIT_SUM_DEBT,
       o_totalprice - 150000.0::DOUBLE AS AMT_CREDIT_SUM_OVERDUE,
       CAST(CASE WHEN o_orderkey % 50 = 0 THEN {SENTINEL} ELSE {_dd('o_orderdate', ASOF)} END AS INTEGER) AS DAYS_CREDIT,
       CAST({_dd('o_orderdate', ASOF)} + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 400 AS INTEGER) AS DAYS_CREDIT_ENDDATE,
       CAST(CASE WHEN o_orderstatus = 'F' THEN {_dd('o_orderdate', ASOF)} + 30 END AS INTEGER) AS DAYS_ENDDATE_FACT,
       CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 2 AS INTEGER) AS CNT_CREDIT_PROLONG,
       CAST(o_orderkey % 7 - 1 AS INTEGER) AS CREDIT_DAY_OVERDUE
FROM orders""",
    "bureau_balance": """
SELECT l_orderkey AS SK_ID_BUREAU, CAST(-l_linenumber AS INTEGER) AS MONTHS_BALANCE, l_returnflag AS STATUS
FROM lineitem""",
    "previous": f"""
SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, o_orderstatus AS NAME_CONTRACT_STATUS,
       o_totalprice + CAST(o_orderkey % 5 - 2 AS DOUBLE) * 1000.0::DOUBLE AS AMT_APPLICATION,
       o_totalprice AS AMT_CREDIT,
       o_totalprice / (o_orderkey % 30 + 6) AS AMT_ANNUITY,
       o_totalprice * 0.95::DOUBLE AS AMT_GOODS_PRICE,
       {_dd('o_orderdate', MID_ASOF)} AS DAYS_DECISION,
       CAST({_dd('o_orderdate', MID_ASOF)} + 30 AS INTEGER) AS DAYS_FIRST_DUE,
       CAST(CASE WHEN o_orderstatus = 'F' THEN {SENTINEL} ELSE {_dd('o_orderdate', MID_ASOF)} + 365 END AS INTEGER) AS DAYS_TERMINATION,
       CASE WHEN o_orderkey % 10 = 0 THEN 'N' ELSE 'Y' END AS FLAG_LAST_APPL_PER_CONTRACT,
       CASE o_orderkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE 'XNA' END AS NFLAG_INSURED_ON_APPROVAL
FROM orders""",
    "installments": f"""
SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
       CAST(l_linenumber % 3 - 1 AS INTEGER) AS NUM_INSTALMENT_VERSION,
       l_linenumber AS NUM_INSTALMENT_NUMBER,
       {_dd('o_orderdate', ASOF)} AS DAYS_INSTALMENT,
       {_dd('l_shipdate', ASOF)} AS DAYS_ENTRY_PAYMENT,
       l_extendedprice AS AMT_INSTALMENT,
       l_extendedprice * (1.0::DOUBLE - l_discount) AS AMT_PAYMENT
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "pos_cash": f"""
SELECT user_id AS SK_ID_CURR,
       CAST(CASE WHEN event_type = 'error' THEN {SENTINEL} ELSE -(event_id % 36) END AS INTEGER) AS MONTHS_BALANCE,
       event_type AS NAME_CONTRACT_STATUS,
       CAST(floor(value / 10) AS INTEGER) - 1 AS CNT_INSTALMENT,
       CAST(floor(value / 20) AS INTEGER) - 2 AS CNT_INSTALMENT_FUTURE,
       CAST(event_id % 5 - 1 AS INTEGER) AS SK_DPD,
       CAST(event_id % 3 - 1 AS INTEGER) AS SK_DPD_DEF
FROM events""",
    "credit_card": f"""
SELECT user_id AS SK_ID_CURR,
       CAST(CASE WHEN event_type = 'error' THEN {SENTINEL} ELSE -(event_id % 36) END AS INTEGER) AS MONTHS_BALANCE,
       value - 5.0::DOUBLE AS AMT_BALANCE,
       CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE 500.0::DOUBLE END AS AMT_CREDIT_LIMIT_ACTUAL,
       CASE WHEN event_type IN ('purchase', 'click') THEN value ELSE 0.0::DOUBLE END AS AMT_DRAWINGS_CURRENT,
       CASE WHEN event_type = 'purchase' THEN value END AS AMT_PAYMENT_TOTAL_CURRENT,
       CAST(event_id % 4 - 1 AS INTEGER) AS SK_DPD,
       CAST(event_id % 6 - 2 AS INTEGER) AS SK_DPD_DEF,
       'Active' AS NAME_CONTRACT_STATUS
FROM events""",
    "scored": """
SELECT d.doc_id AS row_id, CAST(d.doc_id % 5 AS INTEGER) AS fold,
       CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 1000.0::DOUBLE) AS score,
       CAST(l.quality AS INTEGER) AS target
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the stand-in views it uses as CTEs."""
    ctes = ",\n".join(f"{n} AS ({STANDIN_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{sql}"

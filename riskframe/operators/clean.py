"""Cleaning rules C1-C19 as one projection per table plus two small fits.

Row rules (sentinel, non-positive money, negative counts, positive day
offsets, plausibility ranges, flag coercion) are stateless column
expressions and are composed into a single ``select``. The two data-dependent
steps are *fits* that return a few numbers to the driver:

* C8 winsorising: every column's exact upper quantile from an approximate
  bracket, the counts around it and the (bounded) bracketed values.
* C9 quasi-constant drop: an approximate-median candidate per column, then
  its exact share. Both fits share scans and keep constant-size partial
  buffers per column, so no value->count map and no unpivot of rows x
  columns is ever shuffled or merged in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import binary_flag
from riskframe.session import durable
from riskframe.sources.tables import POSITION

# Fixed values shared with the reference's cleaning rules.
SENTINEL_DAYS = 365243
WINSOR_Q = 0.99
QUASI_CONSTANT_TOL = 0.99
WINSOR_INCLUDE = ("AMT_",)
WINSOR_EXCLUDE = ("FLAG_", "NFLAG", "CNT_", "NUM_", "SK_DPD")
AGE_MIN_DAYS = -100 * 365
AGE_MAX_DAYS = -18 * 365

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


@dataclass(frozen=True)
class CleanSpec:
    """Declarative cleaning rules for one table (C10-C15 are instances)."""

    name: str
    dedup_key: str | None = None
    sentinel_cols: tuple[str, ...] = ()
    nonpos_day_cols: tuple[str, ...] = ()
    range_rules: tuple[tuple[str, float, float], ...] = ()
    money_cols: tuple[str, ...] = ()
    count_cols: tuple[str, ...] = ()
    flag_prefixes: tuple[str, ...] = ()
    winsor_q: float | None = WINSOR_Q
    winsor_include: tuple[str, ...] = WINSOR_INCLUDE
    winsor_exclude: tuple[str, ...] = WINSOR_EXCLUDE
    quasi_tol: float | None = QUASI_CONSTANT_TOL
    protect: tuple[str, ...] = ()


# The columns each table's rules act on.
APPLICATION = CleanSpec(
    "application", dedup_key="SK_ID_CURR",
    sentinel_cols=("DAYS_EMPLOYED", "DAYS_LAST_PHONE_CHANGE", "DAYS_ID_PUBLISH", "DAYS_REGISTRATION"),
    nonpos_day_cols=("DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_LAST_PHONE_CHANGE", "DAYS_ID_PUBLISH",
                     "DAYS_REGISTRATION"),
    range_rules=(("DAYS_BIRTH", AGE_MIN_DAYS, AGE_MAX_DAYS),),
    money_cols=("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_ANNUITY"),
    count_cols=("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    flag_prefixes=("FLAG_",),
    protect=("SK_ID_CURR", "TARGET"),
)
BUREAU = CleanSpec(
    "bureau",
    sentinel_cols=("DAYS_CREDIT", "DAYS_CREDIT_ENDDATE"),
    nonpos_day_cols=("DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT"),
    count_cols=("CNT_CREDIT_PROLONG", "CREDIT_DAY_OVERDUE"),
    money_cols=("AMT_CREDIT_SUM_OVERDUE",),
    protect=("SK_ID_CURR", "SK_ID_BUREAU"),
)
PREVIOUS = CleanSpec(
    "previous",
    nonpos_day_cols=("DAYS_DECISION", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
                     "DAYS_LAST_DUE", "DAYS_TERMINATION"),
    flag_prefixes=("FLAG_", "NFLAG"),
    money_cols=("AMT_APPLICATION", "AMT_CREDIT", "AMT_ANNUITY"),
    protect=("SK_ID_CURR", "SK_ID_PREV"),
)
POS_CASH = CleanSpec(
    "pos_cash",
    sentinel_cols=("MONTHS_BALANCE",),
    count_cols=("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"),
    protect=("SK_ID_CURR",),
)
INSTALLMENTS = CleanSpec(
    "installments",
    sentinel_cols=("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT"),
    nonpos_day_cols=("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT"),
    count_cols=("NUM_INSTALMENT_NUMBER", "NUM_INSTALMENT_VERSION"),
    money_cols=("AMT_PAYMENT", "AMT_INSTALMENT"),
    protect=("SK_ID_CURR", "SK_ID_PREV"),
)
CREDIT_CARD = CleanSpec(
    "credit_card",
    sentinel_cols=("MONTHS_BALANCE",),
    count_cols=("SK_DPD", "SK_DPD_DEF"),
    money_cols=("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT"),
    protect=("SK_ID_CURR",),
)
SPECS = {s.name: s for s in (APPLICATION, BUREAU, PREVIOUS, POS_CASH, INSTALLMENTS, CREDIT_CARD)}


# ---------------------------------------------------------------------------
# Dedup by key, one deterministic row per key

def dedup_first(df: DataFrame, key: str | list[str], order_by: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the smallest row in ``order_by`` (then all columns) order.

    Implemented as ``groupBy(key).agg(min(struct(...)))`` so a hot key is
    reduced map-side like any other aggregate instead of landing whole in one
    window task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = [c for c in (order_by or []) if c in rest]
    fields = order + [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(fields)])
    g = df.groupBy(*keys).agg(F.min(packed).alias("_row"))
    pos = {c: i for i, c in enumerate(fields)}
    return g.select(*[F.col(c) if c in keys else F.col(f"_row._{pos[c]}").alias(c) for c in df.columns])


def dedup_first_read(df: DataFrame, key: str | list[str], position: str = POSITION) -> DataFrame:
    """Keep the row of each key that comes first in the input (NULL is a key like others), by the scan's ``position``,
    which is dropped: a hash aggregate of the positions, combined before the shuffle, and a semi-join with the rows."""
    keys = [key] if isinstance(key, str) else list(key)
    first = df.groupBy(*keys).agg(F.min(position).alias(position)).select(position)
    return df.join(first, position, "left_semi").drop(position)


# ---------------------------------------------------------------------------
# Row rules composed into one projection

def _rule_expr(name: str, dt: T.DataType, spec: CleanSpec) -> Column:
    c = F.col(name)
    if any(name.startswith(p) for p in spec.flag_prefixes):
        return binary_flag(c)
    if not is_numeric(dt):
        return c
    if name in spec.sentinel_cols:                       # C2
        c = F.when(c != F.lit(SENTINEL_DAYS), c)
    if name in spec.nonpos_day_cols:                     # C5
        c = F.when(c <= 0, c)
    for col, lo, hi in spec.range_rules:                 # C6
        if col == name:
            c = F.when(c.between(lo, hi), c)
    if name in spec.money_cols:                          # C3
        c = F.when(c > 0, c)
    if name in spec.count_cols:                          # C4
        c = F.when(c >= 0, c)
    return c


def apply_rules(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """C2-C7 for every present column in one ``select`` (absent columns skipped)."""
    out = df
    if spec.dedup_key and spec.dedup_key in df.columns:
        out = dedup_first_read(out, spec.dedup_key) if POSITION in out.columns else dedup_first(out, spec.dedup_key)
    return out.select(*[_rule_expr(f.name, f.dataType, spec).alias(f.name) for f in out.schema.fields])


# ---------------------------------------------------------------------------
# winsorise

def winsor_columns(df: DataFrame, spec: CleanSpec) -> list[str]:
    cand = [f.name for f in df.schema.fields
            if is_numeric(f.dataType) and any(f.name.startswith(p) for p in spec.winsor_include)]
    return [c for c in cand if not any(c.startswith(p) for p in spec.winsor_exclude)]


def fit_caps(df: DataFrame, cols: list[str], q: float, accuracy: int | None = None,
             approx_accuracy: int = 10000) -> dict[str, float | None]:
    """Upper caps: the q-quantile of each column, NULLs ignored.

    Exact (numpy's linear interpolation) by default, from an approximate
    bracket plus a bounded exact pass (see ``_bracket_exact``); with
    ``accuracy`` the ``percentile_approx`` value instead.
    """
    if not cols:
        return {}
    x = {c: F.col(c).cast("double") for c in cols}
    if accuracy is not None:
        row = df.agg(*[F.percentile_approx(x[c], F.lit(q), F.lit(accuracy)).alias(c) for c in cols]).first()
        return {c: (None if row[c] is None else float(row[c])) for c in cols}
    w = 3.0 / approx_accuracy
    ra = df.agg(*[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                *[F.percentile_approx(x[c], [max(0.0, q - w), min(1.0, q + w)], approx_accuracy).alias(f"b{i}")
                  for i, c in enumerate(cols)]).first()
    br = {c: ((float(ra[f"b{i}"][0]), float(ra[f"b{i}"][1])) if ra[f"b{i}"] else (None, None))
          for i, c in enumerate(cols)}
    aggs = []
    for i, c in enumerate(cols):
        lo, hi = br[c]
        if lo is not None:
            aggs += [F.count(F.when(x[c] < F.lit(lo), 1)).alias(f"below{i}"),
                     F.count(F.when(x[c].between(lo, hi), 1)).alias(f"inside{i}")]
    rb = df.agg(*aggs).first().asDict() if aggs else {}
    stats = {c: (ra[f"n{i}"], br[c][0], br[c][1], rb.get(f"below{i}", 0), rb.get(f"inside{i}", 0))
             for i, c in enumerate(cols)}
    return _bracket_exact(df, cols, q, stats)


def cap_expr(name: str, cap: float | None) -> Column:
    c = F.col(name).cast("double")
    if cap is None:
        return c.alias(name)
    return F.when(c.isNotNull(), F.least(c, F.lit(cap))).alias(name)


# ---------------------------------------------------------------------------
# Quasi-constant columns

_EXACT_IN_DOUBLE = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
_HASH_BITS = 52   # keys stay exact through percentile_approx's double buffer


def _candidate_key(f: T.StructField) -> Column:
    c = F.col(f.name)
    if isinstance(f.dataType, _EXACT_IN_DOUBLE):
        return c.cast("double")
    return F.pmod(F.xxhash64(c), F.lit(1 << _HASH_BITS))


def _pass1_aggs(fields: list[T.StructField], keys: dict, accuracy: int, first: int = 0) -> list[Column]:
    out = []
    for i, f in enumerate(fields, first):
        out.append(F.count(F.col(f.name)).alias(f"nn{i}"))
        out.append(F.percentile_approx(keys[f.name], F.lit(0.5), F.lit(accuracy)).alias(f"m{i}"))
    return out


def top_value_shares(df: DataFrame, cols: list[str] | None = None, tol: float = QUASI_CONSTANT_TOL,
                     accuracy: int = 10000) -> dict[str, float]:
    """Share of the most frequent value (NULL counted as a value) for every
    column whose top share is >= ``tol`` (> 0.5); other columns are omitted.

    Pass 1 picks, per column, the approximate median of the non-null values
    (of a 52-bit hash for long/decimal/string/other types). If one value holds
    >= tol of all rows it fills the whole middle of the sorted column, so the
    approximate median (rank error 1/accuracy) is that value. Pass 2 counts
    the candidate exactly and checks with min/max that no hash collision
    merged two values (a rare third pass then counts each value). Every pass
    keeps a constant-size buffer per column and aggregates map-side.
    """
    assert tol > 0.5 + 1.0 / accuracy
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    if not fields:
        return {}
    keys = {f.name: _candidate_key(f) for f in fields}
    r1 = df.agg(F.count(F.lit(1)).alias("__n"), *_pass1_aggs(fields, keys, accuracy)).first()
    p1 = {f.name: (r1[f"nn{i}"], r1[f"m{i}"]) for i, f in enumerate(fields)}
    return _exact_shares(df, fields, keys, p1, r1["__n"], tol)


def _exact_shares(df: DataFrame, fields: list[T.StructField], keys: dict, p1: dict, n: int, tol: float
                  ) -> dict[str, float]:
    """Pass 2 (+ rare pass 3) of ``top_value_shares`` given pass-1 results."""
    if not n:
        return {}
    out: dict[str, float] = {}
    p2: list[tuple[int, T.StructField]] = []
    for i, f in enumerate(fields):
        nn, m = p1[f.name]
        null_share = (n - nn) / n
        if null_share >= tol:
            out[f.name] = null_share
        elif m is not None and nn >= tol * n:
            p2.append((i, f))
    if not p2:
        return out
    aggs = []
    for i, f in p2:
        hit = keys[f.name] == F.lit(p1[f.name][1])
        aggs.append(F.count(F.when(hit, 1)).alias(f"c{i}"))
        if not isinstance(f.dataType, T.MapType):
            aggs.append(F.min(F.when(hit, F.col(f.name))).alias(f"lo{i}"))
            aggs.append(F.max(F.when(hit, F.col(f.name))).alias(f"hi{i}"))
    r2 = df.agg(*aggs).first().asDict()
    p3 = []
    for i, f in p2:
        cnt, lo, hi = r2[f"c{i}"], r2.get(f"lo{i}"), r2.get(f"hi{i}")
        if lo is not None and hi is not None and lo != hi:      # hash collision
            p3.append((f, lo, hi))
        elif cnt / n >= tol:
            out[f.name] = cnt / n
    if p3:
        aggs = []
        for j, (f, lo, hi) in enumerate(p3):
            aggs.append(F.count(F.when(F.col(f.name) == F.lit(lo), 1)).alias(f"a{j}"))
            aggs.append(F.count(F.when(F.col(f.name) == F.lit(hi), 1)).alias(f"b{j}"))
        r3 = df.agg(*aggs).first()
        for j, (f, _, _) in enumerate(p3):
            best = max(r3[f"a{j}"], r3[f"b{j}"])
            if best / n >= tol:
                out[f.name] = best / n
    return out


# ---------------------------------------------------------------------------
# fitted cleaner

@dataclass
class CleanModel:
    spec: CleanSpec
    caps: dict[str, float | None] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    shares: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        ruled = apply_rules(df, self.spec)
        return self.apply(ruled)

    def apply(self, ruled: DataFrame) -> DataFrame:
        cols = []
        for c in ruled.columns:
            if c in self.dropped:
                continue
            cols.append(cap_expr(c, self.caps[c]) if c in self.caps else F.col(c))
        return ruled.select(*cols)


def _bracket_exact(ruled: DataFrame, cols: list[str], q: float, stats: dict) -> dict[str, float | None]:
    """Exact q-quantiles (numpy's linear rule) from approximate brackets.

    ``stats[c] = (n, lo, hi, below, inside)``: non-null count, the bracket
    around the q-quantile from ``percentile_approx``, the number of values
    below ``lo`` and inside ``[lo, hi]``. One scan counts the bracketed values
    of all columns, distributed running sums place them, and the two order
    statistics of each column (two rows per column) come back. A column whose
    bracket misses a statistic takes the distributed exact quantile.
    """
    from riskframe.operators.metrics import exact_quantiles
    from riskframe.operators.prefix import running_sums
    out: dict[str, float | None] = {}
    need: dict[int, tuple[str, int, int, float]] = {}
    for i, c in enumerate(cols):
        n, lo, hi, below, inside = stats[c]
        if not n:
            out[c] = None
            continue
        h = q * (n - 1)
        j = int(h // 1)
        k = min(j + 1, n - 1)
        if lo is not None and below <= j and k < below + inside:
            need[i] = (c, j - below, k - below, h - j)
        else:
            out[c] = exact_quantiles(ruled, c, [q])[0]
    if not need:
        return out
    parts = [F.struct(F.lit(i).alias("i"), F.when(F.col(c).cast("double").between(stats[c][1], stats[c][2]),
                                                 F.col(c).cast("double")).alias("v"))
             for i, (c, *_) in need.items()]
    counts = durable(ruled.select(F.explode(F.array(*parts)).alias("p")).select("p.i", "p.v")
                     .where(F.col("v").isNotNull()).groupBy("i", "v").count())
    placed = running_sums(counts, "v", ["count"], by=["i"], rank_col=None)
    first = F.col("cum_count") - F.col("count")
    hit = F.lit(False)
    for i, (_, j, k, _) in need.items():
        for target in (j, k):
            hit = hit | ((F.col("i") == i) & (first <= target) & (F.lit(target) < F.col("cum_count")))
    rows = placed.where(hit).select("i", "v", first.alias("first"), "cum_count").collect()
    for i, (c, j, k, t) in need.items():
        a, b = (next(r["v"] for r in rows if r["i"] == i and r["first"] <= x < r["cum_count"]) for x in (j, k))
        out[c] = a + (b - a) * t
    return out


def fit_clean(df: DataFrame, spec: CleanSpec, accuracy: int | None = None, approx_accuracy: int = 10000
              ) -> CleanModel:
    """Fit C8 caps and C9 drops of a table."""
    return fit_ruled(apply_rules(df, spec), spec, accuracy, approx_accuracy)


def fit_ruled(ruled: DataFrame, spec: CleanSpec, accuracy: int | None = None, approx_accuracy: int = 10000
              ) -> CleanModel:
    """Fit C8 caps and C9 drops on the rule-cleaned table.

    Scan A: row count; per C9 column its NULL count and approximate median
    (pass 1); per winsorised column its non-null count and an approximate
    bracket around the cap. Scan B: rows below / inside each bracket and
    C9's exact candidate counts. Scan C: the bracketed values of all
    winsorised columns, counted and placed by distributed running sums, give exact caps.
    All buffers are constant-size per column; no value map is merged in one
    task. Capping is monotone, so a candidate below its cap matches iff
    ``x == m``; a candidate at or above its cap (``capped == cap`` iff
    ``x >= cap``) needs one more small scan. With ``accuracy`` the caps are
    ``percentile_approx`` values from scan A instead (no scan C).
    """
    model = CleanModel(spec)
    wcols = winsor_columns(ruled, spec) if spec.winsor_q is not None else []
    qfields: list[T.StructField] = []
    if spec.quasi_tol is not None:
        assert spec.quasi_tol > 0.5 + 1.0 / approx_accuracy
        qfields = [T.StructField(f.name, T.DoubleType()) if f.name in wcols else f
                   for f in ruled.schema.fields if f.name not in spec.protect]
    keys = {f.name: _candidate_key(f) for f in qfields}
    acc = accuracy or approx_accuracy
    q = spec.winsor_q
    width = 3.0 / acc
    # a winsorised column's median and bracket come from one summary where both want the same accuracy
    shared = {f.name for f in qfields if f.name in wcols and acc == approx_accuracy}
    alone = [(i, f) for i, f in enumerate(qfields) if f.name not in shared]
    aggs_a = [F.count(F.lit(1)).alias("__n")]
    for i, f in alone:
        aggs_a += _pass1_aggs([f], keys, approx_accuracy, i)
    for i, c in enumerate(wcols):
        x = F.col(c).cast("double")
        aggs_a.append(F.count(x).alias(f"wn{i}"))
        probs = [q] if accuracy is not None else [max(0.0, q - width), min(1.0, q + width)]
        aggs_a.append(F.percentile_approx(x, [*probs, 0.5] if c in shared else probs, acc).alias(f"wq{i}"))
    ra = ruled.agg(*aggs_a).first().asDict()
    n = ra["__n"]
    for i, f in enumerate(qfields):
        if f.name in shared:
            at = wcols.index(f.name)
            ra[f"nn{i}"], ra[f"m{i}"] = ra[f"wn{at}"], ra[f"wq{at}"][-1] if ra[f"wq{at}"] else None

    tol = spec.quasi_tol
    dropped: dict[str, float] = {}
    cand: list[tuple[int, T.StructField, object]] = []
    for i, f in enumerate(qfields):
        nn, m = ra[f"nn{i}"], ra[f"m{i}"]
        if not n:
            break
        if (n - nn) / n >= tol:
            dropped[f.name] = (n - nn) / n
        elif m is not None and nn >= tol * n:
            cand.append((i, f, m))

    # scan B: bracket counts + exact candidate counts on raw values
    aggs_b: list[Column] = []
    brackets = {}
    for i, c in enumerate(wcols):
        wq = ra[f"wq{i}"]
        if accuracy is None and wq:
            lo, hi = float(wq[0]), float(wq[1])
            brackets[c] = (lo, hi)
            x = F.col(c).cast("double")
            aggs_b.append(F.count(F.when(x < F.lit(lo), 1)).alias(f"below{i}"))
            aggs_b.append(F.count(F.when(x.between(lo, hi), 1)).alias(f"inside{i}"))
    for i, f, m in cand:
        hit = keys[f.name] == F.lit(m)
        aggs_b.append(F.count(F.when(hit, 1)).alias(f"c{i}"))
        if not isinstance(f.dataType, T.MapType):
            aggs_b.append(F.min(F.when(hit, F.col(f.name))).alias(f"lo{i}"))
            aggs_b.append(F.max(F.when(hit, F.col(f.name))).alias(f"hi{i}"))
    rb = ruled.agg(*aggs_b).first().asDict() if aggs_b else {}

    if accuracy is not None:
        model.caps = {c: (None if not ra[f"wq{i}"] else float(ra[f"wq{i}"][0])) for i, c in enumerate(wcols)}
    else:
        stats = {}
        for i, c in enumerate(wcols):
            lo, hi = brackets.get(c, (None, None))
            stats[c] = (ra[f"wn{i}"], lo, hi, rb.get(f"below{i}", 0), rb.get(f"inside{i}", 0))
        model.caps = _bracket_exact(ruled, wcols, q, stats) if wcols else {}

    recount: list[tuple[str, Column]] = []
    for i, f, m in cand:
        cap = model.caps.get(f.name)
        if f.name in wcols and cap is not None and m >= cap:
            recount.append((f.name, F.count(F.when(F.col(f.name).cast("double") >= F.lit(cap), 1))))
            continue
        cnt, lo, hi = rb[f"c{i}"], rb.get(f"lo{i}"), rb.get(f"hi{i}")
        if lo is not None and hi is not None and lo != hi:        # 52-bit hash collision: count both
            recount.append((f.name, F.greatest(F.count(F.when(F.col(f.name) == F.lit(lo), 1)),
                                               F.count(F.when(F.col(f.name) == F.lit(hi), 1)))))
        elif cnt / n >= tol:
            dropped[f.name] = cnt / n
    if recount:
        rc = ruled.agg(*[e.alias(f"r{j}") for j, (_, e) in enumerate(recount)]).first()
        for j, (name, _) in enumerate(recount):
            if rc[f"r{j}"] / n >= tol:
                dropped[name] = rc[f"r{j}"] / n
    model.dropped = sorted(dropped)
    model.shares = dropped
    return model


def clean(df: DataFrame, spec: CleanSpec | str, accuracy: int | None = None) -> DataFrame:
    """Fit on ``df`` and apply to it (the reference fits per table).

    The rules (joins, dedup and all) run once: fit and application read the written result."""
    spec = SPECS[spec] if isinstance(spec, str) else spec
    ruled = durable(apply_rules(df, spec))
    return fit_ruled(ruled, spec, accuracy).apply(ruled)


def clean_application(df, **kw): return clean(df, APPLICATION, **kw)   # noqa: E704
def clean_bureau(df, **kw): return clean(df, BUREAU, **kw)             # noqa: E704
def clean_prev(df, **kw): return clean(df, PREVIOUS, **kw)             # noqa: E704
def clean_pos(df, **kw): return clean(df, POS_CASH, **kw)              # noqa: E704
def clean_installments(df, **kw): return clean(df, INSTALLMENTS, **kw)  # noqa: E704
def clean_cc(df, **kw): return clean(df, CREDIT_CARD, **kw)            # noqa: E704


# ---------------------------------------------------------------------------
# Small helpers

def valid_folds(df: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Rows that belong to a fold."""
    return df.filter(F.col(fold_col) >= 0)


# Fixed value: the notebook's extreme-income threshold.
EXTREME_INCOME = 10_000_000


def extreme_rows(df: DataFrame, col: str = "AMT_INCOME_TOTAL", threshold: float = EXTREME_INCOME) -> DataFrame:
    """C17: rows at or above a threshold. (Where the scan maps NaN to NULL the filter runs beside that mapping, not in the Parquet reader.)"""
    return df.filter(F.col(col) >= F.lit(threshold))


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """``drop`` already ignores absent columns."""
    return df.drop(*cols)


def columns_with_prefix(df: DataFrame, *prefixes: str, numeric_only: bool = False) -> list[str]:
    """Prefix / dtype column selection."""
    return [f.name for f in df.schema.fields
            if any(f.name.startswith(p) for p in prefixes) and (not numeric_only or is_numeric(f.dataType))]

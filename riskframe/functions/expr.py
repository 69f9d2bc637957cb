"""Scalar column expressions.

Every function here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
# Flag spellings accepted by the binary-flag coercion (case-insensitive);
# "1"/"0" are accepted as strings too because Spark columns have one type.
FLAG_TRUE = ("1", "Y", "YES", "TRUE")
FLAG_FALSE = ("0", "N", "NO", "FALSE")
DAYS_PER_YEAR = 365.25


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finite_or_null(x) -> Column:
    """NULL for NaN and +/-Infinity, the value otherwise."""
    x = _c(x)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def safe_div(a, b) -> Column:
    """a / b as double; NULL when b is 0 or NULL, or the ratio is not finite."""
    q = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return finite_or_null(q)


def keep_if(x, cond: Column) -> Column:
    """The value where ``cond`` holds, NULL elsewhere (NULL input stays NULL)."""
    return F.when(cond, _c(x))


def clip01(x) -> Column:
    """Clip to [0, 1]; NULL stays NULL (``greatest``/``least`` alone skip NULLs)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def binary_flag(x) -> Column:
    """1/Y/YES/TRUE -> 1, 0/N/NO/FALSE -> 0, anything else -> NULL (as int)."""
    s = F.upper(_c(x).cast("string"))
    # numeric 1.0 / 0.0 arrive as "1.0"/"0.0" after the cast
    s = F.regexp_replace(s, r"^([01])\.0+$", "$1")
    return (F.when(s.isin(*FLAG_TRUE), F.lit(1))
            .when(s.isin(*FLAG_FALSE), F.lit(0))
            .otherwise(F.lit(None)).cast("int"))


def datediff_days(ts, asof: str | _dt.date) -> Column:
    """Whole days from ``asof`` to the date of ``ts`` (negative = before)."""
    return F.datediff(F.to_date(_c(ts)), F.lit(str(asof)).cast("date"))


def age_band(days_birth) -> Column:
    """Decade band of a negative day count, flooring twice like the reference.

    ``abs(floor(floor(d / 365.25) / 10) * 10)``: -9131 days (25.0 years) -> 30.
    """
    d = _c(days_birth).cast("double")
    return F.abs(F.floor(F.floor(d / F.lit(DAYS_PER_YEAR)) / F.lit(10.0)) * F.lit(10.0)).cast("double")

"""Comparison rounding applied at the end of every registered query.

The same expressions are applied on the DuckDB side (``sqlgen.r2/r6``).
Money-scale doubles keep 2 decimals, other doubles 6; a tiny offset keeps
exact half-way ties (means of cent amounts) from rounding differently when
the two engines sum in different orders, and ``+ 0.0`` turns -0.0 into 0.0.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = re.compile(r"AMT|PAYMENT_DIFF|PRICE|ACCTBAL|INCOME|INC_PER_DEP|_SUM$", re.I)


def r6(c):
    return F.round(c + F.lit(1e-9), 6) + F.lit(0.0)


def r2(c):
    return F.round(c + F.lit(1e-6), 2) + F.lit(0.0)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def finish(df: DataFrame, money: tuple[str, ...] = (), plain: tuple[str, ...] = ()) -> DataFrame:
    """Comparison projection, mirrored in SQL by ``queries._final_sql``.

    Integers become doubles (a nullable integer column converts to float64 in
    pandas from Spark but to a nullable Int from DuckDB), timestamps become
    ISO strings, doubles are rounded; ``money``/``plain`` override the name rule.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, _INTEGRAL):
            cols.append(c.cast("double").alias(f.name))
        elif isinstance(f.dataType, _TIMES):
            cols.append(c.cast("string").alias(f.name))
        elif isinstance(f.dataType, T.DoubleType) and f.name not in plain:
            use2 = f.name in money or bool(MONEY.search(f.name))
            cols.append((r2(c) if use2 else r6(c)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def is_money(name: str, money: tuple[str, ...] = ()) -> bool:
    return name in money or bool(MONEY.search(name))

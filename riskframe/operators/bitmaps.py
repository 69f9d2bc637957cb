"""Exact distinct counts by bitmaps (A14, D3), mergeable across days or tables.

An id goes to a bucket of 32,768 neighbouring ids and to one bit of it. A bitmap
table has one row per bucket (and group) of at most 4 KB, built map-side, so what
is shuffled is bounded by the range of the ids, not by the number of rows. Tables
of different days or files are merged by OR, and their counts stay exact.

Ids are integral; NULL ids are in no bitmap; an empty table gives an empty bitmap
table and a count of 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, BITS = "id_bucket", "id_bits"


def has_integral_ids(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def id_bitmaps(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Bitmap table of the ids in ``key``, per group of ``by``: by..., id_bucket, id_bits."""
    if not has_integral_ids(df, key):
        raise ValueError(f"bitmaps take integral ids, {key} is {df.schema[key].dataType.simpleString()}")
    ids = F.col(key).cast("long")
    rows = df.where(ids.isNotNull()).select(*by, F.bitmap_bucket_number(ids).alias(BUCKET), F.bitmap_bit_position(ids).alias("_bit"))
    return rows.groupBy(*by, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITS))


def merge_bitmaps(tables: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """One bitmap table with the ids of all ``tables``; groups that are not in ``by`` are merged."""
    rows = reduce(DataFrame.unionByName, [t.select(*by, BUCKET, BITS) for t in tables])
    return rows.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_from_bitmaps(bitmaps: DataFrame, by: Sequence[str] = (), name: str = "customers") -> DataFrame:
    """Number of distinct ids, per group of ``by``; one row without groups, 0 for an empty table."""
    count = F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("long").alias(name)
    return bitmaps.groupBy(*by).agg(count) if by else bitmaps.agg(count)


def distinct_ids(df: DataFrame, key: str, name: str = "customers") -> DataFrame:
    """One row with the exact number of distinct ids: by bitmaps, or by a distinct aggregate for ids that are not integral."""
    if has_integral_ids(df, key):
        return distinct_from_bitmaps(id_bitmaps(df, key), name=name)
    return df.agg(F.count_distinct(key).alias(name))

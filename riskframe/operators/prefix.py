"""Distributed running sums and global ranks (the helper behind folds and metrics).

``Window.orderBy(x)`` without ``partitionBy`` sorts every row in one task.
Instead the ordered column is cut into value ranges at approximate
quantiles (a bounded list of split points, computed in one aggregation),
each range is ranked by its own window task, and a small table of
per-range totals supplies the offset of every range. The only data that
goes through the driver is the list of split points; the offset table has
at most ``groups x buckets`` rows and is joined back with AQE choosing a
broadcast only from its runtime size.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BUCKETS = 10000


def default_buckets(df: DataFrame) -> int:
    sp = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(4, min(MAX_BUCKETS, 4 * sp))


def range_splits(df: DataFrame, col: str, n_buckets: int, accuracy: int = 10000) -> list[float]:
    """Interior split points at approximate quantiles (sorted, distinct, bounded)."""
    if n_buckets <= 1:
        return []
    qs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), qs, accuracy).alias("s")).first()
    vals = row["s"] or []
    return sorted({float(v) for v in vals if v is not None})


def add_bucket(df: DataFrame, col: str, splits: list[float], out: str = "_bucket") -> DataFrame:
    """Bucket id by value range: ``splits[i-1] <= x < splits[i]`` (order preserving)."""
    if not splits:
        return df.withColumn(out, F.lit(0))
    bz = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol=col, outputCol=out,
                    handleInvalid="keep")
    return bz.transform(df).withColumn(out, F.col(out).cast("int"))


def running_sums(df: DataFrame, order_col: str, value_cols: list[str], *, descending: bool = False,
                 by: list[str] | None = None, n_buckets: int | None = None,
                 rank_col: str | None = "_rank", totals: bool = False) -> DataFrame:
    """Inclusive running sums ``cum_<v>`` of ``value_cols`` in ``order_col`` order
    (within each ``by`` group) plus a 0-based position ``rank_col``; with
    ``totals`` also the group totals ``tot_<v>`` and row count ``tot_n`` (read
    off the same per-bucket totals, no extra pass).

    Rows with equal ``order_col`` values must be unique per group (aggregate
    first); ties then never straddle a bucket boundary and the result is
    deterministic. NULL ``order_col`` values are dropped.
    """
    by = list(by or [])
    n_buckets = n_buckets or default_buckets(df)
    key = "_ok"
    src = df.where(F.col(order_col).isNotNull()).withColumn(
        key, (-F.col(order_col) if descending else F.col(order_col)).cast("double"))
    splits = range_splits(src, key, n_buckets)
    b = add_bucket(src, key, splits)
    totals_df = b.groupBy(*by, "_bucket").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols],
                                               F.count(F.lit(1)).alias("_t_n"))
    w_off = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    extra = ([F.sum(f"_t_{v}").over(w_all).alias(f"tot_{v}") for v in value_cols]
             + [F.sum("_t_n").over(w_all).alias("tot_n")]) if totals else []
    offsets = totals_df.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}") for v in value_cols],
        F.coalesce(F.sum("_t_n").over(w_off), F.lit(0)).alias("_o_n"), *extra)
    # offsets has |groups| x n_buckets rows at most; AQE broadcasts it when its
    # runtime size is small and falls back to a shuffle join otherwise
    j = b.join(offsets, [*by, "_bucket"], "inner")
    w_in = Window.partitionBy(*by, "_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    cols = [F.col(c) for c in df.columns]
    cols += [(F.col(f"_o_{v}") + F.sum(v).over(w_in)).alias(f"cum_{v}") for v in value_cols]
    if rank_col:
        w_rn = Window.partitionBy(*by, "_bucket").orderBy(key)
        cols.append((F.col("_o_n") + F.row_number().over(w_rn) - 1).alias(rank_col))
    if totals:
        cols += [F.col(f"tot_{v}") for v in value_cols] + [F.col("tot_n")]
    return j.select(*cols)


def global_rank(df: DataFrame, order_cols: list[Column | str], *, by: list[str] | None = None,
                n_buckets: int | None = None, rank_col: str = "_rank", salt_col: Column | None = None
                ) -> DataFrame:
    """0-based position of every row in ``order_cols`` order within ``by`` groups.

    The rows are spread over ``n_buckets`` buckets by ``salt_col`` (a column
    whose order is the leading sort key, e.g. a hash) so that a big group
    never sits in one task; per-bucket counts give the offsets.
    """
    by = list(by or [])
    n_buckets = n_buckets or default_buckets(df)
    if salt_col is None:
        raise ValueError("global_rank needs a salt column that leads the sort order")
    b = df.withColumn("_bucket", salt_col.cast("int"))
    counts = b.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_t_n"))
    w_off = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_t_n").over(w_off), F.lit(0)).alias("_o_n"))
    j = b.join(offsets, [*by, "_bucket"], "inner")      # AQE picks broadcast from runtime size
    w = Window.partitionBy(*by, "_bucket").orderBy(*order_cols)
    return j.select(*[F.col(c) for c in df.columns],
                    (F.col("_o_n") + F.row_number().over(w) - 1).alias(rank_col))


def numbered(df: DataFrame, *order_cols: str, position: str = "position") -> DataFrame:
    """The rows with their 0-based position in the order of the columns, whatever their types.

    The rows are range-partitioned by the columns and written down (so numbers and rows agree
    for good); a table of one row per range supplies the offsets. Rows that are equal in
    all columns are told apart arbitrarily."""
    from riskframe.session import durable
    rows = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    placed = durable(rows.withColumn("_row", F.monotonically_increasing_id())        # range << 33 | place in it
                     .withColumn("_range", F.shiftright("_row", 33)).withColumn("_row", F.col("_row") - F.shiftleft("_range", 33)))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)       # one row a range
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_range").select(*df.columns, (F.col("_before") + F.col("_row")).alias(position))

"""Folds, hold-out splits and samples.

Rows are ordered inside each class by a seeded 60-bit hash of the id (the
leading digits of an MD5, which any engine can recompute), then by the id, so
the assignment depends on neither partitioning nor settings. Positions come
from ``prefix.global_rank`` with the hash's leading bits as the bucket: bucket
order is hash order, so the bucket count follows the cluster's shuffle
partitions and the positions stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.prefix import global_rank

HASH_BITS = 60


def id_hash(id_col: str, seed: int) -> Column:
    """A non-negative 60-bit hash of ``<id>:<seed>`` (a NULL id hashes as empty)."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_bucket(h: Column, n_buckets: int) -> Column:
    """The leading bits of the hash: ``n_buckets``, rounded up to a power of two, ranges of it."""
    return F.shiftright(h, HASH_BITS - (n_buckets - 1).bit_length()).cast("int")


def class_rank(df: DataFrame, y_col: str, id_col: str, seed: int = 42, n_buckets: int | None = None,
               rank_col: str = "_rank") -> DataFrame:
    """0-based position of each row inside its class, in (hash, id) order, whatever ``n_buckets``
    (four a shuffle partition unless given)."""
    n_buckets = n_buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    src = df.withColumn("_h", id_hash(id_col, seed))
    ranked = global_rank(src, [F.col("_h"), F.col(id_col)], by=[y_col], n_buckets=n_buckets,
                         rank_col=rank_col, salt_col=hash_bucket(F.col("_h"), n_buckets))
    return ranked.drop("_h")


def fold_map(df: DataFrame, y_col: str = "TARGET", n_splits: int = 5, seed: int = 42, id_col: str = "SK_ID_CURR") -> DataFrame:
    """F1 as the narrow map ``(row_id, fold)``: only ids and classes are shuffled and ranked.
    Written once (S4) and joined (``join_folds``) it spares ranking the wide rows."""
    return add_cv_folds(df.select(id_col, y_col), y_col, n_splits, seed, id_col).select(F.col(id_col).alias("row_id"), "fold")


def add_cv_folds(df: DataFrame, y_col: str = "TARGET", n_splits: int = 5, seed: int = 42,
                 id_col: str = "SK_ID_CURR", fold_col: str = "fold") -> DataFrame:
    """stratified k-fold id: within each class the i-th row goes to fold i mod k,
    so per-class fold sizes differ by at most one. Rows with a NULL target get -1."""
    known = df.where(F.col(y_col).isNotNull())
    r = class_rank(known, y_col, id_col, seed)
    folded = r.withColumn(fold_col, (F.col("_rank") % n_splits).cast("int")).drop("_rank")
    unknown = df.where(F.col(y_col).isNull()).withColumn(fold_col, F.lit(-1))
    return folded.unionByName(unknown)


def save_folds_table(df: DataFrame, path: str, id_col: str = "SK_ID_CURR", fold_col: str = "fold") -> None:
    """The fold map ``(row_id, fold)``."""
    df.select(F.col(id_col).alias("row_id"), F.col(fold_col).cast("int").alias("fold")) \
        .write.mode("overwrite").parquet(path)


def join_folds(features: DataFrame, fold_map: DataFrame, id_col: str = "SK_ID_CURR", fold_col: str = "fold") -> DataFrame:
    """Features with the fold of the written map ``(row_id, fold)``, matched on the key; rows the map lacks get -1.

    The map's key is renamed, so no ``row_id`` reaches the features (T9)."""
    folds = fold_map.select(F.col("row_id").alias(id_col), F.col(fold_col))
    return features.drop(fold_col).join(folds, id_col, "left").fillna(-1, subset=[fold_col])


def split_holdout(df: DataFrame, y_col: str = "TARGET", test_size: float = 0.2, seed: int = 42,
                  id_col: str = "SK_ID_CURR") -> tuple[DataFrame, DataFrame]:
    """stratified hold-out; class c contributes round(test_size * n_c) rows to the test side."""
    r = class_rank(df.where(F.col(y_col).isNotNull()), y_col, id_col, seed)
    sizes = df.where(F.col(y_col).isNotNull()).groupBy(y_col).agg(F.count(F.lit(1)).alias("_n"))
    j = r.join(sizes, y_col, "inner")          # AQE broadcasts it when its runtime size is small
    is_test = F.col("_rank") < F.floor(F.col("_n") * F.lit(test_size) + F.lit(0.5))
    tagged = j.withColumn("_test", is_test).drop("_rank", "_n")
    return tagged.where(~F.col("_test")).drop("_test"), tagged.where(F.col("_test")).drop("_test")


def fold_pairs(df: DataFrame, n_splits: int, fold_col: str = "fold") -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) per fold (validation = the fold, train = the other valid folds)."""
    v = df.where(F.col(fold_col) >= 0)
    return [(v.where(F.col(fold_col) != f), v.where(F.col(fold_col) == f)) for f in range(n_splits)]


#: Tasks that merge the tasks' samples before the last one does.
SAMPLE_MERGERS = 64


def sample_n(df: DataFrame, n: int, seed: int = 42, id_col: str = "SK_ID_CURR", portable: bool = False) -> DataFrame:
    """``min(n, rows)`` rows without replacement, reproducible: the n smallest seeded hashes, Spark's own
    64-bit hash or, with ``portable``, the one that any engine can recompute (``id_hash``), in that order.

    Every task keeps its n smallest rows at any time, at most ``4 * n`` in memory, and the tasks' rows are merged
    the same way in two steps. The hashes alone go this way first; the n-th smallest then bounds the rows, so
    the other columns of hardly more than n rows leave the scan."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.ml.functions import array_to_vector, vector_to_array
    h = id_hash(id_col, seed) if portable else F.xxhash64(F.col(id_col), F.lit(seed))
    vectors = {f.name for f in df.schema.fields if f.dataType.typeName() == "vectorudt" or "VectorUDT" in repr(f.dataType)}
    task = F.spark_partition_id().alias("_task")

    def smallest(table):
        keys = [(c, "ascending") for c in ("_h", id_col) if c in table.column_names]
        return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start")[:n])

    def keep(batches):
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows >= 4 * n:
                held = smallest(held)
        if held is not None:
            yield from smallest(held).combine_chunks().to_batches()

    def merged(plain: DataFrame) -> DataFrame:
        out = plain.mapInArrow(keep, plain.schema)
        return out.repartition(SAMPLE_MERGERS, "_task").mapInArrow(keep, plain.schema).repartition(1).mapInArrow(keep, plain.schema)

    last = merged(df.select(h.alias("_h"), task)).agg(F.max("_h")).first()[0]
    near = df if last is None else df.where(h <= F.lit(last))
    out = merged(near.select(h.alias("_h"), task, *[vector_to_array(F.col(c)).alias(c) if c in vectors else F.col(c) for c in df.columns]))
    return out.select(*[array_to_vector(F.col(c)).alias(c) if c in vectors else F.col(c) for c in df.columns])

"""Feature tables stored by buckets of their key (S2, J2), so that joins on it need no shuffle.

A table is written as Parquet files, one per bucket, sorted by the key, with a
manifest of key and number of buckets beside it. Any session can read it: the
folder is declared as an external table of the session's catalog. Tables that
are to be joined take the same number of buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.sinks import read_manifest, write_manifest


def _name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to the folder ``path`` by ``buckets`` of ``key`` and return the written table.

    The rows are dealt by the hash that buckets use, so each task writes one file; a frame that
    already comes so dealt (an aggregate by the key over as many partitions) is not shuffled again.
    """
    spark, name = df.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    write_manifest({"key": key, "buckets": buckets, "schema": df.schema.toDDL()}, f"{path.rstrip('/')}.buckets", spark)
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed``, also of another session."""
    kept = read_manifest(f"{path.rstrip('/')}.buckets", spark)
    key = "`" + kept["key"].replace("`", "``") + "`"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({kept['schema']}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(kept['buckets'])} BUCKETS LOCATION '{place}'")
    return spark.table(_name(path))

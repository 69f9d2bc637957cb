"""Sinks S2, S4-S9: Parquet/CSV tables and small JSON manifests.

Tables are written by the executors (no collect); manifests are a few
hundred bytes of JSON written through Spark's text writer so they land on
the same (shared) file system as the tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet sink (optionally partitioned, e.g. by fold for pruning)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV report sink with a header row."""
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, numeric: tuple[str, ...] = ()) -> DataFrame:
    """A CSV table with a header, in one pass: with ``schema`` typed by it, else the
    ``numeric`` columns as doubles and the rest as strings (no inference pass). A value
    that is no number is an error, as in any cast."""
    r = spark.read.option("header", True)
    if schema:
        return r.schema(schema).option("mode", "FAILFAST").csv(path)
    df = r.csv(path)
    return df.withColumns({c: df[c].cast("double") for c in numeric if c in df.columns}) if numeric else df


def write_manifest(obj: dict, path: str, spark: SparkSession | None = None) -> None:
    """A JSON manifest (column list, feature order, parameters); ``spark`` where the thread has no active session."""
    spark = spark or SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(obj),)], "v string").coalesce(1).write.mode("overwrite").text(path)


def read_manifest(path: str, spark: SparkSession | None = None) -> dict:
    spark = spark or SparkSession.getActiveSession()
    return json.loads(spark.read.text(path).first()[0])

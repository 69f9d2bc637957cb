"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
exist for tests, ``bench.py`` and the job entry points.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "riskframe", driver_memory: str = "16g",
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session configured the way the library expects."""
    master = master or os.environ.get("RISKFRAME_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            d = None
    if d:
        sc.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; invent one only when none is set.

    On a cluster ``spark.checkpoint.dir`` points at shared storage; without it
    this is an error there. Only with a local master (tests, bench) is a fresh
    folder under /tmp created.
    """
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    d = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(d)
    return d


def intermediate_dir(spark: SparkSession) -> str:
    """This application's folder for intermediate tables and model copies."""
    return f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}"


def drop_intermediate(spark: SparkSession) -> None:
    """Delete the intermediate tables and model copies of this application.

    Call it once results are written: frames that still read such a table fail
    afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(intermediate_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_state(spark: SparkSession, sf_dir: str) -> int:
    """A number that changes when a file under ``sf_dir`` is added, removed or rewritten."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    state = []
    while files.hasNext():
        f = files.next()
        state.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(state)))


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def durable(df, path: str | None = None):
    """Cut lineage: write the frame as a Parquet table in the shared checkpoint
    folder and read it back.

    ``Dataset.checkpoint()`` on an unpersisted plan computes it twice (one job
    for the eager count, one to write the files); a written table costs one
    computation, survives executor loss, and is read back column-pruned.
    """
    import uuid
    spark = df.sparkSession
    path = path or f"{intermediate_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

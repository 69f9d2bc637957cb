"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import durable

__all__ = ["durable", "fresh", "marked_texts", "ordered", "sigmoid", "slices", "split_by_width", "table", "text_bytes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ordered(df: DataFrame, *cols, parts: int | None = None) -> DataFrame:
    """Sort the whole frame by ``cols`` over all partitions, number the rows and write it down.

    The result (a table in the shared checkpoint folder, so the numbers never
    change afterwards) has ``_part`` (range partition, ascending in the order)
    and ``_place`` (position inside it). No task sees more than its range.
    """
    df = (df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)).sortWithinPartitions(*cols)
    row = F.monotonically_increasing_id()       # partition number << 33 | position
    return durable(df.withColumn("_row", row)
                   .withColumn("_part", F.shiftright("_row", 33).cast("int"))
                   .withColumn("_place", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
                   .drop("_row"))


def marked_texts(docs: DataFrame, marks: DataFrame, doc_id: str, text: str, read=None) -> DataFrame:
    """(id, y, t): one text per row of ``marks`` (id, y), the one with the least hash of the texts that share the id.

    With ``read``, a function of the text's column, t is what it makes of the text; it is applied where
    the text is scanned, so that texts themselves need no shuffle. The least is kept map-side, so an id
    that many documents carry is one row per task before the aggregate's shuffle.
    """
    t = F.col(text)
    texts = docs.select(F.col(doc_id).alias("id"), F.xxhash64(t).alias("h"), (read(t) if read else t).alias("t"))
    return (marks.select("id", "y").distinct().join(texts, "id").groupBy("id", "y").agg(F.min(F.struct("h", "t")).alias("b"))
            .select("id", "y", "b.t"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where the frame has such columns already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def slices(arrays, rows: int = 512):
    """Arrow arrays in small slices, so that a task holds few rows' results at a time."""
    for array in arrays:
        for i in range(0, len(array), rows):
            yield array.slice(i, rows)


def text_bytes(values):
    """UTF-8 bytes of each text of an Arrow column; null counts as empty."""
    import pyarrow as pa
    return [b"" if v is None else v for v in values.cast(pa.binary()).to_pylist()]


def split_by_width(total: int, parts: int) -> list[int]:
    """``total`` units over ``parts`` fields, widths differing by one at most."""
    return [total // parts + (i < total % parts) for i in range(parts)]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))

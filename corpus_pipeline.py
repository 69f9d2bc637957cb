"""A corpus pipeline of five operators: quality, toxicity, SimHash near-dedup, mixing, BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's
``docs``. Filtering stages return the columns of ``docs``; the last one returns
doc_id, source, ids and decoded text sizes. Models are fitted on the labelled
rows of ``sf_dir`` whose texts are in the tables there.

Rows with null ids pass through the filters like others (each row is judged by
its text); an empty table gives empty results at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe, mixing, quality_rank, simhash, toxicity
from riskframe.llm.common import durable, table
from riskframe.llm.queries import word_tokenizer


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~quality_rank.held_out(F.col("doc_id")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored one half and above stay."""
    model = quality_rank.fit(table(spark, sf_dir, "documents"), _labels(spark, sf_dir))
    return docs.where(quality_rank.score(F.col("text"), model) >= 0.5)


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half stay."""
    chain = toxicity.fit(table(spark, sf_dir, "documents"), _labels(spark, sf_dir))
    return docs.where(F.element_at(toxicity.score(F.col("text"), chain), -1) < 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays (of rows that share that id, the first in the files)."""
    return simhash.keep_first(docs, distance=4, shingle=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice is two rows."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and the digests of ids and decoded text."""
    done = bpe.round_trip(docs.select("doc_id", "source", "text"), word_tokenizer())
    return done.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality classifier", quality), ("toxicity", non_toxic), ("SimHash near-dedup", near_dedup),
          ("mixing sources to target weights", mix), ("BPE encoding and decoding", encode)]

# Trained classifiers, XXH64 fingerprints and pivotal rounding have no SQL form: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs

"""Small fixtures for the training-data operators."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def word_tokenizer():
    from riskframe.llm.queries import word_tokenizer
    return word_tokenizer()


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_ = "word " * 4000 + "x" * 20000 + "é" * 3000
    rows = [(1, "The quick brown fox jumps over the lazy dog, twice.\nMIT License.", "en", "a", 9),
            (2, None, "en", "a", 0), (3, "", None, "b", None), (None, "no id here at all", "en", None, 3),
            (4, " \t\n ", "en", None, 1), (5, long_, "fr", "b", 1), (6, "Élan vital, Ünïcödé 中文 ​ \x1c ok", "de", "c", 2),
            (6, "Élan vital, Ünïcödé 中文 ​ \x1c ok", "de", "c", 2), (7, "<|endoftext|> it's 3 o'clock<|startoftext|>", "en", "c", 2),
            (8, "The quick brown fox jumps over the lazy dog, twice.\nMIT License.", "en", "a", 9), (None, None, None, None, None)]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """The frame with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    names = ("ids", "fp", "size", "score", "component_id", "copies", "target", "chunk", "v", "n_links", "_part", "_place", "rid", "key")
    return df.select("*", *[F.lit("mine").alias(n) for n in names])

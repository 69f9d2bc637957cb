"""The pipeline's stages against the operators, and the oracle queries."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import bpe, quality_rank
from riskframe.llm.queries import ORACLE, QUERIES

from .conftest import clashing, frame

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert i == len(corpus_pipeline.STAGES) - 1 or out.columns == columns
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0 and sizes[4] == sizes[5] > 0
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "toxicity", "SimHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]
    got = corpus_pipeline.run(spark, SF)
    assert got.select("doc_id", "ids_sha256").exceptAll(docs.select("doc_id", "ids_sha256")).count() == 0 and got.count() == sizes[5]


def test_filters_follow_their_models(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = QUERIES["op6_quality"](spark, SF)
    kept = corpus_pipeline.quality(spark, docs, SF).select("doc_id")
    assert kept.exceptAll(scores.where("predicted = 1").select("doc_id")).count() == 0
    assert scores.where("predicted = 1").count() == kept.count()
    clean = corpus_pipeline.non_toxic(spark, docs, SF).select("doc_id")
    assert clean.exceptAll(QUERIES["op10_toxicity"](spark, SF).where("predicted = 0").select("doc_id")).count() == 0


def test_stages_on_odd_rows(spark, odd_docs, tmp_path):
    clashing(frame(spark, odd_docs)).write.parquet(str(tmp_path / "in"))
    for given in (spark.read.parquet(str(tmp_path / "in")), spark.read.parquet(str(tmp_path / "in")).where("doc_id = -1")):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, given, SF).write.mode("overwrite").parquet(str(tmp_path / f"o{i}"))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    mine = QUERIES[name](spark, SF).toPandas()
    theirs = con.execute(ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    columns = sorted(mine.columns)
    assert sorted(map(tuple, mine[columns].values.tolist())) == sorted(map(tuple, theirs[columns].values.tolist()))


def test_held_out_rule(spark):
    import zlib
    rows = spark.range(200).select("id", quality_rank.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_bpe_query_matches_library(spark):
    import hashlib

    from tokenizers import Tokenizer

    from riskframe.llm.queries import word_tokenizer
    library = Tokenizer.from_str(word_tokenizer())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_bpe"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.CACHE > 0

"""Registered queries of the training-data operators: production parameters over whole tables.

Tokenizer files are parameters of the operators; the queries take the public
tokenizers package's files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embed_dedup, lexical, license_scan, mixing, packing, period_runs, pfor, quality_rank, simhash, token_counts,
               topk_search, toxicity)
from .common import table

WORD_BPE = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
BYTE_BPE = "byte_bpe_50k.json"


def word_tokenizer() -> str:
    return bpe.read_tokenizer(public_tokenizers.path(WORD_BPE))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings linked at cosine 0.9 and above: vec_id, n_links, component_id, kept."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document: doc_id, section, start, chars, tokens, crossing."""
    ranks = token_counts.read_ranks(public_tokenizers.path(BYTE_RANKS))
    return token_counts.attribute(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, rule="start")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids of every document and their decoding: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    done = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), word_tokenizer())
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files written and read back: doc_id, start, n_tokens, ids_crc32."""
    shards = pfor.write(table(spark, sf_dir, "documents"), word_tokenizer(), end_id=1)
    return pfor.read(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    library = license_scan.Library(license_scan.PHRASES, license_scan.TEMPLATES)
    found = table(spark, sf_dir, "documents").select("doc_id", license_scan.scan(F.col("text"), library).alias("found"))
    d = license_scan.digest(F.col("found"), library.cover)
    return found.select("doc_id", *[c.alias(n) for n, c in d.items()])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_rank.fit(docs, labels.where(~quality_rank.held_out(F.col("doc_id"))))
    scored = docs.select("doc_id", quality_rank.score(F.col("text"), model).alias("score"))
    return scored.select("doc_id", quality_rank.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: doc_id, source, size, source_size, target, copies, taken."""
    docs = table(spark, sf_dir, "documents")
    taken = mixing.copies(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every query vector: query_id, rank, vec_id, score."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups at 4 bits over 4-word shingles: doc_id, fingerprint, component_id."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=4, shingle=4)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document: doc_id, held_out, score, predicted, and the chain's probabilities."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = toxicity.fit(docs, labels.where(~quality_rank.held_out(F.col("doc_id"))))
    scored = docs.select("doc_id", toxicity.score(F.col("text"), chain).alias("chain"))
    score = F.element_at("chain", -1)
    return scored.select("doc_id", quality_rank.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "chain")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest-scoring documents of every benchmark item: item_id, rank, doc_id, score."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces of power-of-two lengths: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    blocks = packing.write(table(spark, sf_dir, "documents"), bpe.read_tokenizer(public_tokenizers.path(BYTE_BPE)), longest=2048, end_id=1)
    return packing.read(blocks).select("doc_id", "start", "length", packing.ids_crc32(F.col("ids")).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of which go round in a loop: doc_id, n_runs, the longest run, and two digests."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", period_runs.scan(period_runs.looped(F.col("doc_id"), F.col("text"))).alias("found"))
    return found.select("doc_id", *[c.alias(n) for n, c in period_runs.digest(F.col("found")).items()])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_embedding_near_dedup, op2_token_counts, op3_bpe, op4_token_files, op5_license_scan, op6_quality, op7_mix,
                            op8_top_k, op9_simhash, op10_toxicity, op11_ranked_search, op12_packing, op13_period_runs, pipeline)}

# All pairs in DuckDB: only the oracle does that, on the small tables it is run on.
ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS n, vec_id, CAST(embedding AS DOUBLE[]) AS e,
         coalesce(vec_id IS NOT NULL AND len(embedding) > 0 AND len([x for x in CAST(embedding AS DOUBLE[]) if x IS NULL OR NOT isfinite(x)]) = 0
                  AND len([x for x in CAST(embedding AS DOUBLE[]) if x <> 0]) > 0, false) AS ok
  FROM embeddings),
links AS (
  SELECT a.n AS a, b.n AS b, a.vec_id AS va, b.vec_id AS vb FROM v a JOIN v b ON a.n <> b.n AND a.ok AND b.ok AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9),
reach AS (
  SELECT n AS a, vec_id AS c FROM v
  UNION
  SELECT l.a, r.c FROM reach r JOIN links l ON l.b = r.a)
SELECT v.vec_id, count(l.b) AS n_links, any_value(m.c) AS component_id,
       v.vec_id IS NOT DISTINCT FROM any_value(m.c) AS kept
FROM v JOIN (SELECT a, min(c) AS c FROM reach GROUP BY a) m ON m.a = v.n LEFT JOIN links l ON l.a = v.n
GROUP BY v.n, v.vec_id""",
    "op8_top_k": """
WITH v AS (
  SELECT vec_id, [floor(256 * x) for x in CAST(embedding AS DOUBLE[])] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in CAST(embedding AS DOUBLE[]) if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op11_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
sizes AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM d WHERE len(w) > 0),
wanted AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
held AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM held, sizes GROUP BY term),
impact AS (
  SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS impact
  FROM held JOIN weight USING (term), sizes),
s AS (
  SELECT item, item_id, r, doc_id, CAST(sum(times * impact) AS BIGINT) AS score
  FROM wanted JOIN impact USING (term) GROUP BY ALL HAVING sum(times * impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s) WHERE rank <= 20""",
}

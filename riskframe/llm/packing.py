"""Sequence packing by power-of-two decomposition.

``write`` encodes every document, appends an end id and cuts it into pieces
whose lengths are the binary digits of its token count: as many pieces of the
longest sequence as fit, then one piece for every further binary digit, the
longest first. Pieces of one length form a bucket. A piece is a sequence of its
own, so no sequence crosses documents and none is padded: each is as long as a
power of two.

The buckets are written as blocks: rows of a Parquet table in the shared folder,
each a matrix of up to ``BLOCK_IDS`` ids with one piece of the block's length a
row, in the narrowest unsigned integers that hold the vocabulary. Texts are
encoded where they are read and ids are written once; neither is shuffled.
``read`` gives the pieces back with dense sequence numbers: shorter buckets
first, inside a bucket in the order of reading.

Defined results: a null or empty text is the end id alone; rows of one doc_id
are documents of their own; a null doc_id stays null; an empty table has no
pieces. No other column is read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

#: A block is closed once it holds this many ids; a task holds one open block of each length.
BLOCK_IDS = 1 << 18
BLOCKS = ("part int, length int, first long, n_pieces int, width int, doc_ids array<long>, starts array<long>, "
          "doc_tokens array<long>, data binary")


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """Lengths of a document's pieces: the longest as often as it fits, then the rest's binary digits, descending."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as itself where it is printable, the others from U+0100 on in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteEncoder:
    """Ids as the tokenizers library gives them for a byte-level BPE file without normaliser and prefix space.

    The file's merges stand in the order of the ids they make, so an id is its merge's rank and tiktoken's ranked
    merging over the same pattern gives the library's ids (held against the library over all code points). A file
    that is not of this kind is an error.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, spec: str):
        import tiktoken
        file = json.loads(spec)
        model, split, added = file["model"], file["pre_tokenizer"], file["added_tokens"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        plain = (file["normalizer"] is None and split["type"] == "ByteLevel" and not split["add_prefix_space"] and split["use_regex"]
                 and not model["dropout"] and made == sorted(made)
                 and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added))
        if not plain:
            raise ValueError("not a plain byte-level BPE file with merges in the order of their ids")
        special = {t["content"]: t["id"] for t in added}
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.size = max([*ranks.values(), *special.values()]) + 1

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all")


_WORKER: dict = {}


def _encoder(spec: str) -> ByteEncoder:
    """The worker's encoder, one for each file content; kept between tasks."""
    if spec not in _WORKER:
        _WORKER[spec] = ByteEncoder(spec)
    return _WORKER[spec]


class Bucket:
    """The open block of one length in one task."""

    def __init__(self, part: int, length: int, width: int):
        self.part, self.length, self.type, self.width, self.first = part, length, f"<u{width}", width, 0
        self.doc_ids, self.starts, self.tokens, self.ids = [], [], [], []

    def add(self, doc_id, start: int, tokens: int, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(start)
        self.tokens.append(tokens)
        self.ids.append(ids)

    def full(self) -> bool:
        return len(self.ids) * self.length >= BLOCK_IDS

    def close(self) -> pa.RecordBatch:
        n = len(self.ids)
        data = np.concatenate(self.ids).astype(self.type).tobytes()
        longs = pa.list_(pa.int64())
        out = pa.RecordBatch.from_arrays(
            [pa.array([self.part], pa.int32()), pa.array([self.length], pa.int32()), pa.array([self.first], pa.int64()), pa.array([n], pa.int32()),
             pa.array([self.width], pa.int32()), pa.array([self.doc_ids], longs), pa.array([self.starts], longs), pa.array([self.tokens], longs), pa.array([data], pa.binary())],
            names=["part", "length", "first", "n_pieces", "width", "doc_ids", "starts", "doc_tokens", "data"])
        self.first += n
        self.doc_ids, self.starts, self.tokens, self.ids = [], [], [], []
        return out


def write(df: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, cut and write the buckets; returns the table of their blocks (reread from the shared folder).

    ``tokenizer`` is the content of a byte-level BPE file. ``first`` numbers the pieces of one length inside their part.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    spec = df.sparkSession.sparkContext.broadcast(tokenizer)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part = _encoder(spec.value), TaskContext.get().partitionId()
        width = 2 if max(e.size - 1, end_id) < 1 << 16 else 4
        end = np.asarray([end_id], np.uint32)
        buckets: dict[int, Bucket] = {}
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([e.encode(value.as_py() or ""), end])
                start = 0
                for length in piece_lengths(len(ids), longest):
                    bucket = buckets.get(length) or buckets.setdefault(length, Bucket(part, length, width))
                    bucket.add(key, start, len(ids), ids[start:start + length])
                    start += length
                    if bucket.full():
                        yield bucket.close()
        for length in sorted(buckets):
            if buckets[length].ids:
                yield buckets[length].close()

    return durable(rows.mapInArrow(cut, BLOCKS))


def bucket_starts(blocks: DataFrame) -> DataFrame:
    """(part, length, before): pieces numbered before the bucket of a part. A row for each part and length, written down.

    Each length's window has a row a part; the lengths' own totals are one row a length.
    """
    held = durable(blocks.groupBy("part", "length").agg(F.sum("n_pieces").alias("held")))
    inside = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shorter = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    base = (held.groupBy("length").agg(F.sum("held").alias("all"))
            .select("length", F.coalesce(F.sum("all").over(shorter), F.lit(0)).alias("base")))
    return durable(held.withColumn("inside", F.coalesce(F.sum("held").over(inside), F.lit(0))).join(base, "length")
                   .select("part", "length", (F.col("base") + F.col("inside")).alias("before")))


def read(blocks: DataFrame) -> DataFrame:
    """The pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (raw little-endian unsigned 32-bit).

    A sequence is one piece, so every offset is 0. The written table of bucket starts is joined as its size on disk has it.
    """
    placed = (blocks.join(bucket_starts(blocks), ["part", "length"])
              .select((F.col("before") + F.col("first")).alias("first"), "length", "width", "doc_ids", "starts", "doc_tokens", "data"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, length, width, doc_ids, starts, tokens = (batch.column(i)[row] for i in range(6))
                n, length = len(doc_ids), length.as_py()
                data = np.frombuffer(batch.column(6)[row].as_buffer(), f"<u{width.as_py()}").astype("<u4")
                ends = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * (4 * length))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, starts.values, pa.array(np.full(n, length, np.int64)), tokens.values,
                     pa.array(first.as_py() + np.arange(n)), pa.array(np.zeros(n, np.int64)), pa.BinaryArray.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(data)])],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return placed.mapInArrow(pieces, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def ids_crc32(ids: Column) -> Column:
    return F.crc32(ids)

"""Token-id files in patched frame-of-reference blocks.

``write`` encodes texts in ascending id order, appends an end id to each, and
writes *shards*: rows of a Parquet table in the shared folder, each holding one
self-contained binary file image of consecutive whole documents. ``read`` gives
the ids back per document with the document's place in the whole stream.

File image (little-endian)::

    magic 'PFR1' | u32 ids | u32 documents | u32 blocks
    u32 ids of each document          (document directory)
    u64 byte offset of each block     (block index; one more for the end)
    blocks: u32 minimum | u8 width | u8 0 | u16 exceptions
            u64 words, 64 values packed per `width` words
            u16 place of each exception | u32 value minus minimum of each exception

A block holds ``BLOCK`` ids (the last one of a file fewer). The width is the
least that holds ``PERCENTILE`` of the block's values minus their minimum;
larger values are written as exceptions and packed as zero.

Defined results: a null or empty text holds the end id alone; rows of one
doc_id stand by the hash and then the order of their texts; null doc_ids come
first; an empty table gives empty files and no rows. No other column is read.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Cutter, Known
from .common import durable

MAGIC = b"PFR1"
BLOCK = 512
PERCENTILE = 0.9
#: A file image is closed once it holds this many ids; a document is never split.
SHARD_IDS = 1 << 18
#: Chunks whose ids a worker remembers, in each of two generations.
CACHE = 400_000


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(groups, 64) unsigned values below 2**width as (groups, width) 64-bit words."""
    columns = np.ascontiguousarray(values.T)
    words = np.zeros((width, values.shape[0]), dtype=np.uint64)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        words[word] |= columns[j] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The reverse of ``pack``."""
    rows = np.ascontiguousarray(words.T)
    out = np.zeros((64, words.shape[0]), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        out[j] = rows[word] >> np.uint64(shift)
        if shift + width > 64:
            out[j] |= rows[word + 1] << np.uint64(64 - shift)
        out[j] &= mask
    return np.ascontiguousarray(out.T)


def write_file(documents: list[np.ndarray]) -> bytes:
    """One file image of the documents' ids (unsigned 32-bit)."""
    counts = np.asarray([len(d) for d in documents], dtype="<u4")
    ids = np.concatenate(documents).astype(np.uint64) if documents else np.zeros(0, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    full = np.zeros(blocks * BLOCK, dtype=np.uint64)
    full[:n] = ids
    full[n:] = ids[(blocks - 1) * BLOCK:].min() if n else 0
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1) if blocks else np.zeros(0, np.uint64)
    over = full - low[:, None]
    at = int(np.ceil(PERCENTILE * BLOCK)) - 1
    limit = np.partition(over, at, axis=1)[:, at] if blocks else low
    width = np.asarray([int(x).bit_length() for x in limit], dtype=np.int64)
    large = (over >> width[:, None].astype(np.uint64)) > 0
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        words = pack(np.where(large[rows], 0, over[rows]).reshape(-1, 64).astype(np.uint64), int(w))
        size = BLOCK // 64 * int(w) * 8
        data = words.astype("<u8").tobytes()
        for i, r in enumerate(rows):
            packed[r] = data[i * size:(i + 1) * size]
    body = []
    for b in range(blocks):
        places = np.flatnonzero(large[b])
        body.append(struct.pack("<IBBH", int(low[b]), int(width[b]), 0, len(places)) + packed[b]
                    + places.astype("<u2").tobytes() + over[b, places].astype("<u4").tobytes())
    starts = np.concatenate([[0], np.cumsum([len(x) for x in body])]).astype("<u8") if body else np.zeros(1, "<u8")
    head = MAGIC + struct.pack("<III", n, len(documents), blocks)
    first = len(head) + 4 * len(documents) + 8 * len(starts)
    return b"".join([head, counts.tobytes(), (starts + np.uint64(first)).astype("<u8").tobytes(), *body])


def read_file(data: bytes) -> list[np.ndarray]:
    """The documents' ids of a file image."""
    if data[:4] != MAGIC:
        raise ValueError("not a token-id file")
    n, documents, blocks = struct.unpack_from("<III", data, 4)
    counts = np.frombuffer(data, "<u4", documents, 16)
    starts = np.frombuffer(data, "<u8", blocks + 1, 16 + 4 * documents).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)
    out = np.empty((blocks, BLOCK), dtype=np.uint64)
    heads = [struct.unpack_from("<IBBH", data, s) for s in starts[:-1]]
    width = np.asarray([h[1] for h in heads], dtype=np.int64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        size = BLOCK // 64 * int(w) * 8
        words = raw[(starts[rows] + 8)[:, None] + np.arange(size)].reshape(-1).view("<u8").reshape(-1, int(w) or 1)
        out[rows] = unpack(words, int(w)).reshape(-1, BLOCK) if w else 0
    for b, (_, w, _, k) in enumerate(heads):
        if k:
            at = int(starts[b]) + 8 + BLOCK // 64 * w * 8
            out[b, np.frombuffer(data, "<u2", k, at)] = np.frombuffer(data, "<u4", k, at + 2 * k)
    out += np.asarray([h[0] for h in heads], dtype=np.uint64)[:, None]
    ids = out.reshape(-1)[:n].astype(np.uint32)
    return np.split(ids, np.cumsum(counts)[:-1]) if documents else []


class LibraryEncoder:
    """Ids by the tokenizers library: its normaliser, pre-tokeniser and model, each distinct chunk once.

    No rule of the file joins characters over white space (normaliser, pre-tokeniser and model work inside a chunk),
    so a text's ids are its chunks' ids, around the special tokens' strings.
    """

    def __init__(self, spec: str):
        self.cutter = Cutter(spec)
        self.model = self.cutter.rules.model
        self.chunks = Known(self.chunk, CACHE)

    def chunk(self, chunk: str) -> bytes:
        tokenize = self.model.tokenize
        return array("I", [t.id for p in self.cutter.pieces(chunk) for t in tokenize(p)]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.cutter.encode(texts, self.chunks)


_WORKER: dict = {}


def _encoder(spec: str) -> LibraryEncoder:
    if hash(spec) not in _WORKER:
        _WORKER[hash(spec)] = LibraryEncoder(spec)
    return _WORKER[hash(spec)]


SHARDS = "part int, file long, first long, n_tokens long, doc_ids array<long>, data binary"


def write(df: DataFrame, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token-id files; returns the table of them (reread from the shared folder).

    ``part`` and ``file`` ascend with doc_id, ``first`` is the place of the file's first id inside its part.
    """
    spec = df.sparkSession.sparkContext.broadcast(tokenizer)
    tie = F.xxhash64("text")
    rows = (df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text"))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, end = _encoder(spec.value), TaskContext.get().partitionId(), int(end_id).to_bytes(4, "little")
        number = first = held = 0
        ids: list = []
        docs: list[np.ndarray] = []

        def shard():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([first], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([write_file(docs)], pa.binary())],
                names=["part", "file", "first", "n_tokens", "doc_ids", "data"])

        for batch in batches:
            keys, column = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, len(keys), 512):
                for key, b in zip(keys[i:i + 512], e.encode(column.slice(i, 512).to_pylist()), strict=True):
                    ids.append(key)
                    docs.append(np.frombuffer(b + end, "<u4"))
                    held += len(docs[-1])
                    if held >= SHARD_IDS:
                        yield shard()
                        number, first, held, ids, docs = number + 1, first + held, 0, [], []
        if docs:
            yield shard()

    return durable(rows.mapInArrow(files, SHARDS))


def part_starts(shards: DataFrame) -> DataFrame:
    """Ids before each part: one row per part, so one window over them is small."""
    return (shards.groupBy("part").agg(F.sum("n_tokens").alias("held"))
            .select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before")))


def read(shards: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it), ids as raw little-endian u32."""
    # one row of two numbers per partition of the writing job: the files stay where they are
    placed = (shards.join(F.broadcast(part_starts(shards)), "part")
              .select((F.col("before") + F.col("first")).alias("first"), "doc_ids", "data"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs = read_file(batch.column(2)[row].as_py())
                sizes = [len(d) for d in docs]
                starts = batch.column(0)[row].as_py() + np.cumsum([0, *sizes])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column(1)[row].as_py(), pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array([d.astype("<u4").tobytes() for d in docs], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")



"""Ranked lexical search with range-maximum sparse tables over posting lists.

``postings`` reads every text once and writes, for each document, its term count
and its counts of the items' terms; corpus sizes and document frequencies come
from that table. ``search`` then takes the documents in chunks. In a chunk every
term has a posting list in document order, each posting with its impact, and a
sparse table of range maxima over the lists.

An item is answered best first. An interval of documents is bounded by the sum,
over the item's terms, of the highest impact in it (two lookups a term). The
interval with the highest bound is opened: the document that holds the highest of
those impacts is scored exactly and the interval is split there. Intervals whose
bound is below the item's k-th best score so far, or equal with no smaller
document id left in it, are never opened. Several of the best intervals are
opened at a time to fill the arrays. A task keeps its best k of each item from
chunk to chunk, so later chunks are pruned by earlier ones; the tasks' lists are
merged in two steps.

Items are a stated query set. They are taken in blocks of at most ``BLOCK_TERMS``
distinct terms on average, each block's terms (and nothing of the documents but
corpus sizes and their terms' document frequencies) go to all tasks, and every
block is searched against all documents.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``,
with only A-Z lower-cased.

Defined results: null and empty texts have no terms and match nothing; every row
of the documents is a document and every row of the items an item of its own,
also under a repeated id; null document ids (and the largest long, which stands for
them) come last among equal scores and are null; an item
without terms or matches has no rows; an empty table on either side gives none.
Clashing columns do no harm: only ids and texts are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, text_bytes

#: Distinct terms of a block of items: a few MB for every task.
BLOCK_TERMS = 1 << 18
#: A chunk is searched once it holds this many documents or postings of the items' terms.
CHUNK_DOCS, CHUNK_POSTINGS = 8192, 1 << 20
#: Most intervals opened together.
OPEN = 256
#: Parts in which the tasks' lists of an item are merged first.
MERGE_PARTS = 64
NO_ID = np.iinfo(np.int64).max

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text's UTF-8 bytes, repeats included."""
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(row, item_id, term, times): the items' terms, written down; ``row`` tells rows of one id apart."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, key, data in zip(*(batch.column(i).to_pylist() for i in (0, 1)), text_bytes(batch.column(2)), strict=True):
                held = Counter(terms_of(data))
                if held:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(held), pa.int64()), pa.array([key] * len(held), pa.int64()), pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                        names=["row", "item_id", "term", "times"])

    given = items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return durable(given.mapInArrow(count, "row long, item_id long, term binary, times long"))


class Block:
    """A block of items: codes of its terms, and each item's codes and how often it has them."""

    def __init__(self, rows):
        self.code: dict[bytes, int] = {}
        held: dict[int, tuple[list, list]] = {}
        self.item_id: dict[int, int] = {}
        for row in rows:
            codes, times = held.setdefault(row["row"], ([], []))
            codes.append(self.code.setdefault(bytes(row["term"]), len(self.code)))
            times.append(row["times"])
            self.item_id[row["row"]] = row["item_id"]
        self.items = {row: (np.asarray(c), np.asarray(t, dtype=np.int64)) for row, (c, t) in sorted(held.items())}


def blocks(terms: DataFrame, size: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks: dealt by the hash of their row, so many that a block has ``size`` terms on average."""
    count = max(1, -(-terms.count() // size))
    dealt = terms.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count)))
    for i in range(count):
        rows = dealt.where(F.col("block") == i).select("row", "item_id", "term", "times").toLocalIterator()
        block = Block(rows)
        if block.items:
            yield block


def postings(docs: DataFrame, block: Block, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, codes, counts): each document's number of terms and its counts of the block's terms, written down."""
    code = docs.sparkSession.sparkContext.broadcast(block.code)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = code.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                sizes, codes, counts, ends = [], [], [], [0]
                for data in text_bytes(some.column(1)):
                    words = terms_of(data)
                    held = Counter(map(find, words))
                    held.pop(None, None)
                    sizes.append(len(words))
                    codes += held.keys()
                    counts += held.values()
                    ends.append(len(codes))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(codes, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], names=["doc_id", "n", "codes", "counts"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = durable(given.mapInArrow(count, "doc_id long, n long, codes array<int>, counts array<long>"))
    code.unpersist()
    return made


def weights(table: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the weight of each of the block's terms."""
    documents, length = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = np.zeros(len(block.code), dtype=np.int64)
    # one row for each of the block's terms
    for code, df in table.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df")).toLocalIterator():
        out[code] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    return documents, length, out


class Chunk:
    """Posting lists of some documents in one array, by term and then document, with their sparse table."""

    def __init__(self, doc_ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray,
                 documents: int, length: int, weight: np.ndarray):
        order = np.lexsort((doc_ids, -n))           # long documents stand together, equal ones by id
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.docs, self.ids = len(order), doc_ids[order]
        m = 75 + (25 * n * documents) // max(length, 1)
        owner = np.repeat(np.arange(len(n)), sizes)
        impact = weight[codes] * ((1_000_000_000 * counts) // (1000 * counts + 12 * m[owner]))
        key = codes.astype(np.int64) * self.docs + place[owner]
        by = np.argsort(key, kind="stable")
        self.key, self.impact = key[by], impact[by]
        self.ends = np.searchsorted(self.key, np.arange(len(weight) + 1) * self.docs)
        self.best = self.table(self.impact, int(np.diff(self.ends).max(initial=1)))
        self.least = self.table(~self.ids, self.docs)

    @staticmethod
    def table(values: np.ndarray, longest: int) -> list[np.ndarray]:
        """Row j: place of the first maximum of the 2**j values from each place on."""
        rows = [np.arange(len(values), dtype=np.int32)]
        while 2 << (len(rows) - 1) <= longest:
            last, half = rows[-1], 1 << (len(rows) - 1)
            left, right = last[:-half], last[half:]
            rows.append(np.where(values[left] >= values[right], left, right))
        width = len(values)
        return np.stack([np.pad(r, (0, width - len(r))) for r in rows]) if width else np.zeros((1, 0), np.int32)

    @staticmethod
    def peak(table: np.ndarray, values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of the first maximum of values[left:right], for filled ranges."""
        row = np.frexp((right - left).astype(np.float64))[1] - 1
        a, b = table[row, left], table[row, right - (1 << row)]
        return np.where(values[a] >= values[b], a, b)


class Search:
    """One item's search in a chunk, and its best documents over all chunks of a task."""

    def __init__(self, codes: np.ndarray, times: np.ndarray, k: int):
        self.codes, self.times, self.k = codes, times, k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.opened = 0

    def keep(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores > 0
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        best = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[best], ids[best]

    def may_hold(self, bound: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Which intervals may hold a document better than the k-th best so far."""
        if len(self.scores) < self.k:
            return bound > 0
        return (bound > self.scores[-1]) | ((bound == self.scores[-1]) & (least_id < self.ids[-1]))

    def bounded(self, c: Chunk, left: np.ndarray, right: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple:
        """Intervals of documents lo..hi with the item's posting ranges left..right: bounds, split documents; those that may hold a result."""
        filled = right > left
        at = np.zeros_like(left)
        at[filled] = c.peak(c.best, c.impact, left[filled], right[filled])
        part = np.where(filled, c.impact[at] * np.broadcast_to(self.times, left.shape), 0)
        bound = part.sum(axis=1)
        top = part.argmax(axis=1)
        split = c.key[at[np.arange(len(at)), top]] - self.codes[top] * c.docs
        some = (bound > 0).nonzero()[0]
        least = c.ids[c.peak(c.least, ~c.ids, lo[some], hi[some])] if len(some) else np.zeros(0, np.int64)
        some = some[self.may_hold(bound[some], least)]
        return left[some], right[some], lo[some], hi[some], bound[some], split[some]

    def run(self, c: Chunk) -> None:
        present = c.ends[self.codes + 1] > c.ends[self.codes]
        codes, times = self.codes, self.times
        self.codes, self.times = codes[present], times[present]
        if len(self.codes):
            self._run(c)
        self.codes, self.times = codes, times

    def _run(self, c: Chunk) -> None:
        base = self.codes * c.docs
        queue = self.bounded(c, c.ends[self.codes][None, :], c.ends[self.codes + 1][None, :], np.zeros(1, np.int64), np.full(1, c.docs))
        take = 1
        while len(queue[4]):
            best = np.argpartition(-queue[4], take - 1)[:take] if len(queue[4]) > take else np.arange(len(queue[4]))
            left, right, lo, hi, _, split = (q[best] for q in queue)
            self.opened += len(best)
            key = base[None, :] + split[:, None]
            at = np.searchsorted(c.key, key)
            hit = (at < right) & (c.key[np.minimum(at, len(c.key) - 1)] == key)
            scores = np.where(hit, c.impact[np.minimum(at, len(c.key) - 1)] * self.times, 0).sum(axis=1)
            self.keep(scores, c.ids[split])
            rest = np.ones(len(queue[4]), dtype=bool)
            rest[best] = False
            if len(self.scores) == self.k:
                rest &= queue[4] >= self.scores[-1]
            children = self.bounded(c, np.concatenate([left, at + hit]), np.concatenate([at, right]),
                                    np.concatenate([lo, split + 1]), np.concatenate([split, hi]))
            queue = tuple(np.concatenate([q[rest], new]) for q, new in zip(queue, children, strict=True))
            take = min(2 * take, OPEN)


def search_block(table: DataFrame, block: Block, k: int) -> DataFrame:
    """(row, doc_id, score, task): the best k of every item in every task."""
    documents, length, weight = weights(table, block)
    shared = table.sparkSession.sparkContext.broadcast((documents, length, weight, block.items))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, length, weight, items = shared.value
        searches = {row: Search(codes, times, k) for row, (codes, times) in items.items()}
        held: list[tuple] = []
        docs = posts = 0

        def close() -> None:
            chunk = Chunk(*(np.concatenate(x) for x in zip(*held, strict=True)), documents, length, weight)
            for s in searches.values():
                s.run(chunk)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                codes, counts = some.column(2), some.column(3)
                held.append((some.column(0).fill_null(NO_ID).to_numpy(), some.column(1).to_numpy(), codes.value_lengths().to_numpy(),
                             codes.flatten().to_numpy(), counts.flatten().to_numpy()))
                docs, posts = docs + some.num_rows, posts + len(held[-1][3])
                if docs >= CHUNK_DOCS or posts >= CHUNK_POSTINGS:
                    close()
                    held, docs, posts = [], 0, 0
        if held:
            close()
        task = TaskContext.get().partitionId()
        for row, s in searches.items():
            if len(s.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s.ids), row)), pa.array(s.ids, mask=s.ids == NO_ID), pa.array(s.scores), pa.array(np.full(len(s.ids), task))],
                    names=["row", "doc_id", "score", "task"])

    return table.where("size(codes) > 0").mapInArrow(find, "row long, doc_id long, score long, task long")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The best k documents of each row, with rank; lists of tasks are merged in parts first."""
    best_first = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    part = F.pmod("task", F.lit(MERGE_PARTS))
    some = Window.partitionBy("row", part).orderBy(*best_first)
    every = Window.partitionBy("row").orderBy(*best_first)
    return (found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k))


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """The k best documents of every item: item_id, rank (from 1), doc_id, score."""
    terms = item_terms(items, item_id, item_text)
    names = terms.select("row", "item_id").distinct()
    found = None
    for block in blocks(terms):
        table = postings(docs, block, doc_id, text)
        part = durable(search_block(table, block, k))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "row long, doc_id long, score long, task long")
    return merged(found, k).join(names, "row").select("item_id", "rank", "doc_id", "score")

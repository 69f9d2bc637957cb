"""Token counts of a document's sections, from one encoding of the whole document.

Each document is encoded once, whole; every token's character span follows from
the bytes it stands for. The spans are interval-joined (both sides are sorted)
to the sections, here the lines of the text, each with its closing newline. A
token that crosses a border goes, by ``rule``, to the section that holds its
``start`` or its ``end``, or to the one it ``overlap``s most (the earlier of
equals). Every token is counted once, so the counts of a document add up to its
token count.

Defined results: a null or empty text has no section and no row in ``spans``; ``attribute`` returns one
row per section in order. A token that covers part of a character counts as covering that character.
Repeated rows give repeated results. Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

RULES = ("start", "end", "overlap")


def read_ranks(path: str) -> dict[bytes, int]:
    """A byte-level BPE vocabulary as ranks (a fixed size, read on the driver)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_sizes(ranks: dict[bytes, int]) -> np.ndarray:
    """Bytes of each token, by id."""
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for b, i in ranks.items():
        sizes[i] = len(b)
    return sizes


def token_spans(encoding, sizes: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, start, end) of a text's tokens, in characters; a token's span covers every character it has a byte of."""
    ids = np.asarray(encoding.encode_ordinary(text), dtype=np.int64)
    size = sizes[ids]
    ends = np.cumsum(size)
    if text.isascii():
        return ids, ends - size, ends
    char = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)     # 1-based character of each byte
    return ids, char[ends - size] - 1, char[ends - 1]


def sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the lines of a text, in characters; a line holds its newline."""
    lines = [len(line) + 1 for line in text.split("\n")]
    lines[-1] -= 1
    ends = np.cumsum(lines if lines[-1] else lines[:-1])
    return np.concatenate([[0], ends[:-1]]), ends


def assign(start: np.ndarray, end: np.ndarray, s_start: np.ndarray, s_end: np.ndarray, rule: str) -> np.ndarray:
    """Section of each token; the sections lie side by side and cover the text."""
    first = np.searchsorted(s_end, start, side="right")
    last = np.searchsorted(s_end, end - 1, side="right")
    if rule == "start":
        return first
    if rule == "end":
        return last
    best = first.copy()
    for i in np.flatnonzero(last > first):
        k = np.arange(first[i], last[i] + 1)
        best[i] = k[np.argmax(np.minimum(s_end[k], end[i]) - np.maximum(s_start[k], start[i]))]
    return best


_WORKER: dict = {}


def vocabulary_digest(ranks: dict[bytes, int]) -> str:
    """Digest of the tokens and their numbers: vocabularies of one size are not one vocabulary."""
    taken = hashlib.sha256()
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        taken.update(b"%d %d " % (rank, len(token)) + token)
    return taken.hexdigest()


def _encoding(ranks: dict[bytes, int], pattern: str, digest: str):
    import tiktoken
    key = (digest, pattern)
    if key not in _WORKER:
        _WORKER[key] = (tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), token_sizes(ranks))
    return _WORKER[key]


RESULT = "struct<start:array<int>,chars:array<int>,tokens:array<int>,crossing:array<int>>"


def count_udf(spark, ranks: dict[bytes, int], pattern: str, rule: str = "start"):
    """Column function: text -> per section its start, characters, tokens, and tokens that crossed its far border."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    shared, digest = spark.sparkContext.broadcast(ranks), vocabulary_digest(ranks)

    @F.arrow_udf(RESULT)
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding, sizes_of = _encoding(shared.value, pattern, digest)
        names = ("start", "chars", "tokens", "crossing")
        for column in slices(texts):
            sizes, parts = [0], {n: [] for n in names}
            for text in column.to_pylist():
                if not text:
                    sizes.append(0)
                    continue
                _, start, end = token_spans(encoding, sizes_of, text)
                s_start, s_end = sections(text)
                k = len(s_end)
                owner = assign(start, end, s_start, s_end, rule)
                crosses = np.searchsorted(s_end, end - 1, side="right") > (home := np.searchsorted(s_end, start, side="right"))
                sizes.append(k)
                for n, v in zip(names, (s_start, s_end - s_start, np.bincount(owner, minlength=k), np.bincount(home[crosses], minlength=k)), strict=True):
                    parts[n].append(v)
            offsets = pa.array(np.cumsum(sizes).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts[n]).astype(np.int32) if parts[n] else [], pa.int32()))
                     for n in names]
            yield pa.StructArray.from_arrays(lists, names=list(names))

    return count


def attribute(df: DataFrame, ranks: dict[bytes, int], pattern: str, rule: str = "start", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per section: doc_id, section (from 0), start, chars, tokens, crossing."""
    counted = df.select(F.col(doc_id).alias("doc_id"), count_udf(df.sparkSession, ranks, pattern, rule)(F.col(text)).alias("c"))
    return (counted.select("doc_id", F.posexplode(F.arrays_zip("c.start", "c.chars", "c.tokens", "c.crossing")).alias("section", "s"))
            .select("doc_id", F.col("section").cast("long").alias("section"), F.col("s.start").cast("long").alias("start"),
                    F.col("s.chars").cast("long").alias("chars"), F.col("s.tokens").cast("long").alias("tokens"),
                    F.col("s.crossing").cast("long").alias("crossing")))

"""SimHash near-dedup with pigeonhole blocks.

``fingerprint``: the majority bits of the XXH64 hashes of a text's word shingles.
``link_classes``: components of fingerprints that differ in at most ``distance``
bits. A 64-bit fingerprint is cut into ``blocks`` fields; two that differ in at
most ``distance`` bits agree on some ``blocks - distance`` of them, so each
fingerprint is filed under every such choice of fields (the number of blocks
follows the number of fingerprints: the filing keys must be long enough to keep
unrelated fingerprints apart; every choice is exact). Inside a key, neighbours in
order are verified first; their components are then compared only where a key
holds more than one of them: members outside the key's largest component meet all
members of other components, in tiles of bounded size (``across``). A large group of
near copies thus costs one link per fingerprint, a stranger in its key one
comparison per member, and no key is the work of one task.

Defined results: copies share a fingerprint and are handled once; a text without
words has fingerprint zero and links like any other; a null text is empty.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, fresh, slices, split_by_width, text_bytes
from .components import components

BITS = 64
#: Key bits beyond the logarithm of the number of fingerprints.
SPARE_BITS = 8
#: Fingerprints a side that a tile of a mixed key holds on average.
TILE = 4096


def fingerprint_of(text: bytes, shingle: int, seed: int) -> int:
    """SimHash of one text's UTF-8 bytes (ASCII letters lower-cased, words split at ASCII white space)."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    n = max(1, len(words) - shingle + 1)
    hash_of = xxhash.xxh64_intdigest
    hashes = [hash_of(joined[a:b], seed)
              for a, b in zip(starts[:n].tolist(), (starts[len(words) - n + 1:] - 1).tolist(), strict=True)]
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        some = np.asarray(hashes[i:i + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """Fingerprint column (long) of a text column."""
    @F.arrow_udf("long")
    def simhash(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in slices(texts):
            yield pa.array([fingerprint_of(b, shingle, seed) for b in text_bytes(column)], pa.int64())

    return simhash(text)


def masks(distance: int, count: int) -> list[int]:
    """Masks of the filing keys: all choices of ``blocks - distance`` of ``blocks`` fields, as signed longs."""
    need = math.log2(max(2, count)) + SPARE_BITS
    blocks = next((b for b in range(distance + 1, BITS + 1) if BITS * (b - distance) / b >= min(need, BITS - 2 * distance)), BITS)
    widths = split_by_width(BITS, blocks)
    at = [sum(widths[:i]) for i in range(blocks)]
    fields = [((1 << w) - 1) << a for w, a in zip(widths, at, strict=True)]
    out = [sum(c) for c in itertools.combinations(fields, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def across(filed: DataFrame, distance: int) -> DataFrame:
    """(u, v): links between components, for keys of ``filed`` (choice, key, fp, c: each fp's component) that hold several.

    In each key only members outside its largest component ask, and all members answer; members of one
    component aren't compared. Askers and answerers are dealt into tiles by a hash, so a hot key is many tasks.
    """
    held = filed.groupBy("choice", "key", "c").agg(F.count("*").alias("n"))
    sizes = (held.groupBy("choice", "key").agg(F.max(F.struct("n", "c")).alias("main"), F.sum("n").alias("total"))
             .select("choice", "key", F.col("main.c").alias("main"), F.ceil((F.col("total") - F.col("main.n")) / TILE).alias("down"),
                     F.ceil(F.col("total") / TILE).alias("over")))
    placed = durable(filed.join(sizes, ["choice", "key"]))

    def dealt(tiles: str) -> Column:
        return F.pmod(F.xxhash64("fp"), F.col(tiles))

    def every(tiles: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(tiles) - 1))

    asking = placed.where("c != main").withColumn("row", dealt("down")).withColumn("column", every("over"))
    giving = placed.withColumn("column", dealt("over")).withColumn("row", every("down"))
    giving = giving.select("choice", "key", "row", "column", F.col("fp").alias("fp2"), F.col("c").alias("c2"))
    return (asking.join(giving, ["choice", "key", "row", "column"])
            .where((F.col("c") != F.col("c2")) & (_differ("fp", "fp2") <= distance))
            .select(F.col("c").alias("u"), F.col("c2").alias("v")).distinct())


def link_classes(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, class): for each distinct ``fp`` of ``prints`` that has links, the smallest fp reachable over links."""
    distinct = prints.select("fp").distinct()
    keys = masks(distance, prints.count())
    filed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in keys])).alias("choice", "key"))
    order = Window.partitionBy("choice", "key").orderBy("fp")
    shared = durable(filed.withColumn("last", F.lag("fp").over(order)).withColumn("next", F.lead("fp").over(order))
                     .where("last IS NOT NULL OR next IS NOT NULL").drop("next"))
    near = components(shared.where(_differ("fp", "last") <= distance)
                      .select(F.col("fp").alias("u"), F.col("last").alias("v")))
    placed = durable(shared.drop("last").join(near, F.col("fp") == F.col("node"), "left")
                     .select("choice", "key", "fp", F.coalesce("component", "fp").alias("c")))
    mixed = placed.groupBy("choice", "key").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a < b").select("choice", "key")
    merged = components(across(durable(placed.join(mixed, ["choice", "key"], "left_semi")), distance)).withColumnRenamed("component", "final")
    near = near.withColumnRenamed("node", "fp").withColumnRenamed("component", "c")
    lone = merged.join(near, merged.node == near.fp, "left_anti").select(F.col("node").alias("fp"), F.col("node").alias("c"))
    return (near.unionByName(lone).join(merged, F.col("c") == F.col("node"), "left")
            .select("fp", F.coalesce("final", "c").alias("class")))


def grouped(prints: DataFrame, distance: int = 4) -> DataFrame:
    """``prints`` (a written table with doc_id and fp) with class (a fingerprint that names the group) and component_id."""
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # one row per fingerprint from here on
    classes = link_classes(durable(least), distance)
    whole = durable(least.join(classes, "fp", "left").select("fp", F.coalesce("class", "fp").alias("class"), "least"))
    named = durable(whole.groupBy("class").agg(F.min("least").alias("component_id")))    # both sides of the join are scans: a large class can be split
    return prints.join(durable(whole.join(named, "class").select("fp", "class", "component_id")), "fp")


def near_duplicates(df: DataFrame, distance: int = 4, shingle: int = 4, seed: int = 42, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, fp (long), component_id (smallest doc_id reachable over links, itself included).

    A null doc_id takes part, but only names a component that has no other id. Repeated rows are copies.
    """
    prints = durable(df.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle, seed).alias("fp")))
    return grouped(prints, distance).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, distance: int = 4, shingle: int = 4, seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` (a scan of files) with the smallest id of their group; of several such rows the first in the files.

    Rows are known by file and place in it. In a group without ids, the first row in the files stays.
    """
    path, at = fresh(docs, "_path", "_at")
    row = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at))
    prints = durable(row.select(F.col(doc_id).alias("doc_id"), F.col(path).alias("_path"), F.col(at).alias("_at"),
                                fingerprint(F.col(text), shingle, seed).alias("fp")))
    least = grouped(prints, distance).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = least.groupBy("class").agg(F.min(F.struct("_path", "_at")).alias("f"))
    return row.join(first.select(F.col("f._path").alias(path), F.col("f._at").alias(at)), [path, at], "left_semi").select(*docs.columns)


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

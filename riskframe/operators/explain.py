"""Per-row tree attributions X1-X4 (path-dependent TreeSHAP).

The fitted ensemble is read from Spark ML's own saved node table and walked
down level by level with joins; each leaf becomes one row of a written table:
its value, and for every feature on its path the interval that leads to the
leaf and the share of the cover that passes. A row's attribution from a
leaf depends on the row only through which of these features pass, so a leaf
carries a table of the attributions under every pass/fail pattern (leaves of
more than ``PATTERN_FEATURES`` features run the path recursion on the rows).

Leaves are taken to the rows in chunks of at most ``CHUNK_CELLS`` numbers, one
chunk at a time through the driver, so a model may have any number of trees; rows
are never shuffled and stay in ``mapInPandas`` batches. The result is the long table
``(row_id, feature, value, phi)``; the base value (expected margin) is a model
constant, so ``sum(phi) + base = margin`` row by row. Only the asked features'
leaves and columns take part where ``only`` is given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskframe.session import durable

#: Leaves of at most so many distinct features carry their pattern table (2**k patterns).
PATTERN_FEATURES = 10
#: Numbers of the pattern tables that are sent to the tasks at once (64 MB).
CHUNK_CELLS = 8_000_000


@dataclass
class Ensemble:
    """A model's leaves as a written table, and its expected margin."""

    leaves: DataFrame               # leaf, value, feats, z, lo, hi, k, chunk
    base: float
    n_features: int
    n_chunks: int


def leaf_table(nodes: DataFrame, weights: DataFrame) -> DataFrame:
    """One row per leaf: ``value`` (tree weight x prediction) and, for each distinct feature of its path, the cover share ``z``
    and the interval ``lo < x <= hi`` that passes. ``nodes``: treeID, id, prediction, impurityStats, leftChild, rightChild, split;
    ``weights``: treeID, weight."""
    cover = F.col("impurityStats")[0]
    node = durable(nodes.select("treeID", "id", "prediction", cover.alias("cover"), "leftChild", "rightChild",
                                F.col("split.featureIndex").alias("f"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("at")))
    step = "struct<f:int,frac:double,lo:double,hi:double>"
    walk = node.where("id = 0").withColumn("path", F.array().cast(f"array<{step}>"))
    leaves = None
    while True:
        walk = durable(walk)
        ends = walk.where("leftChild < 0").select("treeID", "prediction", "path")
        leaves = ends if leaves is None else leaves.unionByName(ends)
        inner = walk.where("leftChild >= 0")
        if inner.isEmpty():
            break
        low, high = F.lit(float("-inf")), F.lit(float("inf"))
        sides = F.explode(F.array(F.struct(F.col("leftChild").alias("child"), low.alias("lo"), F.col("at").alias("hi")),
                                  F.struct(F.col("rightChild").alias("child"), F.col("at").alias("lo"), high.alias("hi")))).alias("s")
        down = inner.select("treeID", "path", F.col("cover").alias("above"), F.col("f").alias("on"), sides).select("*", F.col("s.child").alias("id")).join(node, ["treeID", "id"])
        new = F.struct(F.col("on").cast("int").alias("f"), (F.col("cover") / F.col("above")).alias("frac"), F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")).cast(step)
        walk = down.select("treeID", "id", "prediction", "cover", "leftChild", "rightChild", "f", "at", F.array_append("path", new).alias("path"))
    keyed = durable(leaves.join(weights, "treeID").select(F.monotonically_increasing_id().alias("leaf"), (F.col("weight") * F.col("prediction")).alias("value"), "path"))
    steps = keyed.select("leaf", "value", F.explode_outer("path").alias("p"))
    per = steps.groupBy("leaf", "value", F.col("p.f").alias("f")).agg(F.product("p.frac").alias("z"), F.max("p.lo").alias("lo"), F.min("p.hi").alias("hi"))
    cell = F.when(F.col("f").isNotNull(), F.struct("f", "z", "lo", "hi"))
    g = per.groupBy("leaf", "value").agg(F.array_sort(F.collect_list(cell)).alias("c"))      # at most a tree's depth of features
    return g.select("leaf", "value", *[F.col("c")[n].alias(m) for n, m in (("f", "feats"), ("z", "z"), ("lo", "lo"), ("hi", "hi"))], F.size("c").alias("k"))


def load_ensemble(model, spark: SparkSession, n_features: int) -> Ensemble:
    """The leaf table of a fitted model (written), in chunks by the size of the leaves' pattern tables."""
    from riskframe.operators.model import model_dir, node_table
    path = model_dir(spark)
    nodes = node_table(model, spark, path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weight")       # a tuple's columns
    leaves = durable(leaf_table(nodes, weights))
    share = F.aggregate("z", F.lit(1.0), lambda a, z: a * z)
    # a pattern table has k columns of 2**k rows; the chunk count follows their total
    cells = F.sum(F.when(F.col("k") <= PATTERN_FEATURES, F.col("k") * F.pow(F.lit(2.0), F.col("k"))).otherwise(F.col("k")) + 8)
    base, total = leaves.agg(F.coalesce(F.sum(F.col("value") * share), F.lit(0.0)), F.coalesce(cells, F.lit(0.0))).first()
    n_chunks = max(1, -(-int(total) // CHUNK_CELLS))
    return Ensemble(leaves.withColumn("chunk", F.pmod(F.xxhash64("leaf"), F.lit(n_chunks))), float(base), n_features, n_chunks)


def _extend(w: list[np.ndarray], z: float | np.ndarray, o: np.ndarray) -> list[np.ndarray]:
    n = len(w)
    new = [x.copy() for x in w] + [np.zeros_like(o, dtype=float) if n else np.ones_like(o, dtype=float)]
    for i in range(n - 1, -1, -1):
        new[i + 1] = new[i + 1] + o * new[i] * (i + 1) / (n + 1)
        new[i] = z * new[i] * (n - i) / (n + 1)
    return new


def _unwound_sum(w: list[np.ndarray], z: float | np.ndarray, o: np.ndarray) -> np.ndarray:
    """Sum of the path weights with element (z, o) removed (vectorised over rows)."""
    ln = len(w) - 1
    nxt = w[ln].copy()
    total = np.zeros_like(nxt)
    with np.errstate(divide="ignore", invalid="ignore"):
        for j in range(ln - 1, -1, -1):
            one = nxt * (ln + 1) / ((j + 1) * np.where(o != 0, o, 1.0))
            zero = np.where(z != 0, w[j] * (ln + 1) / (np.where(z != 0, z, 1.0) * (ln - j)), 0.0)
            tmp = np.where(o != 0, one, zero)
            total = total + tmp
            nxt = np.where(o != 0, w[j] - tmp * z * (ln - j) / (ln + 1), nxt)
    return total


def leaf_values(value: np.ndarray, z: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """Attributions of leaves of k features under pass (1) / fail (0) marks: (rows, k) from (rows,), (rows, k), (rows, k)."""
    k = z.shape[1]
    w = _extend([], 1.0, np.ones(len(value)))
    for j in range(k):
        w = _extend(w, z[:, j], passed[:, j])
    # removing a path element depends on its own (z, passed) only, not on its place
    return np.stack([_unwound_sum(w, z[:, j], passed[:, j]) * (passed[:, j] - z[:, j]) * value for j in range(k)], axis=1)


def leaf_groups(rows) -> list[tuple]:
    """Leaves grouped by their number of features: (feats, lo, hi, z, value, pattern table or None), as arrays."""
    by_size: dict[int, list] = {}
    for r in rows:
        if r["k"]:
            by_size.setdefault(r["k"], []).append(r)
    out = []
    for k, group in sorted(by_size.items()):
        feats, lo, hi, z = (np.asarray([r[c] for r in group]) for c in ("feats", "lo", "hi", "z"))
        value = np.asarray([r["value"] for r in group])
        table = None
        if k <= PATTERN_FEATURES:
            patterns = (np.arange(1 << k)[:, None] >> np.arange(k)[None, :] & 1).astype(float)
            n = len(group)
            table = leaf_values(np.repeat(value, 1 << k), np.repeat(z, 1 << k, axis=0), np.tile(patterns, (n, 1))).reshape(n << k, k)
        out.append((feats, lo, hi, z, value, table))
    return out


def add_attributions(phi: np.ndarray, x: np.ndarray, groups: list[tuple], at_once: int = 1 << 20) -> None:
    """Add the attributions of the leaves to ``phi`` (rows x features), some leaves at a time."""
    n, width = x.shape
    row = np.arange(n)[:, None, None] * width
    for feats, lo, hi, z, value, table in groups:
        leaves, k = feats.shape
        step = max(1, at_once // max(1, n * k))
        for i in range(0, leaves, step):
            f = feats[i:i + step]
            cell = x[:, f]
            passed = (cell > lo[i:i + step]) & (cell <= hi[i:i + step])
            if table is not None:
                pattern = (passed << np.arange(k)).sum(axis=2) + (np.arange(i, i + len(f)) << k)
                part = table[pattern]
            else:
                m = len(f)
                part = leaf_values(np.tile(value[i:i + step], n), np.tile(z[i:i + step], (n, 1)), passed.reshape(n * m, k).astype(float)).reshape(n, m, k)
            phi += np.bincount((row + f[None]).ravel(), weights=part.ravel(), minlength=n * width).reshape(n, width)


def attributions(df: DataFrame, ens: Ensemble, slot_cols: list[str], names: list[str], id_col: str = "row_id",
                 long: bool = True, only: list[str] | None = None) -> DataFrame:
    """Per row and feature ``(row_id, feature, value, phi)`` (long) or one
    ``phi`` array per row (wide). ``slot_cols`` are the assembled model inputs
    in vector order; with ``only`` the leaves of other features alone are not read
    and just the features of those names are returned."""
    import sys

    from pyspark import cloudpickle
    # ship this module's numeric code by value: executors need no install of the package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark = df.sparkSession
    nm, base = list(names), ens.base
    wanted = [i for i, n in enumerate(nm) if only is None or n in only]
    leaves = ens.leaves if only is None else ens.leaves.where(F.arrays_overlap("feats", F.array(*[F.lit(i) for i in wanted])))
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, x array<double>, phi array<double>"

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[slot_cols].to_numpy(dtype=float)
            yield pd.DataFrame({id_col: pdf[id_col], "x": list(x), "phi": list(np.zeros_like(x))})

    out = df.select(id_col, *slot_cols).mapInPandas(start, schema)
    for chunk in range(ens.n_chunks):
        rows = leaves.where(F.col("chunk") == chunk).drop("chunk").collect()        # CHUNK_CELLS numbers with their patterns
        shared = spark.sparkContext.broadcast(leaf_groups(rows))

        def add(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    x, phi = np.stack(pdf["x"]), np.stack(pdf["phi"])
                    add_attributions(phi, x, shared.value)
                    yield pd.DataFrame({id_col: pdf[id_col], "x": list(x), "phi": list(phi)})

        out = out.mapInPandas(add, schema)
        if ens.n_chunks > 1:
            out = durable(out)          # the next chunk replaces this one
            shared.unpersist()
    if not long:
        return out.select(id_col, F.array(*[F.col("phi")[i] for i in wanted]).alias("phi"), F.lit(base).alias("base"))
    cells = F.array(*[F.struct(F.lit(nm[i]).alias("feature"), F.col("x")[i].alias("value"), F.col("phi")[i].alias("phi")) for i in wanted])
    return out.select(id_col, F.explode(cells).alias("c")).select(id_col, "c.feature", "c.value", "c.phi")


def summary(attr: DataFrame) -> DataFrame:
    """Mean |phi| per feature over the explained rows, highest first."""
    return attr.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"),
                                       F.count(F.lit(1)).alias("n_rows")) \
        .orderBy(F.col("mean_abs_phi").desc(), F.col("feature"))


def top_contributions(attr: DataFrame, k: int = 20, id_col: str = "row_id") -> DataFrame:
    """The ``k`` largest |phi| per explained row (window per row: at most
    one row's features in a window partition)."""
    w = Window.partitionBy(id_col).orderBy(F.abs("phi").desc(), F.col("feature"))
    return attr.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def dependence_pairs(attr: DataFrame, features: list[str]) -> DataFrame:
    """(value, phi) pairs for the given (top-gain) features."""
    return attr.where(F.col("feature").isin(*features)).select("feature", "value", "phi")

"""Exact top-k inner products over norm-sorted vectors.

Vectors (whole numbers) are sorted by descending length over the whole table (by
classes of an eighth of a power of two, inside a class by their first rotated
coordinate) and cut into chunks of that order. Vectors are rotated by the leading
eigenvectors of the table's second moments (the right singular vectors of the
vector matrix), which puts most of an inner product into the first few coordinates:
the partial sum over those plus the product of the residual lengths bounds the whole
product (Cauchy-Schwarz). Each group of chunks is summed up by its longest length,
the range of its first rotated coordinates and its longest residual, which bounds
its products with any query before a vector is copied:

1. a query first meets the chunk of the highest bound, which gives its threshold;
2. it then goes only to chunks whose bound reaches the threshold, and a chunk only
   to the blocks of queries that ask for it. Queries are put into blocks by their
   first chunk, so that those of a block ask for much the same chunks;
3. where block and chunk meet, vectors are passed by descending length, and those
   whose bound lies below a query's threshold are passed over; all others are scored
   in whole numbers.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows without an id, take no part; vectors of different lengths
don't meet; every row is a candidate, also under a repeated id, for all queries of
another id, and the queries of one id share one list (equal rows are searched once and
counted as often as they stand there); equal scores rank by smaller id; with fewer
than k candidates all are returned. Extra columns are not
read. Scores beyond the range of a long are held at its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, ordered

#: Vectors of a chunk, queries of a block, vectors scored at once.
CHUNK, QUERIES, STEP = 4096, 1024, 512
#: Numbers of a chunk at most (wide vectors get chunks of fewer rows).
CHUNK_NUMBERS = 1 << 23
#: Share of the coordinates in the partial sum.
HEAD = 0.25
#: Numbers of all rotations together; wider vectors get fewer directions, at least one for each vector length.
ROTATION_NUMBERS = 1 << 22
#: Rotated coordinates in a chunk's bound, and groups of chunks that have one.
BOX, GROUPS = 16, 1 << 15
#: Queries bounded at once.
SLICE = 64
#: Rounds of the power iteration.
POWER_ROUNDS = 2
EXACT = 1 << 53


def whole_numbers(vector: str, scale: float) -> Column:
    """floor(scale * x) of every component, x in double precision; null where the vector takes no part."""
    v = F.col(vector).cast("array<double>")
    fine = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))
    return F.when(fine, F.transform(v, lambda x: F.floor(x * scale)))


def _matrix(values: pa.Array) -> np.ndarray:
    ends = values.offsets.to_numpy()
    return values.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].reshape(len(values), -1)


def _sums(vectors: DataFrame, right: dict[int, np.ndarray | None]) -> dict[int, np.ndarray]:
    """Per vector length the sum of x (x' R) over all vectors x, R being its matrix in ``right`` (None: the identity).

    Sums of the matrices' size are gathered, never vectors.
    """
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                x = _matrix(batch.column(0).take(pa.array(np.flatnonzero(dims == d)))).astype(np.float64)
                sums[d] = sums.get(d, 0) + x.T @ (x if right[d] is None else x @ right[d])
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, d, np.int32)), pa.array(np.arange(m.size, dtype=np.int32)), pa.array(m.ravel())],
                                             names=["dims", "at", "total"])

    totals = vectors.select("v").mapInArrow(moments, "dims int, at int, total double").groupBy("dims", "at").agg(F.sum("total").alias("total")).toArrow()
    dims, at, total = (totals[n].to_numpy() for n in ("dims", "at", "total"))
    out = {d: np.zeros((d, d if r is None else r.shape[1])) for d, r in right.items()}
    for d, m in out.items():
        m.ravel()[at[dims == d]] = total[dims == d]
    return out


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length an orthonormal basis (a column each) of the directions with the largest share of the squares.

    From the second moments where these are at most ``ROTATION_NUMBERS`` numbers, else by block power
    iteration from fixed random directions, whose sums are that small at every width. Any orthonormal
    basis gives right bounds; the better it fits, the more is passed over.
    """
    sizes = [r.dims for r in vectors.select(F.size("v").alias("dims")).distinct().collect()]     # as many numbers as there are vector lengths
    share = ROTATION_NUMBERS // max(1, len(sizes))
    wide = {d: max(1, min(int(d * HEAD), share // d)) for d in sizes}
    if all(d * d <= share for d in sizes):
        return {d: np.linalg.eigh(m)[1][:, ::-1][:, :wide[d]].copy() if np.isfinite(m).all() else np.eye(d)[:, :wide[d]]
                for d, m in _sums(vectors, dict.fromkeys(sizes)).items()}
    basis = {d: np.linalg.qr(np.random.default_rng(d).standard_normal((d, h)))[0] for d, h in wide.items()}
    for _ in range(POWER_ROUNDS):
        for d, m in _sums(vectors, basis).items():
            if np.isfinite(m).all():
                basis[d] = np.linalg.qr(m)[0]
    return basis


def _rotated(x: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in ``basis`` and the length of what lies outside of it."""
    head = x @ basis
    return head, np.linalg.norm(x - head @ basis.T, axis=1)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact."""
    if q.size and c.size and float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    big = q.astype(object) @ c.astype(object).T
    return np.clip(big, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best of the listed candidates (higher score first, then smaller id)."""
    order = np.lexsort((ids, ~scores, query))
    q = query[order]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0)) if len(q) else np.zeros(0, int)
    return order[np.arange(len(q)) - start < k]


def search(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int, rotation: np.ndarray):
    """(place of query, place of vector, score) of each query's k best among the vectors, none below its floor."""
    order = np.argsort(-np.einsum("ij,ij->i", c.astype(np.float64), c.astype(np.float64)), kind="stable")
    ids, c = ids[order], c[order]
    rq, rc = q.astype(np.float64), c.astype(np.float64)
    q_long, c_long = np.linalg.norm(rq, axis=1), np.linalg.norm(rc, axis=1)
    (rq, q_rest), (rc, c_rest) = _rotated(rq, rotation), _rotated(rc, rotation)
    least = floor.astype(np.float64)
    found = [(np.zeros(0, np.int64),) * 3]
    for i in range(0, len(ids), STEP):
        part = slice(i, i + STEP)
        slack = 1e-9 * (1.0 + q_long * c_long[i])               # rounding of the rotated sums
        live = np.flatnonzero(q_long * c_long[i] + slack >= least)
        if not len(live):
            break                                               # no later vector is longer
        bound = rq[live] @ rc[part].T + np.outer(q_rest[live], c_rest[part]) + slack[live, None]
        open_ = bound >= least[live, None]
        rows, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if not len(rows):
            continue
        score = products(q[live[rows]], c[part][cols])
        keep = open_[np.ix_(rows, cols)] & (score >= least[live[rows], None]) & (q_ids[live[rows], None] != ids[part][cols][None, :])
        r, s = np.nonzero(keep)
        found.append((live[rows][r], i + cols[s], score[r, s]))
        query, name, value = (np.concatenate(x) for x in zip(*found, strict=True))
        top = best(query, ids[name], value, k)
        query, name, value = query[top], name[top], value[top]
        found = [(query, name, value)]
        held = np.bincount(query, minlength=len(q_ids))
        last = np.full(len(q_ids), np.inf)
        np.minimum.at(last, query, value.astype(np.float64))
        least = np.where(held >= k, np.maximum(least, np.nextafter(last, -np.inf)), least)
    return found[0][0], order[found[0][1]], found[0][2]


FOUND = "query_id long, vec_id long, score long, times long"


def _meet(k: int, rotation: dict[int, np.ndarray]):
    def meet(asked: pa.Table, given: pa.Table) -> pa.Table:
        out: list = [[], [], [], []]
        if len(asked) and len(given):
            qv, cv = asked["q"].combine_chunks(), given["v"].combine_chunks()
            q_dims, c_dims = (x.value_lengths().to_numpy(zero_copy_only=False) for x in (qv, cv))
            q_ids, ids = asked["query_id"].to_numpy(), given["vec_id"].to_numpy()
            floor = asked["floor"].to_numpy(zero_copy_only=False)
            q_n, n = asked["q_n"].to_numpy(), given["n"].to_numpy()
            for d in np.intersect1d(q_dims, c_dims):
                a, b = np.flatnonzero(q_dims == d), np.flatnonzero(c_dims == d)
                found = search(q_ids[a], _matrix(qv.take(pa.array(a))), floor[a], ids[b], _matrix(cv.take(pa.array(b))), k, rotation[int(d)])
                asker, hit = a[found[0]], b[found[1]]
                for o, x in zip(out, (q_ids[asker], ids[hit], found[2], q_n[asker] * n[hit]), strict=True):
                    o.append(x)
        return pa.table({n: np.concatenate(o) if o else np.zeros(0, np.int64) for n, o in zip(("query_id", "vec_id", "score", "times"), out, strict=True)})

    return meet


def outlines(rotation: dict[int, np.ndarray]):
    """Column function: length, first ``BOX`` rotated coordinates (zero beyond the basis) and residual of a vector."""
    @F.arrow_udf("array<double>")
    def outline(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in vectors:
            dims = column.value_lengths().to_numpy(zero_copy_only=False)
            out = np.zeros((len(column), BOX + 2))
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = _matrix(column.take(pa.array(at))).astype(np.float64)
                head, rest = _rotated(x, rotation[d][:, :BOX])
                out[at, 0], out[at, -1] = np.linalg.norm(x, axis=1), rest
                out[at, 1:1 + head.shape[1]] = head
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, BOX + 2, dtype=np.int32)), pa.array(out.ravel()))

    return outline


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Upper bounds of the products of queries (outlines) with any vector of groups of outlines between ``low`` and ``high``."""
    box, longest = queries[:, 1:-1], queries[:, :1] * high[:, 0]
    inside = np.maximum(box, 0) @ high[:, 1:-1].T + np.minimum(box, 0) @ low[:, 1:-1].T + queries[:, -1:] * high[:, -1]
    return np.minimum(longest, inside) + 1e-9 * (1.0 + longest)


def _numbered(df: DataFrame, *cols) -> tuple[DataFrame, int]:
    """The frame with ``pos``, its rows' places in the order of ``cols``, and the number of rows."""
    done = ordered(df, *cols)
    held = sorted((r["_part"], r["count"]) for r in done.groupBy("_part").count().collect())     # as many numbers as partitions
    starts, total = [], 0
    for part, n in held:
        starts += [F.lit(part), F.lit(total)]
        total += n
    before = F.create_map(*starts) if starts else F.create_map(F.lit(0), F.lit(0))
    return done.withColumn("pos", (before[F.col("_part")] + F.col("_place")).cast("long")).drop("_part", "_place"), total


def choice_of(groups: pa.Table, name: str, pick):
    """Column function of (dims, outline, floor): the ``name`` of those groups that ``pick`` takes for a query.

    ``groups`` has a row per group of chunks (and vector length): ``GROUPS`` at most, so tasks may hold them.
    """
    of_dims, names = groups["dims"].to_numpy(), groups[name].to_numpy()
    low, high = (np.array(groups[n].to_pylist(), dtype=np.float64).reshape(-1, BOX + 2) for n in ("low", "high"))

    @F.arrow_udf("array<long>")
    def choose(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for dims, outline, floor in columns:
            for start in range(0, len(dims), SLICE):
                d, least = (x.slice(start, SLICE).to_numpy(zero_copy_only=False) for x in (dims, floor))
                out: list = [None] * len(d)
                box = _matrix(outline.slice(start, SLICE))
                for one in np.unique(d):
                    here = np.flatnonzero(of_dims == one)
                    at = np.flatnonzero(d == one)
                    for i, taken in zip(at, pick(bounds(box[at], low[here], high[here]), least[at]), strict=True):
                        out[i] = names[here][taken]
                yield pa.array(out, pa.list_(pa.int64()))

    return choose


def likeliest(bound: np.ndarray, floor: np.ndarray) -> list[np.ndarray]:
    return list(bound.argmax(axis=1)[:, None])


def reaching(bound: np.ndarray, floor: np.ndarray) -> list[np.ndarray]:
    return [np.flatnonzero(row) for row in bound >= floor[:, None]]


def meetings(rows: DataFrame, queries: Column, k: int):
    """(asked, given, meet): queries by (block, chunk) and vectors by (for_block, for_chunk), for those pairs that can hold a query's k best.

    ``rows`` is a written table (vec_id, v, n); ``meet`` searches one such pair.
    """
    rotation = rotations(rows)
    size = max(1, min(CHUNK, CHUNK_NUMBERS // max(rotation, default=1)))
    outlined = rows.withColumn("outline", outlines(rotation)("v")).withColumn("dims", F.size("v"))
    band = F.coalesce(F.floor(F.log2(F.col("outline")[0]) * 8), F.lit(-1))
    vectors, total = _numbered(outlined.withColumn("band", band).withColumn("lead", F.col("outline")[1]), "dims", F.desc("band"), "lead", "vec_id")
    together = max(1, -(-total // (size * GROUPS)))              # chunks of a group
    vectors = vectors.withColumn("chunk", F.floor(F.col("pos") / size)).withColumn("group", F.floor(F.col("chunk") / together))
    at = [F.col("outline")[i] for i in range(BOX + 2)]
    groups = vectors.groupBy("dims", "group").agg(F.min("chunk").alias("start"), F.array(*[F.min(a) for a in at]).alias("low"),
                                                  F.array(*[F.max(a) for a in at]).alias("high")).toArrow()
    given = vectors.select("vec_id", "v", "n", "chunk")
    meet = _meet(k, rotation)

    def copied(asked: DataFrame) -> DataFrame:
        """The vectors of every chunk, once for each block that asks for it."""
        pairs = asked.select(F.col("block").alias("for_block"), F.col("chunk").alias("for_chunk")).distinct()
        return given.join(pairs, F.col("chunk") == F.col("for_chunk")).drop("chunk")

    asked = (vectors.where(queries).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("n").alias("q_n"), "dims", "outline")
             .withColumn("floor", F.lit(float("-inf"))).withColumn("chunk", choice_of(groups, "start", likeliest)("dims", "outline", "floor")[0]))
    first, _ = _numbered(asked, "chunk", "query_id")
    first = first.withColumn("block", F.floor(F.col("pos") / QUERIES))
    found = first.groupBy("block", "chunk").cogroup(copied(first).groupBy("for_block", "for_chunk")).applyInArrow(meet, FOUND)
    floors = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("least"))
    asked = durable(first.drop("chunk", "pos").join(floors, "query_id", "left").withColumn("floor", F.coalesce("least", "floor")).drop("least"))
    asked = (asked.withColumn("group", F.explode(choice_of(groups, "group", reaching)("dims", "outline", "floor")))
             .withColumn("chunk", F.explode(F.sequence(F.col("group") * together, F.col("group") * together + (together - 1))))
             .select("query_id", "q", "q_n", "floor", "block", "chunk"))
    return asked, copied(asked), meet


def top_k(df: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``df`` where ``queries`` (a condition on vec_id) holds."""
    rows = durable(df.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(embedding, scale).alias("v"))
                   .where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id", "v").agg(F.count("*").alias("n")))
    asked, given, meet = meetings(rows, queries, k)
    found = asked.groupBy("block", "chunk").cogroup(given.groupBy("for_block", "for_chunk")).applyInArrow(meet, FOUND)
    found = found.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k).cast("long")))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

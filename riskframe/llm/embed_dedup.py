"""Embedding near-dedup by sorted projection passes.

Every pass draws its own random hyperplanes; a vector's signs beside them,
concatenated, order the vectors lexicographically, so that vectors at a small
angle tend to share a long prefix. Each vector is compared with its neighbours
in a bounded window of that order, pairs are verified by cosine in double
precision, and the verified pairs of all passes are united. The number of passes
follows from the number of vectors, the window and the wanted recall of a pair
just at the threshold, as if every sign halved the vectors. Whether that held is
measured: how many signs a vector shares with the ends of its window tells how
likely a partner at the threshold lies inside. Vectors whose passes together fall
short of the recall (those in dense regions) get further passes or, where that is
cheaper, are compared with every vector that the triangle inequality leaves, tile
by tile; those within half the threshold angle of a common vector link with it
and not with each other.

The windows only have to join what hangs together: the links of each vector are
then counted exactly within its component. Members within half the threshold
angle of the component's first vector all link with each other and are counted
by weight; only the others are compared, tile by tile, so a large group of near
copies is never written out as pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, link with nothing; vectors of different
lengths don't link; equal vectors are one class with as many members as rows
(each row is a vector of its own, also under a repeated id). Extra columns are
not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable
from .components import components

#: Bits of a pass's signature.
SIGN_BITS = 64
#: Rows compared at once while a pass is read.
STEP = 512
#: Rows of a side of a counting tile, and of a tile of vectors in dense regions.
TILE, DENSE_TILE = 1024, 4096
#: Vectors in dense regions that are looked at for leaders, and the most leaders.
LOOK, LEADERS = 1024, 64


def matrix(values: pa.Array) -> np.ndarray:
    """Unit rows, in double precision, of a list array whose vectors all have one length."""
    ends = values.offsets.to_numpy()
    flat = values.values.to_numpy(zero_copy_only=False).astype(np.float64)[ends[0]:ends[-1]].reshape(len(values), -1)
    with np.errstate(over="ignore"):
        long = np.linalg.norm(flat, axis=1, keepdims=True)
    far = ~((long[:, 0] > 1e-100) & (long[:, 0] < 1e100))       # squares that overflow or vanish: by the largest component first
    if far.any():
        flat[far] /= np.abs(flat[far]).max(axis=1, keepdims=True)
        long[far] = np.linalg.norm(flat[far], axis=1, keepdims=True)
    return flat / long


def usable(vector: str) -> Column:
    """Whether a vector can link at all."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0.0), F.lit(False))


def passes_for(count: int, threshold: float, window: int, recall: float) -> int:
    """Passes so that a pair at the threshold shares a window with probability ``recall`` at least."""
    bits = max(0.0, math.log2(max(1, count) / window))
    found = (1.0 - math.acos(threshold) / math.pi) ** bits
    return 1 if found >= recall else math.ceil(math.log(1.0 - recall) / math.log(1.0 - found))


def _planes(number: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dims]).standard_normal((dims, SIGN_BITS))


def signatures(vector, passes: int, seed: int, first: int = 0):
    """Column of one sortable signature per pass, from pass ``first`` on."""
    @F.arrow_udf("array<binary>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        planes: dict = {}
        for values in batches:
            out: list = [None] * len(values)
            dims = values.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                x = matrix(values.take(pa.array(rows)))
                for number in range(first, first + passes):
                    if (number, d) not in planes:
                        planes[number, d] = _planes(number, int(d), seed)
                    bits = np.packbits(x @ planes[number, d] > 0, axis=1)
                    for r, b in zip(rows, bits, strict=True):
                        out[r] = (out[r] or []) + [b.tobytes()]
            yield pa.array(out, pa.list_(pa.binary()))

    return sign(vector)


def _stars(ids: np.ndarray, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs as links of each row to the first row reachable among them."""
    lead = np.arange(len(ids))
    while True:
        least = np.minimum(lead[rows], lead[others])
        new = lead.copy()
        np.minimum.at(new, rows, least)
        np.minimum.at(new, others, least)
        new = new[new]
        if (new == lead).all():
            break
        lead = new
    far = np.flatnonzero(lead != np.arange(len(ids)))
    return ids[far], ids[lead[far]]


def _verified(group: np.ndarray, ids: np.ndarray, x: np.ndarray, new: int, threshold: float):
    """Star links among rows of one pass; the last ``new`` rows are compared with all rows."""
    at = len(ids) - new
    near = (x[at:].astype(np.float32) @ x.astype(np.float32).T) >= threshold - 1e-4
    near &= group[at:, None] == group[None, :]
    rows, others = np.nonzero(near)
    keep = others < rows + at
    rows, others = rows[keep] + at, others[keep]
    sure = np.einsum("ij,ij->i", x[rows], x[others]) >= threshold
    return _stars(ids, rows[sure], others[sure])


def shared_signs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading signs that signatures have in common."""
    x = a ^ b
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 - np.frexp(high)[1], SIGN_BITS - np.frexp(low)[1])


class Sight:
    """How likely a partner at the threshold lies inside a row's window, for the rows of a part in order.

    A partner leaves the row's order at its first other sign, to the side that sign tells; it lies inside if it
    shares more signs than the row at the window's end on that side. At a part's border the side in sight stands
    for both.
    """

    def __init__(self, window: int, threshold: float, open_left: bool):
        self.window, self.key, self.open_left = window, None, open_left
        agree = 1.0 - math.acos(threshold) / math.pi
        self.weights, self.tail = (1.0 - agree) * agree ** np.arange(SIGN_BITS), agree ** SIGN_BITS
        self.ids, self.signs, self.done = np.zeros(0, np.int64), np.zeros(0, np.uint64), 0

    def add(self, key: int, ids: np.ndarray, signs: np.ndarray):
        """(ids, logarithms of the chance to miss) of the rows whose windows are complete now."""
        out = []
        if key != self.key:
            if self.key is not None:
                out.append(self.close(False))
                self.open_left = False
            self.key, self.ids, self.signs, self.done = key, ids[:0], signs[:0], 0
        self.ids, self.signs = np.concatenate([self.ids, ids]), np.concatenate([self.signs, signs])
        out.append(self._settle(max(self.done, len(self.ids) - self.window), False))
        drop = max(0, self.done - self.window)
        self.ids, self.signs, self.done = self.ids[drop:], self.signs[drop:], self.done - drop
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def close(self, open_right: bool = True):
        return self._settle(len(self.ids), open_right)

    def _settle(self, to: int, open_right: bool):
        at = np.arange(self.done, to)
        self.done = to
        signs, n = self.signs[at], len(self.ids)
        before, after = at - self.window, at + self.window
        left, right = (shared_signs(signs, self.signs[np.clip(e, 0, n - 1)]) if len(at) else np.zeros(0, int) for e in (before, after))
        no_left, no_right = before < 0, after >= n
        left_, right_ = (np.where(gone, -1, d) for gone, d in ((no_left, left), (no_right, right)))
        if self.open_left:
            left_ = np.where(no_left, np.where(no_right, left, right), left_)
        if open_right:
            right_ = np.where(no_right, np.where(no_left, right, left), right_)
        bits = np.unpackbits(signs.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        inside = (np.arange(SIGN_BITS) > np.where(bits, left_[:, None], right_[:, None])) @ self.weights
        inside += self.tail * ((left_ < SIGN_BITS) & (right_ < SIGN_BITS))
        return self.ids[at], np.log1p(-np.minimum(inside, 1.0 - 1e-12))


PASS_ROWS = "part int, place long, links long, u long, v long, pass int, vec_id long, vec array<double>, miss double"


def window_links(classes: DataFrame, count: int, threshold: float, window: int, passes: int, seed: int,
                 begin: int = 0) -> tuple[DataFrame, DataFrame]:
    """(u, v): verified links, of every class with what its windows reach, over ``passes`` passes from ``begin`` on;
    and (vec_id, miss): the logarithm of the chance that a pass misses a partner at the threshold."""
    signed = classes.select("vec_id", F.col("vec").cast("array<double>").alias("vec"),
                            F.posexplode(signatures(F.col("vec").cast("array<double>"), passes, seed, begin)).alias("pass", "sign"))
    parts = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, count * passes // (4 * window)))
    order = ["pass", F.size("vec"), "sign", "vec_id"]
    rows = signed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("pass", "vec_id", "vec", "sign")

    def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        held: list = []                       # (group, ids, x) of the last rows
        sight = Sight(window, threshold, part > 0)

        def chances(ids, miss):
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.array([2] * n, pa.int64()), pa.array(ids, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.float64())), pa.array(miss, pa.float64())], schema=_schema())

        def border(places, group, ids, x):
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(places, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.array(group >> 16, pa.int32()), pa.array(ids, pa.int64()),
                 pa.array(list(x), pa.list_(pa.float64())), pa.nulls(n, pa.float64())], schema=_schema())

        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            numbers = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(lengths) != 0) | (np.diff(numbers) != 0)) + 1), len(lengths)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for i in range(a, b, STEP):
                    n = min(STEP, b - i)
                    some = batch.slice(i, n)
                    group = (some.column(0).to_numpy().astype(np.int64) << 16) + lengths[i]
                    ids, x = some.column(1).to_numpy(), matrix(some.column(2))
                    if count > window:
                        yield chances(*sight.add(int(group[0]), ids, _signs(some.column(3))))
                    if place < window:
                        k = min(n, window - place)
                        yield border(np.arange(place, place + k), group[:k], ids[:k], x[:k])
                    if held and held[2].shape[1] == x.shape[1]:
                        u, v = _verified(np.concatenate([held[0], group]), np.concatenate([held[1], ids]), np.concatenate([held[2], x]), n, threshold)
                        held = [np.concatenate([h, new])[-window:] for h, new in zip(held, (group, ids, x), strict=True)]
                    else:
                        u, v = _verified(group, ids, x, n, threshold)
                        held = [y[-window:] for y in (group, ids, x)]
                    place += n
                    if len(u):
                        m = len(u)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part] * m, pa.int32()), pa.nulls(m, pa.int64()), pa.array([1] * m, pa.int64()), pa.array(u, pa.int64()),
                             pa.array(v, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.float64())), pa.nulls(m, pa.float64())], schema=_schema())
        if place:
            if count > window:
                yield chances(*sight.close())
            first = max(place - len(held[1]), window)          # the first rows are out already
            k = place - first
            if k > 0:
                yield border(np.arange(first, place), *(h[-k:] for h in held))
            # `place` of this row: how many rows the part has
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([0], pa.int64()), *(pa.nulls(1, t) for t in
                 (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()))], schema=_schema())

    made = durable(rows.mapInArrow(one_pass, PASS_ROWS))
    inside = made.where("links = 1").select("u", "v")
    # rows of each part: as many numbers as partitions
    held = sorted((r.part, r.place) for r in made.where("links = 0").select("part", "place").collect())
    starts = np.cumsum([0, *(n for _, n in held)])
    first = {p: int(s) for (p, _), s in zip(held, starts, strict=False)}
    borders = np.asarray(starts[1:-1], dtype=np.int64)

    @F.arrow_udf("array<int>")
    def beside(part: pa.Array, place: pa.Array) -> pa.Array:
        rank = np.asarray([first[p] for p in part.to_pylist()]) + place.to_numpy()
        return pa.array([list(range(a, b)) for a, b in zip(np.searchsorted(borders, rank - window, "right"), np.searchsorted(borders, rank + window, "right"), strict=True)], pa.list_(pa.int32()))

    def across(group: pa.Table) -> pa.Table:
        passes_, ids = group["pass"].to_numpy(), group["vec_id"].to_numpy()
        us, vs = [], []
        lengths = group["vec"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(lengths):
            rows = np.flatnonzero(lengths == d)
            u, v = _verified(passes_[rows], ids[rows], matrix(group["vec"].combine_chunks().take(pa.array(rows))), len(rows), threshold)
            us.append(u)
            vs.append(v)
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs)}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    over = (made.where("links IS NULL").select("pass", "vec_id", "vec", F.explode(beside("part", "place")).alias("border"))
            .groupBy("border").applyInArrow(across, "u long, v long"))
    return inside.unionByName(over), made.where("links = 2").select(F.col("u").alias("vec_id"), "miss")


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64)


def dense_links(classes: DataFrame, dense: DataFrame, threshold: float) -> tuple[float, DataFrame]:
    """All links of the classes whose vec_id is in ``dense``, exactly: the pairs to compare, and (u, v).

    Dense vectors near a leader go by its ball, and meet what lies within the threshold angle of the ball; the others
    (room -1) meet everything. Within half the threshold angle of a leader all vectors link (core): two of them are
    never compared.
    """
    theta = math.acos(min(1.0, threshold))
    some = [np.asarray(r.vec, np.float64) for r in dense.orderBy(F.xxhash64("vec_id"), "vec_id").limit(LOOK).collect()]
    leaders: dict[int, np.ndarray] = {}
    for x in some:
        x, held = x / np.linalg.norm(x), leaders.get(len(x), np.zeros((0, len(x))))
        if sum(map(len, leaders.values())) < LEADERS and (not len(held) or (held @ x).max() < math.cos(min(math.pi / 2, 1.5 * theta))):
            leaders[len(x)] = np.vstack([held, x])
    place = {d: sum(len(y) for e, y in leaders.items() if e < d) for d in leaders}

    def angles(values: pa.Array):
        dims = values.value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            rows = np.flatnonzero(dims == d)
            if d in leaders:
                for i in range(0, len(rows), STEP):
                    yield rows[i:i + STEP], place[d], np.arccos(np.clip(matrix(values.take(pa.array(rows[i:i + STEP]))) @ leaders[d].T, -1.0, 1.0))

    @F.arrow_udf("struct<leader: int, angle: double>")
    def nearest(values: pa.Array) -> pa.Array:
        leader, angle = np.full(len(values), -1, np.int32), np.zeros(len(values))
        for rows, at, a in angles(values):
            best = a.argmin(axis=1)
            near = a[np.arange(len(rows)), best] <= 2 * theta
            leader[rows[near]], angle[rows[near]] = best[near] + at, a[np.arange(len(rows)), best][near]
        return pa.StructArray.from_arrays([pa.array(leader), pa.array(angle)], names=["leader", "angle"])

    vec = F.col("vec").cast("array<double>")
    asks = durable(dense.select("vec_id", "vec", F.size("vec").alias("dims"), nearest(vec).alias("a")).select(
        "vec_id", "vec", "dims", F.col("a.leader").alias("leader"), F.col("a.angle").alias("angle"))
        .withColumn("core", (F.col("leader") >= 0) & (F.col("angle") < theta / 2 - 1e-6)))
    radius = {r.leader: r.r for r in asks.where("leader >= 0").groupBy("leader").agg(F.max("angle").alias("r")).collect()}     # LEADERS rows at most

    @F.arrow_udf("array<struct<leader: int, core: boolean>>")
    def reached(values: pa.Array) -> pa.Array:
        out = [[{"leader": -1, "core": False}] for _ in range(len(values))]
        for rows, at, a in angles(values):
            reach = np.asarray([radius.get(at + i, -1.0) + theta + 1e-6 if at + i in radius else -1.0 for i in range(a.shape[1])])
            for r, g in zip(*np.nonzero(a <= reach), strict=True):
                out[rows[r]].append({"leader": int(at + g), "core": bool(a[r, g] < theta / 2 - 1e-6)})
        return pa.array(out, pa.list_(pa.struct([("leader", pa.int32()), ("core", pa.bool_())])))

    given = (classes.select("vec_id", F.size("vec").alias("dims"), F.explode(reached(vec)).alias("g"))
             .select("vec_id", "dims", F.col("g.leader").alias("leader"), F.col("g.core").alias("core")))
    given = durable(given.join(asks.select("dims", "leader").distinct(), ["dims", "leader"], "left_semi"))
    room = ["dims", "leader", "core"]
    there = given.groupBy(*room).agg(F.count("*").alias("given_n")).withColumnRenamed("core", "given_core")
    meets = durable(asks.groupBy(*room).agg(F.count("*").alias("asks_n")).join(there, ["dims", "leader"]).where("NOT (core AND given_core)"))
    pairs = meets.agg(F.sum(F.col("asks_n").cast("double") * F.col("given_n"))).first()[0] or 0.0

    # the core in stars around its member of least id
    cores = given.where("core")
    stars = (cores.join(cores.groupBy("leader").agg(F.min("vec_id").alias("v")), "leader").select(F.col("vec_id").alias("u"), "v"))
    chunks = lambda n: F.ceil(F.col(n) / DENSE_TILE)                                                 # noqa: E731
    chunk = lambda n: F.pmod(F.xxhash64("vec_id"), chunks(n))                                        # noqa: E731
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), chunks(n) - 1))                    # noqa: E731
    left = asks.join(meets, room).select(*room, "given_core", chunk("asks_n").alias("i"), every("given_n").alias("j"), "vec_id", "vec", F.lit(True).alias("asks"))
    right = (given.withColumnRenamed("core", "given_core").join(meets, ["dims", "leader", "given_core"]).join(classes.select("vec_id", "vec"), "vec_id")
             .select(*room, "given_core", every("asks_n").alias("i"), chunk("given_n").alias("j"), "vec_id", "vec", F.lit(False).alias("asks")))

    def tile(group: pa.Table) -> pa.Table:
        asks, ids, x = group["asks"].to_numpy(), group["vec_id"].to_numpy(), matrix(group["vec"].combine_chunks())
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        low = x[b].astype(np.float32).T
        out = [(np.zeros(0, np.int64),) * 2]
        names, where = np.unique(ids, return_inverse=True)
        for i in range(0, len(a), STEP):
            rows, others = np.nonzero(x[a[i:i + STEP]].astype(np.float32) @ low >= threshold - 1e-4)
            for k in range(0, len(rows), 1 << 18):
                r, o = a[i + rows[k:k + (1 << 18)]], b[others[k:k + (1 << 18)]]
                sure = np.einsum("ij,ij->i", x[r], x[o]) >= threshold
                out.append(_stars(names, where[r[sure]], where[o[sure]]))
        u, v = (np.concatenate(y) for y in zip(*out, strict=True))
        place = {d: i for i, d in enumerate(names.tolist())}
        u, v = _stars(names, *(np.asarray([place[y] for y in z.tolist()], np.int64) for z in (u, v)))
        return pa.table({"u": u, "v": v}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    found = left.unionByName(right).groupBy(*room, "given_core", "i", "j").applyInArrow(tile, "u long, v long")
    return pairs, found.unionByName(stars)


def all_links(classes: DataFrame, threshold: float, window: int, recall: float, seed: int) -> DataFrame:
    """(u, v): links that join what hangs together, each class's partners found with ``recall`` at least."""
    count = classes.count()
    passes = passes_for(count, threshold, window, recall)
    wanted, rounds, links, misses = math.log(1.0 - recall), 0, [], []
    while True:
        found, miss = window_links(classes, count, threshold, window, passes, seed, rounds * passes)
        rounds += 1
        links.append(found)
        misses.append(miss)
        total = functools.reduce(DataFrame.unionByName, misses).groupBy("vec_id").agg(F.sum("miss").alias("miss"))
        short = durable(total.where(F.col("miss") > wanted))
        worst = short.agg(F.max("miss")).first()[0]
        if worst is None:
            break
        pairs, rest = dense_links(classes, durable(classes.join(short, "vec_id").select("vec_id", "vec")), threshold)
        more = rounds * (wanted / worst - 1.0) if worst < 0 else math.inf
        # the dearer way is not gone: further passes, or every pair that is left
        if pairs <= max(1.0, more) * passes * 2 * window * count:
            links.append(rest)
            break
    return functools.reduce(DataFrame.unionByName, links)


def _schema() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("place", pa.int64()), ("links", pa.int64()), ("u", pa.int64()), ("v", pa.int64()),
                      ("pass", pa.int32()), ("vec_id", pa.int64()), ("vec", pa.list_(pa.float64())), ("miss", pa.float64())])


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(vec_id, n_links) for the classes of ``members`` (component, vec_id, n, vec), exactly, within components."""
    half = math.cos(math.acos(threshold) / 2 - 1e-6) if threshold < 1 else 1.0
    heads = members.where("component = vec_id").groupBy("component").agg(F.min("vec").alias("head"))

    @F.arrow_udf("boolean")
    def close(vec: pa.Array, head: pa.Array) -> pa.Array:
        out = np.zeros(len(vec), dtype=bool)
        dims = vec.value_lengths().to_numpy(zero_copy_only=False)
        same = head.value_lengths().to_numpy(zero_copy_only=False) == dims
        for d in np.unique(dims[same]):
            rows = pa.array(np.flatnonzero(same & (dims == d)))
            out[rows.to_numpy()] = np.einsum("ij,ij->i", matrix(vec.take(rows)), matrix(head.take(rows))) >= half
        return pa.array(out)

    placed = durable(members.join(heads, "component").withColumn("core", close("vec", "head")).drop("head"))
    sizes = durable(placed.groupBy("component").agg(
        F.sum(F.when(F.col("core"), F.col("n"))).alias("core_n"), F.ceil(F.count("*") / TILE).alias("all_chunks"),
        F.ceil(F.sum(F.when(F.col("core"), 0).otherwise(1)) / TILE).alias("odd_chunks")))
    filed = placed.join(sizes, "component").withColumn("h", F.xxhash64("vec_id")).withColumn("dims", F.size("vec"))
    base = filed.select("vec_id", F.when(F.col("core"), F.col("core_n") - 1).otherwise(F.col("n") - 1).alias("links"))
    chunk = lambda n: F.pmod("h", F.greatest(F.col(n), F.lit(1)))                                   # noqa: E731
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))                    # noqa: E731
    busy = filed.where("odd_chunks > 0")
    odd = busy.where("NOT core").select("component", chunk("odd_chunks").alias("i"), every("all_chunks").alias("j"), "dims", "vec_id", "n", "core", "vec", F.lit(True).alias("asks"))
    rest = busy.select("component", every("odd_chunks").alias("i"), chunk("all_chunks").alias("j"), "dims", "vec_id", "n", "core", "vec", F.lit(False).alias("asks"))

    def tile(group: pa.Table) -> pa.Table:
        asks, ids, n = group["asks"].to_numpy(), group["vec_id"].to_numpy(), group["n"].to_numpy()
        core, x = group["core"].to_numpy(), matrix(group["vec"].combine_chunks())
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        near = (x[a] @ x[b].T >= threshold) & (ids[a][:, None] != ids[b][None, :])
        own = near @ n[b]
        back = (n[a] @ near) * core[b]
        some = back > 0
        return pa.table({"vec_id": np.concatenate([ids[a], ids[b][some]]), "links": np.concatenate([own, back[some]]).astype(np.int64)})

    found = odd.unionByName(rest).groupBy("component", "dims", "i", "j").applyInArrow(tile, "vec_id long, links long")
    return base.unionByName(found).groupBy("vec_id").agg(F.sum("links").alias("n_links"))


def near_duplicates(df: DataFrame, threshold: float = 0.9, window: int = 256, recall: float = 0.9999, seed: int = 42,
                    vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vec"))
    rows = rows.withColumn("ok", usable("vec") & F.col("vec_id").isNotNull())
    # equal vectors are a class with a key of its own, whatever their ids: an id may stand on different vectors
    classes = durable(rows.where("ok").groupBy("vec").agg(F.min("vec_id").alias("name"), F.count("*").alias("n"))
                      .withColumn("vec_id", F.monotonically_increasing_id()))
    links = all_links(classes, threshold, window, recall, seed)
    found = components(links)
    members = (classes.join(found, F.col("vec_id") == F.col("node"))
               .select("component", "vec_id", "n", F.col("vec").cast("array<double>").alias("vec")))
    counts = durable(link_counts(members, threshold).join(found, F.col("vec_id") == F.col("node")).select("vec_id", "n_links", "component"))
    placed = durable(classes.join(counts, "vec_id", "left").select(
        "vec", "name", F.coalesce("n_links", F.col("n") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component")))
    names = durable(placed.groupBy("component").agg(F.min("name").alias("component_id")))       # both sides are scans: a large component can be split
    named = durable(placed.join(names, "component").select("vec", "n_links", "component_id"))
    good = rows.where("ok").select("vec_id", "vec").join(named, "vec").select("vec_id", "n_links", "component_id")
    bad = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Near-duplicates and exact search against brute force."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskframe.llm import components, embed_dedup, simhash, topk_search

from .conftest import clashing, frame

VEC = "vec_id long, embedding array<float>, label int"


def closure(n, pairs, names):
    """Smallest name reachable, per place."""
    lead = list(range(n))

    def find(i):
        while lead[i] != i:
            lead[i] = lead[lead[i]]
            i = lead[i]
        return i

    for a, b in pairs:
        lead[find(a)] = find(b)
    best = {}
    for i in range(n):
        if names[i] is not None:
            best[find(i)] = min(best.get(find(i), names[i]), names[i])
    return [best.get(find(i)) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, int(k)) for k in range(1000, 1200)] + [tuple(map(int, rng.integers(2000, 2400, 2))) for _ in range(200)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    nodes = sorted({x for p in pairs for x in p if p[0] != p[1]})
    place = {x: i for i, x in enumerate(nodes)}
    want = closure(len(nodes), [(place[a], place[b]) for a, b in pairs if a != b], nodes)
    assert got == dict(zip(nodes, want, strict=True))
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_print(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_texts(spark, odd_docs):
    base = " ".join(f"w{i % 97}q{i}" for i in range(300))
    rows = [*odd_docs, *[(100 + i, base + f" tail{i}", "en", "a", 1) for i in range(40)], (200, "A b C", "en", "a", 1), (201, "a B c", "en", "a", 1)]
    got = simhash.near_duplicates(clashing(frame(spark, rows)).drop("component_id", "fp")).select("doc_id", simhash.hex_of(F.col("fp")).alias("h"), "component_id").collect()
    prints = [brute_print(r[1]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = closure(len(rows), pairs, [r[0] for r in rows])
    key = lambda x: (x[0] is None, x[0] or 0, x[1], -1 if x[2] is None else x[2])        # noqa: E731
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, want, strict=True)), key=key)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("spread", [1, 3, 6])
def test_fingerprint_links(spark, spread):
    """Dense clouds of fingerprints: every class is found although whole groups share keys."""
    rng = np.random.default_rng(spread)
    prints = [0, -1]
    for _ in range(6):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(60):
            x = centre
            for b in rng.choice(64, size=spread, replace=False):
                x ^= 1 << int(b)
            prints.append(x - (1 << 64) if x >> 63 else x)
    prints = sorted(set(prints))
    got = {r.fp: r["class"] for r in simhash.link_classes(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()}
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & ((1 << 64) - 1)).bit_count() <= 4]
    want = closure(len(prints), pairs, prints)
    groups = lambda name: {frozenset(p for p, c in zip(prints, name, strict=True) if c == k) for k in set(name)}     # noqa: E731
    assert groups([got.get(p, p) for p in prints]) == groups(want)


def test_a_large_cloud_and_strangers_in_its_keys(spark, monkeypatch):
    """A cloud of distinct near fingerprints shares keys with strangers: links between components are found in tiles."""
    monkeypatch.setattr(simhash, "TILE", 50)
    rng = np.random.default_rng(12)
    flip = lambda bits: sum(1 << int(b) for b in bits)                       # noqa: E731
    cloud = {flip(b) for n in (1, 2) for b in itertools.combinations(range(40), n)}
    strangers = {flip(rng.choice(30, size=int(n), replace=False)) for n in rng.integers(5, 14, 200)}
    prints = sorted({x - (1 << 64) if x >> 63 else x for x in cloud | strangers})
    x = np.array(prints, dtype=np.int64).view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 4
    want = closure(len(prints), [(int(i), int(j)) for i, j in zip(*np.nonzero(near), strict=True) if j < i], prints)
    got = {r.fp: r["class"] for r in simhash.link_classes(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()}
    groups = lambda name: {frozenset(p for p, c in zip(prints, name, strict=True) if c == k) for k in set(name)}     # noqa: E731
    assert groups([got.get(p, p) for p in prints]) == groups(want)
    assert len(set(want)) > 3

    # two components in one key: the larger one's members never meet each other
    filed = spark.createDataFrame([(0, 5, p, 0) for p in prints if p in cloud] + [(0, 5, flip(range(41, 45)), 9), (0, 5, flip(range(40, 60)), 10)],
                                  "choice int, key long, fp long, c long")
    assert [tuple(r) for r in simhash.across(filed, 4).collect()] == []
    one = spark.createDataFrame([(0, 5, 0, 0), (0, 5, 1, 0), (0, 5, 31, 9), (0, 5, 1 << 60, 9), (0, 6, 0, 0), (0, 6, 1, 1)], "choice int, key long, fp long, c long")
    assert sorted({(max(r), min(r)) for r in simhash.across(one, 4).collect()}) == [(1, 0), (9, 0)]


def test_masks_are_exact():
    for count in (2, 1000, 1 << 24, 1 << 36):
        keys = [m & ((1 << 64) - 1) for m in simhash.masks(4, count)]
        rng = np.random.default_rng(count % 1000)
        for _ in range(300):
            x = sum(1 << int(b) for b in rng.choice(64, size=4, replace=False))
            assert any(x & m == 0 for m in keys)


def test_keep_first(spark, odd_docs, tmp_path):
    clashing(frame(spark, odd_docs)).coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    assert ids == [(False, 1), (False, 2), (False, 5), (False, 6), (False, 7), (True, None)]
    assert simhash.keep_first(spark.read.parquet(str(tmp_path / "d")).where("doc_id = -1")).count() == 0


def brute_links(rows, threshold):
    ok = [r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.asarray(rows[i][1], np.float32).astype(float), np.asarray(rows[j][1], np.float32).astype(float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    pairs.append((i, j))
    return pairs


def odd_vectors(rng, dims=16):
    rows = [(i, rng.standard_normal(dims).tolist(), 0) for i in range(150)]
    for g in range(5):
        centre = rng.standard_normal(dims)
        rows += [(1000 + 100 * g + i, (centre + rng.standard_normal(dims) * 0.05 * g).tolist(), 1) for i in range(50)]
    rows += [(5000 + i, [1.0] + [0.0] * (dims - 1), None) for i in range(60)]
    rows += [(6000, None, 1), (6001, [], 1), (6002, [0.0] * dims, 1), (6003, [None] + [1.0] * (dims - 1), 1), (6004, [float("nan")] * dims, 1),
             (6005, [float("inf")] + [1.0] * (dims - 1), 1), (None, [1.0] * dims, 1), (6006, [1.0, 2.0], 1), (6007, [2.0, 4.0], 1), (6008, [3.0] * 3, None),
             (50, rows[50][1], 0)]
    return rows


def test_embedding_links(spark):
    rows = odd_vectors(np.random.default_rng(2))
    pairs = brute_links(rows, 0.9)
    links = np.bincount(np.asarray(pairs).ravel(), minlength=len(rows))
    want = closure(len(rows), pairs, [r[0] for r in rows])
    df = clashing(frame(spark, rows, VEC)).drop("n_links", "component_id")
    for window in (4, 64):
        got = embed_dedup.near_duplicates(df, window=window, recall=0.999999).collect()
        key = lambda x: (x[0] is None, x[0] or 0, x[1])                            # noqa: E731
        assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=key) == sorted(
            ((r[0], int(n), c, c == r[0]) for r, n, c in zip(rows, links, want, strict=True)), key=key)
    assert embed_dedup.near_duplicates(frame(spark, [], VEC)).count() == 0


@pytest.mark.parametrize("tile", [8, 1024])
def test_link_counts_in_loose_components(spark, tile, monkeypatch):
    """Chains of vectors without a common core are counted tile by tile."""
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    rows = [(i, [math.cos(i * 0.05), math.sin(i * 0.05), 0.0], 0) for i in range(60)]
    pairs = brute_links(rows, 0.9)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(frame(spark, rows, VEC), window=64).collect()}
    links = np.bincount(np.asarray(pairs).ravel(), minlength=len(rows))
    assert got == {i: (int(links[i]), 0) for i in range(60)}


def skewed_vectors(rng, spread=1500, cone=2000, pairs=300, dims=32, inner=0.85):
    """Vectors of which most lie in one cone, and isolated pairs at cosine 0.905 whose one end lies in it."""
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)                # noqa: E731
    centre = unit(rng.standard_normal(dims))
    side = rng.standard_normal((cone, dims))
    inside = math.sqrt(inner) * centre + math.sqrt(1 - inner) * unit(side - np.outer(side @ centre, centre))
    off = rng.standard_normal((pairs, dims))
    off = unit(off - (off * inside[:pairs]).sum(1, keepdims=True) * inside[:pairs])
    partners = 0.905 * inside[:pairs] + math.sqrt(1 - 0.905 ** 2) * off
    return np.vstack([unit(rng.standard_normal((spread, dims))), inside, partners])


def test_links_in_a_dense_region(spark, monkeypatch):
    """Where signs hardly split the vectors, all links are found none the less."""
    monkeypatch.setattr(embed_dedup, "STEP", 16)
    x = skewed_vectors(np.random.default_rng(6)).astype(np.float32)
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    pairs = [(i, j) for i, j in zip(*np.nonzero(near), strict=True) if j < i]
    want = closure(len(x), pairs, list(range(len(x))))
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           embed_dedup.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), window=8).collect()}
    assert got == {i: (int(n) - 1, c) for i, (n, c) in enumerate(zip(near.sum(1), want, strict=True))}


def brute_top(rows, k):
    """Every row of another id is a candidate; the queries of one id share a list."""
    fine = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in fine if i % 50 == 0}):
        found = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for j, x in fine if j == q for i, v in fine if i != q and len(v) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("chunk", [7, 4096])
def test_top_k(spark, chunk, monkeypatch):
    monkeypatch.setattr(topk_search, "CHUNK", chunk)
    monkeypatch.setattr(topk_search, "QUERIES", 3)
    rows = odd_vectors(np.random.default_rng(4)) + [(7000, [1e6] * 16, 0), (7050, [1e30] * 16, 0)]
    got = topk_search.top_k(clashing(frame(spark, rows, VEC)).drop("score"), F.col("vec_id") % 50 == 0).collect()
    want = brute_top([r for r in rows if r[0] != 7050], 5)
    # components beyond a long's range are held at its ends; the rest of the ranking is exact
    mine = sorted(map(tuple, got))
    assert all(abs(r[3]) <= (1 << 63) - 1 for r in mine) and {r[0] for r in mine} == {r[0] for r in want} | {7050}
    exact = {(q, v, s) for q, _, v, s in want}
    assert all((q, v, s) in exact for q, _, v, s in mine if 7050 not in (q, v))
    plain = sorted(map(tuple, topk_search.top_k(frame(spark, [r for r in rows if r[0] != 7050], VEC), F.col("vec_id") % 50 == 0).collect()))
    assert plain == want
    assert topk_search.top_k(frame(spark, [], VEC), F.col("vec_id") % 50 == 0).count() == 0
    few = [(50, [1.0, 2.0], 0), (51, [0.5, 0.5], 0)]
    assert sorted(map(tuple, topk_search.top_k(frame(spark, few, VEC), F.col("vec_id") % 50 == 0).collect())) == brute_top(few, 5)


def test_top_k_copies_only_to_blocks_that_ask(spark, monkeypatch):
    """Lengths of a wide range: few chunks are copied to a block of queries, and nothing is lost."""
    monkeypatch.setattr(topk_search, "CHUNK", 16)
    monkeypatch.setattr(topk_search, "QUERIES", 4)
    monkeypatch.setattr(topk_search, "GROUPS", 20)
    rng = np.random.default_rng(21)
    x = rng.standard_normal((1200, 8)) * np.exp(rng.standard_normal((1200, 1)) * 1.5)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    assert sorted(map(tuple, topk_search.top_k(frame(spark, rows, VEC), F.col("vec_id") % 50 == 0).collect())) == brute_top(rows, 5)
    whole = [(i, [math.floor(256 * float(np.float32(c))) for c in v], 1) for i, v, _ in rows]
    asked, given, _ = topk_search.meetings(spark.createDataFrame(whole, "vec_id long, v array<bigint>, n long"), F.col("vec_id") % 50 == 0, 5)
    assert 0 < given.count() < 1200 * 6 / 2 and asked.count() < 24 * 75 / 2          # six blocks of four queries, 75 chunks


@pytest.mark.parametrize("numbers", [1 << 22, 4000, 700])
def test_wide_vectors_are_rotated(spark, monkeypatch, numbers):
    """Every width has a rotation, from all moments or from few directions; products are bounded by it and nothing is lost."""
    monkeypatch.setattr(topk_search, "ROTATION_NUMBERS", numbers)
    monkeypatch.setattr(topk_search, "CHUNK", 32)
    rng = np.random.default_rng(22)
    x = rng.standard_normal((200, 3)) @ rng.standard_normal((3, 300)) + 0.01 * rng.standard_normal((200, 300))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(500 + i, rng.standard_normal(7).tolist(), 0) for i in range(60)]
    whole = spark.createDataFrame([(i, np.floor(256 * np.array(v)).astype(int).tolist()) for i, v, _ in rows], "vec_id long, v array<bigint>")
    basis = topk_search.rotations(whole)
    assert sorted(basis) == [7, 300] and sum(b.size for b in basis.values()) <= numbers
    assert all(np.allclose(b.T @ b, np.eye(b.shape[1]), atol=1e-12) for b in basis.values())
    y = np.floor(256 * x)
    head, rest = topk_search._rotated(y, basis[300])
    assert (head @ head.T + np.outer(rest, rest) >= y @ y.T - 1e-6 * np.abs(y @ y.T).max()).all()
    if numbers > 2000:
        assert rest.max() < 0.05 * np.linalg.norm(y, axis=1).mean()                # three directions hold nearly everything
    assert sorted(map(tuple, topk_search.top_k(frame(spark, rows, VEC), F.col("vec_id") % 50 == 0).collect())) == brute_top(rows, 5)


def test_top_k_of_repeated_ids_and_rows(spark):
    """Another vector under a repeated id is a candidate, and equal rows count as often as they stand there; the SQL says the same."""
    import duckdb

    from riskframe.llm.queries import ORACLE
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.standard_normal(4).round(1).tolist(), 0) for i in rng.integers(40, 120, 150)]
    rows += [(70, [9.0] * 4, 0)] * 4 + [(70, [-9.0] * 4, 0), (100, [1.0] * 4, 0), (100, [1.0] * 4, 0), (100, [-1.0] * 4, 0)]
    got = sorted(map(tuple, topk_search.top_k(frame(spark, rows, VEC), F.col("vec_id") % 50 == 0).collect()))
    assert got == brute_top(rows, 5)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(ORACLE["op8_top_k"]).fetchall()) == got


def test_links_of_repeated_ids(spark):
    """Each row is a vector of its own: an id on two vectors neither adds up their links nor joins their components."""
    import duckdb

    from riskframe.llm.queries import ORACLE
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.99, 0.05], 0), (3, [0.0, 2.0], 0), (1, [0.0, 1.0], 0), (9, [-1.0, 0.0], 0), (8, [-1.0, 0.1], 0), (8, [-1.0, 0.0], 0)]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(frame(spark, rows, VEC)).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    assert got == sorted(con.execute(ORACLE["op1_embedding_near_dedup"]).fetchall())
    assert (1, 2, 1, True) in got and (1, 1, 1, True) in got


@pytest.mark.parametrize("scale", [1e200, 1e-200])
def test_links_of_extreme_vectors(spark, scale):
    rows = [(1, [1.0 * scale, 0.0], 0), (2, [0.99 * scale, 0.05 * scale], 0), (3, [0.0, scale], 0)]
    got = {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(frame(spark, rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: 1, 2: 1, 3: 0}

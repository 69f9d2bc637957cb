"""Packing, periodic runs and ranked lexical search against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm import bpe, lexical, packing, period_runs

from .conftest import clashing, frame

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# packing

@pytest.fixture(scope="module")
def byte_file():
    return bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_byte_encoder_is_the_library_on_all_code_points(byte_file, library):
    e = packing.ByteEncoder(byte_file)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 1 << 14):
        texts = [f"a{chr(c)} {chr(c)}1{chr(c)}\n{chr(c)}<|endoftext|>" for c in points[i:i + (1 << 14)]]
        want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        assert [e.encode(t).tolist() for t in texts] == want


def test_byte_encoder_rejects_other_files(word_tokenizer):
    with pytest.raises((ValueError, KeyError, TypeError)):
        packing.ByteEncoder(word_tokenizer)


def test_piece_lengths():
    for n in [1, 2, 3, 7, 8, 9, 2047, 2048, 2049, 5000, 1 << 20]:
        cut = packing.piece_lengths(n, 2048)
        assert sum(cut) == n and all(x & (x - 1) == 0 and x <= 2048 for x in cut)
        assert max(Counter(x for x in cut if x < 2048).values(), default=1) == 1
    with pytest.raises(ValueError):
        packing.write(None, "", longest=100)


@pytest.mark.parametrize("longest", [2048, 16])
def test_packing_round_trip(spark, odd_docs, byte_file, library, longest):
    rows = [*odd_docs, (50, "hot copy", "en", "a", 1), *[(51, "same row", "en", "a", 1)] * 300]
    blocks = packing.write(clashing(frame(spark, rows)).repartition(4), byte_file, longest=longest)
    got = packing.read(blocks).collect()
    want = Counter()
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want[(r[0], tuple(ids))] += 1
    found = Counter()
    for doc, count in Counter((r.doc_id, r.start, r.length, r.doc_tokens, bytes(r.ids)) for r in got).items():
        found[doc] = count
    expected = Counter()
    for (doc, ids), count in want.items():
        start = 0
        for length in packing.piece_lengths(len(ids), longest):
            expected[(doc, start, length, len(ids), np.asarray(ids[start:start + length], "<u4").tobytes())] += count
            start += length
    assert found == expected
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and all(r.offset == 0 for r in got)
    by_number = sorted(got, key=lambda r: r.sequence_id)
    assert [r.length for r in by_number] == sorted(r.length for r in got)          # equal lengths stand together
    assert packing.read(packing.write(frame(spark, []), byte_file)).count() == 0


def test_blocks_are_closed(spark, byte_file):
    """Blocks hold a bounded number of ids; numbers go on over blocks and parts."""
    rows = [(i, "a b c " * 2000, "en", "a", 1) for i in range(400)]
    blocks = packing.write(frame(spark, rows).repartition(3), byte_file)
    assert blocks.agg(F.max(F.col("n_pieces") * F.col("length"))).first()[0] <= packing.BLOCK_IDS
    assert blocks.where("length = 2048").count() > 3
    numbers = [r[0] for r in packing.read(blocks).select("sequence_id").collect()]
    assert sorted(numbers) == list(range(len(numbers)))


# periodic runs

def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            part = words[start:j]
            smallest = next(p for p in range(1, q + 1) if all(part[x] == part[x - p] for x in range(p, length)))
            if smallest == q and length >= max(6, 4 * q):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = SPACE.findall(text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, ln, q in found for i in range(s + q, s + ln)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()      # noqa: E731
    return (doc_id, len(found), *(best or (None, None, None)), best[1] * 1000 // best[2] if best else None,
            sha("".join(f"{s},{ln},{q}\n" for s, ln, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(6))
def test_runs_brute_force(seed):
    rng = np.random.default_rng(seed)
    for _ in range(400):
        n = int(rng.integers(0, 70))
        words = rng.integers(0, int(rng.integers(1, 5)), size=n)
        if n > 8 and rng.random() < 0.8:         # loops inside loops
            for _ in range(int(rng.integers(1, 4))):
                a = int(rng.integers(0, n - 2))
                p = int(rng.integers(1, max(2, (n - a) // 3)))
                z = int(rng.integers(a, n))
                for i in range(a + p, z):
                    words[i] = words[i - p]
        assert period_runs.runs(words.astype(np.int64)) == brute_runs(words.tolist())


def test_runs_of_hard_texts():
    """Fibonacci and Thue-Morse words, and long repeats, whose plain diagonal sums grow with the square."""
    fib, a = [0], [0, 1]
    while len(a) < 600:
        fib, a = a, a + fib
    morse = [bin(i).count("1") % 2 for i in range(512)]
    cube = (morse[:64] * 5 + [7] + morse[:64] * 4 + [0, 0, 0, 0, 0, 0, 0, 1]) * 1
    for words in (a, morse, cube, ([1] * 7 + [2]) * 9, ([1, 2] * 5 + [3]) * 4 + [1, 2]):
        assert period_runs.runs(np.asarray(words, dtype=np.int64)) == brute_runs(list(words))
    n = 200_000
    assert period_runs.runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert period_runs.runs(np.arange(n) % 17) == [(0, n, 17)]
    assert period_runs.runs(np.arange(n) % (n // 4)) == [(0, n, n // 4)]
    two = np.random.default_rng(1).integers(0, 2, n)
    assert len(period_runs.runs(two)) > 100


def test_period_runs_rows(spark, odd_docs):
    tenth = [i for i in range(1000, 4000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rng = np.random.default_rng(5)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 40, int(rng.integers(1, 200))))      # noqa: E731
    rows = [*[r for r in odd_docs if r[0] != 5], (5, "word " * 300, "en", "b", 1), *[(i, text() + "\n \té é", "en", "a", 1) for i in tenth],
            (tenth[0], "  ", "en", "a", 1), (tenth[1], None, "en", "a", 1), (tenth[2], " \x0b x y z x y z x y z x y z \x1c", "en", "a", 1)]
    docs = clashing(frame(spark, rows))
    found = docs.select("doc_id", period_runs.scan(period_runs.looped(F.col("doc_id"), F.col("text"))).alias("found"))
    got = [tuple(r) for r in found.select("doc_id", *[c.alias(n) for n, c in period_runs.digest(F.col("found")).items()]).collect()]
    order = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)        # noqa: E731
    assert sorted(got, key=order) == sorted((brute_row(r[0], r[1]) for r in rows), key=order)
    assert sum(r[1] > 0 for r in got) > 30
    plain = frame(spark, [(1, "a b a b a b a b c", "en", "a", 1)]).select(period_runs.scan(F.col("text")).alias("f")).first().f
    assert [tuple(r) for r in plain.runs] == [(0, 8, 2)] and plain.collapsed == "a b c"


# ranked lexical search

def brute_search(docs, items, k):
    fold = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(t or "")]     # noqa: E731
    held = [(d, fold(t)) for d, t in docs]
    n_docs, length = sum(1 for _, w in held if w), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    counts = [(d, len(w), Counter(w)) for d, w in held]
    for item, text in items:
        scored = []
        for d, n, tf in counts:
            if n:
                m = 75 + (25 * n * n_docs) // length
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in fold(text) if tf[t])
                if score > 0:
                    scored.append((-score, math.inf if d is None else d, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: x[:2])[:k])]
    return out


def _rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, x or 0) for x in r))


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_search_brute_force(spark, odd_docs, monkeypatch):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(60)] + ["Élan", "中文", "fox", "x9"]
    weight = 1 / np.arange(1, len(words) + 1)
    text = lambda n: ", ".join(rng.choice(words, n, p=weight / weight.sum()))      # noqa: E731
    copies = text(30)
    rows = [*odd_docs, *[(1000 - i, text(int(rng.integers(0, 120))), "en", "a", 1) for i in range(300)], *[(2000 - i, copies, "en", "a", 1) for i in range(200)],
            *[(3000, copies, "en", "a", 1)] * 30, *[(None, copies, "en", "a", 1)] * 3]
    items = [(1, copies), (1, "fox W1 w1"), (2, None), (3, ""), (4, "nothing matches thisword"), (None, "w2 élan ÉLAN"), (5, text(40)), (6, "the The THE quick"), (6, "the The THE quick")]
    docs = clashing(frame(spark, rows)).repartition(3)
    asked = clashing(spark.createDataFrame(items, "item_id long, text string"))
    want = _sorted(brute_search([(r[0], r[1]) for r in rows], items, 20))
    assert _rows(lexical.search(docs, asked, k=20)) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)     # items in several blocks
    terms = lexical.item_terms(asked, "item_id", "text")
    assert len(list(lexical.blocks(terms, 40))) > 1
    assert _rows(lexical.search(docs, asked, k=3)) == _sorted(brute_search([(r[0], r[1]) for r in rows], items, 3))
    empty, none = frame(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(docs, none).count() == 0 and lexical.search(empty, asked).count() == 0


def chunk_of(docs, code, documents, length, weight):
    parts = []
    for d, w in docs:
        held = Counter(code[x] for x in w if x in code)
        parts.append((d, len(w), len(held), list(held), list(held.values())))
    return lexical.Chunk(np.asarray([p[0] for p in parts]), np.asarray([p[1] for p in parts]), np.asarray([p[2] for p in parts]),
                         np.asarray([c for p in parts for c in p[3]], dtype=np.int32), np.asarray([c for p in parts for c in p[4]], dtype=np.int64), documents, length, weight)


def test_intervals_are_pruned():
    """Carried over chunks, the k-th best score leaves most documents unopened, and results stay exact."""
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(400)]
    p = 1 / np.arange(1, 401)
    code = {w: i for i, w in enumerate(words)}
    docs = [(i, list(rng.choice(words, int(rng.integers(5, 150)), p=p / p.sum()))) for i in range(6000)]
    df = Counter(t for _, w in docs for t in set(w))
    length = sum(len(w) for _, w in docs)
    weight = np.asarray([math.floor(1000 * math.log((2 * 6000 + 2) / (2 * df[w] + 1))) for w in words])
    query = Counter(int(x) for x in rng.choice(400, 12))
    s = lexical.Search(np.asarray(list(query)), np.asarray(list(query.values())), 20)
    for i in range(0, 6000, 2000):
        s.run(chunk_of(docs[i:i + 2000], code, 6000, length, weight))
    want = brute_search([(d, " ".join(w)) for d, w in docs], [(0, " ".join(words[c] for c in query.elements()))], 20)
    assert list(zip(s.ids.tolist(), s.scores.tolist(), strict=True)) == [(d, x) for _, _, d, x in want]
    assert s.opened < 3000


def test_range_maxima():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 100)
    table = lexical.Chunk.table(values, 100)
    pairs = [(a, b) for a in range(100) for b in range(a + 1, 101)]
    got = lexical.Chunk.peak(table, values, np.asarray([a for a, _ in pairs]), np.asarray([b for _, b in pairs]))
    assert got.tolist() == [a + int(values[a:b].argmax()) for a, b in pairs]


def test_registered_rows_on_small_tables(spark):
    """The registered queries over the smallest given tables."""
    import duckdb

    from riskframe.llm.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = sorted(map(tuple, QUERIES["op13_period_runs"](spark, sf).collect()))
    short = [(d, t) for d, t in docs if len(SPACE.findall(t or "")) < 700]
    rows = defaultdict(list)
    for r in got:
        rows[r[0]].append(r)
    assert len(got) == len(docs) and all(rows[d] == [brute_row(d, t)] for d, t in short)
    pieces = QUERIES["op12_packing"](spark, sf).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in docs}
    assert Counter(r.doc_id for r in pieces) == Counter({d: len(packing.piece_lengths(len(x), 2048)) for d, x in ids.items()})
    for r in pieces:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert _rows(QUERIES["op11_ranked_search"](spark, sf).select("item_id", "rank", "doc_id", "score")) == _sorted(con.execute(ORACLE["op11_ranked_search"]).fetchall())

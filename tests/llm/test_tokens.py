"""BPE, token-id files and token counts against the libraries, on odd texts."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import bpe, pfor, token_counts

from .conftest import DOCS, clashing, frame


@pytest.fixture(scope="session")
def library(word_tokenizer):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(word_tokenizer)


def as_ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_encoders_agree_with_the_library(word_tokenizer, library):
    rng = random.Random(5)
    chars = [chr(c) for c in [*range(1, 0x600), *range(0x2000, 0x2070), *range(0x3000, 0x3100), *range(0x1F300, 0x1F340)]]
    texts = ["", "a" * 500, "ab" * 300, "=" * 77, "e" * 5000]
    texts += ["".join(rng.choice("aabbceinotrhs ") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    texts += ["".join(rng.choice(chars) for _ in range(60)) for _ in range(300)]
    texts += ["".join(rng.choice(["<|startoftext|>", "<|endoftext|>", "<|", "a", " ", "é,", "ΑΣ", "İ", "\x1c", "'s", "'LL", "x.", "é."])
                      for _ in range(12)) for _ in range(300)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    own, lib = bpe.Encoder(bpe.Vocabulary(word_tokenizer), cache=50), pfor.LibraryEncoder(word_tokenizer)
    assert [as_ids(b) for b in own.encode(texts)] == want
    assert [as_ids(b) for b in lib.encode(texts)] == want
    decoder = bpe.Decoder(own.v)
    assert [decoder.decode(np.asarray(i, dtype=np.int64)).decode() for i in want] == [library.decode(i, skip_special_tokens=False) for i in want]


def test_round_trip_frame(spark, odd_docs, word_tokenizer, library):
    df = clashing(frame(spark, odd_docs))
    one = bpe.round_trip(df.select("doc_id", "text", "ids"), word_tokenizer).collect()
    two = bpe.decode(bpe.encode(df, word_tokenizer), word_tokenizer).select("doc_id", "text", "ids", "decoded", bpe.ids_digest(F.col("ids")).alias("sha")).collect()
    assert len(one) == len(two) == len(odd_docs)
    for r in [*one, *two]:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    for r in two:
        assert r.sha == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    assert bpe.round_trip(frame(spark, []), word_tokenizer).count() == 0


def test_file_image_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(40):
        top = int(rng.choice([1, 2, 100, 49408, 1 << 32]))
        docs = [rng.integers(0, top, size=int(rng.integers(0, 2000)), dtype=np.uint64).astype("<u4") for _ in range(int(rng.integers(0, 9)))]
        got = pfor.read_file(pfor.write_file(docs))
        assert len(got) == len(docs) and all((a == b).all() for a, b in zip(docs, got, strict=True))
    rare = np.full(5000, 7, dtype="<u4")
    rare[[3, 900, 4999]] = 4_000_000_000
    image = pfor.write_file([rare])
    assert (pfor.read_file(image)[0] == rare).all() and len(image) < 400       # outliers don't widen the blocks


def test_files_hold_documents_in_order(spark, odd_docs, word_tokenizer, library, monkeypatch):
    monkeypatch.setattr(pfor, "SHARD_IDS", 64)
    df = clashing(frame(spark, odd_docs))
    shards = pfor.write(df, word_tokenizer, end_id=1)
    rows = pfor.read(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).orderBy("start").collect()
    assert [r.doc_id for r in rows][:2] == [None, None] and len(rows) == len(odd_docs)
    known = [r.doc_id for r in rows][2:]
    assert known == sorted(known)
    want = {}
    for d, t, *_ in odd_docs:
        ids = np.asarray([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for r in rows:
        assert (r.n_tokens, r.crc) in want[r.doc_id] and r.start == start
        start += r.n_tokens
    assert pfor.read(pfor.write(frame(spark, []), word_tokenizer)).count() == 0


@pytest.fixture(scope="session")
def ranks():
    import public_tokenizers
    return token_counts.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_against_brute_force(spark, odd_docs, ranks, rule):
    import public_tokenizers
    import tiktoken
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*odd_docs, (20, "a\n\n\n  b \n\n c\n", "en", "a", 1), (21, "\n", "en", "a", 1), (22, "x  \n  \n y 中\n文", "en", "a", 1)]
    got = {}
    for r in token_counts.attribute(clashing(frame(spark, texts)), ranks, public_tokenizers.PATTERN, rule=rule).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start, r.chars, r.tokens))
    for d, t, *_ in texts:
        if not t:
            assert d is None or d not in got
            continue
        if d in (None, 6):
            continue
        tokens = encoding.encode_ordinary(t)
        lines = t.splitlines(keepends=True) if "\x1c" not in t else None
        spans, at = [], 0
        for k in range(len(t) + 1):
            if k == len(t) or t[k] == "\n":
                if min(k + 1, len(t)) > at:
                    spans.append((at, min(k + 1, len(t))))
                at = k + 1
        assert lines is None or len(lines) == len(spans)
        char = [i for i, c in enumerate(t) for _ in c.encode()]
        counts, byte = [0] * len(spans), 0
        for b in encoding.decode_tokens_bytes(tokens):
            first, last = char[byte], char[byte + len(b) - 1] + 1
            byte += len(b)
            if rule == "start":
                k = next(i for i, (_, e) in enumerate(spans) if first < e)
            elif rule == "end":
                k = next(i for i, (_, e) in enumerate(spans) if last - 1 < e)
            else:
                over = [max(0, min(e, last) - max(s, first)) for s, e in spans]
                k = over.index(max(over))
            counts[k] += 1
        assert sorted(got[d]) == [(i, s, e - s, c) for i, ((s, e), c) in enumerate(zip(spans, counts, strict=True))]
        assert sum(counts) == len(tokens)
    assert token_counts.attribute(spark.createDataFrame([], DOCS), ranks, public_tokenizers.PATTERN).count() == 0

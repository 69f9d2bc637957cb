"""BPE encoding and decoding of texts, by backtracking over longest token matches.

``encode``: a text is cut at white space (no pre-token of the tokenizer crosses
it), each distinct chunk is normalised and pre-tokenised by the tokenizer's own
rules, and each pre-token is encoded by the backtracking encoder: one
Aho-Corasick pass gives the longest token at every position, a token is taken
only if the pair (last token, token) could stand beside each other after all
merges (pair-compatibility table), else the next shorter token is tried and
finally the last token is taken back. Positions found hopeless are marked and
never visited again, so the work is linear in the pre-token.

``decode``: token texts lie in one byte block; an offset table gives each id's
slice, and a whole id list is gathered at once.

Defined results: a null or empty text has no ids and decodes to the empty text;
the special tokens' strings inside a text become their ids, as in the library.
Rows are independent: repeated rows give repeated results, columns other than
the text are never read. Ids outside the vocabulary decode to nothing.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, slices

WORD_END = "</w>"
#: Chunks (white-space separated words) whose ids a worker remembers; a speed-up only, results don't depend on it.
CACHE = 120_000
#: Longer chunks are not remembered.
LONG = 64

#: White space of the tokenizer's split rule (fixed values, Unicode White_Space).
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Marks that close a word.
MARKS = ".,;:!?"
#: Separators that Python's split() takes as white space although the tokenizer doesn't.
NOT_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def ending(char: str) -> str:
    """The private character for a symbol that closes a word."""
    return chr(0xE000 + ord(char))


class Vocabulary:
    """Tables of a byte-level BPE tokenizer file whose words end in ``</w>``."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("a BPE tokenizer file with word ends is needed")
        ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.text = text
        self.content = {i: t for t, i in ids.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        # ranks: base symbols first, then merges in order, so that a smaller rank merges earlier
        made = {ids[a + b] for a, b in merges}
        base = sorted(i for i in ids.values() if i not in made)
        self.id_of = [*base, *(ids[a + b] for a, b in merges)]
        rank = {i: r for r, i in enumerate(self.id_of)}
        self.left, self.right = list(range(len(base))), list(range(len(base)))
        self.symbols = []
        for i in base:
            t = self.content[i]
            self.symbols.append(ending(t[:-len(WORD_END)]) if t.endswith(WORD_END) and len(t) > len(WORD_END) else t)
        self.pair: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges, len(base)):
            x, y = rank[ids[a]], rank[ids[b]]
            self.left.append(x)
            self.right.append(y)
            self.symbols.append(self.symbols[x] + self.symbols[y])
            self.pair.setdefault((x, y), r)
        # a token is usable if its own two halves still merge last of all
        n = len(base)
        usable = [True] * n
        for r in range(n, len(self.symbols)):
            x, y = self.left[r], self.right[r]
            usable.append(usable[x] and usable[y] and self.compatible(x, y, r))
        self.rank_of = {s: r for r, s in enumerate(self.symbols) if usable[r]}
        self.shorter = [-1] * len(self.symbols)
        for s, r in self.rank_of.items():
            self.shorter[r] = next((self.rank_of[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.rank_of), -1)

    def compatible(self, a: int, b: int, limit: int = 1 << 62) -> bool:
        """Whether tokens of ranks a, b stay apart: no merge over their border comes before those inside them."""
        pair, left, right = self.pair, self.left, self.right
        while True:
            if pair.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a = a, right[a]
                if a != limit:
                    continue
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 != limit:
                    continue
                limit, a = a, right[a]
                if a == limit:
                    return True


class Known(dict):
    """Results of ``make`` by chunk, in two generations: a full one is kept as the older, what is asked again comes back."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, chunk: str) -> bytes:
        value = self.older.get(chunk)
        if value is None:
            value = self.make(chunk)
        if len(chunk) <= LONG:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[chunk] = value
        return value


class Cutter:
    """Cuts texts into chunks at white space, and chunks into the tokenizer's pre-tokens (as byte symbols)."""

    def __init__(self, text: str):
        import regex
        from tokenizers import Tokenizer

        self.rules = Tokenizer.from_str(text)
        self.normalise, self.library_pieces = self.rules.normalizer.normalize_str, self.rules.pre_tokenizer.pre_tokenize_str
        self.special = {t.content: i for i, t in self.rules.get_added_tokens_decoder().items()}
        # ASCII chunks take the same rules in a form that needs no alignment to the source
        self.ascii = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+").findall
        self.spaces = regex.compile(f"[{SPACES}]+").split
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split

    def chunks(self, text: str) -> list[str]:
        if any(c in text for c in NOT_SPACES):
            return [c for c in self.spaces(text) if c]
        return text.split()

    def pieces(self, chunk: str) -> list[str]:
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            pieces = self.ascii(chunk.lower())
            return pieces if chunk.isprintable() else [p.translate(_SHOWN) for p in pieces]
        # lower() differs from the rules' lower-casing of single characters at a closing sigma only
        chunk = chunk.lower() if "\u03a3" not in chunk and is_normalized("NFC", chunk) and chunk.rstrip(MARKS).isalpha() else self.normalise(chunk)
        word = chunk.rstrip(MARKS)
        if word.isalpha():                          # letters make one piece, marks after them another
            piece = word.encode().decode("latin-1").translate(_SHOWN)
            return [piece, chunk[len(word):]] if len(word) < len(chunk) else [piece]
        return [p for p, _ in self.library_pieces(chunk)]

    def encode(self, texts: list[str | None], known: Known) -> list[bytes]:
        """Each text's ids, where ``known`` gives those of a chunk, as little-endian unsigned 32-bit integers."""
        out = []
        for t in texts:
            if not t:
                out.append(b"")
            elif any(s in t for s in self.special):
                out.append(b"".join(int(self.special[part]).to_bytes(4, "little") if part in self.special
                                    else b"".join(map(known.__getitem__, self.chunks(part))) for part in self.specials(t)))
            else:
                out.append(b"".join(map(known.__getitem__, self.chunks(t))))
        return out


_SHOWN = {b: s for b, s in byte_symbols().items() if s != chr(b)}


class Encoder:
    """Encodes texts with a Vocabulary; one per Python worker."""

    def __init__(self, vocab: Vocabulary, cache: int = CACHE):
        import ahocorasick

        self.v, self.cutter = vocab, Cutter(vocab.text)
        self.machine = ahocorasick.Automaton()
        for s, r in vocab.rank_of.items():
            self.machine.add_word(s, (r, len(s) - 1))
        self.machine.make_automaton()
        self.sizes = [len(s) for s in vocab.symbols]
        self.words = Known(self.word_bytes, cache)
        self.chunks = Known(self.chunk, cache)
        self.fits: dict[int, bool] = {}

    def word(self, symbols: str) -> list[int]:
        """Ids of one pre-token, given as byte symbols (the last one not yet closed)."""
        v = self.v
        s = symbols[:-1] + ending(symbols[-1])
        whole = v.rank_of.get(s)
        if whole is not None:
            return [v.id_of[whole]]
        n = len(s)
        longest = [-1] * n
        for end, (r, back) in self.machine.iter(s):
            longest[end - back] = r
        fits, shorter, sizes, compatible = self.fits, v.shorter, self.sizes, v.compatible
        if len(fits) > 200_000:
            fits.clear()
        out: list[int] = []
        hopeless: set[int] = set()
        at, token, last = 0, longest[0], -1
        while True:
            end = at + sizes[token]
            if end in hopeless:
                ok = False
            elif last < 0:
                ok = True
            else:
                key = last << 32 | token
                ok = fits.get(key)
                if ok is None:
                    ok = fits[key] = compatible(last, token)
            if ok:
                out.append(token)
                if end == n:
                    return [v.id_of[r] for r in out]
                at, last, token = end, token, longest[end]
                continue
            token = shorter[token]
            while token < 0:
                hopeless.add(at)
                last = out.pop()
                at -= sizes[last]
                token, last = shorter[last], out[-1] if out else -1

    def word_bytes(self, symbols: str) -> bytes:
        return array("I", self.word(symbols)).tobytes()

    def chunk(self, chunk: str) -> bytes:
        words = self.words
        return b"".join([words[p] for p in self.cutter.pieces(chunk)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self.cutter.encode(texts, self.chunks)


class Decoder:
    """Token texts in one block of bytes, with the offset of each id."""

    def __init__(self, vocab: Vocabulary, joined_by: str = " "):
        size = max(vocab.content) + 1
        tokens = [vocab.content[i].encode() + joined_by.encode() if i in vocab.content else b"" for i in range(size)]
        self.joint = len(joined_by.encode())
        self.block = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.asarray([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < len(self.starts))]
        if not len(ids):
            return b""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.block[at].tobytes()[:-self.joint or None]


_WORKER: dict = {}


def _encoder(text: str) -> Encoder:
    """The worker's encoder; kept between tasks."""
    key = ("encoder", hash(text))
    if key not in _WORKER:
        _WORKER[key] = Encoder(Vocabulary(text))
    return _WORKER[key]


def _decoder(vocab: Vocabulary) -> Decoder:
    key = ("decoder", hash(vocab.text))
    if key not in _WORKER:
        _WORKER[key] = Decoder(vocab)
    return _WORKER[key]


def read_tokenizer(path: str) -> str:
    """The tokenizer file's content, read on the driver (a few MB, a fixed size)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_udf(spark, tokenizer: str):
    """Column function: text -> array<int> of ids, by the tokenizer file's content."""
    shared = spark.sparkContext.broadcast(tokenizer)

    @F.arrow_udf("array<int>")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        e = _encoder(shared.value)
        for some in slices(texts):
            ids = e.encode(some.to_pylist())
            ends = np.cumsum([0, *(len(b) // 4 for b in ids)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))

    return encode


def decode_udf(spark, tokenizer: str):
    """Column function: array<int> of ids -> text, token texts joined as the library does for this file."""
    shared = spark.sparkContext.broadcast(tokenizer)

    @F.arrow_udf("string")
    def decode(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        d = _decoder(Vocabulary(shared.value))
        for some in slices(ids):
            values = some.values.to_numpy(zero_copy_only=False)
            ends = some.offsets.to_numpy()
            yield pa.array([d.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()).cast(pa.string())

    return decode


def round_trip_udf(spark, tokenizer: str):
    """Column function: text -> struct of the ids and the text decoded from them, in one pass through Python."""
    shared = spark.sparkContext.broadcast(tokenizer)

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        e = _encoder(shared.value)
        d = _decoder(e.v)
        for some in slices(texts, 256):
            raw = e.encode(some.to_pylist())
            ends = np.cumsum([0, *(len(b) // 4 for b in raw)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), dtype="<i4")))
            values = ids.values.to_numpy()
            decoded = pa.array([d.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.StructArray.from_arrays([ids, decoded.cast(pa.string())], names=["ids", "decoded"])

    return both


def encode(df: DataFrame, tokenizer: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with a column of token ids; a column of that name is replaced."""
    return df.withColumn(out, encode_udf(df.sparkSession, tokenizer)(F.col(text)))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the decoded text of a column of ids; null ids decode to the empty text."""
    given = F.coalesce(F.col(ids), F.array().cast("array<int>"))
    return df.withColumn(out, decode_udf(df.sparkSession, tokenizer)(given))


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256)


def round_trip(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the ids of a text and the text decoded from them; columns of those names are replaced."""
    kept = [c for c in df.columns if c not in (ids, decoded)]
    name, = fresh(df, "_bpe")
    made = df.select(*kept, round_trip_udf(df.sparkSession, tokenizer)(F.col(text)).alias(name))
    return made.select(*kept, F.col(name)["ids"].alias(ids), F.col(name)["decoded"].alias(decoded))

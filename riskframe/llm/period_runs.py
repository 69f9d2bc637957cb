"""Runs of periodic words, by a sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and at least max(6, 4 * q) words that no neighbouring word extends
keeping period q. On the diagonal of lag q the words after its first q are
matches: a diagonal's match length counts the words in a row that equal the
word q before them.

``runs`` goes over the words once. A word's earlier occurrences increment the
match lengths of their lags; a lag that gets no increment has ended, and its run
is emitted there and then if it is long enough. The DP stays sparse because only
occurrences that a run can use are looked at, and this loses none:

- A run of a lag q with 2**k <= q < 2**(k+1) has at least 3 * 2**k matches in a
  row (5 for q = 1). So an occurrence counts for lags of that size only with the
  whole *context* of that many words equal, and then its diagonal already has
  that match length.
- Of the occurrences with equal context only the nearest counts. Were there two
  at lags p < q, the context has periods p and q with p + q <= 3 * 2**k words,
  so the greatest common divisor of p and q is a period too: the diagonal of q is
  a multiple of a shorter period and no run of its own.

So a word increments at most one lag of each size, about log2(words) in all, and
a text of one word repeated is no worse than others. Contexts of doubling length
are numbered by sorting pairs of numbers, only where both halves occur again.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; rows are judged one by one, so repeated rows and ids get equal
results; an empty table gives no rows. No other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import slices, text_bytes

#: Fixed by the definition of a run: fewest words, and fewest periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


class Contexts:
    """Numbers of equal stretches of 2**m words; -1 where a stretch occurs once."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.levels = [_again(words, np.arange(self.n), self.n)]

    def power(self, m: int) -> np.ndarray:
        while len(self.levels) <= m:
            half = self.levels[-1]
            self.levels.append(self.pair(half, half, 1 << (len(self.levels) - 1)))
        return self.levels[m]

    def pair(self, left: np.ndarray, right: np.ndarray, gap: int) -> np.ndarray:
        """Numbers of the stretches made of one at each place and one ``gap`` words on."""
        if gap >= self.n:
            return np.full(self.n, -1)
        at = np.flatnonzero((left[:-gap] >= 0) & (right[gap:] >= 0))
        return _again(left[at] * np.int64(self.n + 1) + right[at + gap], at, self.n)

    def of_lags(self, k: int) -> tuple[int, np.ndarray]:
        """Length and numbers of the contexts for lags of 2**k up to 2**(k+1)."""
        if k == 0:
            return 5, self.pair(self.power(2), self.power(0), 4)
        return 3 << k, self.pair(self.power(k + 1), self.power(k), 2 << k)


def _again(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Dense numbers of ``keys`` at the places ``at`` of n, -1 elsewhere and where a key occurs once."""
    out = np.full(n, -1)
    if len(at):
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        number = np.concatenate([[0], np.cumsum(~same)])
        twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        out[at[order[twice]]] = number[twice]
    return out


def increments(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(word, lag, context length): the lags each word increments, by ascending word."""
    contexts = Contexts(words)
    found = []
    k = 0
    while LEAST_PERIODS << k <= max(len(words), 4):
        length, number = contexts.of_lags(k)
        at = np.flatnonzero(number >= 0)
        if not len(at):
            break               # no context of this length occurs again, so no longer one does
        order = at[np.argsort(number[at], kind="stable")]
        lag = np.diff(order)
        good = (number[order[1:]] == number[order[:-1]]) & (lag >= 1 << k) & (lag < 2 << k)
        here, lag = order[1:][good] + (length - 1), lag[good]
        if len(here):
            found.append(np.stack([here, lag, np.full(len(here), length)], axis=1))
        k += 1
    if not found:
        return []
    every = np.concatenate(found)
    return every[np.argsort(every[:, 0], kind="stable")].tolist()


def runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of numbered words, by start and period."""
    active: dict[int, list[int]] = {}       # lag -> first and last word of the diagonal's matches
    out = []

    def end(lag: int) -> None:
        first, last = active.pop(lag)
        length = last - first + 1 + lag
        if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            out.append((first - lag, length, lag))

    before = -1
    for word, lag, context in increments(words):
        if word != before:
            if active:
                for other in [q for q, span in active.items() if span[1] < word - 1]:
                    end(other)
            before = word
        span = active.get(lag)
        if span is None:
            active[lag] = [word - context + 1, word]
        else:
            span[1] = word
    for lag in list(active):
        end(lag)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(count: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``count`` words stay: those that no run holds after its first period."""
    keep = np.ones(count, dtype=bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return keep


def numbered(words: list[bytes]) -> np.ndarray:
    number: dict[bytes, int] = {}
    return np.asarray([number.setdefault(w, len(number)) for w in words], dtype=np.int64)


FOUND = "struct<runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


def scan(text: Column) -> Column:
    """Column of a text's runs (by start, then period) and of the text without what they repeat.

    Words are split at ASCII white space and joined by one space; they are numbered from 0.
    """
    @F.arrow_udf(FOUND)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in slices(texts, 256):
            rows, collapsed, ends = [], [], [0]
            for data in text_bytes(column):
                words = data.split()
                found = runs(numbered(words)) if len(words) >= LEAST_WORDS else []
                if found:
                    keep = collapse(len(words), found)
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                rows += found
                ends.append(len(rows))
                collapsed.append(b" ".join(words))
            parts = np.asarray(rows, dtype=np.int64).reshape(-1, 3)
            each = pa.StructArray.from_arrays([pa.array(parts[:, i]) for i in range(3)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)
            yield pa.StructArray.from_arrays([lists, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["runs", "collapsed"])

    return find(text)


def looped(doc_id: Column, text: Column) -> Column:
    """The text that the registered query scans: in every tenth document (by CRC-32 of the id) the words from some place on go round in a loop."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(text)


def digest(found: Column) -> dict[str, Column]:
    """The registered query's columns from a column of ``scan``."""
    every = found["runs"]
    longest = F.element_at(F.array_sort(every, lambda x, y: F.when(x["length"] != y["length"], F.sign(y["length"] - x["length"]))
                                        .when(x["start"] != y["start"], F.sign(x["start"] - y["start"]))
                                        .otherwise(F.sign(x["period"] - y["period"])).cast("int")), 1)
    best = F.when(F.size(every) > 0, longest)
    lines = F.array_join(F.transform(every, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return {"n_runs": F.size(every).cast("long"), "start": best["start"], "length": best["length"], "period": best["period"],
            "exponent_milli": F.floor(1000 * best["length"] / best["period"]).cast("long"),
            "runs_sha256": F.sha2(lines, 256), "collapsed_sha256": F.sha2(found["collapsed"], 256)}

"""License scans with a generalised suffix automaton of licence words.

All templates' words make one automaton. A text's words are streamed through it,
which gives at every word the matching statistic: the longest run ending there
that occurs in some template. Runs of ``least`` words and more are placed in the
templates that hold them (each template at the longest run that it holds there) and
chained, in text and template order, into covered spans by best score: words covered
less a cost of the words between, in relation to the template's length. A template
covered by ``cover`` of its words gives its label. Short fixed
phrases are templates too: every place where one stands is read off the states
the stream passes (a phrase ends where its state lies on the suffix links).

Words: A-Z lower-cased, then runs of ASCII letters, digits and all characters
from U+0080. Defined results: a null or empty text has no words and no matches;
repeated rows give repeated results; columns other than the text are not read.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import slices, text_bytes

# Phrases that name a licence, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Licence notices and opening clauses (public licence texts), by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton over word sequences."""

    def __init__(self, texts: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        for text in texts:
            last = 0
            for w in text:
                last = self._extend(last, w)
        # where each state's runs end: template -> places, from every state of the template up the suffix links
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        self.whole: dict[int, int] = {}
        for t, text in enumerate(texts):
            s = 0
            for i, w in enumerate(text):
                s = self.next[s][w]
                up = s
                while up > 0:
                    self.ends[up].append((t, i + 1))
                    up = self.link[up]
            self.whole[t] = s

    def _add(self, size: int, edges: dict[bytes, int], link: int) -> int:
        self.next.append(edges)
        self.size.append(size)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        """A state of q's shorter runs, reached from p by w."""
        made = self._add(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = made
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = made
            p = self.link[p]
        return made

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, w)
        new = self._add(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, w)
        return new


class Piece(NamedTuple):
    """Words start to end of a text that are words t_start to t_end of a template."""

    start: int
    end: int
    t_start: int
    t_end: int


@dataclass
class Library:
    """Phrases and templates with their automaton; whole licence texts may be given as templates."""

    phrases: dict[str, str]
    templates: tuple[tuple[str, str], ...]
    least: int = 3
    cover: float = 0.6
    skip: float = 8.0       # words of its template that a chain loses for as many words between as the template has

    def __post_init__(self):
        runs = [words(p.encode()) for p in self.phrases] + [words(t.encode()) for _, t in self.templates]
        self.labels = [*self.phrases.values(), *(label for label, _ in self.templates)]
        self.lengths = [len(r) for r in runs]
        self.machine = Automaton(runs)
        known = self.machine.next[0]
        self.known = set(known)
        # phrases that end at a state: those on its suffix links, and its own if the match is long enough
        state_of: dict[int, list[int]] = {}
        for t in range(len(self.phrases)):
            state_of.setdefault(self.machine.whole[t], []).append(t)
        self.phrase_ends: list[tuple[int, ...]] = []
        for s in range(len(self.machine.next)):
            found, up = [], s
            while up > 0:
                found += state_of.get(up, [])
                up = self.machine.link[up]
            self.phrase_ends.append(tuple(found))

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """(words, [(phrase, first word)], [(template, first word, word after the last, covered words)])."""
        run = words(text)
        known = self.known
        hits = [i for i, w in enumerate(run) if w in known]
        machine = self.machine
        follow, link, size = machine.next, machine.link, machine.size
        phrases: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []            # (end, words, state) of runs that can't be extended
        state = held = 0
        before = -2
        for i in hits:
            if i != before + 1:
                if held >= self.least:
                    matches.append((before + 1, held, state))
                state = held = 0
            before = i
            w = run[i]
            if w not in follow[state]:
                if held >= self.least:
                    matches.append((i, held, state))
                while state >= 0 and w not in follow[state]:
                    state = link[state]
                held = size[state] if state >= 0 else 0
                state = max(state, 0)
            state = follow[state][w]
            held += 1
            for p in self.phrase_ends[state]:
                if self.lengths[p] <= held:
                    phrases.append((p, i + 1 - self.lengths[p]))
        if held >= self.least:
            matches.append((before + 1, held, state))
        return len(run), phrases, self.chain(matches)

    def pieces(self, matches: list[tuple[int, int, int]]) -> dict[int, list[Piece]]:
        """Template -> the pieces of it that stand in the text, by their end; each at the longest match ending there."""
        machine, found = self.machine, {}
        for end, held, state in matches:
            seen: set[int] = set()
            while state > 0 and held >= self.least:
                here = {t for t, _ in machine.ends[state]} - seen
                for t, place in machine.ends[state]:
                    if t in here and t >= len(self.phrases):
                        found.setdefault(t, []).append(Piece(end - held, end, place - held, place))
                seen |= here
                state = machine.link[state]
                held = machine.size[state] if state > 0 else 0
        return found

    def chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Best-scoring chains of pieces per template, increasing in the text and in the template.

        A chain scores the template words it covers less ``skip / length of the template`` for every word
        of the text between its pieces. A piece joins no chain that scores less than the words between
        cost, so only pieces within ``length ** 2 / skip`` words before it are looked at; that leaves none
        out, as no chain scores more than the length. Chains of one template don't overlap in the text:
        the better one stays (of equals the one that ends first).
        """
        spans: list[tuple[int, int, int, int]] = []
        for t, run in self.pieces(matches).items():
            length = self.lengths[t]
            cost, reach = self.skip / length, length * length / self.skip
            gain, score, back = [], [], []                      # words a piece adds to its chain, the chain's score, piece before
            low = 0
            for i, p in enumerate(run):
                while run[low].end < p.start - reach:
                    low += 1
                best = (float(p.end - p.start), p.end - p.start, -1)
                for j in range(i - 1, low - 1, -1):
                    q = run[j]
                    new = p.end - p.start - max(0, q.end - p.start, q.t_end - p.t_start)
                    if q.end < p.end and q.t_end < p.t_end and new > 0:
                        whole = score[j] + new - cost * max(0, p.start - q.end)
                        if whole > best[0]:
                            best = (whole, new, j)
                score.append(best[0])
                gain.append(best[1])
                back.append(best[2])
            taken: list[tuple[int, int]] = []                   # the text ranges of chains that stay, in order
            for i in sorted(range(len(run)), key=lambda i: (-score[i], run[i].end, run[i].t_end)):
                covered, k = gain[i], i
                while back[k] >= 0:
                    k = back[k]
                    covered += gain[k]
                first, end = run[k].start, run[i].end
                at = bisect(taken, (first, end))
                if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < end):
                    continue
                taken.insert(at, (first, end))
                spans.append((t, first, end, covered))
        return sorted(spans, key=lambda s: (s[1], s[0]))


RESULT = ("struct<n_words:long,base:array<struct<label:string,start:long>>,"
          "spans:array<struct<label:string,start:long,end:long,covered:int,share:double>>>")


def scan(text: Column, library: Library) -> Column:
    """Column of a text's words, phrase places and template spans."""
    @F.arrow_udf(RESULT)
    def scanned(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        place = [("label", pa.string()), ("start", pa.int64())]
        span = [*place, ("end", pa.int64()), ("covered", pa.int32()), ("share", pa.float64())]
        kind = pa.struct([("n_words", pa.int64()), ("base", pa.list_(pa.struct(place))), ("spans", pa.list_(pa.struct(span)))])
        for column in slices(texts):
            out = []
            for b in text_bytes(column):
                n, phrases, spans = library.scan(b)
                out.append({"n_words": n, "base": [{"label": library.labels[p], "start": s} for p, s in phrases],
                            "spans": [{"label": library.labels[t], "start": a, "end": e, "covered": c, "share": c / library.lengths[t]}
                                      for t, a, e, c in spans]})
            yield pa.array(out, kind)

    return scanned(text)


def digest(found: Column, cover: float) -> dict[str, Column]:
    """Counts, labels and score of a scan column."""
    base, spans = found["base"], found["spans"]
    sure = F.filter(spans, lambda s: s["share"] >= cover)
    base_labels = F.array_distinct(base["label"])
    joined = lambda a: F.array_join(F.array_sort(a), ",")                                     # noqa: E731
    best = F.greatest(F.coalesce(F.array_max(spans["share"]), F.lit(0.0)), F.when(F.size(base) > 0, 1.0).otherwise(0.0))
    return {"n_words": found["n_words"], "n_base": F.size(base).cast("long"), "first_word": F.array_min(base["start"]),
            "last_word": F.array_max(base["start"]), "base_labels": joined(base_labels),
            "labels": joined(F.array_union(base_labels, sure["label"])), "score": F.least(F.lit(1.0), best)}

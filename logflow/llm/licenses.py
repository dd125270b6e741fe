"""License scans (4): a generalised suffix automaton of license notices.

The notices and phrases below form one automaton over word ids.  Every file
is streamed through it; each position gets its matching statistic, the
length of the longest run of words ending there that stands in some notice.
Runs of at least ``min_match`` words that cannot be extended are chained per
notice into covered spans by dynamic programming over (place in the file, place
in the notice), so stray matches between the parts of a notice break nothing.
A notice is a label where a chain covers ``min_cover`` of its words and no chain
of another label covers more words of the same place (ties: both are labels).
A phrase's places are the positions whose automaton state has the phrase as a
suffix.

Before the automaton runs, words outside all notices and word pairs that
stand in no notice are excluded by table lookup; no match can span them.

Null text is an empty text: no words, no labels, score 0, first and last word
null.  Rows without doc_id are left out, repeated rows give a row each, an
empty table gives no row, and other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm._common import id_text

# Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Wording of public license notices.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation either version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is "
                 "distributed on an as is basis without warranties or conditions of any kind either express or implied "
                 "see the license for the specific language governing permissions and limitations under the license"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer redistributions in binary form must reproduce the above copyright notice this list of "
            "conditions and the following disclaimer in the documentation and or other materials provided with the "
            "distribution"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program if not see"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with this library if not "
             "see"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program if not "
             "see"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications "
             "and to alter it and redistribute it freely subject to the following restrictions"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
            "this work"),
]

#: ASCII letters lower-cased; ASCII bytes that are no letter or digit become blanks.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in range(256))


def license_words(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton over sequences of word ids."""

    def __init__(self, sequences: list[list[int]]):
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, seq in enumerate(sequences):
            last = 0
            for k, w in enumerate(seq):
                last = self._extend(last, w, ends)
                ends[last].add((t, k))
        order = sorted(range(1, len(self.go)), key=lambda s: -self.length[s])
        for s in order:
            ends[self.link[s]] |= ends[s]
        #: (sequence, last position) of every occurrence of a state's words
        self.ends = [sorted(e) for e in ends]

    def _new(self, length: int, go: dict, link: int, ends: list) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        ends.append(set())
        return len(self.go) - 1

    def _clone(self, p: int, q: int, w: int, ends: list) -> int:
        c = self._new(self.length[p] + 1, dict(self.go[q]), self.link[q], ends)
        while p >= 0 and self.go[p].get(w) == q:
            self.go[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, w: int, ends: list) -> int:
        q = self.go[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w, ends)
        cur = self._new(self.length[last] + 1, {}, 0, ends)
        p = last
        while p >= 0 and w not in self.go[p]:
            self.go[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.go[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w, ends)
        return cur

    def step(self, state: int, matched: int, w: int) -> tuple[int, int]:
        while state and w not in self.go[state]:
            state = self.link[state]
            matched = self.length[state]
        if w in self.go[state]:
            return self.go[state][w], matched + 1
        return 0, 0


class Scanner:
    def __init__(self, min_match: int = 4, min_cover: float = 0.6, notices: list[tuple[str, str]] = NOTICES):
        self.min_match, self.min_cover = min_match, min_cover
        phrases = [license_words(p) for p, _ in PHRASES]
        self.labels = [label for label, _ in notices]
        notices = [license_words(n) for _, n in notices]
        self.sizes = [len(n) for n in notices]
        vocab = sorted({w for s in phrases + notices for w in s})
        self.ids = {w: k + 1 for k, w in enumerate(vocab)}
        seqs = [[self.ids[w] for w in s] for s in notices + phrases]
        self.sam = Automaton(seqs)
        #: codes of the word pairs that stand in a notice or phrase
        self.pairs = np.array(sorted({a * len(self.ids) + b for s in seqs for a, b in zip(s, s[1:])}), dtype=np.int64)
        self.first = min(min_match, min(map(len, phrases)))
        #: phrases that end where a state ends, if as many words are matched
        sam = self.sam
        self.phrase_at = [{(t - len(notices), len(seqs[t])) for t, k in e if t >= len(notices) and k == len(seqs[t]) - 1
                           and sam.length[sam.link[s]] < len(seqs[t]) <= sam.length[s]} if s else set()
                          for s, e in enumerate(sam.ends)]
        for s in sorted(range(1, len(self.sam.link)), key=self.sam.length.__getitem__):
            self.phrase_at[s] |= self.phrase_at[self.sam.link[s]]

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Spans of at least ``first`` words whose neighbours all pair up."""
        ok = np.zeros(len(ids) + 1, dtype=np.int8)
        known = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        code = ids[known].astype(np.int64) * len(self.ids) + ids[known + 1]
        at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        ok[known[self.pairs[at] == code] + 1] = 1
        edge = np.diff(ok)
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        keep = b - a >= self.first
        return list(zip(a[keep].tolist(), b[keep].tolist()))

    def scan(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], dict[int, list[tuple[int, int, int]]]]:
        """Phrase places (word, phrase) and for each notice its maximal
        matches (first word, words, position in the notice)."""
        places: list[tuple[int, int]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}
        sam = self.sam
        for a, b in self.runs(ids) if len(ids) > 1 else []:
            state = matched = 0
            for i in range(a, b):
                before, long = state, matched
                state, matched = sam.step(state, matched, int(ids[i]))
                if matched <= long and long >= self.min_match:
                    self._add(matches, i - long, long, before)
                for p, n in self.phrase_at[state]:
                    if matched >= n:
                        places.append((i - n + 1, p))
            if matched >= self.min_match:
                self._add(matches, b - matched, matched, state)
        return places, matches

    def _add(self, matches: dict, at: int, n: int, state: int) -> None:
        for t, end in self.sam.ends[state]:
            if t < len(self.sizes) and end - n + 1 >= 0:
                matches.setdefault(t, []).append((at, n, end - n + 1))

    def chains(self, matches: dict[int, list[tuple[int, int, int]]]) -> tuple[list[tuple[str, int, int]], float]:
        """Covered spans (label, first word, end) and the best coverage."""
        found, best = [], 0.0
        for t, some in matches.items():
            some = sorted(some)
            covered, before = best_chains(some, self.sizes[t])
            best = max(best, min(1.0, max(covered) / self.sizes[t]))
            found += [(self.labels[t], c, parts) for c, parts in
                      apart(some, covered, before, self.min_cover * self.sizes[t])]
        if not found:
            return [], best
        # words of the longest chain that covers each place
        top = np.zeros(max(parts[-1][1] for _, _, parts in found), dtype=np.int64)
        for _, c, parts in found:
            for a, b in parts:
                top[a:b] = np.maximum(top[a:b], c)
        return [(label, parts[0][0], parts[-1][1]) for label, c, parts in found
                if 2 * sum(int((top[a:b] > c).sum()) for a, b in parts) < sum(b - a for a, b in parts)], best


def best_chains(found: list[tuple[int, int, int]], size: int) -> tuple[list[int], list[int]]:
    """For each match the words that the best chain ending with it covers,
    and the match before it there (-1: none).  ``found`` are (first word,
    words, place in the notice), sorted; parts may lie at most ``size`` words
    apart, and words that two parts share count once.  Ties go to the later
    match before."""
    covered, before, low = [], [], 0
    for j, (at, n, pos) in enumerate(found):
        while found[low][0] + 2 * size < at:
            low += 1
        best = (n, -1)
        for i in range(low, j):
            a, m, place = found[i]
            if a < at and place < pos and at - a - m <= size:
                gain = n - max(0, a + m - at, place + m - pos)
                if gain > 0:
                    best = max(best, (covered[i] + gain, i))
        covered.append(best[0])
        before.append(best[1])
    return covered, before


def apart(found: list[tuple[int, int, int]], covered: list[int], before: list[int],
          least: float) -> list[tuple[int, list[tuple[int, int]]]]:
    """(words covered, parts) of chains of at least ``least`` words that do
    not overlap, those that cover most words first."""
    chains = []
    for j, c in enumerate(covered):
        if c >= least:
            parts, i = [], j
            while i >= 0:
                parts.append((found[i][0], found[i][0] + found[i][1]))
                i = before[i]
            chains.append((c, parts[::-1]))
    taken: list[tuple[int, int]] = []
    out = []
    for c, parts in sorted(chains, key=lambda e: (-e[0], e[1][-1][1] - e[1][0][0], e[1][0][0])):
        first, end = parts[0][0], parts[-1][1]
        k = bisect.bisect_left(taken, (first, end))
        if (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or end <= taken[k][0]):
            taken.insert(k, (first, end))
            out.append((c, parts))
    return out


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<struct<label: string, first: long, end: long>>")


def read_notices(templates: DataFrame, *, max_words: int = 1_000_000) -> list[tuple[str, str]]:
    """Notices of a table (label, text); rows without either are left out.
    The automaton of all notices is held by every task, so a table of more
    than ``max_words`` words is refused."""
    rows = templates.select(F.col("label").cast("string"), F.col("text").cast("string")).where(
        "label is not null and text is not null")
    size = rows.agg(F.coalesce(F.sum(F.length("text") - F.length(F.regexp_replace("text", r"\s+", "")) + 1), F.lit(0))).first()[0]
    if size > max_words:
        raise ValueError(f"{size} words of notices; the automaton is built for at most {max_words}")
    return sorted((r[0], r[1]) for r in rows.distinct().collect() if license_words(r[1]))


def scan_licenses(docs: DataFrame, *, templates: DataFrame | None = None, min_match: int = 4,
                  min_cover: float = 0.6) -> DataFrame:
    """One row for each document; ``templates`` (label, text) replaces the
    notices given here, phrases stay."""
    notices = NOTICES if templates is None else read_notices(templates)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(min_match, min_cover, notices)
        get = scanner.ids.get
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                words = license_words(text)
                ids = np.fromiter(map(get, words, repeat(0)), dtype=np.int32, count=len(words))
                places, matches = scanner.scan(ids)
                spans, score = scanner.chains(matches)
                base = {PHRASES[p][1] for _, p in places}
                starts = [a for a, _ in places]
                rows.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(base)), ",".join(sorted(base | {s[0] for s in spans})),
                             1.0 if places else score,
                             [{"label": x, "first": a, "end": b} for x, a, b in sorted(spans, key=lambda s: s[1:])]))
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                              "labels", "score", "spans"])
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return id_text(docs).mapInPandas(scan, SCHEMA)

"""Licence scans by a generalised suffix automaton of licence notices.

The automaton holds every run of words of all templates. A file's words stream through
it once and give matching statistics: at each word, the longest run ending there that
some template has, and, along the suffix links, the shorter runs of other templates.
Matches that can't be made longer are chained, in order in both file and template, into
covered spans; a template covered well enough gives its label, unless another label's
template covers the same words better.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame

from passagework.llm.common import small_batches, texts, worker_cache

# Phrases whose words, standing consecutively, give the base labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Words of well-known licences and their notices, a paragraph each, so that a
# part that stands alone is told too.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("unlicense", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("agpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license for more details"),
    ("lgpl", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
)

#: Words a match must have, words that may be missing between chained matches, and the
#: share of a template that gives its label.
MIN_MATCH, GAP, COVERED = 4, 6, 0.6

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, spans array<struct<label: string, start: int, end: int>>"
)
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)


def file_words(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


class SuffixAutomaton:
    """All runs of words of several templates; ``end[s]`` is a place (template, last word) of state s."""

    def __init__(self, templates: list[list[bytes]]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.end = [-1], [0], [(-1, -1)]
        for t, words in enumerate(templates):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, word, (t, i))

    def _state(self, length: int, ways: dict[bytes, int], link: int, end: tuple[int, int]) -> int:
        self.next.append(ways)
        self.length.append(length)
        self.link.append(link)
        self.end.append(end)
        return len(self.next) - 1

    def _split(self, at: int, word: bytes, below: int) -> int:
        """A copy of ``below`` that is one word longer than ``at``."""
        copy = self._state(self.length[at] + 1, dict(self.next[below]), self.link[below], self.end[below])
        self.link[below] = copy
        while at >= 0 and self.next[at].get(word) == below:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: bytes, end: tuple[int, int]) -> int:
        below = self.next[last].get(word)
        if below is not None:  # an earlier template has this run
            return below if self.length[below] == self.length[last] + 1 else self._split(last, word, below)
        new, at = self._state(self.length[last] + 1, {}, 0, end), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            below = self.next[at][word]
            fits = self.length[below] == self.length[at] + 1
            self.link[new] = below if fits else self._split(at, word, below)
        return new

    def walk(self, words: list[bytes], least: int = 1) -> Iterator[tuple[int, int, int]]:
        """(last word, length, state) of the longest match at each word, if of ``least`` words."""
        ways, link, length = self.next, self.link, self.length
        state = size = 0
        for i, word in enumerate(words):
            to = ways[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = ways[state].get(word)
            if to is None:
                size = 0
                continue
            state, size = to, size + 1
            if size >= least:
                yield i, size, state

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(last word, length, state) of each longest match that can't be extended by the next word."""
        before = None
        for now in self.walk(words):
            if before and (now[0] > before[0] + 1 or now[1] <= before[1]):
                yield before
            before = now
        if before:
            yield before


class Match(NamedTuple):
    """``size`` words that stand from ``start`` in the file and from ``at`` in the template."""

    start: int
    at: int
    size: int


class Chain(NamedTuple):
    template: int
    share: float
    words: int
    start: int
    end: int


class Scanner:
    def __init__(self, templates=TEMPLATES) -> None:
        self.labels = [label for label, _ in templates]
        self.words = [text.encode().split() for _, text in templates]
        self.automaton = SuffixAutomaton(self.words)
        link, length = self.automaton.link, self.automaton.length
        #: where (template, last word) the runs of each state end, for runs that are long enough
        self.ends: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for e, _, state in self.automaton.walk(words, MIN_MATCH):
                while length[state] >= MIN_MATCH:
                    self.ends.setdefault(state, []).append((t, e))
                    state = link[state]

    def matches(self, words: list[bytes]) -> dict[int, list[Match]]:
        """All matches of ``MIN_MATCH`` words or more that can't be made longer, by template and their end."""
        link, length = self.automaton.link, self.automaton.length
        found: dict[int, list[Match]] = {}
        for i, size, state in self.automaton.walk(words, MIN_MATCH):
            following = words[i + 1] if i + 1 < len(words) else None
            seen: set[tuple[int, int]] = set()
            while size >= MIN_MATCH:
                for t, e in self.ends[state]:
                    if (t, e) in seen:
                        continue
                    seen.add((t, e))
                    if e + 1 == len(self.words[t]) or self.words[t][e + 1] != following:
                        found.setdefault(t, []).append(Match(i - size + 1, e - size + 1, size))
                state = link[state]
                size = length[state]
        return found

    def chains(self, words: list[bytes]) -> list[Chain]:
        """The chains of each template that cover most of it, none of them sharing a match."""
        out = []
        for t, found in self.matches(words).items():
            covered, before = chained(found)
            taken: set[int] = set()
            for j in sorted(range(len(found)), key=lambda j: (-covered[j], j)):
                path = [j]
                while before[path[-1]] >= 0:
                    path.append(before[path[-1]])
                if taken.isdisjoint(path):
                    share = covered[j] / len(self.words[t])
                    out.append(Chain(t, share, covered[j], found[path[-1]].start, found[j].start + found[j].size))
                taken.update(path)
        return out

    def named(self, chains: list[Chain]) -> list[tuple[str, int, int]]:
        """(label, first word, end) of chains that cover enough.

        One goes if over half of its words lie in a chain of another label that covers more words.
        """
        good = sorted((c for c in chains if c.share >= COVERED), key=lambda c: (-c.words, -c.share, c.start, c.template))
        kept: list[Chain] = []
        taken: dict[int, set[str]] = {}  # labels that hold a word
        for c in good:
            label = self.labels[c.template]
            others = sum(bool(taken.get(i, set()) - {label}) for i in range(c.start, c.end))
            if 2 * others > c.end - c.start:
                continue
            kept.append(c)
            for i in range(c.start, c.end):
                taken.setdefault(i, set()).add(label)
        return sorted((self.labels[c.template], c.start, c.end) for c in kept)

    def scan(self, text: str) -> tuple:
        words = file_words(text)
        line = b" " + b" ".join(words) + b" "
        starts: list[int] = []
        base: set[str] = set()
        for phrase, label in PHRASES.items():
            wanted, at = b" " + phrase.encode() + b" ", -1
            while (at := line.find(wanted, at + 1)) >= 0:
                starts.append(line.count(b" ", 0, at))
                base.add(label)
        chains = self.chains(words)
        best = max((c.share for c in chains), default=0.0)
        good = self.named(chains)
        labels = base | {x[0] for x in good}
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            1.0 if base else min(1.0, best),
            [dict(label=x, start=a, end=b) for x, a, b in dict.fromkeys(good)],
        )


def chained(found: list[Match]) -> tuple[list[int], list[int]]:
    """For each match, in order of ends: most words a chain up to it covers, and the match before it (or -1).

    A match follows another if it begins and ends later in file and template, with at most
    ``GAP`` words between them in the file; words that both cover count once.
    """
    covered, before = [], []
    by_end: dict[int, list[int]] = {}
    for j, m in enumerate(found):
        best, link = m.size, -1
        end = m.start + m.size
        for e in range(m.start - GAP, end):
            for i in by_end.get(e, ()):
                p = found[i]
                if p.start >= m.start or p.at >= m.at or p.at + p.size >= m.at + m.size:
                    continue
                twice = max(0, e - m.start, p.at + p.size - m.at)
                if covered[i] + m.size - twice > best:
                    best, link = covered[i] + m.size - twice, i
        covered.append(best)
        before.append(link)
        by_end.setdefault(end, []).append(j)
    return covered, before


def licence_scan(docs: DataFrame) -> DataFrame:
    """Labels, base places and covered spans (in words) of every whole text; null texts are empty.

    ``score`` is the best covered share of a template, 1 where a base phrase stands. One row
    per input row; the scan is narrow, and a text is held once.
    """
    names = [x.split()[0] for x in SCHEMA.split(", ")[:8]] + ["spans"]

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = worker_cache("licences", Scanner)
        for frame in small_batches(frames, "text", 8_000_000):
            rows = [(i, *scanner.scan(t)) for i, t in zip(frame["doc_id"], frame["text"], strict=True)]
            made = pd.DataFrame(rows, columns=names)
            for name in ("doc_id", "first_word", "last_word"):
                made[name] = made[name].astype("Int64")
            yield made

    return texts(docs, "doc_id").mapInPandas(scan, SCHEMA)

"""Licence scan: a generalised suffix automaton over the tokens of licence templates, streamed over each text.

The automaton gives, at each word, the length of the longest run of words ending there that stands in some template
(the matching statistics), and where it ends in which templates. Long matches of one template are chained as long as
they advance in the text and in the template and stay close together in the text; a chain that covers enough of the
template's words is a span. So repeated or shuffled parts of a template cover no more than one of them in order does, and
a text with insertions, cuts and names filled in is still found. Phrases (short fixed word runs) count by themselves.

Templates are a parameter: any labelled texts, whole licences or notices. The default ones are public texts that stand in
files as they are.

Cases: null, empty and wordless texts have no words, no places and score 0; texts are streamed whole, in one pass;
repeated rows give a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import BoundedCache, map_texts

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases that count by themselves, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Texts of licences, and the notices that longer licences ask for, with the label each stands for.
NOTICES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License."""),
    ("gpl", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
        later version."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

# Templates are sent to every task: more text than this is refused.
MOST_TEMPLATE_BYTES = 16 << 20
_PAIR_MARKS = 1 << 20


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class SuffixAutomaton:
    """Generalised suffix automaton of token sequences (token ids from 0)."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for seq in sequences:
            last = 0
            for token in seq:
                last = self._extend(last, token)
        # Where prefixes end: (sequence, last place) for the states they lead to.
        self.here: dict[int, list[tuple[int, int]]] = {}
        for k, seq in enumerate(sequences):
            state = 0
            for i, token in enumerate(seq):
                state = self.next[state][token]
                self.here.setdefault(state, []).append((k, i))
        self.below: dict[int, list[int]] = {}
        for state, link in enumerate(self.link):
            self.below.setdefault(link, []).append(state)
        self._ends: dict[int, list[tuple[int, int]]] = {}

    def ends(self, state: int) -> list[tuple[int, int]]:
        """(sequence, last place) of every occurrence of the state's strings."""
        if state not in self._ends:
            found, todo = [], [state]
            while todo:
                s = todo.pop()
                found += self.here.get(s, [])
                todo += self.below.get(s, [])
            self._ends[state] = found
        return self._ends[state]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        """The state for the shorter strings of q that follow p: q itself, or a copy of it."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:  # another template has been here
            return self._split(last, known, token)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][token], token)
        return new


@dataclass(frozen=True)
class Finding:
    """Words first..last (inclusive) cover `covered` words of a template, in order."""

    label: str
    first: int
    last: int
    covered: int
    share: float


Match = tuple[int, int, int, int]  # first and last word in the text, first and last place in the template


def best_chain(matches: list[Match], gap: int) -> tuple[int, int, int]:
    """(covered, first, last) of the chain that covers most template words; the one that ends, then begins, first on a tie.

    A match that overlaps what the chain already has, in the text or in the template, counts from behind that.
    """
    best, open_ = (0, 0, 0), []
    for a, z, p, q in sorted(matches, key=lambda m: (m[1], m[0], m[3])):
        covered, first = z - a + 1, a
        # Later matches neither end nor begin earlier, so what is too far behind now stays so.
        open_ = [o for o in open_ if o[2] >= a - gap - 1]
        for before, begin, end, place in open_:
            fresh = min(z - max(end, a - 1), q - max(place, p - 1))
            if fresh > 0 and z - fresh + 1 - end <= gap + 1 and (before + fresh, -begin) > (covered, -first):
                covered, first = before + fresh, begin
        open_.append((covered, first, z, q))
        if covered > best[0]:
            best = covered, first, z
    return best


def chains(matches: list[Match], gap: int, least: int) -> list[tuple[int, int, int]]:
    """(first, last, covered) of disjoint stretches whose best chain covers at least `least` words of the template."""
    out, groups, reach = [], [], None
    for m in sorted(matches):
        if reach is None or m[0] - reach > gap + 1:
            groups.append([])
            reach = m[1]
        groups[-1].append(m)
        reach = max(reach, m[1])
    while groups:
        group = groups.pop()
        if len({m[2:] for m in group}) == 1 and group[0][3] - group[0][2] + 1 < least or not group:
            continue  # copies of one short part: no two of them make a chain
        covered, first, last = best_chain(group, gap)
        if covered >= least:
            out.append((first, last, covered))
            groups += [side for side in ([m for m in group if m[1] < first], [m for m in group if m[0] > last]) if side]
    return sorted(out)


class Scanner:
    """Streams texts through the automaton of all notices and counts the phrases."""

    def __init__(self, notices=NOTICES, phrases=PHRASES, least_match: int = 3, least_share: float = 0.7, gap: int = 8):
        self.least_match, self.least_share, self.gap = least_match, least_share, gap
        self.labels = [label for label, _ in notices]
        sequences = [words_of(text.encode()) for _, text in notices]
        self.phrase_words = [(words_of(p.encode()), label) for p, label in phrases]
        vocabulary = dict.fromkeys(w for s in [*sequences, *[p for p, _ in self.phrase_words]] for w in s)
        self.token = {w: i for i, w in enumerate(vocabulary)}
        coded = [[self.token[w] for w in s] for s in sequences]
        self.sizes = [len(s) for s in coded]
        self.automaton = SuffixAutomaton(coded)
        # Marks the word pairs of templates, by a hash: a pair taken for another only costs a look into the automaton.
        self.pair_known = np.zeros(_PAIR_MARKS, dtype=bool)
        for s in coded:
            self.pair_known[self._pair(np.array(s[:-1], dtype=np.int64), np.array(s[1:], dtype=np.int64))] = True
        self.phrases = [(np.array([self.token[w] for w in p]), label) for p, label in self.phrase_words]

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) * 1_000_003 + right) % _PAIR_MARKS

    def statistics(self, tokens: list[int]) -> tuple[list[int], list[int]]:
        """For each token: length of the longest template run that ends there, and the state it ends in."""
        a = self.automaton
        nxt, link, length = a.next, a.link, a.length
        state = matched = 0
        lengths, states = [], []
        for t in tokens:
            while state and t not in nxt[state]:
                state = link[state]
                matched = length[state]
            if t in nxt[state]:
                state = nxt[state][t]
                matched += 1
            lengths.append(matched)
            states.append(state)
        return lengths, states

    def findings(self, tokens: np.ndarray) -> list[Finding]:
        """Template spans. tokens: -1 for words of no template.

        A match longer than one word consists of word pairs that some template holds; the automaton runs over each
        stretch of such pairs, as everything between can only match one word.
        """
        linked = np.zeros(len(tokens) + 1, dtype=bool)
        if len(tokens) > 1:
            linked[1:-1] = self.pair_known[self._pair(tokens[:-1], tokens[1:])] & (tokens[:-1] >= 0) & (tokens[1:] >= 0)
        edges = np.flatnonzero(linked[1:] != linked[:-1])  # a stretch begins at its first word, ends at its last
        matches: dict[int, list[Match]] = {}
        for first, last in edges.reshape(-1, 2).tolist():
            if last - first + 1 < self.least_match:
                continue
            lengths, states = self.statistics(tokens[first:last + 1].tolist())
            for i, n in enumerate(lengths):
                longest_here = i + 1 == len(lengths) or lengths[i + 1] <= n
                if n >= self.least_match and longest_here:
                    for k, end in self.automaton.ends(states[i]):
                        matches.setdefault(k, []).append((first + i - n + 1, first + i, end - n + 1, end))
        found = []
        for k, own in sorted(matches.items()):
            found += [Finding(self.labels[k], a, z, n, n / self.sizes[k]) for a, z, n in chains(
                own, self.gap, math.ceil(self.least_share * self.sizes[k] - 1e-9))]
        return sorted(found, key=lambda f: (f.first, f.last, f.label))

    def places(self, tokens: np.ndarray) -> list[tuple[int, str]]:
        """(start, label) of every place where a phrase stands, in order."""
        out = []
        for phrase, label in self.phrases:
            n = len(phrase)
            if len(tokens) >= n:
                at = np.flatnonzero(tokens[:len(tokens) - n + 1] == phrase[0])
                for j in range(1, n):
                    at = at[tokens[at + j] == phrase[j]]
                out += [(int(s), label) for s in at]
        return sorted(out)


class TextScanner(Scanner):
    """Takes whole texts. White-space-free pieces are kept with their tokens, so most words are looked up once."""

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.of_piece = BoundedCache(self._piece)

    def _piece(self, piece: bytes) -> bytes:
        return array("i", [self.token.get(w, -1) for w in words_of(piece)]).tobytes()

    def tokens(self, text: str) -> np.ndarray:
        # Words hold no ASCII white space, so the pieces' words are the text's.
        pieces = text.encode().split()
        return np.frombuffer(b"".join(map(self.of_piece.__getitem__, pieces)), dtype=np.int32)

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[Finding]]:
        tokens = self.tokens(text)
        return len(tokens), self.places(tokens), self.findings(tokens)


def templates(rows: DataFrame) -> tuple[tuple[str, str], ...]:
    """Templates from a table with the columns label and text; rows with a null are left out."""
    sound = rows.where("label is not null and text is not null").select("label", "text")
    size = sound.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MOST_TEMPLATE_BYTES:
        raise ValueError(f"{size} bytes of templates; at most {MOST_TEMPLATE_BYTES} can be sent to every task")
    return tuple((r["label"], r["text"]) for r in sound.distinct().orderBy("label", "text").collect())


def scan(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """doc_id, n_words, phrases (start and label of each place) and spans (template findings) of each row."""
    state: dict[str, TextScanner] = {}

    def work(texts):
        if "scanner" not in state:
            state["scanner"] = TextScanner(notices)
        scanner = state["scanner"]
        found = [scanner.scan(t) for t in texts]
        return (
            [n for n, _, _ in found],
            [[{"start": s, "label": x} for s, x in places] for _, places, _ in found],
            [[{"label": f.label, "first": f.first, "last": f.last, "share": f.share} for f in spans] for _, _, spans in found])

    return map_texts(docs, [
        ("n_words", "long"), ("phrases", "array<struct<start: long, label: string>>"),
        ("spans", "array<struct<label: string, first: long, last: long, share: double>>")], work)


def scan_digest(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """Counts, places and labels of scan, one row per document.

    score: largest share of a template that a span covers, 1.0 where a phrase stands, else 0.0.
    """
    base = F.array_sort(F.array_distinct(F.expr("transform(phrases, p -> p.label)")))
    own = F.expr("transform(spans, s -> s.label)")
    starts = F.expr("transform(phrases, p -> p.start)")
    return scan(docs, notices).select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.expr("transform(spans, s -> s.share)")), F.lit(0.0))).alias("score"))

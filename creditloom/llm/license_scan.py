"""Licence texts inside documents.

A generalised suffix automaton holds all word sequences of the licence templates.  Streaming
the words of a document through it gives the matching statistics: how long the sequence that
ends at each word occurs in some template, and along the suffix links how long its end occurs in
each other one.  Matches that their template cannot extend and that are long enough are chained,
in the order of both texts, into spans; a span's share of its template decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import small_batches

# Phrases whose every place counts, and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Wording of common public licences and notices, each with its label.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
]

# Words of a match that is worth chaining (whole templates may be shorter), words of a gap
# inside a chain, and the share of a template that a chain has to cover.
LEAST_MATCH = 4
MOST_GAP = 12
LEAST_SHARE = 0.75

# Bytes outside words become blanks; A-Z are lower-cased; bytes of other letters stay.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; none for null."""
    return text.encode().translate(FOLD).split() if text else []


def best_chains(parts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, template end, words covered) of the best chain that ends with each part.

    ``parts`` are (end, length, template end), sorted.  A part follows another if it ends later
    in both texts and at most MOST_GAP words lie between them in either; words that overlap in
    one of the texts count once.  Of chains that cover as much, the earlier start counts.
    """
    chains: list[tuple[int, int, int, int]] = []
    for i, (end, length, t) in enumerate(parts):
        start, at = end - length, t - length
        best = (length, -start)
        for j in range(i - 1, -1, -1):
            first, stop, above, covered = chains[j]
            if start - stop > MOST_GAP:
                break  # parts are in the order of their ends
            over = max(0, stop - start, above - at)
            if stop < end and above < t and over < length and max(start + over - stop, at + over - above) <= MOST_GAP:
                best = max(best, (covered + length - over, -first))
        chains.append((-best[1], end, t, best[0]))
    return chains


class Automaton:
    """Generalised suffix automaton over word sequences, with where each state's words end."""

    def __init__(self, templates: list[tuple[str, list[bytes]]]):
        self.labels = [label for label, _ in templates]
        self.lengths = [len(w) for _, w in templates]
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, set[int]]] = [{}]
        for k, (_, sequence) in enumerate(templates):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].setdefault(k, set()).add(at + 1)
        # Whatever ends with a state's words also ends with those of its suffix link.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            for k, ends in self.ends[state].items():
                self.ends[self.link[state]].setdefault(k, set()).update(ends)
        self.least = min([LEAST_MATCH, *self.lengths], default=LEAST_MATCH)
        # For each state the templates that hold its words or a long enough end of them: the
        # state of the longest such end.
        self.held: list[dict[int, int]] = [{} for _ in self.link]
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            below = {k: s for k, s in self.held[self.link[state]].items() if self.length[s] >= self.asked(k)}
            self.held[state] = below | {k: state for k in self.ends[state]}

    def asked(self, template: int) -> int:
        """Words of a match that is worth chaining; short templates ask for all of theirs."""
        return min(LEAST_MATCH, self.lengths[template])

    def _state(self, length: int, link: int, moves: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        self.ends.append({})
        return len(self.length) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """The state of the words that come over ``state``; ``target`` is split if it holds longer ones."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:  # another template has these words already
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.next[last][word])
        return new

    def matches(self, sequence: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """(end, length, template, state) wherever the longest end that a template holds stops growing.

        ``state`` says where in the template those words end.
        """
        state, length, moves = 0, 0, self.next
        before: dict[int, tuple[int, int]] = {}  # template: (length, state)
        for at, word in enumerate(sequence):
            while state and word not in moves[state]:
                state = self.link[state]
                length = self.length[state]
            if word in moves[state]:
                state = moves[state][word]
                length += 1
            now: dict[int, tuple[int, int]] = {}
            if length >= self.least:
                for k, s in self.held[state].items():
                    long = min(length, self.length[s])
                    if long >= self.asked(k):
                        now[k] = (long, s)
            for k, (long, s) in before.items():
                if k not in now or now[k][0] != long + 1:
                    yield at, long, k, s
            before = now
        for k, (long, s) in before.items():
            yield len(sequence), long, k, s

    def spans(self, sequence: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(template, start, end, share) of the best chains, in words, by start and template."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        for end, length, k, state in self.matches(sequence):
            found.setdefault(k, []).extend((end, length, t) for t in self.ends[state][k])
        out = []
        for k, parts in found.items():
            chains = best_chains(sorted(parts))
            best: list[tuple[int, int, float]] = []
            for start, end, _, covered in sorted(chains, key=lambda c: (c[0], -c[3], c[1])):
                if not best or start >= best[-1][1]:
                    best.append((start, end, covered / self.lengths[k]))
                elif covered / self.lengths[k] > best[-1][2]:
                    best[-1] = (start, end, covered / self.lengths[k])
            out += [(k, *b) for b in best]
        return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def base_places(sequence: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    """(start, label) of every place where the words of a phrase stand one after another."""
    out = []
    for phrase, label in phrases:
        last, at = phrase[-1], 0
        for _ in range(sequence.count(last)):
            at = sequence.index(last, at) + 1
            start = at - len(phrase)
            if start >= 0 and sequence[start:at] == phrase:
                out.append((start, label))
    return sorted(out)


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:long,end:long,share:double>>"
)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    One row for each row of ``docs``.  spans are the chains that cover at least LEAST_SHARE of
    a template, in words counted from 0, end exclusive; their labels join those of the base
    phrases.  score is the largest share of any chain, 0 without one.  Ties between chains go
    to the earlier one.  Null and empty texts have no words; null ids stay null; repeated rows
    are scanned each; an empty table gives no rows; other columns are not looked at.

    The templates are few and fixed; each task builds the automaton from them once.
    """
    small_batches(docs)
    wanted = [(label, words(wording)) for label, wording in (TEMPLATES if templates is None else templates)]
    phrases = [(words(p), label) for p, label in PHRASES]

    @F.pandas_udf(RESULT)
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton([t for t in wanted if t[1]])
        for batch in batches:
            out = []
            for value in batch:
                sequence = words(value)
                places = base_places(sequence, phrases)
                chains = automaton.spans(sequence)
                good = [c for c in chains if c[3] >= LEAST_SHARE]
                base = sorted({label for _, label in places})
                labels = sorted({*base, *(automaton.labels[c[0]] for c in good)})
                out.append(
                    (
                        len(sequence),
                        len(places),
                        places[0][0] if places else None,
                        places[-1][0] if places else None,
                        ",".join(base),
                        ",".join(labels),
                        max((c[3] for c in chains), default=0.0),
                        [{"label": automaton.labels[k], "start": a, "end": b, "share": s} for k, a, b, s in good],
                    )
                )
            frame = pd.DataFrame(out, columns=[x.split()[0] for x in RESULT.split(", ")])
            yield frame.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(F.col(doc_id).alias("doc_id"), look(F.col(text)).alias("r")).select(F.col("doc_id").alias(doc_id), "r.*")

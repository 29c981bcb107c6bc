"""License scans by template markup compiled to token automata.

A template is wording with two kinds of markup: ``[[ ... ]]`` is an optional
region (regions may nest), ``<<a..b>>`` a replaceable one that takes ``a`` to
``b`` words of any kind; all other words are mandatory. It is compiled to an
automaton over words, made deterministic as texts need it. A text has the
template's label if the automaton accepts a run of its consecutive words, that is
if its mandatory wording stands there exactly. Plain phrases are found as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: phrases and their labels ---
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# --- end of fixed values ---

# --- fixed values: wording of public licenses and of their usual notices ---
_NO_WARRANTY = """THIS SOFTWARE IS PROVIDED [[BY]] <<0..20>> "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<1..20>> BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: [[1.]] Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. [[2.]] Redistributions in binary form
must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice [[(including the next paragraph)]]
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<1..20>> BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit", "under the [[terms of the]] MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<1..20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""),
    ("bsd-2-clause", _BSD + " " + _NO_WARRANTY),
    ("bsd-3-clause", _BSD + """ [[3.]] Neither the name of <<1..20>> nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission. """
     + _NO_WARRANTY),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
<<1..4>> except in compliance with the License. You may obtain a copy of the License at
[[http://www.apache.org/licenses/LICENSE-2.0]] [[https://www.apache.org/licenses/LICENSE-2.0]] Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("apache-2.0", "under the [[terms of the]] Apache License [[Version]] 2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl-2.0", """under the terms of the GNU General Public License as published by the Free Software
Foundation; either version 2 of the License, or [[(at your option)]] any later version"""),
    ("gpl-2.0", "under the [[terms of the]] GNU General Public License [[either]] version 2"),
    ("gpl-3.0", """under the terms of the GNU General Public License as published by the Free Software
Foundation, either version 3 of the License, or [[(at your option)]] any later version"""),
    ("gpl-3.0", "under the [[terms of the]] GNU General Public License [[either]] version 3"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0 [[only]] [[or later]]"),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
[[If a copy of the MPL was not distributed with this file, You can obtain one at <<1..8>>]]"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free
to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by-4.0", "under [[a]] [[the]] [[Creative Commons Attribution <<0..2>> License]] CC BY 4.0"),
    ("cc-by-sa-4.0", "under [[a]] [[the]] [[Creative Commons Attribution-ShareAlike <<0..2>> License]] CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "under [[a]] [[the]] [[Creative Commons Attribution-NonCommercial <<0..2>> License]] CC BY-NC 4.0"),
]
# --- end of fixed values ---

#: Bytes that are no part of a word become blanks, A-Z become a-z.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))
_PART = re.compile(r"(\[\[|\]\]|<<\d+\.\.\d+>>)")
#: Remembered steps of an automaton; beyond it they are forgotten and found anew.
STEPS = 100_000


def words_of(text: str) -> list[bytes]:
    """Lower-cased maximal runs of digits, letters and characters beyond ASCII."""
    return text.encode().translate(_FOLD).split()


class Automaton:
    """The words' automaton of one template. States are sets of positions, held as
    bits; ``anchor`` is the mandatory wording that it begins with."""

    def __init__(self, template: str):
        self.words: list[bytes | None] = []  # of each position, None for any
        self.follow: list[int] = [0]  # positions after the start and after each position
        parts = iter(_PART.split(template))
        self.final = self._build(parts, {0})
        first = []
        while self.follow[len(first)] == 1 << len(first) and self.words[len(first)] is not None:
            first.append(self.words[len(first)])
            if len(first) in self.final:
                break
        if not first:
            raise ValueError("a template must begin with mandatory words")
        self.anchor = b" " + b" ".join(first) + b" "
        self.known = {w for w in self.words if w is not None}
        self.last = sum(1 << (p - 1) for p in self.final if p)
        self.steps: dict[tuple[int, bytes | None], int] = {}

    def _add(self, word: bytes | None, ends: set[int]) -> set[int]:
        self.words.append(word)
        self.follow.append(0)
        for e in ends:
            self.follow[e] |= 1 << (len(self.words) - 1)
        return {len(self.words)}

    def _build(self, parts: Iterator[str], ends: set[int], depth: int = 0) -> set[int]:
        """Positions after which the wording so far may end (0: none was read)."""
        for part in parts:
            if part == "[[":
                ends = ends | self._build(parts, ends, depth + 1)
            elif part == "]]":
                if not depth:
                    raise ValueError("a region ends that did not begin")
                return ends
            elif _PART.fullmatch(part):
                least, most = map(int, part[2:-2].split(".."))
                for i in range(most):
                    ends = self._add(None, ends) | (ends if i >= least else set())
            else:
                for word in words_of(part):
                    ends = self._add(word, ends)
        if depth:
            raise ValueError("a region does not end")
        return ends

    def step(self, state: int, word: bytes) -> int:
        """Positions reached from those of ``state`` (0 bits: dead) over a word."""
        key = (state, word if word in self.known else None)
        after = self.steps.get(key)
        if after is None:
            if len(self.steps) >= STEPS:
                self.steps.clear()
            reach, left = 0, state
            while left:
                low = left & -left
                reach |= self.follow[low.bit_length()]
                left ^= low
            after = self.steps[key] = self._only(reach, key[1])
        return after

    def _only(self, reach: int, word: bytes | None) -> int:
        after = 0
        while reach:
            low = reach & -reach
            want = self.words[low.bit_length() - 1]
            if want is None or want == word:
                after |= low
            reach ^= low
        return after

    def longest(self, words: list[bytes], start: int) -> int:
        """End of the longest run that is accepted from ``start`` on, or -1."""
        end, state = -1, self._only(self.follow[0], words[start] if words[start] in self.known else None)
        at = start
        while state:
            at += 1
            if state & self.last:
                end = at
            if at == len(words):
                break
            state = self.step(state, words[at])
        return end


def places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word places at which ``phrase`` (with a blank on both sides) stands in
    ``joined`` (words with blanks between and around); places may overlap."""
    at, word, seen = joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", seen, at)
        seen = at
        yield word
        at = joined.find(phrase, at + 1)


class Scanner:
    """Phrases and templates, compiled once in each Python worker."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.phrases = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in phrases.items()]
        self.automata = [(label, Automaton(t)) for label, t in templates]

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str]]]:
        """Number of words; (place, label) of each phrase; (start, end, label) of each
        template, leftmost, longest, and not overlapping within a template."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        base = sorted((place, label) for phrase, label in self.phrases for place in places(joined, phrase))
        found = []
        for label, automaton in self.automata:
            done = 0
            for place in places(joined, automaton.anchor):
                if place >= done and (end := automaton.longest(words, place)) >= 0:
                    found.append((place, end, label))
                    done = end
        return len(words), base, sorted(found)


_SCANNERS: dict[tuple, Scanner] = {}
_BASE = pa.list_(pa.struct([("place", pa.int64()), ("label", pa.string())]))
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))


def scan_licenses(text: Column, phrases: dict[str, str] | None = None,
                  templates: list[tuple[str, str]] | None = None) -> Column:
    """Struct (n_words, base, found) of a text: base has (place, label) of every
    phrase, found (start, end, label) of every accepted template; places count words
    from 0, ends are exclusive, both lists are sorted.

    Null and empty texts have no words and lists without entries. Texts are read
    whole: a text costs a search for each phrase and opening wording, and from each
    opening at most as many steps as the template has words. Rows are independent,
    so repeated rows agree; other columns are not read; tables may be empty.
    """
    # Templates travel as text; phrases of no words and templates that do not
    # begin with a mandatory word are refused here, before any task runs.
    phrases = tuple((PHRASES if phrases is None else phrases).items())
    templates = tuple(TEMPLATES if templates is None else templates)
    if not all(words_of(p) for p, _ in phrases):
        raise ValueError("a phrase has no words")
    Scanner(dict(phrases), list(templates))

    @F.arrow_udf("struct<n_words:long,base:array<struct<place:long,label:string>>,"
                 "found:array<struct<start:long,end:long,label:string>>>")
    def run(texts: pa.Array) -> pa.Array:
        scanner = _SCANNERS.setdefault((phrases, templates), None) or Scanner(dict(phrases), list(templates))
        _SCANNERS[(phrases, templates)] = scanner
        seen = [scanner.scan(t.as_py() or "") for t in texts]
        return pa.StructArray.from_arrays([
            pa.array([s[0] for s in seen], pa.int64()),
            pa.array([[{"place": p, "label": x} for p, x in s[1]] for s in seen], _BASE),
            pa.array([[{"start": a, "end": b, "label": x} for a, b, x in s[2]] for s in seen], _FOUND),
        ], ["n_words", "base", "found"])

    return run(text)

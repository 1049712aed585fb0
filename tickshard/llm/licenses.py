"""License scans: templates with optional and replaceable regions, as word automata.

A template is license wording with markup: ``<<optional>> ... <</optional>>`` around words
that may be missing, and ``<<var match="...">>`` for words that may be replaced, whose
text must match the given pattern as a whole. A template compiles into a non-deterministic
automaton over words; it accepts a stretch of text when all mandatory words stand there in
order and what stands between them fits the regions. ``.+`` is a state that loops over words
of any number; other patterns are read word by word as long as more words could still match.
Case, punctuation and white space don't count. Automata only start at words that can begin a
template, in texts that hold one of its rare words.

Licenses stand with their whole mandatory wording; notices that name a license are templates
of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tickshard.llm.words import ALNUM, Words, portions

# The base phrases and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Wording of licenses and of the notices that point at them.
_BSD_OPENING = (
    'redistribution and use in source and binary forms with or without modification are '
    'permitted provided that the following conditions are met <<optional>>1<</optional>> '
    'redistributions of source code must retain the above copyright notice this list of '
    'conditions and the following disclaimer <<optional>>2<</optional>> redistributions in '
    'binary form must reproduce the above copyright notice this list of conditions and the '
    'following disclaimer in the documentation and or other materials provided with the '
    'distribution '
)
_BSD_END = (
    'this software is provided by <<var match=".+">> as is and any express or implied warranties '
    'including but not limited to the implied warranties of merchantability and fitness for a '
    'particular purpose are disclaimed in no event shall <<var match=".+">> be liable for any '
    'direct indirect incidental special exemplary or consequential damages including but not '
    'limited to procurement of substitute goods or services loss of use data or profits or '
    'business interruption however caused and on any theory of liability whether in contract '
    'strict liability or tort including negligence or otherwise arising in any way out of the '
    'use of this software even if advised of the possibility of such damage'
)
TEMPLATES = {
    "mit": [
        'released under the <<optional>>terms of the<</optional>> mit license',
        'licensed under the <<optional>>terms of the<</optional>> mit license',
        'this <<var match="(software|project|work|code|file|program|library|package)">> is '
        '<<optional>>released<</optional>> <<optional>>licensed<</optional>> under the '
        '<<optional>>terms of the<</optional>> mit license',
        'spdx license identifier mit',
        'permission is hereby granted free of charge to any person obtaining a copy of '
        '<<var match=".+">> and associated documentation files the software to deal in the '
        'software without restriction including without limitation the rights to use copy '
        'modify merge publish distribute sublicense and or sell copies of the software and to '
        'permit persons to whom the software is furnished to do so subject to the following '
        'conditions the above copyright notice and this permission notice '
        '<<optional>>including the next paragraph<</optional>> shall be included in all copies '
        'or substantial portions of the software '
        'the software is provided as is without warranty of any kind express or implied '
        'including but not limited to the warranties of merchantability fitness for a '
        'particular purpose and noninfringement in no event shall <<var match=".+">> be liable '
        'for any claim damages or other liability whether in an action of contract tort or '
        'otherwise arising from out of or in connection with the software or the use or other '
        'dealings in the software',
    ],
    "apache": [
        'licensed under the apache license <<optional>>version 2 0<</optional>> '
        '<<optional>>the license<</optional>>',
        'released under the apache license <<optional>>version 2 0<</optional>>',
        'spdx license identifier apache 2 0',
        'licensed under the apache license version 2 0 the license you may not use this '
        '<<var match="(file|work|software)">> except in compliance with the license you may '
        'obtain a copy of the license at <<var match=".+">> unless required by applicable law or '
        'agreed to in writing software distributed under the license is distributed on an as is '
        'basis without warranties or conditions of any kind either express or implied see the '
        'license for the specific language governing permissions and limitations under the license',
    ],
    "gpl": [
        'this <<var match="[^ ]+( [^ ]+){0,10}">> is licensed under the <<optional>>terms of the<</optional>> gnu '
        '<<optional>>lesser<</optional>> <<optional>>affero<</optional>> general public license '
        '<<optional>>version <<var match="[1-3]( [01])?">><</optional>> '
        '<<optional>>or <<var match="(later|any later version)">><</optional>>',
        'this program is free software you can redistribute it and or modify it under the terms '
        'of the gnu general public license as published by the free software foundation either '
        'version <<var match="[1-3]">> of the license or at your option any later version this '
        'program is distributed in the hope that it will be useful but without any warranty '
        'without even the implied warranty of merchantability or fitness for a particular purpose '
        'see the gnu general public license for more details',
        'spdx license identifier <<var match="(a|l)?gpl">>',
    ],
    "cc-by": [
        'licensed under <<optional>>a<</optional>> <<optional>>the<</optional>> cc by '
        '<<optional>>4 0<</optional>>',
    ],
    "cc-by-nc": [
        'licensed under <<optional>>a<</optional>> <<optional>>the<</optional>> cc by nc '
        '<<optional>>4 0<</optional>>',
    ],
    "cc-by-sa": [
        'licensed under <<optional>>a<</optional>> <<optional>>the<</optional>> cc by sa '
        '<<optional>>4 0<</optional>>',
    ],
    "bsd-2-clause": [
        _BSD_OPENING + _BSD_END,
        'spdx license identifier bsd 2 clause',
    ],
    "bsd-3-clause": [
        _BSD_OPENING + '<<optional>>3<</optional>> neither the name of <<var match=".+">> nor the '
        'names of <<var match=".+">> may be used to endorse or promote products derived from this '
        'software without specific prior written permission ' + _BSD_END,
        'spdx license identifier bsd 3 clause',
    ],
    "isc": [
        'permission to use copy modify and or distribute this software for any purpose with or '
        'without fee is hereby granted provided that the above copyright notice and this '
        'permission notice appear in all copies '
        'the software is provided as is and <<var match=".+">> disclaims all warranties with '
        'regard to this software including all implied warranties of merchantability and fitness '
        'in no event shall <<var match=".+">> be liable for any special direct indirect or '
        'consequential damages or any damages whatsoever resulting from loss of use data or '
        'profits whether in an action of contract negligence or other tortious action arising out '
        'of or in connection with the use or performance of this software',
    ],
}

_MARKUP = re.compile(r'<<(/?optional|var match="[^"]*")>>')
_WORDS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@dataclass
class Automaton:
    """States are numbers; state ``last`` accepts."""

    step: dict[int, list[tuple[str, int]]] = field(default_factory=dict)
    free: dict[int, list[int]] = field(default_factory=dict)
    replace: dict[int, list[tuple[regex.Pattern, int]]] = field(default_factory=dict)
    #: States that take any word and stay.
    loops: set[int] = field(default_factory=set)
    #: States that take any word and go to the loop after them.
    enter: set[int] = field(default_factory=set)
    last: int = 0
    mandatory: list[str] = field(default_factory=list)

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free.get(todo.pop(), ()):
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def openings(self) -> set[str] | None:
        """Words that can begin a match; None if any word can."""
        start = self.closure({0})
        if any(s in self.replace or s in self.enter for s in start):
            return None
        return {w for s in start for w, _ in self.step.get(s, ())}

    def match(self, words: list[str], at: int, hopeless: set[int] | None = None) -> int:
        """Where the match that begins at word *at* ends, or -1.

        Of several ends the last is taken, but words that loop end with the first wording
        that follows them. *hopeless* collects loops that were entered and led nowhere: to
        enter them later in the same text is no use.
        """
        now, end, i = self.closure({0}), -1, at
        waiting: dict[int, set[int]] = {}
        hopeless, entered = set() if hopeless is None else hopeless, set()
        while now or waiting:
            for s in now:
                for pattern, to in self.replace.get(s, ()):
                    for stop in _stretches(pattern, words, i):
                        waiting.setdefault(stop, set()).add(to)
            if self.last in now:
                end = i
            if i == len(words):
                break
            after = {to for s in now for w, to in self.step.get(s, ()) if w == words[i]}
            looping = {s for s in now if s in self.loops} if end < 0 else set()
            fresh = {s + 1 for s in now if s in self.enter} - hopeless
            entered |= fresh
            i += 1
            now = self.closure(after | looping | fresh | waiting.pop(i, set()))
        if end < 0:
            hopeless |= entered
        return end


def _stretches(pattern: regex.Pattern, words: list[str], at: int) -> Iterator[int]:
    """Ends of the stretches of words from *at* that match; as long as one still can."""
    text = ""
    for stop in range(at + 1, len(words) + 1):
        text = f"{text} {words[stop - 1]}" if text else words[stop - 1]
        found = pattern.fullmatch(text, partial=True)
        if found is None:
            break
        if not found.partial:
            yield stop
        elif pattern.fullmatch(text):
            yield stop


def compile_template(text: str) -> Automaton:
    """The automaton of a template; optional regions may be nested."""
    made = Automaton()
    state, opened = 0, []
    for i, part in enumerate(_MARKUP.split(text)):
        if i % 2 == 0:
            for word in _WORDS.findall(lowered(part)):
                made.step.setdefault(state, []).append((word, state + 1))
                if not opened:
                    made.mandatory.append(word)
                state += 1
        elif part == "optional":
            made.free.setdefault(state, []).append(state + 1)
            state += 1
            opened.append(state)
        elif part == "/optional":
            begin = opened.pop()
            made.free.setdefault(begin, []).append(state + 1)
            made.free.setdefault(state, []).append(state + 1)
            state += 1
        else:
            pattern = part.removeprefix('var match="').removesuffix('"')
            if pattern == ".+":
                made.enter.add(state)
                made.loops.add(state + 1)
                made.free.setdefault(state + 1, []).append(state + 2)
                state += 2
            else:
                made.replace.setdefault(state, []).append((regex.compile(pattern), state + 1))
                state += 1
    if opened:
        raise ValueError("an optional region is not closed")
    made.last = state
    return made


def lowered(text: str) -> str:
    """A-Z in lower case, and nothing else changed."""
    return text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


class Scanner:
    """Compiled templates and the words that say which texts and places to look at."""

    def __init__(self, templates: dict[str, list[str]], base: dict[str, str]):
        self.automata = [(label, compile_template(t)) for label, ts in templates.items() for t in ts]
        self.base = [(phrase.split(), label) for phrase, label in base.items()]
        rare = {"license", "licensed", "permission", "redistribution", "warranties"}
        self.anchors = sorted(
            {
                next((w for w in a.mandatory if w in rare), max(a.mandatory, key=len))
                for _, a in self.automata
            }
            | {p[0] for p, _ in self.base}
        )
        self.openings: dict[str, list[tuple[str, Automaton]]] = {}
        for label, automaton in self.automata:
            for word in automaton.openings() or ():
                self.openings.setdefault(word, []).append((label, automaton))
        self.anywhere = [(n, a) for n, a in self.automata if a.openings() is None]
        self.anchor_hashes = np.sort(Words(self.anchors, ALNUM).hashes())

    def scan(self, words: list[str]) -> tuple[list[tuple[int, str]], list[tuple[int, int, str]]]:
        """Base places (start, label) and matched stretches (start, end, label) of templates."""
        base = [
            (i, label)
            for phrase, label in self.base
            for i, w in enumerate(words)
            if w == phrase[0] and words[i : i + len(phrase)] == phrase
        ]
        matched = []
        after: dict[int, int] = {}  # where a template's last match ended
        hopeless: dict[int, set[int]] = {}
        for i, word in enumerate(words):
            for label, automaton in (*self.openings.get(word, ()), *self.anywhere):
                if i < after.get(id(automaton), 0):
                    continue
                end = automaton.match(words, i, hopeless.setdefault(id(automaton), set()))
                if end >= 0:
                    after[id(automaton)] = end
                    matched.append((i, end, label))
        return base, matched


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    base: dict[str, str] = BASE,
) -> DataFrame:
    """Base phrases and matched templates in every text of *docs* (doc_id, text).

    doc_id, n_words, n_base (places of all phrases), first_word and last_word (NULL without
    a place), base_labels, labels (distinct, sorted, comma-joined; empty if none), spans
    (label:start:end in words, end exclusive) and score: the share of the words that
    belong to a phrase or a match. Matches of one template do not overlap. A template that ends inside a longer match of another
    label (``CC BY`` in ``CC BY NC``) gives no label. NULL texts count as empty; one row per
    row, whatever its id; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((templates, base))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    names += ["score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*shared.value)
        lengths = {label: len(phrase) for phrase, label in scanner.base}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in portions(texts):
                words = Words(texts[part], ALNUM)
                counts = words.counts().tolist()
                anchored = np.isin(words.hashes(), scanner.anchor_hashes)
                held = np.add.reduceat(np.append(anchored, False), words.first[:-1]) > 0
                held &= np.diff(words.first) > 0
                rows = []
                for i, n in enumerate(counts):
                    if not held[i]:
                        rows.append((n, 0, None, None, "", "", 0.0, ""))
                        continue
                    low, high = int(words.first[i]), int(words.first[i + 1])
                    text = [
                        words.raw[a:b].decode("utf-8", "surrogatepass")
                        for a, b in zip(words.starts[low:high].tolist(), words.ends[low:high].tolist())
                    ]
                    rows.append(_row(n, *scanner.scan(text), lengths))
                columns = list(zip(*rows)) if rows else [()] * 8
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[part.start : part.stop],
                        *(pa.array(c, t) for c, t in zip(columns, kinds)),
                    ],
                    names=names,
                )

    fields = (
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, spans string"
    )
    return docs.select("doc_id", "text").mapInArrow(run, fields)


def _row(n: int, base: list, matched: list, lengths: dict[str, int]) -> tuple:
    whole = [
        (s, e, label)
        for s, e, label in matched
        if not any(a <= s and e <= b and e - s < b - a and other != label for a, b, other in matched)
    ]
    starts = [s for s, _ in base]
    covered = {w for s, label in base for w in range(s, s + lengths[label])}
    covered |= {w for s, e, _ in whole for w in range(s, e)}
    base_labels = sorted({label for _, label in base})
    labels = sorted({*base_labels, *(label for _, _, label in whole)})
    return (
        n,
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(base_labels),
        ",".join(labels),
        len(covered) / n,
        ",".join(f"{label}:{s}:{e}" for s, e, label in sorted(whole)),
    )

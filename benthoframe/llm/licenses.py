"""Licence scans: matching statistics from a generalised suffix automaton of licence tokens, chained into covered spans.

The automaton holds the word sequences of all templates. A text is streamed through it word by word; the length of the longest
suffix seen so far that occurs in a template is its matching statistic. Where that length stops growing, a maximal match ends. Maximal matches of
at least `least` words are chained per template in ascending order of both positions, and a template whose words the best chain
covers by the share `covered` labels the text. Fixed phrases are found beside it.

Defined results: null text is empty: no words, no label, score 0. Repeated rows give equal results; extra columns are not
read; templates that share a span are all chained.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices of public licences, by label.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]

#: Words of all templates together.
MAX_WORDS = 500_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Words of ASCII letters and digits and of everything beyond ASCII, with A-Z in lower case."""
    return _WORD.findall(text.encode().lower())


class Automaton:
    """Generalised suffix automaton of word sequences; a state keeps one end (template, position) for each template it is in."""

    def __init__(self, templates: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]
        for t, words in enumerate(templates):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].setdefault(t, []).append(i + 1)
        # what ends in a state ends in all its suffixes too
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.ends[self.link[s]]
            for t, at in self.ends[s].items():
                up.setdefault(t, []).extend(at)
        self.ends[0] = {}
        self.ends = [{t: sorted(set(at)) for t, at in e.items()} for e in self.ends]

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.length) - 1

    def _clone(self, p: int, q: int, w: bytes) -> int:
        made = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = made
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = made
            p = self.link[p]
        return made

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
        made, p = self._state(self.length[last] + 1, 0, {}), last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = made
            p = self.link[p]
        if p != -1:
            q = self.next[p][w]
            self.link[made] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return made

    def matches(self, words: list[bytes], least: int) -> list[tuple[int, int, int]]:
        """Maximal matches of at least `least` words: (end in the text, length, state)."""
        out, state, size = [], 0, 0
        following, link, length = self.next, self.link, self.length
        root = following[0]
        for i, w in enumerate(words):
            if state == 0:
                state = root.get(w, 0)
                size = 1 if state else 0
                continue
            to = following[state].get(w)
            if to is not None:
                state, size = to, size + 1
                continue
            if size >= least:
                out.append((i, size, state))
            while state and w not in following[state]:
                state = link[state]
                size = length[state]
            to = following[state].get(w)
            state, size = (to, size + 1) if to is not None else (0, 0)
        if size >= least:
            out.append((len(words), size, state))
        return out


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, least: int = 3, covered: float = 0.8):
        self.phrases = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in phrases.items()]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(words_of(t)) for _, t in templates]
        self.automaton = Automaton([words_of(t) for _, t in templates])
        self.least, self.covered = least, covered

    def base(self, words: list[bytes]) -> tuple[int, int | None, int | None, list[str]]:
        """Number of places of the phrases, their least and largest first word, and the labels found."""
        line, at, labels = b" " + b" ".join(words) + b" ", [], set()
        for phrase, label in self.phrases:
            here = line.find(phrase)
            while here >= 0:
                at.append(here)
                labels.add(label)
                here = line.find(phrase, here + 1)
        first, last = (line.count(b" ", 0, x) for x in (min(at), max(at))) if at else (None, None)
        return len(at), first, last, sorted(labels)

    def spans(self, words: list[bytes]) -> list[tuple[str, float, int, int]]:
        """(label, share of the template covered, first word, end word) of every template reached by a chain."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for end, size, state in self.automaton.matches(words, self.least):
            for t, ends in self.automaton.ends[state].items():
                by.setdefault(t, []).extend((end, at, size) for at in ends)
        out = []
        for t, found in by.items():
            covered, first, end = best_chain(found, self.sizes[t])
            out.append((self.labels[t], covered / self.sizes[t], first, end))
        return out

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        n, first, last, base = self.base(words)
        spans = self.spans(words)
        found = [s for s in spans if s[1] >= self.covered]
        score = max([1.0 if n else 0.0, *(s[1] for s in spans)])
        labels = ",".join(sorted({*base, *(s[0] for s in found)}))
        return len(words), n, first, last, ",".join(base), labels, min(1.0, score), [{"label": a, "covered": b, "first": c, "end": d} for a, b, c, d in sorted(found)]


def best_chain(found: list[tuple[int, int, int]], template: int, slack: int = 2) -> tuple[int, int, int]:
    """Most template words that matches (text end, template end, words) cover in ascending order of both, and their text span.

    A chain ends where the text has over `slack` times the template's words since its first match, so far-off matches don't
    add up. Of the chains that end in a match those are kept that begin later or cover more than every other: only they can
    be the best of a longer chain. A match looks at the kept chains that began within the window before it, so the cost is
    matches times chains of one window, whose number depends on the template and not on the text.
    """
    best, window = (0, 0, 0), slack * template
    kept: list[tuple[int, int, int, int]] = []  # template end, text end, covered words, first word
    for text_end, template_end, size in sorted(found):
        kept = [c for c in kept if text_end - c[3] <= window]
        by_first = {text_end - size: size}
        for before, end, covered, first in kept:
            fresh = min(size, template_end - before, text_end - end)
            if fresh > 0 and covered + fresh > by_first.get(first, 0):
                by_first[first] = covered + fresh
        most = 0
        for first in sorted(by_first, reverse=True):
            if by_first[first] > most:
                most = by_first[first]
                kept.append((template_end, text_end, most, first))
                if most > best[0]:
                    best = (most, first, text_end)
    return best


_scanners: dict[bytes, Scanner] = {}


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, least: int = 3, covered: float = 0.8) -> DataFrame:
    """doc_id, counts and places of the phrases, labels, score and covered template spans of every row.

    `templates` are (label, text): notices as they stand in files, or whole licences. They go to every task in an automaton, so
    more than `MAX_WORDS` words are refused.
    """
    if sum(len(words_of(text)) for _, text in templates) > MAX_WORDS:
        raise ValueError(f"The templates have over {MAX_WORDS} words.")
    settings = (phrases, templates, least, covered)
    name = hashlib.sha256(repr(settings).encode()).digest()
    named = [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("covered", pa.float64()), ("first", pa.int64()), ("end", pa.int64())]))),
    ]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _scanners:
            _scanners[name] = Scanner(*settings)
        for batch in batches:
            rows = [_scanners[name].scan(t.as_py() or "") for t in batch.column("text")]
            columns = list(zip(*rows)) or [()] * (len(named) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, (_, t) in zip(columns, named[1:]))], schema=pa.schema(named))

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label:string,covered:double,first:long,end:long>>"
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema)

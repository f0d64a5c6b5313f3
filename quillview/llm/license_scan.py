"""Licence scans: matching statistics over a generalised suffix automaton of licence tokens.

The automaton is built once over the word sequences of all templates. A text is streamed through
it word by word; at each word the state holds the longest run of words, ending there, that occurs
in some template. Runs that no longer word extends are the maximal matches. In those of at least
``min_words`` words, each template's own matches are placed and the heaviest chain of them, rising in
text and template, is its cover; a template is reported once that is enough of it, those of under ten
words only whole. Templates are whole licence texts (``licences/``), notices, and names of licences with
their versions, made by rule. Of templates that share most words (GPL and LGPL notices, BSD licences) one
gives way to another that explains more of the same words of the text. Short phrases (the base labels) are found by
the same pass: a phrase stands at a place exactly when the automaton, at the phrase's last word, is
in a state whose longest suffix chain contains the phrase.

Words are maximal runs of ASCII letters, ASCII digits and non-ASCII characters, after A-Z are
lower-cased.

Defined results: a null or empty text has no words, no places, empty labels and score 0. Null ids
pass through. Rows are independent, so repeated rows give repeated results and order does not
matter; an empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

# Phrases with their labels, then notices and sentences, names, whole licences.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation"
    ),
    "lgpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation"
    ),
    "agpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation"
    ),
    "apache-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}
# Names of licences with their versions: kind, name, versions; and of Creative Commons, written short and long.
NAMES = (
    ("gpl", "GNU General Public License", ("1", "2", "3")),
    ("lgpl", "GNU Library General Public License", ("2",)),
    ("lgpl", "GNU Lesser General Public License", ("2.1", "3")),
    ("agpl", "GNU Affero General Public License", ("1", "3")),
    ("gfdl", "GNU Free Documentation License", ("1.1", "1.2", "1.3")),
    ("apache", "Apache License", ("1.0", "1.1", "2.0")),
    ("mpl", "Mozilla Public License", ("1.0", "1.1", "2.0")),
    ("epl", "Eclipse Public License", ("1.0", "2.0")),
    ("eupl", "European Union Public Licence", ("1.0", "1.1", "1.2")),
)
COMMONS = {"": "", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives", "NC-SA": "NonCommercial-ShareAlike", "NC-ND": "NonCommercial-NoDerivatives"}


def named_templates() -> dict[str, list[str]]:
    """label -> how the licence's name and version are written."""
    out: dict[str, list[str]] = {}
    for kind, name, versions in NAMES:
        for v in versions:
            label = f"{kind}-{v if '.' in v else v + '.0'}"
            out.setdefault(label, []).extend([f"{name}, version {v}", f"{name} {v}", f"{name} v{v}"])
    for short, long in COMMONS.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            label = "-".join(filter(None, ("cc-by", short.lower(), v)))
            out[label] = [f"CC {'-'.join(filter(None, ('BY', short)))} {v}", f"Creative Commons {'-'.join(filter(None, ('Attribution', long)))} {v}"]
    return out


#: Templates under this many words are names and numbers: nothing of them may be missing.
SHORT = 10
#: Licences in ``licences/``, without copyright lines; their labels end in ``-whole-text``.
WHOLE = (
    "0bsd", "apache-2.0", "artistic-1.0", "bsd-2-clause", "bsd-3-clause", "cc0-1.0", "gfdl-1.2", "gfdl-1.3", "gpl-1.0", "gpl-2.0", "gpl-3.0",
    "isc", "lgpl-2.0", "lgpl-2.1", "lgpl-3.0", "mit", "mpl-1.1", "mpl-2.0", "unicode-3.0", "unlicense", "zlib",
)
for _label, _written in named_templates().items():
    for _k, _text in enumerate(_written):  # trailing spaces tell ways of writing apart, a label has none
        TEMPLATES[f"{_label}{' ' * _k}"] = _text
for _name in WHOLE:
    TEMPLATES[f"{_name}-whole-text"] = resources.files(__package__).joinpath("licences", f"{_name}.txt").read_text("utf-8")
#: Bytes that separate words, and A-Z, go through one translation table.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word numbers."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, word: int) -> int:
        """The state for ``at`` followed by ``word``, cloned if it also stands for longer runs."""
        to = self.next[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        clone = self._new(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = clone
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            state, at = self._new(self.length[last] + 1, {}, 0), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = state
                at = self.link[at]
            if at >= 0:
                self.link[state] = self._split(at, word)
            last = state

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """One word of a text: the new state and the matching statistic there."""
        while word not in self.next[state]:
            if state == 0:
                return 0, 0
            state = self.link[state]
            length = self.length[state]
        return self.next[state][word], length + 1

    def walk(self, sequence: list[int]) -> int:
        state = 0
        for word in sequence:
            state = self.next[state][word]
        return state


SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("label", pa.string())])
Span = tuple[int, int, int, str]  # first word, word after the last, words covered, label


class Scanner:
    """Templates and phrases compiled for scanning; holds nothing that grows with the corpus."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str], min_words: int, min_cover: float) -> None:
        self.min_words, self.min_cover = min_words, min_cover
        self.vocabulary: dict[bytes, int] = {}
        number = lambda text: [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text.encode())]
        self.phrases = [(number(p), label) for p, label in phrases.items()]
        self.templates = [(label.rstrip(), number(t)) for label, t in templates.items()]
        self.machine = SuffixAutomaton()
        for sequence in [p for p, _ in self.phrases] + [t for _, t in self.templates]:
            self.machine.add(sequence)
        # A phrase ends wherever its state lies on the suffix chain of the current state.
        self.ends: list[list[int]] = [[] for _ in self.machine.next]
        for k, (sequence, _) in enumerate(self.phrases):
            self.ends[self.machine.walk(sequence)].append(k)
        order = sorted(range(1, len(self.machine.next)), key=self.machine.length.__getitem__)
        self.chain: list[list[int]] = [[] for _ in self.machine.next]
        for s in order:
            self.chain[s] = self.ends[s] + self.chain[self.machine.link[s]]
        # Where runs of each template start, by their first words, to place long matches.
        self.places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for t, (_, sequence) in enumerate(self.templates):
            for i in range(len(sequence) - min_words + 1):
                self.places.setdefault(tuple(sequence[i : i + min_words]), []).append((t, i))

    def scan(self, text: bytes) -> tuple[int, int, int | None, int | None, list[str], list[str], float, list[Span]]:
        found = words(text)
        get = self.vocabulary.get
        ids = [get(w, -1) for w in found]
        hits: list[tuple[int, int]] = []  # start of a phrase, which phrase
        runs: list[tuple[int, int]] = []  # maximal matches: start, length
        step, chain = self.machine.step, self.chain
        state = length = 0
        for i, word in enumerate(ids):
            if word < 0:
                if length >= self.min_words:
                    runs.append((i - length, length))
                state = length = 0
                continue
            before = length
            state, length = step(state, length, word)
            if before >= self.min_words and length <= before:
                runs.append((i - before, before))
            for k in chain[state] if length > 1 else ():
                size = len(self.phrases[k][0])
                if size <= length:
                    hits.append((i - size + 1, k))
        if length >= self.min_words:
            runs.append((len(ids) - length, length))
        chains = self.chains(ids, runs)
        cover = {t: sum(size for _, size in c) / len(self.templates[t][1]) for t, c in chains.items()}
        base = sorted({self.phrases[k][1] for _, k in hits})
        enough = lambda t: cover[t] >= (1.0 if len(self.templates[t][1]) < SHORT else self.min_cover)
        chosen = self.best({t: c for t, c in chains.items() if enough(t)}, cover)
        own = {self.templates[t][0] for t in chosen}
        spans = sorted((chains[t][0][0], sum(chains[t][-1]), sum(size for _, size in chains[t]), self.templates[t][0]) for t in chosen)
        score = max([*cover.values(), 1.0 if hits else 0.0, 0.0])
        starts = [s for s, _ in hits]
        return len(ids), len(hits), min(starts, default=None), max(starts, default=None), base, sorted(own | set(base)), min(1.0, score), spans

    def chains(self, ids: list[int], runs: list[tuple[int, int]]) -> dict[int, list[tuple[int, int]]]:
        """For each template met, its heaviest chain of matches: start in the text and size."""
        matches: dict[int, list[tuple[int, int, int]]] = {}
        least, done = self.min_words, 0
        for start, length in runs:
            end = start + length - least + 1
            for j in range(max(start, done), end):
                for t, i in self.places.get(tuple(ids[j : j + least]), ()):
                    template = self.templates[t][1]
                    if i and j and template[i - 1] == ids[j - 1]:
                        continue  # part of the match that starts a word earlier
                    size = least
                    while i + size < len(template) and j + size < len(ids) and template[i + size] == ids[j + size]:
                        size += 1
                    matches.setdefault(t, []).append((j, i, size))
            done = max(done, end)
        return {t: self.heaviest(found, len(self.templates[t][1])) for t, found in matches.items()}

    @staticmethod
    def heaviest(found: list[tuple[int, int, int]], length: int) -> list[tuple[int, int]]:
        """The chain of most words in which each match starts after the one before, in text and template."""
        if len(found) == 1:
            return [(found[0][0], found[0][2])]
        found.sort()
        tree: list[tuple[int, int]] = [(0, -1)] * (length + 1)  # most words of a chain, its last match, by its end in the template
        before: list[int] = []
        ended: list[tuple[int, int, int, int]] = []
        best = (0, -1)
        for k, (start, i, size) in enumerate(found):
            while ended and ended[0][0] <= start:
                _, at, total, which = heapq.heappop(ended)
                while at <= length:
                    if tree[at][0] < total:
                        tree[at] = (total, which)
                    at += at & -at
            top, at = (0, -1), i
            while at > 0:
                top = max(top, tree[at])
                at -= at & -at
            before.append(top[1])
            heapq.heappush(ended, (start + size, i + size, top[0] + size, k))
            best = max(best, (top[0] + size, k))
        chain, k = [], best[1]
        while k >= 0:
            chain.append((found[k][0], found[k][2]))
            k = before[k]
        return chain[::-1]

    @staticmethod
    def best(chains: dict[int, list[tuple[int, int]]], cover: dict[int, float]) -> list[int]:
        """Templates that no other explains better: with more words of their stretch of the text, or as many and more cover.

        A template that stands in the text whole and in one piece gives way to none.
        """

        def loses(a: int, b: int) -> bool:
            if len(chains[a]) == 1 and cover[a] == 1.0:
                return False
            start, end = chains[a][0][0], sum(chains[a][-1])
            mine = sum(size for _, size in chains[a])
            other = sum(max(0, min(end, s + size) - max(start, s)) for s, size in chains[b])
            return other > mine or (other == mine and cover[b] > cover[a])

        return [a for a in chains if not any(a != b and loses(a, b) for b in chains)]


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    min_words: int = 3,
    min_cover: float = 0.8,
) -> DataFrame:
    """One row per input row: word count, base hits, labels, the best template coverage and the ``spans`` of the
    text that templates cover: first word, word after the last, words covered between them, label.

    ``min_words``: least length of a match that takes part in a chain; ``min_cover``: share of a
    template that a chain must cover for the template's label. Both hold for texts of any length.
    """
    built: list[Scanner] = []

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not built:
            built.append(Scanner(phrases, templates, min_words, min_cover))
        rows = [built[0].scan(t or b"") for t in common.utf8(batch.column(1))]
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *(pa.array(c, pa.int64()) for c in cols[:4]),
                *(pa.array([",".join(x) for x in c], pa.string()) for c in cols[4:6]),
                pa.array(cols[6], pa.float64()),
                pa.array([[dict(zip(("first", "end", "covered", "label"), x, strict=True)) for x in c] for c in cols[7]], pa.list_(SPAN)),
            ],
            names=[id_column, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
        )

    kind = docs.schema[id_column].dataType.simpleString()
    return common.map_rows(
        docs.select(id_column, docs[text_column].cast("string").alias("text")),
        one,
        f"{id_column} {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<first:bigint,end:bigint,covered:bigint,label:string>>",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(common.table(spark, sf_dir, "documents"))

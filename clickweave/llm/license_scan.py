"""Licence notices in texts, found with one suffix automaton over the words of all templates.

The automaton holds every stretch of words of every template. A text is streamed through it once, which gives at each
word the longest stretch ending there that some template has (the matching statistics). Whole phrases are places at
which that stretch ends in the phrase. Stretches that cannot be extended and have enough words are chained, for each template on
its own, where they go on in the same order with little in between; a chain that covers enough of its template is a span.

Words are runs of letters, digits and bytes beyond ASCII, with A-Z lower-cased.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import bound_batches, column, free_name

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices in common use, by label. Each is a template; punctuation and case do not matter.
TEMPLATES = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
        " Public License as published by the Free Software Foundation",
        "licensed under the GNU Affero General Public License",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
        "released under the BSD License",
        "licensed under the BSD License",
    ),
    "cc-by": ("licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-nc": (
        "licensed under CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc-by-sa": (
        "licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc0": ("to the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version",
        "licensed under the GNU General Public License, version 3",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "lgpl": ("licensed under the GNU Lesser General Public License",),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
        "released under the MIT License",
        "licensed under the MIT License",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
}

#: Words of all templates together at most: every task builds the automaton.
MOST_WORDS = 200_000
#: Bytes of a text that are cut into words at a time.
BLOCK = 1 << 20

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
OTHER = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, a block at a time."""
    data, at = (text or "").encode(errors="replace"), 0
    while at < len(data):
        cut = OTHER.search(data, at + BLOCK)
        end = cut.start() if cut else len(data)
        yield WORD.findall(data[at:end].lower())
        at = end


def words_of(text: str) -> list[bytes]:
    return [w for block in word_blocks(text) for w in block]


class Automaton:
    """Suffix automaton of several word sequences, with the places at which the stretches of a state end."""

    def __init__(self, templates: Sequence[Sequence[bytes]], phrases: Mapping[tuple[bytes, ...], str]):
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [[self.number.setdefault(w, len(self.number)) for w in t] for t in (*templates, *phrases)]
        for sequence in coded:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.marks: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for t, sequence in enumerate(coded[: len(templates)]):
            state = 0
            for end, word in enumerate(sequence, 1):
                state = self.next[state][word]
                self.marks[state].append((t, end))
        self.children: list[list[int]] = [[] for _ in self.next]
        for state, link in enumerate(self.link[1:], 1):
            self.children[link].append(state)
        self.known_places: dict[int, list[tuple[int, int]]] = {}
        #: For each state, words and label of the phrases that its longest stretch ends in.
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(self.next)
        for sequence, label in zip(coded[len(templates) :], phrases.values()):
            state = 0
            for word in sequence:
                state = self.next[state][word]
            self.phrases[state] += ((len(sequence), label),)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.phrases[state] += self.phrases[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        """The state of the sequence read so far and ``word``; stretches that are there already are shared."""
        if word in self.next[last]:
            return self._own_state(last, word)
        state = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._own_state(last, word)
        return state

    def _own_state(self, last: int, word: int) -> int:
        """The state whose longest stretch is that of ``last`` and ``word``, split off a larger one if need be."""
        whole = self.next[last][word]
        if self.length[whole] == self.length[last] + 1:
            return whole
        own = self._state(self.length[last] + 1, dict(self.next[whole]), self.link[whole])
        self.link[whole] = own
        while last >= 0 and self.next[last].get(word) == whole:
            self.next[last][word] = own
            last = self.link[last]
        return own

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def places(self, state: int) -> list[tuple[int, int]]:
        """(template, end) of every place in the templates at which the state's stretches end."""
        found = self.known_places.get(state)
        if found is None:
            found, open_states = [], [state]
            while open_states:
                s = open_states.pop()
                found += self.marks[s]
                open_states += self.children[s]
            found.sort()
            self.known_places[state] = found
        return found


class Chains:
    """Chains of stretches in one text for every template, kept while they can still go on."""

    def __init__(self, sizes: Sequence[int], least_coverage: float, most_gap: int):
        self.sizes, self.least_coverage, self.most_gap = sizes, least_coverage, most_gap
        #: For each template (end in the text, end in the template, words covered, start in the text), by end in the text.
        self.open: dict[int, deque[tuple[int, int, int, int]]] = {}
        self.pending: dict[int, tuple[int, int, int]] = {}
        self.spans: list[tuple[int, int, int, int]] = []
        self.best = 0.0

    def add(self, start: int, size: int, places: list[tuple[int, int]]) -> None:
        """A stretch of the text, and where it ends in the templates. Stretches come in the order of their ends."""
        fresh: dict[int, list[tuple[int, int, int, int]]] = {}
        for template, end in places:
            chains = self.open.setdefault(template, deque())
            while chains and chains[0][0] + self.most_gap < start:
                self._close(template, chains.popleft())
            covered, first = size, start
            for last, last_end, before, begun in chains:
                # What overlaps in the text or in the template counts once.
                new = size - max(0, last - start, last_end - (end - size))
                if new > 0 and (before + new, begun) > (covered, first):
                    covered, first = before + new, begun
            fresh.setdefault(template, []).append((start + size, end, covered, first))
        for template, chains in fresh.items():
            self.open[template].extend(chains)

    def _close(self, template: int, chain: tuple[int, int, int, int]) -> None:
        last, _, covered, first = chain
        share = covered / self.sizes[template]
        self.best = max(self.best, share)
        if share < self.least_coverage:
            return
        held = self.pending.get(template)
        if held is not None and held[1] > first:
            # Of overlapping spans of a template the one that covers more stays, the earlier one of equals.
            if covered > held[2]:
                self.pending[template] = (first, last, covered)
            return
        if held is not None:
            self.spans.append((template, *held))
        self.pending[template] = (first, last, covered)

    def finish(self) -> list[tuple[int, int, int, int]]:
        """(template, start, end, words covered) by start, end and template."""
        for template, chains in self.open.items():
            for chain in chains:
                self._close(template, chain)
        self.spans += [(template, *held) for template, held in self.pending.items()]
        return sorted(self.spans, key=lambda s: (s[1], s[2], s[0]))


def scan(text: str | None, automaton: Automaton, chains: Chains, least_match: int) -> tuple[int, int, int | None, int | None, set[str]]:
    """Number of words, of phrases, their first and last start, and their labels; stretches go to ``chains``."""
    following, links, lengths, phrases = automaton.next, automaton.link, automaton.length, automaton.phrases
    known = automaton.number.get
    at, state, depth = 0, 0, 0
    n_places, first, last, labels = 0, None, None, set()
    for block in word_blocks(text):
        for at, word in enumerate(map(known, block), at + 1):
            moves = following[state]
            if word in moves:
                state = moves[word]
                depth += 1
            elif state or word is not None:
                if depth >= least_match:
                    chains.add(at - 1 - depth, depth, automaton.places(state))
                if word is None:
                    state = depth = 0
                    continue
                while state and word not in following[state]:
                    state = links[state]
                    depth = lengths[state]
                if word in following[state]:
                    state = following[state][word]
                    depth += 1
            else:
                continue
            for size, label in phrases[state]:
                if depth >= size:
                    n_places += 1
                    start = at - size
                    first = start if first is None else min(first, start)
                    last = start if last is None else max(last, start)
                    labels.add(label)
    if depth >= least_match:
        chains.add(at - depth, depth, automaton.places(state))
    return at, n_places, first, last, labels


FOUND = (
    "n_words bigint, n_places bigint, first_place bigint, last_place bigint, labels array<string>, score double,"
    " span_labels array<string>, span_starts array<bigint>, span_ends array<bigint>, span_covered array<bigint>,"
    " span_sizes array<bigint>"
)


def scan_licences(
    docs: DataFrame,
    text: str = "text",
    templates: Mapping[str, Iterable[str]] | None = None,
    phrases: Mapping[str, str] | None = None,
    least_match: int = 3,
    least_coverage: float = 0.8,
    most_gap: int = 20,
) -> DataFrame:
    """``docs`` with ``licences``, a struct of what was found in each whole text.

    ``n_words``; of the phrases ``n_places`` (all places, overlapping ones too), ``first_place`` and ``last_place`` (the
    smallest and largest start, words from 0, null without any) and ``phrase_labels``; ``spans``, an array of label, start,
    end, words covered and words of the template; ``labels`` of phrases and spans, distinct and sorted; and ``score``, the
    largest share of a template that a chain covers, reported or not, where a phrase found is 1.

    Stretches of ``least_match`` words are chained if they come in the order of the template, at most ``most_gap`` words
    apart in the text; a chain that covers ``least_coverage`` of its template is a span. Of overlapping spans of one template
    the one that covers more stays. Null, empty and wordless texts have no words and find nothing; every row stands for
    itself, so repeated rows and ids are fine, and nothing is shuffled. A clashing column name gets underscores.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    labelled = [(label, words_of(t)) for label, texts in templates.items() for t in texts]
    sought = {tuple(words_of(phrase)): label for phrase, label in phrases.items()}
    if not all(words for _, words in labelled) or not all(sought):
        raise ValueError("templates and phrases need words")
    if len(sought) < len(phrases):
        raise ValueError("two phrases have the same words")
    if sum(len(words) for _, words in labelled) + sum(map(len, sought)) > MOST_WORDS:
        raise ValueError(f"templates and phrases have more than {MOST_WORDS} words")
    bound_batches(docs.sparkSession)
    names, sizes = [label for label, _ in labelled], [len(words) for _, words in labelled]
    columns = [c.split()[0] for c in FOUND.split(", ")]

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton([words for _, words in labelled], sought)
        for batch in batches:
            out = []
            for value in batch:
                chains = Chains(sizes, least_coverage, most_gap)
                *counts, labels = scan(value, automaton, chains, least_match)
                spans = chains.finish()
                score = 1.0 if counts[1] else min(1.0, chains.best)
                by_part = list(zip(*spans)) if spans else [()] * 4
                out.append((*counts, sorted(labels), score, [names[t] for t in by_part[0]], *map(list, by_part[1:]), [sizes[t] for t in by_part[0]]))
            yield pd.DataFrame(out, columns=columns).astype({"first_place": "Int64", "last_place": "Int64"})

    raw, name = free_name(docs, "raw", "licences")
    out, f = docs.withColumn(raw, found(column(docs, text))), F.col(raw)
    spans = F.arrays_zip(
        f["span_labels"].alias("label"),
        f["span_starts"].alias("start"),
        f["span_ends"].alias("end"),
        f["span_covered"].alias("covered"),
        f["span_sizes"].alias("template_words"),
    )
    labels = F.array_sort(F.array_union(f["labels"], F.array_distinct(f["span_labels"])))
    kept = [f[c] for c in ("n_words", "n_places", "first_place", "last_place", "score")]
    return out.withColumn(name, F.struct(*kept, f["labels"].alias("phrase_labels"), labels.alias("labels"), spans.alias("spans"))).drop(raw)

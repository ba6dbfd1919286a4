"""Licence scans: a generalised suffix automaton of licence words, matching statistics, chains.

The automaton holds every run of words of every template.  A file's words are streamed through it:
after each word the state knows the longest run ending there that stands in some template (the
matching statistics).  Where a run stops growing it is a maximal match; matches of at least
MIN_MATCH words are chained when they follow one another in the file and in the template, with at
most MAX_GAP words between them, and a chain that covers at least COVERED of its template's words
gives the file the template's label.  Short phrases are templates as well, found wherever their
words stand consecutively; they are the base labels.

Words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased.  Only pairs of
neighbouring words that stand in some template can begin or continue a match, so the stretches of
such pairs are found for a whole slice at once and only they are streamed.

Defined results: null and empty texts have 0 words, no places (first and last null), empty labels
and score 0; texts are read whole; repeated rows are scanned each; other columns are ignored.
No shuffle, no state between rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablelift.llm.common import Words, slices

SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
MIN_MATCH = 4
MAX_GAP = 12
COVERED = 0.5

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Passages of public licences and of the notices that point to them.
TEMPLATES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("mit", "Released under the MIT License."),
)


def word_list(text: str) -> list[str]:
    words = Words(pa.array([text]), SEPARATORS)
    raw = words.data.tobytes()
    return [raw[s:e].decode().lower() for s, e in zip(words.start, words.end, strict=True)]


class Automaton(NamedTuple):
    vocabulary: np.ndarray  # sorted word hashes
    pairs: np.ndarray  # sorted first * size + second of neighbouring words
    steps: list[dict[int, int]]
    link: list[int]
    length: list[int]
    phrases: list[list[tuple[int, int]]]  # per state: (words, phrase) that end there
    places: list[list[tuple[int, int]]]  # per state: (template, last word) of its runs, once per template
    sizes: list[int]  # words per template


def build(templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]) -> Automaton:
    """The generalised suffix automaton of all templates and phrases."""
    texts = [word_list(text) for _, text in templates] + [word_list(text) for text, _ in phrases]
    hashes = [Words(pa.array([" ".join(words)]), SEPARATORS).hash for words in texts]
    vocabulary = np.unique(np.concatenate(hashes))
    coded = [np.searchsorted(vocabulary, h).tolist() for h in hashes]
    steps: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def new_state(size: int, out: dict[int, int], up: int) -> int:
        steps.append(out)
        length.append(size)
        link.append(up)
        return len(steps) - 1

    def split(state: int, word: int, target: int) -> int:
        """A copy of `target` for the shorter runs that reach it by `word` from `state`."""
        copy = new_state(length[state] + 1, dict(steps[target]), link[target])
        link[target] = copy
        while state >= 0 and steps[state].get(word) == target:
            steps[state][word] = copy
            state = link[state]
        return copy

    def extend(last: int, word: int) -> int:
        if word in steps[last]:  # the run stands in an earlier template
            target = steps[last][word]
            return target if length[target] == length[last] + 1 else split(last, word, target)
        fresh = new_state(length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in steps[state]:
            steps[state][word] = fresh
            state = link[state]
        if state >= 0:
            target = steps[state][word]
            link[fresh] = target if length[target] == length[state] + 1 else split(state, word, target)
        return fresh

    for words in coded:
        last = 0
        for word in words:
            last = extend(last, word)

    places: list[dict[int, int]] = [{} for _ in steps]
    for t, words in enumerate(coded[: len(templates)]):
        state = 0
        for at, word in enumerate(words):
            state = steps[state][word]
            up = state
            while up > 0 and t not in places[up]:  # first place of each run in each template
                places[up][t] = at
                up = link[up]
    ends: dict[int, list[tuple[int, int]]] = {}
    for p, words in enumerate(coded[len(templates) :]):
        state = 0
        for word in words:
            state = steps[state][word]
        ends.setdefault(state, []).append((len(words), p))
    found: list[list[tuple[int, int]]] = []
    for state in range(len(steps)):
        up, outs = state, []
        while up > 0:
            outs += ends.get(up, [])
            up = link[up]
        found.append(outs)
    size = len(vocabulary)
    pairs = np.unique([a * size + b for words in coded for a, b in zip(words, words[1:], strict=False)])
    return Automaton(
        vocabulary, pairs, steps, link, length, found, [sorted(p.items()) for p in places], [len(w) for w in coded]
    )


class Match(NamedTuple):
    template: int
    start: int  # in the file
    end: int
    at: int  # first word in the template


def stream(auto: Automaton, words: list[int], offset: int) -> tuple[list[tuple[int, int]], list[Match]]:
    """Phrase places (start, phrase) and long maximal matches of one stretch of known words."""
    steps, link, length = auto.steps, auto.link, auto.length
    state, run = 0, 0
    places, matches = [], []
    for i, word in enumerate([*words, -1]):
        before_state, before = state, run
        while state and word not in steps[state]:
            state = link[state]
            run = length[state]
        if word in steps[state]:
            state = steps[state][word]
            run += 1
        if run <= before and before >= MIN_MATCH:
            end = offset + i - 1
            matches += [Match(t, end - before + 1, end, at - before + 1) for t, at in auto.places[before_state]]
        for size, phrase in auto.phrases[state]:
            if run >= size:
                places.append((offset + i - size + 1, phrase))
    return places, matches


def chain(matches: list[Match], sizes: list[int]) -> list[tuple[int, int, int, float]]:
    """Chains (template, first, last, covered share): each match joins the chain it continues best.

    Both the file and the template must move on; words that two matches share count once.
    """
    chains: list[list] = []  # template, first, last, next free word of the template, covered
    open_of: dict[int, list[int]] = {}
    for m in sorted(matches, key=lambda m: (m.start, m.end, m.template)):
        best = None
        live = [c for c in open_of.get(m.template, []) if m.start - chains[c][2] - 1 <= MAX_GAP]
        for c in live:
            _, _, last, free, covered = chains[c]
            shared = max(0, last + 1 - m.start, free - m.at)
            gained = m.end - m.start + 1 - shared
            near = m.at - free <= MAX_GAP and m.at + m.end - m.start >= free
            if near and m.end > last and gained > 0 and (best is None or covered > chains[best][4]):
                best = c
        if best is None:
            chains.append([m.template, m.start, m.end, m.at + m.end - m.start + 1, m.end - m.start + 1])
            live.append(len(chains) - 1)
        else:
            _, _, last, free, covered = chains[best]
            shared = max(0, last + 1 - m.start, free - m.at)
            chains[best][2:] = [m.end, m.at + m.end - m.start + 1, covered + m.end - m.start + 1 - shared]
        open_of[m.template] = live
    return [(t, first, last, min(1.0, covered / sizes[t])) for t, first, last, _, covered in chains]


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<string>"
)


def scan_texts(
    auto: Automaton, texts: pa.Array, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]
) -> list[tuple]:
    """One tuple of SCHEMA's columns per text."""
    words = Words(texts, SEPARATORS)
    n = len(words.hash)
    code = np.searchsorted(auto.vocabulary, words.hash)
    code[code == len(auto.vocabulary)] = 0
    known = auto.vocabulary[code] == words.hash if n else np.zeros(0, bool)
    joined = np.zeros(n, bool)  # this word and the next stand side by side in a template
    if n > 1:
        pair = code[:-1] * len(auto.vocabulary) + code[1:]
        at = np.minimum(np.searchsorted(auto.pairs, pair), len(auto.pairs) - 1)
        joined[:-1] = known[:-1] & known[1:] & (auto.pairs[at] == pair)
    ends = words.bounds[1:] - 1
    joined[ends[words.counts > 0]] = False
    begin = joined.copy()
    begin[1:] &= ~joined[:-1]
    stop = joined.copy()
    stop[:-1] &= ~joined[1:]
    starts, stops = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    owner = np.searchsorted(words.bounds, starts, "right") - 1
    hits: dict[int, tuple[list, list]] = {}
    for text, a, b in zip(owner.tolist(), starts.tolist(), stops.tolist(), strict=True):
        places, matches = stream(auto, code[a : b + 1].tolist(), a - int(words.bounds[text]))
        if places or matches:
            held = hits.setdefault(text, ([], []))
            held[0].extend(places)
            held[1].extend(matches)
    rows = []
    for i, count in enumerate(words.counts.tolist()):
        if i not in hits:
            rows.append((count, 0, None, None, "", "", 0.0, []))
            continue
        places, matches = hits[i]
        base = {phrases[p][1] for _, p in places}
        chains = [c for c in chain(matches, auto.sizes) if c[3] >= COVERED]
        labels = base | {templates[c[0]][0] for c in chains}
        at = [p for p, _ in places]
        spans = sorted({(c[1], c[2], templates[c[0]][0], round(c[3], 4)) for c in chains})
        rows.append((
            count, len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), max((c[3] for c in chains), default=0.0), [f"{t}:{a}-{b}:{s}" for a, b, t, s in spans],
        ))
    return rows


def scan(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """The `keep` columns of every document with SCHEMA's columns; `spans` are label:first-last:share."""
    keep = list(keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields] + [SCHEMA])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = build(templates, phrases)
        for part in slices(batches, "__text"):
            rows = scan_texts(auto, part.column("__text"), templates, phrases)
            found = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + found, [*keep, *names])

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)

"""License scans by patience alignment of texts with license templates.

A template and a stretch of text are aligned on the words that occur once in each; the longest increasing subsequence of
these anchors is kept, and the gaps between them are aligned the same way, where other words have become unique. Equal
words at the borders of a gap are taken too. The share of template words matched is the coverage.

Words that a template lacks stay in the text, so matched words keep their distances. A text is aligned in overlapping
stretches of twice the template's length, which bounds the span of a match and finds a license that stands there twice. A
template is tried only where its words, counted with repeats, can reach the coverage at all, which is an exact bound. A
notice of up to `SHORT` words differs from another license's by a word, so it must stand there whole, word after word.
"""

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.llm.leaks import item_words
from depthmill.llm.texts import blocks, encoded

COVERAGE = 0.8
#: Words of a notice that has to match whole, without other words in between.
SHORT = 20

#: Names and notices of common licenses, as their holders publish them.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-short": "Released under the MIT License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
}


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence of different values."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        at = bisect_left(tops, value)
        before[i] = ends[at - 1] if at else -1
        tops[at : at + 1] = [value]
        ends[at : at + 1] = [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned places (in text, in template), both ascending."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if there[w] == 1 and here[w] == 1}
        both = [(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place]
        kept = [both[k] for k in increasing([j for _, j in both])]
        found += kept
        if kept:
            edges = [(a - 1, c - 1), *kept, (b, d)]
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:], strict=False)]
    return sorted(found)


def best_stretch(text: list, template: list, least: int) -> list[tuple[int, int]]:
    """The alignment with most words among the stretches of a text (of equal ones the first); empty below `least` words."""
    need, size = Counter(template), len(template)
    best: list[tuple[int, int]] = []
    for start in range(0, max(1, len(text) - size), size):
        part = text[start : start + 2 * size]
        if (Counter(part) & need).total() < max(least, len(best) + 1):
            continue
        found = patience(part, template)
        if len(found) > len(best):
            best = [(start + i, j) for i, j in found]
    return best if len(best) >= least else []


def whole(text: list, template: list) -> list[tuple[int, int]]:
    """The first place where all words of a template stand one after another; empty without one."""
    size = len(template)
    for start in range(len(text) - size + 1):
        if text[start] == template[0] and text[start : start + size] == template:
            return [(start + j, j) for j in range(size)]
    return []


class Templates:
    """Templates as numbers of their common vocabulary."""

    def __init__(self, texts: dict[str, str]):
        words = item_words([t.encode() for t in texts.values()])
        self.names = list(texts)
        self.vocabulary, numbers = np.unique(words.hashes(), return_inverse=True)
        self.words = [numbers[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.need = np.array([np.bincount(w, minlength=len(self.vocabulary)) for w in self.words])

    def scan(self, texts: list[bytes], coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, template, words matched, first word, last word) of every match."""
        words = item_words(texts)
        h = words.hashes()
        if not len(h) or not len(self.vocabulary):
            return
        maybe = np.zeros(1 << 16, bool)
        maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.vocabulary, h[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[number] == h[at]
        at, number = at[same], number[same]
        owner = np.searchsorted(words.first, at, "right") - 1
        size = len(self.vocabulary)
        have = np.bincount(owner * size + number, minlength=len(texts) * size).reshape(len(texts), size)
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        for t, need in enumerate(self.need):
            short = need.sum() <= SHORT
            least = max(1, int(np.ceil((1.0 if short else coverage) * need.sum() - 1e-9)))
            if not need.any():
                continue
            for i in np.flatnonzero(np.minimum(have, need).sum(axis=1) >= least).tolist():
                own = slice(edges[i], edges[i + 1])
                text = np.full(words.counts[i], -1)
                text[at[own] - words.first[i]] = number[own]
                found = whole(text.tolist(), self.words[t]) if short else best_stretch(text.tolist(), self.words[t], least)
                if found:
                    yield i, t, len(found), found[0][0], found[-1][0]


def licensed(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, text_col: str = "text") -> DataFrame:
    """A row for every text and template whose coverage is reached: the columns of `docs` but the text, license, coverage, n_matched, n_template, first_word, last_word.

    Words are runs of ASCII letters, digits and bytes beyond ASCII, in lower case. Null and empty texts match nothing, nor
    does a template without words. Repeated rows are scanned each by itself; an empty table gives no rows. Columns of
    `docs` whose names clash with those added are left out.
    """
    known = Templates(templates if templates is not None else TEMPLATES)
    added = ("license", "coverage", "n_matched", "n_template", "first_word", "last_word")
    rest = [c for c in docs.columns if c != text_col and c not in added]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]) if rest else F.struct(F.lit(0).alias("c0"))
    source = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = source.schema["row"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            found = list(known.scan(encoded(batch.column("text")), coverage))
            if found:
                i, t, n, first, last = zip(*found, strict=True)
                sizes = [len(known.words[k]) for k in t]
                longs = lambda x: pa.array(x, pa.int64())
                arrays = [batch.column("row").take(longs(i)), pa.array([known.names[k] for k in t]), pa.array([a / b for a, b in zip(n, sizes, strict=True)]), longs(n), longs(sizes), longs(first), longs(last)]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *added])

    out = source.mapInArrow(scan, f"row {kind}, license string, coverage double, n_matched long, n_template long, first_word long, last_word long")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)], *added)

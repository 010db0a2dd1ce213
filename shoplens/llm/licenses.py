"""License scans: keys of the templates pick candidates, banded alignment measures them.

Templates are word sequences. Each has keys that no passage with enough of its
words can lack (``Index``): winnowed word 3-grams where such a passage must hold
an unbroken run of GRAM + WINDOW - 1 words, else its rarest single words. At 0.8
no length is enough for the grams, as every fifth word may be changed. All keys
in a text are looked up; each gives a diagonal, and the template is aligned word
by word in a band around it. A match reports the share of the template's words
that align and the span in the text. Complete for passages that drift at most
``BAND`` words.

Templates are of three kinds: notices (also ``-header``), whole texts
(``-text``), and ``-opening``, the first sentence of a text that may go on
otherwise. The whole table is held by every worker: some 20,000 words, and a
longer one costs memory in proportion.

Words are runs without ASCII spaces, in lower case, outer punctuation off, and
those of punctuation alone (comment marks, bullets) are passed over. Null
and empty texts match nothing. Every passage that matches is a row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shoplens.llm.common import WordHasher, map_arrow, mix, read, schema_with, text_batches
from shoplens.llm.license_texts import TEXTS

GRAM, WINDOW, BAND = 3, 3, 6
LONG = 64  # words from which a template has more keys
MIN_COVERAGE = 0.8
EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_/\\"
_HASHER = WordHasher(seed=13)
# license notices and texts to look for (fixed values: public license texts)
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT-opening":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 2 of "
        "the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-header":
        "This library is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-header":
        "This library is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of "
        "the License, or (at your option) any later version.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-4.0":
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0":
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-ND-4.0-long":
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-long":
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-SA-4.0-long":
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-ND-4.0-long":
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "BSD-opening":
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
    "ISC-opening":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice "
        "appear in all copies.",
    "MPL-2.0":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense-opening":
        "This is free and unencumbered software released into the public domain.",
    **TEXTS,
}


# words of a template without which a passage is of another license (as words_of gives them)
_NOTICES = {
    "Apache-2.0": "apache 2.0", "Apache-2.0-header": "apache 2.0", "MIT": "mit", "MPL-2.0": "mozilla 2.0",
    **{f"{k}{form}": told for form in ("", "-header") for k, told in {
        "GPL-3.0": "general 3", "GPL-2.0": "general 2", "LGPL-3.0": "lesser 3", "LGPL-2.1": "lesser 2.1",
        "AGPL-3.0": "affero 3"}.items()},
    "CC-BY-4.0-short": "cc by 4.0", "CC-BY-4.0": "attribution 4.0",
    "CC-BY-SA-4.0-short": "cc by-sa 4.0", "CC-BY-SA-4.0": "attribution-sharealike 4.0",
    "CC-BY-ND-4.0": "cc by-nd 4.0", "CC-BY-ND-4.0-long": "attribution-noderivatives 4.0",
    "CC-BY-NC-4.0": "cc by-nc 4.0", "CC-BY-NC-4.0-long": "attribution-noncommercial 4.0",
    "CC-BY-NC-SA-4.0": "cc by-nc-sa 4.0", "CC-BY-NC-SA-4.0-long": "attribution-noncommercial-sharealike 4.0",
    "CC-BY-NC-ND-4.0": "cc by-nc-nd 4.0", "CC-BY-NC-ND-4.0-long": "attribution-noncommercial-noderivatives 4.0",
}
# GPL-3.0's section 13 names the Affero license, the Affero license's the GPL
_NOTICES |= {"GPL-3.0-text": "affero", "BSD-3-Clause-text": "neither", "BSD-4-Clause-text": "neither advertising"}
TELLING = {TEMPLATES[name]: told for name, told in _NOTICES.items()}


def words_of(text: bytes) -> list[bytes]:
    return [w for w in (x.strip(EDGES) for x in text.lower().split()) if w]


def grams(h: np.ndarray) -> np.ndarray:
    """Hash of every run of GRAM words."""
    n = max(len(h) - GRAM + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            out = out * np.uint64(0x100000001B3) + mix(h[k:k + n], k + 1)
    return out


def winnow(hashes: np.ndarray, window: int = WINDOW) -> list[int]:
    """Positions kept: the rightmost least hash of every window."""
    kept = set()
    for i in range(max(len(hashes) - window + 1, min(len(hashes), 1))):
        part = hashes[i:i + window]
        kept.add(i + len(part) - 1 - int(np.argmin(part[::-1])))
    return sorted(kept)


class Keys:
    """Hashes of runs of ``width`` words, each with its template and position, as sorted arrays."""

    def __init__(self, found: list[tuple[int, int, int]], width: int):
        found = sorted(found)
        self.width = width
        self.keys = np.array([k for k, _, _ in found], dtype=np.uint64)
        self.template = np.array([t for _, t, _ in found], dtype=np.int64)
        self.position = np.array([i for _, _, i in found], dtype=np.int64)
        self.small = np.zeros(1 << 16, dtype=bool)
        self.small[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``hashes``, entry of the index) of every equal pair."""
        maybe = np.flatnonzero(self.small[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        low = np.searchsorted(self.keys, hashes[maybe], "left")
        high = np.searchsorted(self.keys, hashes[maybe], "right")
        times = high - low
        at = np.repeat(maybe, times)
        entry = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return at, entry


class Index:
    """The templates' words, and the keys that every passage of enough words has one of.

    ``lost`` words of a template may be missing. With the words added between
    them (at most ``BAND`` more than are missing) they cut the others into at
    most 2 * lost + BAND + 1 runs. Where the longest run must hold a window of
    grams, the winnowed grams are keys; else ``lost + 1`` single words are, of
    which one is always there: those in the fewest templates, long ones first.
    Long templates have more of them as keys, of which a passage then must have
    ``votes`` in its band.
    """

    def __init__(self, templates: tuple[tuple[str, str], ...], min_coverage: float):
        self.names = [n for n, _ in templates]
        self.words = [words_of(t.encode()) for _, t in templates]
        self.known = [frozenset(ws) for ws in self.words]
        self.need = [max(math.ceil(min_coverage * len(ws)), 1) for ws in self.words]
        # per telling word of a template, the bits of its positions
        self.telling = [[sum(1 << i for i, x in enumerate(ws) if x == w) for w in told.encode().split()]
                        for ws, told in zip(self.words, (TELLING.get(t, "") for _, t in templates))]
        times = Counter(w for ws in self.known for w in ws)
        runs, single = [], []
        self.votes = np.ones(len(templates), dtype=np.int64)
        for t, (words, need) in enumerate(zip(self.words, self.need)):
            lost = len(words) - need
            h = np.array([_HASHER[w] for w in words], dtype=np.uint64)
            if -(-need // (2 * lost + BAND + 1)) >= GRAM + WINDOW - 1:
                g = grams(h)
                runs += [(int(g[i]), t, i) for i in winnow(g)]
            else:
                rare = sorted(range(len(words)), key=lambda i: (times[words[i]], -len(words[i]), i))
                more = 0
                if len(words) >= LONG:
                    own = Counter(words)
                    rare.sort(key=lambda i: own[words[i]])
                    more = (need - 1) // 2
                chosen = {words[i] for i in rare[:lost + 1 + more]}
                entries = [(int(h[j]), t, j) for j, w in enumerate(words) if w in chosen]
                self.votes[t] = len(entries) - lost
                single += entries
        self.runs, self.single = Keys(runs, GRAM), Keys(single, 1)
        self.hashes = [np.array([_HASHER[w] for w in ws], dtype=np.uint64) for ws in self.words]
        self.least = np.array(self.need, dtype=np.int64)
        self.length = np.array([len(ws) for ws in self.words], dtype=np.int64)

    def candidates(self, h: np.ndarray, first: np.ndarray) -> dict[int, set[tuple[int, int]]]:
        """Text -> (template, diagonal) of the keys in the word hashes ``h`` of texts
        that begin at ``first``; a diagonal is text position - template position."""
        out: dict[int, set[tuple[int, int]]] = {}
        for keys, hashes in ((self.runs, grams(h) if len(self.runs.keys) else h[:0]), (self.single, h)):
            at, entry = keys.hits(hashes)
            text = np.searchsorted(first, at, side="right") - 1
            inside = at + keys.width <= first[text + 1]
            text, at, entry = text[inside], at[inside], entry[inside]
            which = keys.template[entry]
            d = at - first[text] - keys.position[entry]
            size = first[text + 1] - first[text]
            room = np.minimum(size, d + self.length[which] + BAND) - np.maximum(d - BAND, 0)
            fits = room >= self.least[which]
            text, which, d = text[fits], which[fits], d[fits]
            if not len(d):
                continue
            low, wide = d.min() - BAND, d.max() - d.min() + 4 * BAND
            place = np.sort((text * len(self.names) + which) * wide + (d - low))
            votes = np.searchsorted(place, place + BAND, "right") - np.searchsorted(place, place - BAND, "left")
            enough = votes >= self.votes[place // wide % len(self.names)]
            place = np.unique(place[enough])
            for p in place.tolist():
                pair, x = divmod(p, int(wide))
                out.setdefault(pair // len(self.names), set()).add((pair % len(self.names), x + int(low)))
        return out


@lru_cache(maxsize=4)
def index_of(templates: tuple[tuple[str, str], ...], min_coverage: float) -> Index:
    return Index(templates, min_coverage)


def alignment(template: list[bytes], words: list[bytes], diagonal: int) -> tuple[int, int, int, int]:
    """(score, bits of the matched template words, first, last) of the best local
    alignment in the band around ``diagonal`` (text position - template position).
    A match scores 2, a replaced, missing or added word -1; of equal scores the
    earliest ends it."""
    best = (0, 0, -1, -1)
    row: dict[int, tuple[int, int, int]] = {}  # text position -> (score, matched, first) ending there
    for i, t in enumerate(template):
        now: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + diagonal - BAND), min(len(words), i + diagonal + BAND + 1)):
            score, matched, first = row.get(j - 1, (0, 0, j))
            if score <= 0:
                score, matched, first = 0, 0, j
            cell = (score + 2, matched | 1 << i, first) if words[j] == t else (score - 1, matched, first)
            for other in (row.get(j), now.get(j - 1)):
                if other and other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, other[1], other[2])
            if cell[0] > 0:
                now[j] = cell
                if cell[0] > best[0]:
                    best = (*cell, j)
        row = now
    return best


def align(template: list[bytes], words: list[bytes], diagonal: int) -> tuple[int, int, int]:
    """(matched words, first, last) of the ``alignment``."""
    _, matched, first, last = alignment(template, words, diagonal)
    return matched.bit_count(), first, last


def best_of(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of the (score, template, matched, first, last) that overlap in the text, the best aligned."""
    kept: list[tuple[int, int, int, int, int]] = []
    for x in sorted(found, key=lambda x: (-x[0], x[3], x[1])):
        if all(x[4] < k[3] or x[3] > k[4] for k in kept):
            kept.append(x)
    return kept


def in_band(template: np.ndarray, h: np.ndarray, diagonal: int) -> int:
    """How many words of a template have an equal one in the band around ``diagonal``."""
    n = len(template) + 2 * BAND
    band = np.zeros(n, dtype=np.uint64)
    a, b = max(diagonal - BAND, 0), min(diagonal - BAND + n, len(h))
    band[a - diagonal + BAND:b - diagonal + BAND] = h[a:b]
    same = np.lib.stride_tricks.sliding_window_view(band, 2 * BAND + 1) == template[:, None]
    return int(same.any(axis=1).sum())


def matches(text: bytes, words: list[bytes], h: np.ndarray, index: Index,
            candidates: set[tuple[int, int]]) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, matched words, start, end) of a text with ``candidates``
    (template, diagonal); start and end count code points. A band that holds too
    few words of the template is not aligned. A passage must align with each of
    the template's telling words; of templates that overlap the best one counts.
    The band is aligned again without a passage found, for others in it."""
    found = []
    left: dict[int, tuple[list, np.ndarray]] = {}  # template -> words and hashes without its passages
    for t, d in sorted(candidates):
        template, known, need = index.words[t], index.known[t], index.need[t]
        band = words[max(d - BAND, 0):max(d + len(template) + BAND, 0)]
        if sum(map(known.__contains__, band)) < need:
            continue
        some, hashes = left.get(t, (words, h))
        while in_band(index.hashes[t], hashes, d) >= need:
            score, bits, first, end = alignment(template, some, d)
            n = bits.bit_count()
            if n < need:
                break
            some, hashes = list(some), hashes.copy()
            some[first:end + 1] = [None] * (end + 1 - first)
            hashes[first:end + 1] = 0
            if all(bits & told for told in index.telling[t]):
                left[t] = some, hashes
                found.append((score, t, n, first, end))
    if not found:
        return []
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", text) if m[0].strip(EDGES)]
    rows = [(index.names[t], n / len(index.words[t]), n, len(text[:spans[first][0]].decode()),
             len(text[:spans[end][1]].decode())) for _, t, n, first, end in best_of(found)]
    return sorted(rows, key=lambda x: (x[3], x[4], x[0]))


def license_spans(df: DataFrame, key: str = "doc_id", text: str = "text",
                  templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(key, license, coverage, matched_words, start, end): a row per matched passage."""
    chosen = tuple((templates or TEMPLATES).items())
    narrow = df.selectExpr(f"`{key}` as `{key}`", f"`{text}` as __text")
    schema = schema_with(narrow.drop("__text"), license="string", coverage="double",
                         matched_words="integer", start="long", end="long")
    names = schema.names

    def run(batches):
        index = index_of(chosen, min_coverage)
        for b, texts in text_batches(batches, 1):
            words = [words_of(t) for t in texts]
            flat = [w for ws in words for w in ws]
            first = np.cumsum([0, *map(len, words)])
            h = np.fromiter(map(_HASHER.__getitem__, flat), np.uint64, len(flat))
            rows = [(d, *m) for d, where in sorted(index.candidates(h, first).items())
                    for m in matches(texts[d], words[d], h[first[d]:first[d + 1]], index, where)]
            owner, *columns = zip(*rows) if rows else [()] * 6
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())),
                 *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    return map_arrow(narrow, run, schema)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license passage of all documents."""
    return license_spans(read(spark, sf_dir, "documents"))

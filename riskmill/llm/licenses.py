"""License notices in texts, by conditional compression.

A template has cues: words of its own of which even the loosest wording that counts must hold one, so many that
`most_differences` cannot take them all. Around every cue a block of text is cut out, with as many words as the longest
template may have on both sides; blocks that overlap are one. A block is compressed by itself and with each template as raw dictionary; templates
are tried in the order of the bytes that they save, all of them, whether they save any or not. They are
confirmed by their wording: the template's words are aligned with the words of the block, and what is
missing, added or exchanged is counted and told. The one with the smallest share of differences wins, if
that is at most `most_differences`. Words that the block lacks bound the differences from below, so templates
that cannot be confirmed are left out exactly. One pass over a block finds all places of a template; of places
that overlap the one with the smallest share stays, and what lies between notices is searched again, so
that the time grows with the text and not with its square.

Each text is worked on by itself in a task, so nothing is shuffled; texts without a cue word are left out by
a filter before. Blocks that come again in a batch are looked up.

Rules: NULL and empty texts have no notices. Rows are per notice; repeated rows give repeated rows. Of
templates with equal differences the one that saves more bytes wins, then the first by name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

#: Wordings of common notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.",),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", re.IGNORECASE | re.ASCII)


def worded(text: str) -> list[tuple[str, int, int]]:
    """Words with their places: ASCII letters and digits, joined by single dots and hyphens; no case."""
    return [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def cues(templates: dict[str, tuple[str, ...]], most_differences: float) -> list[str]:
    """Words of which every text within `most_differences` of any template has one, the longest words first."""
    out = set()
    for text in (t for texts in templates.values() for t in texts):
        words = Counter(w for w, _, _ in worded(text))
        most, taken = int(most_differences * words.total()), 0
        if most >= words.total():
            raise ValueError("most_differences leaves nothing of a template")
        for word in sorted(words, key=lambda w: (-len(w), w)):
            if taken > most:
                break
            out.add(word)
            taken += words[word]
    return sorted(out)


def cue_pattern(templates: dict[str, tuple[str, ...]], most_differences: float) -> str:
    """The cues as a pattern that Java and Python read alike. Joined words may begin or end with a cue, too."""
    words = "|".join(re.escape(w) for w in cues(templates, most_differences))
    return f"(?i)(?<![a-zA-Z0-9])(?:{words})(?![a-zA-Z0-9])" if words else "(?!)"


def cheapest_ends(template: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For every place between words, the differences of the template to the best stretch that ends there."""
    at = np.arange(len(words) + 1)
    cost = np.zeros(len(words) + 1, np.int64)
    for k, want in enumerate(template, 1):
        row = np.minimum(np.append(k, cost[:-1] + (words != want)), cost + 1)
        cost = np.minimum.accumulate(row - at) + at
    return cost


def differences(template: list[str], words: list[str]) -> tuple[int, int, int, list[str]]:
    """The best place of a template in a sequence of words: number of differences, first word, word after
    the last, and the differences as -missing, +added. Words around it cost nothing; of equal places
    the first is taken."""
    width = len(words) + 1
    cost, rows = [0] * width, []
    for k, want in enumerate(template, 1):
        row = [k]
        for j in range(1, width):
            row.append(min(cost[j - 1] + (want != words[j - 1]), cost[j] + 1, row[j - 1] + 1))
        rows.append(cost)
        cost = row
    rows.append(cost)
    end = min(range(width), key=cost.__getitem__)
    k, j, told = len(template), end, []
    while k:
        if j and rows[k][j] == rows[k - 1][j - 1] + (template[k - 1] != words[j - 1]):
            if template[k - 1] != words[j - 1]:
                told.append(f"-{template[k - 1]} +{words[j - 1]}")
            k, j = k - 1, j - 1
        elif rows[k][j] == rows[k - 1][j] + 1:
            told.append(f"-{template[k - 1]}")
            k -= 1
        else:
            told.append(f"+{words[j - 1]}")
            j -= 1
    return cost[end], j, end, told[::-1]


class LicenseScanner:
    """Templates as dictionaries of a compressor."""

    def __init__(self, templates: dict[str, tuple[str, ...]], most_differences: float):
        self.most = most_differences
        self.plain = zstandard.ZstdCompressor(level=9)
        self.cues = frozenset(cues(templates, most_differences))
        self.templates = []
        for name, texts in sorted(templates.items()):
            for text in texts:
                words = [w for w, _, _ in worded(text)]
                if not words:
                    continue
                raw = " ".join(words).encode()
                raw = raw if len(raw) >= 8 else raw + b" " * 8
                known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                compressor = zstandard.ZstdCompressor(level=9, dict_data=known)
                self.templates.append((name, words, Counter(words), compressor))
        self.reach = max((int(len(w) * (1 + most_differences)) for _, w, _, _ in self.templates), default=0)
        self.met: dict[str, list] = {}

    def blocks(self, text: str) -> list[tuple[int, int]]:
        """Stretches of text that hold every notice: so many words around each cue as the longest template may have."""
        words = worded(text)
        found: list[list[int]] = []
        for i, (word, _, _) in enumerate(words):
            if word in self.cues:
                a, b = max(0, i - self.reach), min(len(words), i + self.reach + 1)
                if found and a <= found[-1][1]:
                    found[-1][1] = b
                else:
                    found.append([a, b])
        return [(words[a][1], words[b - 1][2]) for a, b in found]

    def ranked(self, words: list[str]) -> list[tuple[int, str, list[str], int]]:
        """Templates that the words of a block leave possible, by the bytes that they save there; the last
        number is how many of a template's words the block lacks, each of them a difference."""
        there = Counter(words)
        possible = []
        for name, template, counts, compressor in self.templates:
            lacking = sum(max(0, n - there[w]) for w, n in counts.items())
            if lacking / len(template) <= self.most:
                possible.append((name, template, lacking, compressor))
        if not possible:
            return []
        data = " ".join(words).encode()
        alone = len(self.plain.compress(data))
        saved = [(alone - len(c.compress(data)), name, template, lacking) for name, template, lacking, c in possible]
        return sorted(saved, key=lambda s: (-s[0], s[1], s[2]))

    def places(self, template: list[str], words: list[str], code: np.ndarray, numbers: dict) -> list[tuple]:
        """All places of a template in a block that are within reach: differences, first word, word after the last."""
        cost = cheapest_ends(np.array([numbers.get(w, -1) for w in template]), code)
        near = np.flatnonzero(cost <= self.most * len(template))
        out = []
        for ends in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1):
            if len(ends):
                end = int(ends[cost[ends].argmin()])
                start = max(0, end - 2 * len(template))
                number, first, stop, told = differences(template, words[start:end])
                if stop > first and number <= self.most * len(template):
                    out.append((number, start + first, start + stop, told))
        return out

    def notices(self, block: str) -> list[tuple[int, int, str, int, int, str]]:
        """start, end, license, bytes saved, differences and their wording, for each notice of a block."""
        out, work = [], [(0, len(block))]
        while work:
            a, b = work.pop()
            part = worded(block[a:b])
            words = [w for w, _, _ in part]
            if self.cues.isdisjoint(words):
                continue
            numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
            code = np.array([numbers[w] for w in words])
            met = []
            for rank, (saved, name, template, _) in enumerate(self.ranked(words)):
                for number, first, end, told in self.places(template, words, code, numbers):
                    met.append((number / len(template), -len(template), rank, first, end, name, saved, number, told))
            taken = np.zeros(len(words), bool)
            kept = []
            for _, _, _, first, end, name, saved, number, told in sorted(met):
                if not taken[first:end].any():
                    taken[first:end] = True
                    kept.append((a + part[first][1], a + part[end - 1][2], name, saved, number, "; ".join(told)))
            kept.sort()
            out += kept
            if kept:
                edges = [a, *(x for start, stop, *_ in kept for x in (start, stop)), b]
                work += [(x, y) for x, y in zip(edges[::2], edges[1::2]) if x < y]
        return sorted(out)

    def scan(self, text: str) -> list[tuple[int, int, str, int, int, str]]:
        out = []
        for a, b in self.blocks(text):
            block = text[a:b]
            if block not in self.met:
                if len(self.met) > 20_000:
                    self.met.clear()
                self.met[block] = self.notices(block)
            out += [(a + s, a + e, *rest) for s, e, *rest in self.met[block]]
        return out


def license_notices(
    docs: DataFrame, key: str, text: str, *, templates: dict[str, tuple[str, ...]] = TEMPLATES,
    most_differences: float = 0.15,
) -> DataFrame:
    """One row per notice: key, start, end (places in the text), license, bytes_saved, differences, wording."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(templates, most_differences)
        names = ["id", "start", "end", "license", "bytes_saved", "differences", "wording"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows = []
            for key_, text_ in zip(batch.column("id"), batch.column("text")):
                rows += [(key_.as_py(), *found) for found in scanner.scan(text_.as_py())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    cued = docs.filter(F.col(text).rlike(cue_pattern(templates, most_differences))).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return cued.mapInArrow(
        scan, "id long, start long, end long, license string, bytes_saved long, differences long, wording string"
    ).withColumnRenamed("id", key)

"""Licence notices in documents, by the Dice coefficient over word bigrams.

Segments of a text are its lines and its paragraphs of several lines. A segment and a template are
compared as bags of word bigrams, lower-cased and without punctuation. A segment of n bigrams can
only reach a coefficient t with templates of n t / (2 - t) to n (2 - t) / t bigrams, so others are
not looked at; nor are segments with too few bigrams of any template.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.batches import with_columns
from tickloom.llm.decontaminate import Words

THRESHOLD = 0.8

# Public licence notices by their SPDX names.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Released under the BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BLANK = re.compile(r"\n[ \t\r]*\n")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_MIX = np.uint64(0xD6E8FEB86659FD93)


def bigrams(text: str) -> Counter:
    words = _WORD.findall(text.translate(_UPPER))
    return Counter(zip(words, words[1:]))


def segments(text: str | None) -> list[str]:
    """Lines, then paragraphs of several lines; paragraphs are parted by blank lines."""
    lines = (text or "").split("\n")
    return lines + [p for p in _BLANK.split(text) if "\n" in p] if len(lines) > 1 else lines


def _pair_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbouring words of one segment, and the segments they belong to."""
    size = np.diff(words.first)
    owner = np.repeat(np.arange(len(size)), size)
    same = owner[1:] == owner[:-1]
    return (words.hash[:-1] * _MIX + words.hash[1:])[same], owner[1:][same]


class Templates:
    """Templates with their bags, and a table of the hashes of all their bigrams."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.bags = [(name, bag, sum(bag.values())) for name, bag in ((n, bigrams(t)) for n, t in templates) if bag]
        hashes = np.unique(_pair_hashes(Words([t for _, t in templates]))[0])
        self.mask = np.uint64((1 << max(16, len(hashes).bit_length() + 6)) - 1)
        self.table = np.zeros(int(self.mask) + 1, bool)
        self.table[(hashes & self.mask).astype(np.int64)] = True

    def candidates(self, parts: list[str]) -> np.ndarray:
        """Segments with enough bigrams of the templates: 2 c / (n + c) is the best they could reach."""
        pairs, owner = _pair_hashes(Words(parts))
        n = np.bincount(owner, minlength=len(parts))
        c = np.bincount(owner[self.table[(pairs & self.mask).astype(np.int64)]], minlength=len(parts))
        return np.flatnonzero((c > 0) & (2 * c >= self.threshold * (n + c) - 1e-9))

    def match(self, text: str) -> tuple[str, float] | None:
        """The most alike template at or above the threshold; ties go to the name that sorts first."""
        bag = bigrams(text)
        n, t, best = sum(bag.values()), self.threshold, None
        for name, own, m in self.bags:
            if m * (2 - t) < n * t - 1e-9 or n * (2 - t) < m * t - 1e-9:
                continue
            dice = 2.0 * sum(min(k, own[g]) for g, k in bag.items() if g in own) / (n + m)
            if dice >= t and (best is None or (-dice, name) < (-best[1], best[0])):
                best = name, dice
        return best


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """Documents with the notices found in their whole texts.

    notices (array of licence, dice, text) in the order of segments, the best template for each;
    license and dice of the best of them ('' and 0 without any; ties to the name that sorts
    first). Null and empty texts have none. Columns of these names give way.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        known = held.get("known") or held.setdefault("known", Templates(templates, threshold))
        parts, owner = [], []
        for k, t in enumerate(batch.column(0).to_pylist()):
            own = segments(t)
            parts += own
            owner += [k] * len(own)
        found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for s in known.candidates(parts).tolist():
            if m := known.match(parts[s]):
                found[owner[s]].append({"license": m[0], "dice": m[1], "text": parts[s]})
        best = [min(f, key=lambda m: (-m["dice"], m["license"]), default={"license": "", "dice": 0.0}) for f in found]
        return {"notices": found, "license": [b["license"] for b in best], "dice": [b["dice"] for b in best]}

    held: dict[str, Templates] = {}
    return with_columns(docs, "notices array<struct<license: string, dice: double, text: string>>, license string, dice double", work, [text], size=2 << 20)

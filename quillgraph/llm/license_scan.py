"""License scans: winnowed template fingerprints in an inverted index, then banded alignment.

Templates are word sequences ([a-z0-9]+ of the lower-cased text). Hashes of their k-word runs are winnowed
(the rightmost least hash of each window of w stays); the inverted index maps a kept hash to (template,
position). In a document every k-word run is looked up, so that any run of k + w - 1 words shared with
a template meets a kept hash. Hits that lie within `band` of one diagonal make a candidate region; where it
holds enough of the template's words in any order (which bounds what order can give), banded alignment of
that region counts the words matched in order.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import col, map_rows, read
from .license_texts import WHOLE

_WORD = re.compile(r"[a-z0-9]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)

#: The public notices to look for.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "rights-reserved": "All rights reserved.",
    **WHOLE,
}


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def winnow(hashes: list[int], window: int) -> list[int]:
    """Positions kept: of each window the rightmost least hash; all of a shorter sequence is one window."""
    kept: list[int] = []
    for i in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = hashes[i : i + window]
        at = i + max(j for j, h in enumerate(part) if h == min(part))
        if not kept or kept[-1] != at:
            kept.append(at)
    return kept


def _runs(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k word numbers; 0 where the run holds an unknown word (number 0)."""
    if len(ids) < k:
        return np.zeros(0, np.uint64)
    n = len(ids) - k + 1
    out, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(k):
        part = ids[j : j + n].astype(np.uint64)
        out = (out ^ part) * _MUL
        out ^= out >> np.uint64(29)
        known &= part > 0
    return np.where(known, out | np.uint64(1), np.uint64(0))


def align(a: list[int], b: list[int], shift: int, band: int) -> tuple[int, int, int]:
    """Longest common subsequence of a and b where b's position less a's lies within band of shift.

    Returns its length and the first and last position in b that it uses (of equal lengths, the shortest span,
    then the leftmost). Word number 0 matches nothing.
    """
    width = 2 * band + 1
    above = [(0, 0)] * (width + 1)  # for each diagonal: matched words, first position used
    best = (0, 0, 0)
    for i, x in enumerate(a):
        row = [(0, 0)] * (width + 1)
        for c in range(width):
            j = i + shift - band + c
            # above[c + 1] is (i - 1, j), row[c - 1] is (i, j - 1) and above[c] is (i - 1, j - 1).
            row[c] = max(above[c + 1], row[c - 1]) if c else above[1]
            if 0 <= j < len(b) and x and b[j] == x:
                n, first = above[c]
                row[c] = max(row[c], found := (n + 1, first if n else j))
                best = max(best, (*found, j), key=lambda v: (v[0], v[1] - v[2], -v[1]))
        above = row
    return best


class TemplateIndex:
    def __init__(self, templates: dict[str, str], k: int, window: int):
        self.names = sorted(templates)
        self.vocabulary: dict[str, int] = {}
        self.sequences = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(templates[n])] for n in self.names]
        self.k = k
        self.counts = [np.bincount(seq, minlength=len(self.vocabulary) + 1) for seq in self.sequences]
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, seq in enumerate(self.sequences):
            hashes = _runs(np.array(seq), k).tolist()
            # A short template keeps all its runs, so that one changed word leaves some to find it by.
            for at in winnow(hashes, window) if len(seq) >= 3 * (k + window) else range(len(hashes)):
                self.postings[hashes[at]].append((t, at))
        self.kept = np.array(sorted(self.postings), dtype=np.uint64)

    def matches(self, text: str, band: int, coverage: float):
        """(name, matched words, words of the template, start, end) of each region that matches enough."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words(text)), np.int64)
        hashes = _runs(ids, self.k)
        hits = np.flatnonzero(hashes)
        hits = hits[np.isin(hashes[hits], self.kept)]
        if not len(hits):
            return
        regions: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for p in hits.tolist():
            for t, q in self.postings[int(hashes[p])]:
                regions[t].append((p, p - q))
        spans = [m.span() for m in _WORD.finditer(text.lower())]
        sequence = ids.tolist()
        # Lower-casing lengthens a few letters; spans then refer to the lower-cased text.
        for t, places in sorted(regions.items()):
            template, found_to, tried = self.sequences[t], -1, set()
            for at, shift in places:
                if at <= found_to or (shift, found_to) in tried:
                    continue
                tried.add((shift, found_to))
                lo, hi = max(found_to + 1, shift - band), max(0, shift + len(template) + band)
                shared = np.minimum(np.bincount(ids[lo:hi], minlength=len(self.counts[t])), self.counts[t])
                if shared.sum() < coverage * len(template):
                    continue
                n, first, end = align(template, sequence[lo:hi], shift - lo, band)
                if n and n >= coverage * len(template):
                    found_to = lo + end
                    yield self.names[t], n, len(template), spans[lo + first][0], spans[lo + end][1]


def scan_licenses(df: DataFrame, id_col: str, text_col: str, templates: dict[str, str] = TEMPLATES, k: int = 3, window: int = 4, band: int = 8, coverage: float = 0.8) -> DataFrame:
    """A row (doc_id, license, matched, template_words, coverage, start, end) for each match in each whole text.

    Some notices are short, so runs have three words. Null and empty texts give no rows; repeated rows give
    repeated matches; other columns are ignored. Of one template, matches in a text don't overlap and come from
    left to right. A text costs time in proportion to its length plus its candidate regions, each of which is
    at most a template long.
    """

    def rows(incoming):
        index = TemplateIndex(templates, k, window)
        for key, text in incoming:
            for name, n, of, start, end in index.matches(text or "", band, coverage):
                yield key, name, n, of, round(n / of, 6), start, end

    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("matched", pa.int32()), ("template_words", pa.int32()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
    return map_rows(df.select(col(id_col).cast("long"), col(text_col).cast("string")), rows, schema, "doc_id long, license string, matched int, template_words int, coverage double, start long, end long")


def op2_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"), "doc_id", "text")

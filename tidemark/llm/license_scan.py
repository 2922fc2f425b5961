"""License scans: winnowed fingerprints pick candidates, banded alignment confirms them.

Texts and templates are token sequences: runs of letters and digits, A-Z in lower case. Every
run of `gram` tokens has a hash; winnowing (Schleimer, Wilkerson, Aiken: SIGMOD 2003) keeps the
least hash of every window of `window` runs of a template. The kept hashes form the inverted
index. A text looks up all its runs, so any passage of `gram + window - 1` tokens it shares with
a template is found; hits near one diagonal of a template make a candidate region.
The region is aligned with the template by dynamic programming in a band around the diagonals of
its hits; the result says which share of the template's tokens is matched and where.

The templates are a bounded parameter: they go to every task, and their size is checked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ngram_sets import WordHashes, mix
from tidemark.llm.texts import slices

# Short notices as authors put them above or below a text. Parameters may replace them.
NOTICES: dict[str, str] = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
}

MAX_TEMPLATE_BYTES = 8 << 20

_TOKEN = re.compile(r"[^\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Scan:
    """Token runs and windows of winnowing, the band, and the least coverage to report."""

    gram: int = 3
    window: int = 2
    band: int = 8
    min_coverage: float = 0.8


def plain(text: str) -> str:
    """The text with A-Z in lower case; every code point keeps its place."""
    return text.encode().lower().decode()


def winnowed(words: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes of runs of tokens, and the place of each run."""
    made = _runs(words, gram)
    runs = len(made)
    if runs < 1:
        return made, np.empty(0, np.int64)
    if runs <= window:
        at = np.array([int(np.argmin(made))])
    else:
        spans = np.lib.stride_tricks.sliding_window_view(made, window)
        at = np.unique(np.arange(len(spans)) + np.argmin(spans, axis=1))
    return made[at], at


def _runs(words: np.ndarray, gram: int) -> np.ndarray:
    made = np.zeros(max(0, len(words) - gram + 1), np.uint64)
    for i in range(gram):
        made = mix(made * _ODD + words[i : i + len(made)])
    return made


class Index:
    """Kept hashes of the templates, sorted, with the template and place of each."""

    def __init__(self, templates: dict[str, str], scan: Scan):
        self.scan = scan
        self.names = sorted(templates)
        self.known = WordHashes()
        self.words = [self.known.of(_TOKEN.findall(plain(templates[n]))) for n in self.names]
        parts = []
        for number, words in enumerate(self.words):
            # All runs of a short template are kept: an edit leaves few of them whole.
            short = len(words) < 4 * (scan.gram + scan.window)
            kept, at = winnowed(words, min(scan.gram, len(words)), 1 if short else scan.window)
            parts.append((kept, np.full(len(kept), number), at))
        self.hash, self.template, self.place = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.template, self.place = (
            x[order] for x in (self.hash, self.template, self.place)
        )
        self.grams = sorted({min(scan.gram, len(w)) for w in self.words})

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template, place in it, place in the text) of every kept hash in common."""
        found = []
        for gram in self.grams:
            asked = _runs(words, gram)
            low = np.searchsorted(self.hash, asked, "left")
            count = np.searchsorted(self.hash, asked, "right") - low
            text = np.repeat(np.arange(len(asked)), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            entry = np.repeat(low, count) + step
            found.append((self.template[entry], self.place[entry], text))
        return tuple(np.concatenate(c) for c in zip(*found))


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(matched tokens, first, last) of the best local alignment within a band of diagonals.

    A diagonal is the place in the text less the place in the template; the band is
    `low..high`. A match scores 2, a mismatch or a gap -1. Places are those in the text.
    """
    width = high - low + 1
    score = np.zeros(width + 2, np.int64)
    start = np.full(width + 2, -1, np.int64)
    matched = np.zeros(width + 2, np.int64)
    best = (0, 0, -1, -1)
    for i in range(len(template)):
        # Cells of the row before: same diagonal is a step in both, the one above a deletion.
        new_score, new_start, new_matched = (
            np.zeros_like(score), np.full_like(start, -1), np.zeros_like(matched),
        )
        for d in range(1, width + 1):
            j = i + low + d - 1
            if j < 0 or j >= len(text):
                continue
            same = template[i] == text[j]
            options = [
                (score[d] + (2 if same else -1), start[d], matched[d] + same),
                (score[d + 1] - 1, start[d + 1], matched[d + 1]),
                (new_score[d - 1] - 1, new_start[d - 1], new_matched[d - 1]),
            ]
            value, begin, hits = max(options, key=lambda o: o[0])
            if value > 0:
                begin = j if begin < 0 else begin
                new_score[d], new_start[d], new_matched[d] = value, begin, hits
                if value > best[0]:
                    best = (int(value), int(hits), int(begin), j)
        score, start, matched = new_score, new_start, new_matched
    return best[1], best[2], best[3]


def scan_text(text: str, index: Index) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched tokens, start, end) of each match; places in code points."""
    lowered = plain(text)
    hashed = index.known.of(_TOKEN.findall(lowered))
    template, place, at = index.hits(hashed)
    if not len(template):
        return []
    places = [m.span() for m in _TOKEN.finditer(lowered)]
    scan, out = index.scan, []
    for number in np.unique(template).tolist():
        words, name = index.words[number], index.names[number]
        chosen = template == number
        diagonal = np.unique(at[chosen] - place[chosen])
        # A region: hits whose diagonals lie within the band of the one before.
        for group in np.split(diagonal, np.flatnonzero(np.diff(diagonal) > scan.band) + 1):
            low, high = int(group[0]) - scan.band, int(group[-1]) + scan.band
            todo = [(max(0, low), min(len(hashed), high + len(words)))]
            while todo:
                first, last = todo.pop()
                if last - first < scan.min_coverage * len(words):
                    continue
                hits, begin, end = align_region(words, hashed[first:last], low - first, high - first, scan)
                if hits >= scan.min_coverage * len(words):
                    begin, end = first + begin, first + end
                    out.append((name, hits / len(words), hits, places[begin][0], places[end][1]))
                    todo += [(first, begin), (end + 1, last)]
    # Of matches that overlap the one that explains most tokens counts.
    out.sort(key=lambda m: (-m[2], -m[1], m[3], m[0]))
    kept: list[tuple] = []
    for match in out:
        if all(match[4] <= k[3] or match[3] >= k[4] for k in kept):
            kept.append(match)
    return sorted(kept, key=lambda m: (m[3], m[0]))


def align_region(
    template: np.ndarray, text: np.ndarray, low: int, high: int, scan: Scan
) -> tuple[int, int, int]:
    """The best alignment over overlapping bands of bounded width between two diagonals."""
    bands = [(at, min(high, at + 6 * scan.band)) for at in range(low, high + 1, 4 * scan.band)]
    found = [align(template, text, *band) for band in bands]
    return max(found, key=lambda m: (m[0], -m[1]))


def license_scan(
    documents: DataFrame,
    templates: dict[str, str] = NOTICES,
    scan: Scan = Scan(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, license, coverage, n_matched, start, end) of every match in every row.

    `coverage` is the matched share of the template's tokens, at least `scan.min_coverage`;
    `start` and `end` are code points of the text, `end` behind the last matched token. Of
    templates that match overlapping spans the one with most matched tokens is reported, then
    the better covered, then the earlier, then the first by name. A null or empty text and one
    without a match give no row; repeated rows and rows without an id give theirs. An empty
    table or no templates give no rows, other columns are not read.
    """
    size = sum(len(t.encode()) for t in templates.values())
    if size > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates have {size} bytes, at most {MAX_TEMPLATE_BYTES} are sent along")
    templates = {n: t for n, t in templates.items() if _TOKEN.search(t)}
    chosen = documents.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    if not templates:
        chosen = chosen.where(F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, scan) if templates else None
        for batch in batches:
            for part in slices(batch):
                rows, found = [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    matches = scan_text(text or "", index)
                    rows += [row] * len(matches)
                    found += matches
                columns = [[m[i] for m in found] for i in range(5)]
                kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())),
                     *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    names=["id", "license", "coverage", "n_matched", "start", "end"],
                )

    kind = chosen.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, license string, coverage double, n_matched long, start long, end long"
    return chosen.mapInArrow(run, ddl).withColumnRenamed("id", id_col)

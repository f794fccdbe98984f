"""Operator 2: licence scan by conditional compression.

Candidate texts have a licence word. A candidate block is a run of words that has
enough of some template's words, in any order, whatever lines it is wrapped into.
Each block is compressed alone and with every template as a raw zstandard
dictionary; the templates are ranked by what they save. The first of that ranking
whose exact wording is there is the block's licence: its words are aligned with the
text around the block, which gives the place, the words that miss and the words in
between. Of confirmed licences on the same words the one that saves more bytes stays.
Runs of lines with a licence word that hold no confirmed licence are reported as
unknown, with the template that saves most.

Templates are short notices and the full texts in the folder ``licenses``; others are
a parameter. Null and empty texts have no blocks. A text of any length is scanned
whole, and a long unknown block by windows; an alignment holds a few rows of its
matrix if that is large. Of templates that save alike, the first named wins. Repeated
rows are each scanned; an empty table gives no rows. Extra columns play no part,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Public licence notices, by SPDX name.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-short": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "all-rights-reserved": "All rights reserved.",
}
#: Names of templates of one licence differ by these endings.
_FORMS = ("-short", "-long", "-text")


def full_texts(folder: str | None = None) -> dict[str, str]:
    """The licence texts of a folder (of this package if none is named), by the names of their files."""
    root = Path(folder) if folder else Path(__file__).with_name("licenses")
    return {f"{p.stem}-text": p.read_text(encoding="utf-8") for p in sorted(root.glob("*.txt"))}


#: Whole words, as weaker ones (notice, copies, conditions) are common in prose.
CUE = r"(?i)\b(?:licen[cs](?:e|es|ed|ing|or|ee)|copyrights?|copyrighted|warrant(?:y|ies)|permission is|redistribut(?:e|ed|ion|ions)|public domain|rights reserved|creative commons|CC[ -]BY|free software)\b|\(c\) ?\d{4}|©|['\"]as is['\"]"
#: Characters of a long line around a licence word that are held against the templates.
REACH = 600
CONFIRMED = 0.9
#: Cells of an alignment's matrix that are held at once, and characters of a window of an unknown block.
CELLS, WINDOW = 1 << 22, 4096
_WORDS = re.compile(r"[\w.]*\w", re.U)


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(text)]


def align(template: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    """(place in template, place in own) of the words of the best alignment of the whole template: most words, fewest missing and in between.

    A large matrix is halved again and again (Hirschberg), so that only two of its rows are held.
    """
    if (len(template) + 1) * (len(own) + 1) <= CELLS:
        return _aligned(template, own, True)
    # where the best stretch of own ends, and from there back, where it begins
    last = int(_row(template, own, True).argmax())
    first = last - int(_row(template[::-1], own[:last][::-1], True).argmax())
    return [(a, b + first) for a, b in _halved(template, own[first:last])]


def _halved(template: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    if (len(template) + 1) * (len(own) + 1) <= CELLS or len(template) < 2:
        return _aligned(template, own, False)
    half = len(template) // 2
    cut = int((_row(template[:half], own, False) + _row(template[half:][::-1], own[::-1], False)[::-1]).argmax())
    return _halved(template[:half], own[:cut]) + [(a + half, b + cut) for a, b in _halved(template[half:], own[cut:])]


def _next(row: np.ndarray, word: int, own: np.ndarray, at: np.ndarray, lowest: int) -> np.ndarray:
    new = row - 1
    new[1:] = np.maximum(new[1:], np.where(own == word, row[:-1] + 1, lowest))
    return np.maximum.accumulate(new + at) - at


def _row(template: np.ndarray, own: np.ndarray, free: bool) -> np.ndarray:
    """Scores of the whole template against each beginning of own; free: what comes before it costs nothing."""
    at = np.arange(len(own) + 1)
    row, lowest = (np.zeros(len(own) + 1, np.int64) if free else -at), -len(template) - len(own) - 1
    for word in template.tolist():
        row = _next(row, word, own, at, lowest)
    return row


def _aligned(template: np.ndarray, own: np.ndarray, free: bool) -> list[tuple[int, int]]:
    n, at = len(template), np.arange(len(own) + 1)
    best = np.zeros((n + 1, len(own) + 1), np.int32)
    if not free:
        best[0] = -at
    for a in range(n):
        best[a + 1] = _next(best[a], template[a], own, at, -n - len(own) - 1)
    pairs, a, b = [], n, int(best[n].argmax()) if free else len(own)
    while a and b:
        if own[b - 1] == template[a - 1] and best[a, b] == best[a - 1, b - 1] + 1:
            a, b = a - 1, b - 1
            pairs.append((a, b))
        elif best[a, b] == best[a - 1, b] - 1:
            a -= 1
        else:
            b -= 1
    return pairs[::-1]


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = [words(t) for t in templates.values()]
        self.plain = zstandard.ZstdCompressor(level=3)
        self.with_template = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for t in templates.values()]
        self.number = {w: i for i, w in enumerate(sorted({w for t in self.words for w in t}), 1)}
        self.codes = [np.array([self.number[w] for w in t]) for t in self.words]
        self.times = [np.bincount(t, minlength=len(self.number) + 1) for t in self.codes]
        #: Words of a template that have to be there, and words that may be in between.
        self.need = [int(np.ceil(CONFIRMED * len(t) - 1e-9)) for t in self.codes]
        self.extra = [int((1 - CONFIRMED) * len(t) + 1) for t in self.codes]
        self.member = np.zeros((len(self.number) + 1, len(self.words)), np.int32)
        for k, t in enumerate(self.codes):
            self.member[t, k] = 1

    def alone(self, block: str) -> int:
        return len(self.plain.compress(block.encode()))

    def reductions(self, block: str) -> np.ndarray:
        """Share of the block's compressed size that each template saves."""
        raw, alone = block.encode(), self.alone(block)
        return np.array([1 - len(c.compress(raw)) / alone for c in self.with_template])

    def wording(self, k: int, own: list[str], pairs: list[tuple[int, int]]) -> tuple[float, list[str], list[str]]:
        """Share of the template's words that are aligned; missing words; words in between."""
        kept, held = {a for a, _ in pairs}, {b for _, b in pairs}
        between = [own[i] for i in range(pairs[0][1], pairs[-1][1]) if i not in held] if pairs else []
        return len(pairs) / len(self.words[k]), [w for i, w in enumerate(self.words[k]) if i not in kept], between

    def blocks(self, k: int, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first, before last) of the runs of words that may hold template k: those with most of its words, and then others as far apart as its tolerance."""
        n, m = len(self.codes[k]), len(codes)
        extra, need = self.extra[k], self.need[k]
        reach = n + extra
        sums = np.concatenate(([0], np.cumsum(self.member[codes, k], dtype=np.int32)))
        fits = np.flatnonzero(sums[np.minimum(np.arange(m) + reach, m)] - sums[:m] >= need)
        if not len(fits):
            return
        for run in np.split(fits, np.flatnonzero(np.diff(fits) > 1) + 1):
            # pieces of two windows, one window apart, so that each window is whole in one of them
            for lo in range(run[0], run[-1] + 1, reach):
                hi = min(lo + 2 * reach, run[-1] + reach, m)
                if self.shared(k, codes[lo:hi]) < need:
                    continue
                starts = np.arange(lo, max(hi - n, lo) + 1)
                counts = sums[np.minimum(starts + n, m)] - sums[starts]
                while counts.max(initial=0) >= need - extra:
                    best = int(counts.argmax())
                    yield int(starts[best]), min(int(starts[best]) + n, m)
                    counts[max(best - extra, 0) : best + extra + 1] = 0

    def shared(self, k: int, codes: np.ndarray) -> int:
        """Words of template k that are among these, in any order."""
        own = codes[self.member[codes, k] > 0]
        return int(np.minimum(np.bincount(own, minlength=len(self.number) + 1), self.times[k]).sum()) if len(own) else 0

    def winner(self, text: str, found: list, codes: np.ndarray, first: int, last: int) -> tuple[int, list[tuple[int, int]]] | None:
        """(template, alignment) of the best of the ranking by savings whose wording is at this block."""
        saved = self.reductions(text[found[first].start() : found[last - 1].end()])
        for k in np.argsort(-saved, kind="stable").tolist():
            around = len(self.codes[k]) + self.extra[k]
            lo, hi = max(0, first - around), min(len(codes), last + around)
            if saved[k] <= 0 or self.shared(k, codes[lo:hi]) < self.need[k]:
                continue
            pairs = [(a, b + lo) for a, b in align(self.codes[k], codes[lo:hi])]
            if len(pairs) >= self.need[k] and pairs[-1][1] - pairs[0][1] + 1 - len(pairs) <= self.extra[k] and pairs[0][1] < last and pairs[-1][1] >= first:
                return k, pairs
        return None

    def confirmed(self, text: str) -> list[tuple[int, int, dict]]:
        """(start, end, finding) of every licence in the text, in order."""
        found = list(_WORDS.finditer(text))
        own = [m[0].lower() for m in found]
        codes = np.array([self.number.get(w, 0) for w in own], np.int64)
        judged, seen = {}, set()
        for k in range(len(self.words)):
            for block in self.blocks(k, codes):
                if block in seen:
                    continue
                seen.add(block)
                if best := self.winner(text, found, codes, *block):
                    judged[best[0], best[1][0][1], best[1][-1][1]] = best[1]
        ranked = []
        for (k, first, last), pairs in judged.items():
            start, end = found[first].start(), found[last].end()
            saved = float(self.reductions(text[start:end])[k])
            ranked.append((-saved * self.alone(text[start:end]), k, first, last, start, end, saved, pairs))
        taken, out = np.zeros(len(own), bool), []
        for _, k, first, last, start, end, saved, pairs in sorted(ranked, key=lambda r: r[:4]):
            if not taken[first : last + 1].any():
                taken[first : last + 1] = True
                share, missing, between = self.wording(k, own, pairs)
                out.append((start, end, {"license": self.licence(k), "template": self.names[k], "reduction": round(saved, 6), "wording": round(share, 6), "missing": missing, "between": between}))
        return sorted(out, key=lambda x: x[:2])

    def licence(self, k: int) -> str:
        return next((self.names[k].removesuffix(x) for x in _FORMS if self.names[k].endswith(x)), self.names[k])

    def unknown(self, block: str) -> dict:
        """The likeliest template of a block that has no confirmed licence: the best of its windows."""
        ends = list(range(0, max(len(block) - WINDOW // 2, 1), WINDOW // 2))
        savings = [self.reductions(block[a : a + WINDOW]) for a in ends]
        at = max(range(len(ends)), key=lambda i: (float(savings[i].max()), -i))
        saved, own = savings[at], words(block[ends[at] : ends[at] + WINDOW])
        k = int(saved.argmax())
        share, missing, between = self.wording(k, own, align(self.codes[k], np.array([self.number.get(w, 0) for w in own], np.int64)))
        return {"license": "unknown", "template": self.names[k], "reduction": round(float(saved[k]), 6), "wording": round(share, 6), "missing": missing, "between": between}

    def scan(self, block: str) -> dict:
        """The licence of a block that is held to have one: the one with the most words of its template."""
        good = [x for _, _, x in self.confirmed(block)]
        return max(good, key=lambda x: len(self.words[self.names.index(x["template"])]) - 2 * len(x["missing"]) - len(x["between"])) if good else self.unknown(block)


def _near(line: str, at: int, cue: re.Pattern) -> list[tuple[int, int]]:
    """Places of a line: all of it if it is short, else what is near its licence words, to the next space."""
    if len(line) <= 2 * REACH:
        return [(at, at + len(line))]
    out: list[tuple[int, int]] = []
    for m in cue.finditer(line):
        first, last = max(0, m.start() - REACH), min(len(line), m.end() + REACH)
        first = line.find(" ", first, m.start()) + 1 or first if first else 0
        last = (line.rfind(" ", m.end(), last) if last < len(line) else last) or last
        last = max(last, m.end())
        if out and first + at <= out[-1][1]:
            out[-1] = (out[-1][0], max(last + at, out[-1][1]))
        else:
            out.append((first + at, last + at))
    return out


def blocks(text: str, cue: re.Pattern) -> list[tuple[int, str]]:
    """(start, text) of the runs of lines with a licence word; one other line may stand between. Of long lines, only what is near the word."""
    spans, at, run, gap, reached = [], 0, None, 0, 0
    for line in text.split("\n"):
        end = at + len(line)
        if cue.search(line):
            near = _near(line, at, cue)
            if run and near[0][0] == at and run[1] == reached:
                near[0] = (run[0], near[0][1])
            elif run:
                spans.append(run)
            spans += near[:-1]
            run, gap, reached = near[-1], 0, end
        elif run:
            gap += 1
            if gap > 1 or not line.strip():
                spans.append(run)
                run, gap = None, 0
        at = end + 1
    if run:
        spans.append(run)
    return [(a, text[a:b]) for a, b in spans]


_OUT = "start int, length int, license string, template string, reduction double, wording double, missing array<string>, between array<string>"


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """One row per confirmed licence and per unknown block: doc_id, its place in characters, licence, savings and wording."""
    templates = templates or TEMPLATES | full_texts()
    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").rlike(CUE))
    kind = docs.schema[doc_id].dataType.simpleString()
    strings = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, cue = Scanner(templates), re.compile(CUE)
        known: dict[str, dict] = {}
        for batch in batches:
            rows, owners = [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                good = scanner.confirmed(body)
                found = [(start, end - start, x) for start, end, x in good]
                for start, block in blocks(body, cue):
                    if any(a < start + len(block) and start < b for a, b, _ in good):
                        continue
                    if block not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[block] = scanner.unknown(block)
                    found.append((start, len(block), known[block]))
                for start, length, x in sorted(found, key=lambda f: f[:2]):
                    rows.append({"start": start, "length": length, **x})
                    owners.append(i)
            table = pa.Table.from_pylist(rows, pa.schema([("start", pa.int32()), ("length", pa.int32()), ("license", pa.string()), ("template", pa.string()), ("reduction", pa.float64()), ("wording", pa.float64()), ("missing", strings), ("between", strings)])).combine_chunks()
            ids = batch.column(0).take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns)], names=["doc_id", *table.column_names])

    return some.mapInArrow(run, f"doc_id {kind}, {_OUT}")

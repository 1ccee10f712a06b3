"""License notices by conditional compression.

Blocks of text around what speaks of a license reach as far as the longest
template to both sides.  Each block is compressed by zstandard alone and with
each template as a raw dictionary, and the templates are ranked by the bytes
they save.  In that order they are confirmed by their wording: the stretch of
the block that comes nearest to a template word by word, where few words may
differ.  A confirmed stretch is compressed by itself in the same two ways; of
those that overlap the one whose template saves most bytes is the notice, and
none is that its template does not shorten.  Stretches found are taken out
before the next.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_REDUCTION = 0.15
MOST_DIFFERENCES = 0.2  # of a template's words
PIECE_WORDS = 1_000  # longer blocks are compared in pieces that overlap by a whole stretch

# Customary wordings of license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied.",
    "MIT": "Released under the MIT License.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
        "or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "All rights reserved.",
}
CUES = (r"(?i)\b(?:licen[cs]e[ds]?|copyright(?:ed)?|rights\W+reserved|permission\W+(?:is|to)|redistribut\w+"
        r"|public\W+domain|free\W+software|source\W+code\W+form|waived\W+all)\b")
_CUE = re.compile(CUES)
_WORD = re.compile(r"\w+(?:[.\-]\w+)*")
_WORDS = _WORD.findall


def blocks(text: str, reach: int) -> list[list[tuple[int, int]]]:
    """Blocks as (first character, end) of their words: ``reach`` words to both
    sides of each cue, whatever the lines."""
    cues = [m.span() for m in _CUE.finditer(text)]
    if not cues:
        return []
    starts, ends = array("q"), array("q")
    for m in _WORD.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
    spans: list[list[int]] = []
    for a, b in cues:
        first, end = max(0, bisect_left(ends, a) - reach), min(len(starts), bisect_left(starts, b) + reach)
        if spans and first <= spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([first, end])
    return [list(zip(starts[a:b], ends[a:b])) for a, b in spans]


def differences(template: list[str], block: list[str]) -> tuple[int, list[str]]:
    """Fewest word edits from ``template`` to a stretch of ``block``: their
    number and wording (``-word`` missing, ``+word`` added)."""
    total, _, _, out = stretch(template, block)
    return total, out


def stretch(template: list[str], block: list[str]) -> tuple[int, int, int, list[str]]:
    """The number of ``differences``, first word and end of the stretch, wording."""
    n, m = len(template), len(block)
    cost = [[0] * (m + 1)] + [[i] + [0] * m for i in range(1, n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (template[i - 1] != block[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    j = min(range(m + 1), key=lambda x: (cost[n][x], x))
    total, end, i, out = cost[n][j], j, n, []
    while i:
        if j and cost[i][j] == cost[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            if template[i - 1] != block[j - 1]:
                out += [f"+{block[j - 1]}", f"-{template[i - 1]}"]
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + 1:
            out.append(f"-{template[i - 1]}")
            i -= 1
        else:
            out.append(f"+{block[j - 1]}")
            j -= 1
    return total, j, end, out[::-1]


class Scanner:
    def __init__(self, templates: dict[str, str], least: float = LEAST_REDUCTION, most: float = MOST_DIFFERENCES):
        self.least, self.most = least, most
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}

        def against(text):
            raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(level=3, dict_data=raw, **options)

        self.alone = zstandard.ZstdCompressor(level=3, **options)
        self.templates, self.counts = {}, {}
        for name, text in templates.items():
            words = [w.lower() for w in _WORDS(text)]
            self.templates[name] = against(text), against(text.lower()), words
            self.counts[name] = Counter(words)
        # words of the longest stretch that can be confirmed
        self.reach = max((int(len(t[2]) * (1 + most)) + 1 for t in self.templates.values()), default=0)

    def _ranked(self, words: list[str]) -> list[str]:
        """Templates by the bytes they save in a block as dictionaries, most first."""
        data = " ".join(words).encode("utf-8", "replace")
        sizes = {name: len(low.compress(data)) for name, (_, low, _) in self.templates.items()}
        return sorted(sizes, key=lambda name: (sizes[name], name))

    def _sizes(self, name: str, text: str):
        """(bytes saved, bytes alone, bytes with its template) of a stretch, or
        None if the template does not shorten it, upper and lower case aside."""
        z, low, _ = self.templates[name]
        data = text.lower().encode("utf-8", "replace")
        plain = len(self.alone.compress(data))
        saved = plain - len(low.compress(data))
        if saved / plain < self.least:
            return None
        data = text.encode("utf-8", "replace")
        return saved, len(self.alone.compress(data)), len(z.compress(data))

    @staticmethod
    def _bounds(text: str, spans: list[tuple[int, int]], a: int, b: int) -> tuple[int, int]:
        """First character and end of words ``a`` to ``b`` with the marks at both ends."""
        start, end = spans[a][0], spans[b - 1][1]
        while start > (spans[a - 1][1] if a else 0) and not text[start - 1].isspace():
            start -= 1
        while end < (spans[b][0] if b < len(spans) else len(text)) and not text[end].isspace():
            end += 1
        return start, end

    def _piece(self, text: str, spans: list[tuple[int, int]], words: list[str], last: bool):
        """(first word, end, license, bytes alone, bytes with its template, number
        of differences, differences) of the notices in a piece.  Those that
        begin within the overlap with the next piece are left to it."""
        words, out, best = list(words), [], {}
        ranked = self._ranked(words)
        todo = set(ranked)
        while todo or best:
            have = Counter(words) if todo else None
            for rank, name in enumerate(ranked):
                if name not in todo:
                    continue
                template = self.templates[name][2]
                most = self.most * len(template)
                if sum(max(0, n - have[w]) for w, n in self.counts[name].items()) > most:
                    continue
                n, a, b, what = stretch(template, words)
                if n <= most and b > a:
                    start, end = self._bounds(text, spans, a, b)
                    sizes = self._sizes(name, " ".join(text[start:end].split()))
                    best[name] = (-sizes[0] if sizes else 0, rank, n, a, name, b, what, start, sizes)
            todo = set()
            if not best:
                break
            _, _, n, a, name, b, what, start, sizes = min(best.values())
            if not last and a >= len(words) - self.reach:
                pass
            elif sizes:
                out.append((a, b, start, name, *sizes[1:], n, what))
            else:  # not this template's: others may still be found there
                del best[name]
                continue
            words[a:b] = [""] * (b - a)
            todo = {k for k, x in best.items() if x[3] < b and a < x[5]}
            for k in todo:
                del best[k]
        return out

    def text(self, text: str):
        """(first character, license, bytes alone, bytes with its template,
        reduction, number of differences, differences) of each notice."""
        out = []
        for spans in blocks(text, self.reach):
            words = [text[a:b].lower() for a, b in spans]
            at, size = 0, max(PIECE_WORDS, 2 * self.reach)
            while True:
                last = at + size >= len(words)
                for a, b, start, name, plain, with_it, n, what in self._piece(
                        text, spans[at:at + size], words[at:at + size], last):
                    words[at + a:at + b] = [""] * (b - a)
                    out.append((start, name, plain, with_it, (plain - with_it) / plain, n, what))
                if last:
                    break
                at += size - self.reach
        return sorted(out)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
         templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each stretch that is a license notice: ``keep``, block_start
    (its first character), license, plain_bytes, dict_bytes, reduction, n_differences and
    differences.  Null and empty texts give none; repeated rows each give theirs.
    """
    chosen = TEMPLATES if templates is None else templates
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("keep"), F.col(text).cast("string").alias("t"))
    kind = rows.schema["keep"].dataType.simpleString()
    names = ["block_start", "license", "plain_bytes", "dict_bytes", "reduction", "n_differences", "differences"]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.list_(pa.string())]

    def run(batches):
        scanner = Scanner(chosen)
        for batch in batches:
            found = [(i, x) for i, t in enumerate(batch.column(1).to_pylist()) for x in scanner.text(t)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([i for i, _ in found], pa.int64())),
                 *[pa.array([x[k] for _, x in found], kinds[k]) for k in range(7)]], ["keep", *names])

    return rows.filter(F.col("t").rlike(CUES)).mapInArrow(
        run, f"keep {kind}, block_start long, license string, plain_bytes int, dict_bytes int, reduction double, "
             "n_differences int, differences array<string>").select("keep.*", *names)

"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

A text is compared line by line, paragraph by paragraph (lines up to a blank one) and whole. With bigram sets ``A`` and
``B`` the coefficient ``2 |A & B| / (|A| + |B|)`` can reach ``LEAST`` only if neither set is larger than ``(2 - LEAST) / LEAST``
times the other, so a template is looked at only within these bounds and only if it shares a bigram with the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.85
WORD = re.compile(r"[a-z0-9]+")

#: Notices by which texts name their licence, and the wording of short licences.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
    "to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
    "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


class Templates:
    def __init__(self, texts: dict[str, str], least: float):
        known = sorted((len(grams), name, grams) for name, text in texts.items() if (grams := bigrams(WORD.findall(text.lower()))))
        self.sizes, self.names, self.grams = [k[0] for k in known], [k[1] for k in known], [k[2] for k in known]
        self.least, self.reach = least, (2 - least) / least
        self.every = frozenset(g for grams in self.grams for g in grams)

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """The template with the largest coefficient, the first by name among equals, if it reaches ``least``."""
        most = len(words) - 1
        if most < self.sizes[0] / self.reach:
            return None
        shared = [g for g in zip(words, words[1:], strict=False) if g in self.every]
        if not shared:
            return None
        grams = bigrams(words)
        start, end = bisect_left(self.sizes, len(grams) / self.reach), bisect_right(self.sizes, len(grams) * self.reach)
        found = [(2 * len(self.grams[k] & grams) / (self.sizes[k] + len(grams)), self.names[k]) for k in range(start, end)]
        found = [f for f in found if f[0] >= self.least]
        return min(found, key=lambda f: (-f[0], f[1])) if found else None


def units(text: str):
    """``(start, end)`` of every line, every paragraph of several lines, and the whole of several paragraphs."""
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    paragraphs, held = [], []
    for start, end in [*lines, (0, 0)]:
        if text[start:end].strip():
            held.append((start, end))
        else:
            if len(held) > 1:
                paragraphs.append((held[0][0], held[-1][1]))
            held = []
    whole = [(0, len(text))] if (0, len(text)) not in lines and (0, len(text)) not in paragraphs else []
    return [*lines, *paragraphs, *whole]


def hits(text: str, templates: Templates) -> list[tuple[int, int, str, float]]:
    """``(start, end, licence, coefficient)``; of hits inside one another the better stays."""
    found = []
    for start, end in units(text):
        best = templates.best(WORD.findall(text[start:end].lower()))
        if best is not None:
            found.append((start, end, best[1], best[0]))
    found.sort(key=lambda h: (-h[3], h[0], h[1]))
    kept: list[tuple[int, int, str, float]] = []
    for hit in found:
        if all(hit[1] <= k[0] or k[1] <= hit[0] for k in kept):
            kept.append(hit)
    return sorted(kept)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_licences, licence, dice, spans)``, a row for each row of ``docs``.

    ``licence`` is the best hit's (the first in the text among equals), null without one; ``dice`` is its coefficient
    rounded to six places; ``spans`` lists every hit as ``licence:start:end`` in code points. Null and empty texts have no
    hits. Repeated rows are scanned each time; other columns play no part.
    """
    texts = TEMPLATES if templates is None else templates

    def run(batches):
        known = Templates(texts, least)
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = hits(body or "", known)
                best = min(found, key=lambda h: (-h[3], h[0]), default=(0, 0, None, None))
                spans = ",".join(f"{name}:{start}:{end}" for start, end, name, _ in found)
                rows.append((doc, len(found), best[2], None if best[3] is None else round(best[3], 6), spans))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_licences", "licence", "dice", "spans"]
            )

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_licences long, licence string, dice double, spans string")

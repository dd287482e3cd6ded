"""License scans: winnowed template fingerprints pick candidates, banded alignment measures them.

Words are ASCII letters and digits, lower-cased, and bytes over 127, so case,
punctuation and layout do not count. Each template's ``gram``-word hashes are
winnowed: of each ``winnow`` consecutive ones the least is a fingerprint, in
an inverted index from hash to (template, position). The index depends on the
templates alone and goes to every task; documents are probed with all their
grams, not winnowed ones, so a copy of any run that holds a fingerprint is
met even where the template is shorter than a winnowing window. Grams and
windows shrink, by template length, until the longest run that the changed
words ``min_coverage`` allows must leave whole holds a fingerprint.

Hits on nearby diagonals (document position less template position, at most
``band`` apart) are one candidate. It is aligned with its template by local
alignment of words (match 1, mismatch or gap -1; of equal scores the one with
most words matched) within ``band`` of the
diagonals that were hit; the words matched over the template's words are its
coverage, reported from ``min_coverage`` on with the span of the text from the
first matched word to the last. Hits that spread over more than four bands are
aligned in overlapping windows of four bands, half of them shared by the next,
so a row of the alignment stays bounded. A document is never shuffled or split.

Thirteen notices are built in; ``templates_of`` takes any others, full texts
too, from a table.

Edge cases: null and empty texts have no match; a null doc_id is kept; each
place of a document is reported once for each template; repeated rows give
repeated results; a template without words never matches; an empty table gives
an empty result. A very long text is a batch of its own, held with a few arrays
of its words; columns but doc_id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.rolling import BASES, Chunk

GRAM = 3
WINNOW = 4
BAND = 8
MIN_COVERAGE = 0.8
CHUNK_BYTES = 2 << 20
#: Templates go to every task, so a table of them may hold so many bytes of text at most.
TEMPLATE_BYTES = 64 << 20

#: License notices (fixed values; any other templates can be given).
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions: The above copyright notice and this permission notice shall be included in all "
           "copies or substantial portions of the Software.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                        "the License, or (at your option) any later version.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the "
                        "GNU General Public License as published by the Free Software Foundation; either version 2 of "
                        "the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met: Redistributions of source code must retain the "
                    "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
                    "binary form must reproduce the above copyright notice, this list of conditions and the following "
                    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

_FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def align(text: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(words matched, first, one past the last word of ``text``) of the best local alignment.

    Only cells whose diagonal, text position less template position, is from
    ``low`` to ``high`` are filled: a band of a row for each template word.
    """
    width = high - low + 1
    # in units of 1 / (template + 1), so that a match counts a little more than a gap: ties go to more matches
    unit = len(template) + 1
    score = np.zeros((len(template) + 1, width + 2), np.int32)  # one cell of margin at each end
    lane = np.arange(width)
    for q, word in enumerate(template):
        at = q + low + lane
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == word
        # the same diagonal is the same lane one row up; a word left out of the text is one lane on
        best = np.maximum(score[q, 1:-1] + np.where(same, unit + 1, -unit), score[q, 2:] - unit)
        best = np.where(inside, np.maximum(best, 0), 0)
        # gaps along the row: the best of what stands to the left, less one a lane
        score[q + 1, 1:-1] = np.maximum(np.maximum.accumulate(best + unit * lane) - unit * lane, 0)
    if not score.max():
        return 0, 0, 0
    q, k = np.unravel_index(int(score.argmax()), score.shape)
    matched, first, last = 0, None, None
    while q > 0 and score[q, k] > 0:
        p = q - 1 + low + k - 1
        same = 0 <= p < len(text) and text[p] == template[q - 1]
        if same and score[q, k] == score[q - 1, k] + unit + 1:
            matched, first, last = matched + 1, p, p + 1 if last is None else last
            q -= 1
        elif score[q, k] == score[q, k - 1] - unit:
            k -= 1
        elif score[q, k] == score[q - 1, k] - unit:
            q -= 1
        else:
            q, k = q - 1, k + 1
    return matched, int(first), int(last)


class Index:
    """Winnowed fingerprints of the templates: sorted hashes and their (template, position)."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, winnow: int = WINNOW,
                 min_coverage: float = MIN_COVERAGE):
        self.gram, self.names, self.words = gram, list(templates), []
        postings = set()
        for t, text in enumerate(templates.values()):
            c = Chunk([text.encode()], _FOLD)
            w = c.word_hashes(BASES[0])
            self.words.append(w)
            # the longest run of words left whole by as many changes as the coverage allows
            changes = int(len(w) * (1 - min_coverage) + 1e-9)
            run = -(-(len(w) - changes) // (changes + 1))
            for size in {min(gram, max(run, min(1, len(w))))} - {0}:
                h, at = self.grams(c, size)
                window = min(winnow, max(1, run - size + 1))
                for i in range(max(1, len(h) - window + 1)):
                    part = h[i:i + window]
                    least = i + len(part) - 1 - int(part[::-1].argmin())  # the last of equal ones
                    postings.add((size, int(h[least]), t, int(at[least])))
        self.by_size = {}
        for size in sorted({p[0] for p in postings}):
            rows = sorted(p[1:] for p in postings if p[0] == size)
            self.by_size[size] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]),
                                  np.array([r[2] for r in rows]))

    @staticmethod
    def grams(c: Chunk, size: int):
        return c.windows(size, BASES[0])

    def seeds(self, c: Chunk):
        """(text, template, diagonal) of every hit, sorted."""
        out = []
        for size, (keys, template, position) in self.by_size.items():
            h, at = self.grams(c, size)
            a, b = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            hit = np.flatnonzero(b > a)
            n = (b - a)[hit]
            where = np.repeat(at[hit], n)
            which = np.repeat(a[hit] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            out.append((c.text_of[where] if len(where) else where, template[which], where - position[which]))
        if not out:
            return [np.empty(0, np.int64)] * 3
        text, template, diagonal = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((diagonal, template, text))
        return text[order], template[order], diagonal[order]


def found(texts: list[bytes], index: Index, band: int = BAND, min_coverage: float = MIN_COVERAGE):
    """(text, template, matched, template words, first byte, one past the last) of every match in ``texts``."""
    c = Chunk(texts, _FOLD)
    text, template, diagonal = index.seeds(c)
    if not len(text):
        return []
    words = c.word_hashes(BASES[0])
    new = np.r_[True, (text[1:] != text[:-1]) | (template[1:] != template[:-1]) | (diagonal[1:] - diagonal[:-1] > band)]
    begins = np.flatnonzero(new)
    out, seen = [], set()
    for i, j in zip(begins, [*begins[1:], len(text)]):
        t, k = int(text[i]), int(template[i])
        own = words[c.offsets[t]:c.offsets[t + 1]]
        base, pattern = int(c.offsets[t]), index.words[k]
        low, high = int(diagonal[i]) - base - band, int(diagonal[j - 1]) - base + band
        # a run of hits wider than two bands is taken band by band, so a row stays bounded
        for at in range(low, high - band + 1, 2 * band) if high - low > 4 * band else (low,):
            top = min(at + 4 * band, high) if high - low > 4 * band else high
            parts = [(max(0, at), max(0, min(len(own), top + len(pattern))))]
            while parts:  # what stands before and after a match may hold another
                a, z = parts.pop()
                if z - a < min_coverage * len(pattern):
                    continue
                matched, first, last = align(own[a:z], pattern, at - a, top - a)
                if matched and matched >= min_coverage * len(pattern):
                    parts += [(a, a + first), (a + last, z)]
                    b, e = int(c.begins[base + a + first]), int(c.ends[base + a + last - 1])
                    if (t, k, b, e) not in seen:
                        seen.add((t, k, b, e))
                        out.append((t, k, matched, len(pattern), b - int(c.text_at[t]), e - int(c.text_at[t])))
    return out


def templates_of(table: DataFrame, name: str = "license", text: str = "text",
                 most: int = TEMPLATE_BYTES) -> dict[str, str]:
    """Templates from a table, by name: full license texts or any others.

    Their bytes are summed first, and more than ``most`` is an error. A name that
    occurs with several texts gets one template each, "name", "name (2)" and so
    on in order of the texts; rows without name or words are left out.
    """
    t = table.select(F.col(name).cast("string").alias("n"), F.col(text).cast("string").alias("t")).dropna().distinct()
    size = t.agg(F.sum(F.octet_length("n") + F.octet_length("t"))).first()[0] or 0
    if size > most:
        raise ValueError(f"templates hold {size} bytes, more than {most}")
    out: dict[str, str] = {}
    seen: dict[str, int] = {}
    for n, body in sorted(map(tuple, t.collect())):
        if body.encode().translate(_FOLD).split():
            seen[n] = seen.get(n, 0) + 1
            out[n if seen[n] == 1 else f"{n} ({seen[n]})"] = body
    return out


_SCHEMA = ("license string, coverage double, matched_words bigint, template_words bigint, start bigint, "
           "`end` bigint, matched string")


def scanned(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, gram: int = GRAM,
            winnow: int = WINNOW, band: int = BAND, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, matched_words, template_words, start, end, matched), one row a match.

    start and end are the span's code points in the text, matched its words.
    """
    index = Index(TEMPLATES if templates is None else templates, gram, winnow, min_coverage)
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            i = 0
            while i < batch.num_rows:
                part, held, at = [], 0, i
                while i < batch.num_rows and held < CHUNK_BYTES:
                    part.append(texts[i].as_py() or b"")
                    held += len(part[-1])
                    i += 1
                rows = found(part, index, band, min_coverage)
                spans_ = [(part[t][:b].decode(), part[t][b:e].decode()) for t, _, _, _, b, e in rows]
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array([at + r[0] for r in rows], pa.int64())),
                    pa.array([index.names[r[1]] for r in rows], pa.string()),
                    pa.array([r[2] / r[3] for r in rows], pa.float64()),
                    pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([len(x) for x, _ in spans_], pa.int64()),
                    pa.array([len(x) + len(y) for x, y in spans_], pa.int64()),
                    pa.array([y for _, y in spans_], pa.string())],
                    names=["doc_id", "license", "coverage", "matched_words", "template_words", "start", "end", "matched"])

    d = docs.select("doc_id", F.col(text).cast("string").cast("binary"))
    return d.mapInArrow(run, f"doc_id {id_type.simpleString()}, {_SCHEMA}")


def run(spark, sf_dir: str) -> DataFrame:
    return scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))

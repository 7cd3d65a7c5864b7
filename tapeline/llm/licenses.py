"""License notices in documents, by conditional compression.

A block of text that compresses much better once the compressor has seen a template
repeats the template.  Candidate blocks are compressed alone and with each template
as raw dictionary; the templates are ranked by what they save, and the best ones are
confirmed by the words in which block and template differ.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The usual wording of notices, by SPDX name.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)
#: Words that a notice cannot do without; where one of a template's is missing or
#: another stands in the block, it is a notice of another license.
NAMES = frozenset(
    "mit apache gnu lesser affero mozilla mpl cc by sa nc nd attribution sharealike noncommercial"
    " noderivatives 1 2 3 4 0".split()
)

#: Words that say nothing of a license, though templates have them.
COMMON = frozenset("a and any at by for from if in is it may of or that the this to was with you".split())

#: A candidate holds one of these words.
TRIGGER = r"(?i)licen[cs]e|sublicense|redistribut|permission[\W_]+is[\W_]+hereby|waived[\W_]+all[\W_]+copyright"
WORD = re.compile(r"[^\W_]+")
#: Blanks, line ends and signs between them (of a comment, say): one blank to the compressor.
GAP = re.compile(r"\s+(?:[^\w\s]+\s+)*")
DROP = 4  # a block grows until its score is so far below its best
MARGIN = 3  # words around it that are looked at, too
LEAST_SAVED = 0.25  # part of its own or the block's compressed size that a template must save
MOST_CHANGED = 0.25  # words missing or added, of the template's words

HITS = (
    "block int, start int, stop int, license string, template int, alone_bytes int, given_bytes int,"
    " missing array<string>, added array<string>, confirmed boolean"
)


@lru_cache(maxsize=4)
def prepared(templates: tuple) -> tuple:
    """Of each template the compressor, the compressed size and the words; and all
    words together."""
    out = []
    for name, text in templates:
        raw = packed(text)
        words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        size = len(packer().compress(raw))
        out.append((name, packer(words), size, [w.lower() for w in WORD.findall(text)]))
    return out, frozenset(w for *_, words in out for w in words)


def packed(text: str) -> bytes:
    """What the compressor is given of a text."""
    return GAP.sub(" ", text.lower()).encode("utf-8", "replace")


def packer(words: zstandard.ZstdCompressionDict | None = None) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=19, dict_data=words, write_content_size=False, write_dict_id=False)


def reach(templates: tuple) -> tuple[int, int]:
    """Words of the longest template, and of the longest notice of it with a margin."""
    longest = max(len(wanted) for *_, wanted in prepared(templates)[0])
    return longest, longest + int(MOST_CHANGED * longest) + MARGIN


def candidates(text: str, known: frozenset, most: int = 100) -> list[tuple[int, int]]:
    """Spans around trigger words, as far as words of templates prevail: 1 for such
    a word, 0 for a common one and -1 for another, until the score has dropped by
    DROP or ``most`` words are passed; and a few words around.

    Of the triggers within a span only the last is followed to the right: none before it
    reaches farther.  So each word is looked at a few times, however many triggers
    there are."""
    words = [(m.start(), m.end(), m[0].lower()) for m in WORD.finditer(text)]
    ends = [end for _, end, _ in words]
    triggers = sorted({bisect_right(ends, m.start()) for m in re.finditer(TRIGGER, text)} - {len(words)})

    def walk(k: int, step: int) -> int:
        best = i = k
        score = top = 0
        while 0 <= i + step < len(words) and score > top - DROP and abs(i - k) < most:
            i += step
            word = words[i][2]
            score += 0 if word in COMMON else 1 if word in known else -1
            if score > top:
                top, best = score, i
        return min(max(best + step * MARGIN, 0), len(words) - 1)

    spans: list[tuple[int, int]] = []
    t = 0
    while t < len(triggers):
        first, last = walk(triggers[t], -1), walk(triggers[t], 1)
        while (inside := bisect_right(triggers, last) - 1) > t:
            t = inside
            last = max(walk(triggers[t], 1), last)
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(last, spans[-1][1]))
        else:
            spans.append((first, last))
        t += 1
    return [(words[first][0], words[last][1]) for first, last in spans]


def differences(block: list[str], template: list[str]) -> tuple[list[str], list[str], int, int]:
    """Words to add to a stretch of the block and to take from it to get the template:
    of all stretches and common subsequences with the fewest such words the one with
    the most common words, the last of equals.  Words of the block around the stretch
    are no difference; where it lies is given, too."""
    n = len(template)
    # the words in common less those added, and of equals more words in common
    rows = [[0] * (n + 1)]
    for b in block:
        last, row = rows[-1], [0]
        for j, t in enumerate(template):
            row.append(max(last[j] + 1001 if b == t else 0, last[j + 1] - 1000, row[j]))
        rows.append(row)
    i = max(range(len(rows)), key=lambda k: (rows[k][n], k))
    j, missing, common = n, [], []
    while rows[i][j] > 0:
        if block[i - 1] == template[j - 1] and rows[i][j] == rows[i - 1][j - 1] + 1001:
            i, j = i - 1, j - 1
            common.append(i)
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
            missing.append(template[j])
        else:
            i -= 1
    missing = template[:j] + missing[::-1]
    if not common:
        return missing, [], 0, 0
    first, last = common[-1], common[0] + 1
    inside = set(common)
    return missing, [block[i] for i in range(first, last) if i not in inside], first, last


def judged(block: str, templates: tuple) -> tuple:
    """(start, stop, license, number of the template, own size, size given the
    template, missing, added, confirmed) of a block, of the best ranked template that
    is confirmed, or of the best ranked one if none is.  The start and stop leave out
    words around the notice."""
    ready, _ = prepared(templates)
    raw = packed(block)
    alone = len(packer().compress(raw))
    sizes = sorted((len(pack.compress(raw)), k) for k, (_, pack, *_) in enumerate(ready))
    places = [(m.start(), m.end(), m[0].lower()) for m in WORD.finditer(block)]
    words = [w for _, _, w in places]
    best = None
    for size, k in sizes:
        name, _, own, wanted = ready[k]
        saved = alone - size >= LEAST_SAVED * min(alone, own)
        if best and not saved:
            continue
        for at, end in stretches(words, wanted):
            missing, added, first, last = differences(words[at:end], wanted)
            few = len(missing) + len(added) <= MOST_CHANGED * len(wanted)
            good = saved and few and not NAMES & {*missing, *added}
            start, stop = (places[at + first][0], places[at + last - 1][1]) if last else (0, len(block))
            found = (start, stop, name, k, alone, size, missing, added, good)
            if good:
                return found
            best = best or found
    return best


def verdicts(block: str, templates: tuple) -> list[tuple]:
    """As judged, of all notices of a block.  One row if none is confirmed at all: the
    one that saves most.

    A long block is compressed window by window: copies of a notice within a block serve
    the compressor like a template, so a template saves less the longer the block is.
    A window begins behind the last notice; notices that begin in its first part, as
    long as the longest template, are whole in it, later ones are left to the next."""
    longest, margin = reach(templates)
    starts = [m.start() for m in WORD.finditer(block)]
    out: list[tuple] = []
    other = None
    at = 0
    while at == 0 or at < len(starts):
        last = at + longest + margin >= len(starts)
        low = starts[at] if at else 0
        high = len(block) if last else starts[at + longest + margin]
        until = len(block) if last else starts[at + longest]
        at = len(starts) if last else at + longest
        if re.search(TRIGGER, block[low:high]):
            for start, stop, *rest in window_verdicts(block[low:high], templates):
                row = (low + start, low + stop, *rest)
                if not row[-1]:
                    other = max(other or row, row, key=lambda r: r[4] - r[5])
                elif row[0] < until:
                    out.append(row)
                    at = max(at, bisect_left(starts, row[1]))
        if not starts:
            break
    return out or [other or judged(block, templates)]


def window_verdicts(block: str, templates: tuple) -> list[tuple]:
    """As judged, of all notices of a window: what lies before and after a confirmed
    one is judged again, until none is confirmed.  One row if none is at all."""
    whole = judged(block, templates)
    if not whole[-1]:
        return [whole]
    out, parts = [], [(0, len(block), whole)]
    while parts:
        low, high, (start, stop, *rest) = parts.pop()
        start, stop = low + start, low + stop
        out.append((start, stop, *rest))
        for a, b in ((low, start), (stop, high)):
            if re.search(TRIGGER, block[a:b]):
                found = judged(block[a:b], templates)
                if found[-1]:
                    parts.append((a, b, found))
    return sorted(out)


def stretches(words: list[str], wanted: list[str]) -> list[tuple[int, int]]:
    """Parts of a block in which a notice can be confirmed: all that have enough of
    the template's words close together, and the whole of a short block.  If there are
    none, the part with most of the words."""
    n = len(wanted)
    if len(words) <= 2 * n + 20:
        return [(0, len(words))]
    known = set(wanted)
    total = np.cumsum([0, *(w in known for w in words)])
    changed = int(MOST_CHANGED * n)
    ends = np.minimum(np.arange(len(words)) + n + changed, len(words))
    starts = np.flatnonzero(total[ends] - total[:-1] >= n - changed)
    if not len(starts):
        at = around(words, wanted)
        return [(at, at + 2 * n + 20)]
    out: list[tuple[int, int]] = []
    for start in starts.tolist():
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], int(ends[start]))
        else:
            out.append((start, int(ends[start])))
    return out


def around(words: list[str], wanted: list[str]) -> int:
    """Where the stretch of a long block, as long as the template, with most of its
    words begins; some words earlier."""
    known = set(wanted)
    have = [w in known for w in words]
    n = len(wanted)
    total = best = sum(have[:n])
    at = 0
    for i in range(n, len(words)):
        total += have[i] - have[i - n]
        if total > best:
            best, at = total, i - n + 1
    return max(at - 10 - n // 2, 0)


def notices(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple = TEMPLATES,
) -> DataFrame:
    """One row per confirmed notice of a candidate block, or per block without one: the id,
    block (number in the document), start and stop (characters), the license and number of the template that fits best, the
    block's compressed size alone and given the template, the words missing from
    the block and added to it, and whether the notice is confirmed.

    A block is confirmed if the template saves a quarter or more of the block's
    compressed size or of its own, at most a quarter as many words as the template
    has differ, and none of these is a name or version number of a license.  Templates that save equally much rank in
    the order given.  Null and empty texts and those without a trigger word give no
    rows; repeated rows give repeated rows; other columns are not looked at.

    A block of any length is compressed in windows somewhat longer than the longest
    template, so the time grows with the text and a notice is found however many
    others stand around it.

    Documents without a trigger word never leave the JVM; nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *(x.split()[0] for x in HITS.split(", "))]
    kinds = [
        pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(),
        pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_(),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, known = prepared(templates)
        _, most = reach(templates)
        for batch in batches:
            rows, found = [], []
            for r, text in enumerate(batch.column(1)):
                text = text.as_py()
                for k, (start, stop) in enumerate(candidates(text, known, most)):
                    for first, last, *rest in verdicts(text[start:stop], templates):
                        rows.append(r)
                        found.append((k, start + first, start + last, *rest))
            columns = [pa.array([f[i] for f in found], kinds[i]) for i in range(len(kinds))]
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *columns], names)

    some = docs.select(id_col, text_col).filter(F.col(text_col).rlike(TRIGGER))
    return some.mapInArrow(run, f"{id_col} {kind}, {HITS}")

"""License scans by conditional compression.

A candidate is a run of lines that talk about licensing, or words of a template in any
lines, with the words near them.  It is compressed alone and with every license template
as zstandard raw dictionary; the templates are ranked by how much smaller it gets.  The
winners are confirmed by comparing wordings: the words of the candidate that the template
lacks, and the other way.  What lies before and after a confirmed template is searched again.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relload.llm.common import map_texts

# Words that make a line a candidate, lower case.
CUES = ("licens", "licenc", "copyright", "warrant", "spdx", "permission", "redistribut", "public domain", "all rights reserved")

# License wordings as their publishers print them (notices, headers, first paragraphs).
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ),
    "BSD notice": "Licensed under the BSD License.",
    "BSD-3-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "LGPL notice": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "Copyright. All rights reserved.",
}

_MARK = re.compile(r"(?m)^[^\w\n]*(\d{1,2}|[a-z])(?=[.)][ \t]+\S)")  # list numbers are no words of the license
_WORD = re.compile(r"[0-9a-z]+(?:[.-][0-9a-z]+)*")
LEVEL = 3
CONFIRMED = 0.8  # share of the template's words, in order, that the block must hold
FOUND = ("start", "block_chars", "license", "reduction", "share", "missing", "extra", "exact", "found_at", "found_chars")
SHORT = 12  # templates of fewer words must be held in full: each word may name the license
NEAR = 16  # words beside a cue line or template phrase that are compared with it
WINDOW, OVERLAP = 1024, 256  # words compared at once; a template with its extra words fits the overlap
CACHED = 4096  # blocks of more characters are not remembered


@lru_cache(maxsize=1)
def _coders():
    import zstandard as z

    plain = z.ZstdCompressor(level=LEVEL, write_content_size=False)
    with_ = {
        name: z.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=z.ZstdCompressionDict(_flat(text).encode(), dict_type=z.DICT_TYPE_RAWCONTENT))
        for name, text in TEMPLATES.items()
    }
    return plain, with_


def _flat(text: str) -> str:
    return " ".join(text.lower().split())


def _lower(text: str) -> str:
    """Lower case, every letter in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@lru_cache(maxsize=1)
def _wordings():
    """Words of every template; all their triples; the templates by their first triple, longest first."""
    own = {name: _WORD.findall(_flat(text)) for name, text in TEMPLATES.items()}
    first: dict = {}
    for name, w in sorted(own.items(), key=lambda x: -len(x[1])):
        first.setdefault(tuple(w[:3]), []).append((name, w))
    return own, frozenset(t for w in own.values() for t in zip(w, w[1:], w[2:])), first


def _reductions(flat: str) -> list[tuple[float, str]]:
    return _short_reductions(flat) if len(flat) <= CACHED else _all_reductions(flat)


def _all_reductions(flat: str) -> list[tuple[float, str]]:
    data = flat.encode()
    plain, with_ = _coders()
    alone = len(plain.compress(data))
    return sorted(((1 - len(c.compress(data)) / alone, name) for name, c in with_.items()), key=lambda x: (-x[0], x[1]))


@lru_cache(maxsize=4096)
def _short_reductions(flat: str) -> list[tuple[float, str]]:
    return _all_reductions(flat)


@lru_cache(maxsize=1)
def _counts() -> dict:
    return {name: Counter(words) for name, words in _wordings()[0].items()}


def match_block(block: str, compact: bool = False) -> dict | None:
    """The best confirmed template of one block: name, size reduction, covered share, wording differences, place; None if none is.

    ``compact`` asks that no more words stand between those of the template than it has.
    Templates are taken by their size reduction; only those are left out whose words, in
    any order, are too few in the block to confirm them or to beat the best so far.
    """
    return _short_match(block, compact) if len(block) <= CACHED else _match(block, compact)


def _match(block: str, compact: bool) -> dict | None:
    low = _lower(block)
    tokens = list(_WORD.finditer(low))
    words, marks = [t.group() for t in tokens], {m.start(1) for m in _MARK.finditer(low)}
    rank = _reductions(_flat(block))
    best, first, held = None, None, Counter(words)
    for reduction, name in rank:
        own = _wordings()[0][name]
        needed = CONFIRMED if len(own) >= SHORT else 1.0
        most = sum(min(n, held[w]) for w, n in _counts()[name].items()) / len(own)
        if most < needed or (best and most < first[0]):
            continue
        same = missing = 0
        extra: list[str] = []
        lacks: list[str] = []
        steps = SequenceMatcher(None, own, words, autojunk=False).get_opcodes()
        inside = [s for s in steps if not (s[0] == "insert" and s[1] in (0, len(own)))]  # text before and after is no change
        for kind, a, b, c, d in inside:
            same += (b - a) * (kind == "equal")
            missing += (b - a) * (kind != "equal")
            lacks += own[a:b] if kind != "equal" else []
            extra += [words[i] for i in range(c, d) if tokens[i].start() not in marks] if kind != "equal" else []
        share = same / len(own)
        # a number or a license name that differs makes another license
        telling = [w for w in lacks + extra if any(ch.isdigit() for ch in w) or w in {"nc", "sa", "nd", "lesser", "affero", "by-nc", "by-sa", "by"}]
        key = (share, same - len(extra), reduction)
        if share < needed or telling or (compact and len(extra) > len(own)):
            continue
        if best is None or key > first:
            equal = [s for s in steps if s[0] == "equal"]
            at = tokens[equal[0][3]].start()
            first = key
            best = {
                "license": name, "reduction": reduction, "share": share, "missing": missing, "extra": len(extra),
                "exact": not lacks and not extra, "found_at": at, "found_chars": tokens[equal[-1][4] - 1].end() - at,
            }
    return best


@lru_cache(maxsize=4096)
def _short_match(block: str, compact: bool) -> dict | None:
    return _match(block, compact)


def find(text: str) -> list[dict]:
    """Every confirmed template of the text, and every cue run without one, in the order of the text.

    ``start`` and ``block_chars`` hold the cue runs that the template touches and the
    template itself, ``found_at`` and ``found_chars`` the template alone.
    """
    low = _lower(text)
    if not any(c in low for c in CUES):
        return []
    runs = [(start, start + len(block)) for start, block in candidate_blocks(text)]
    _, phrases, first = _wordings()
    tokens = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(low)]
    words, starts = [t[0] for t in tokens], [t[1] for t in tokens]
    triples = list(zip(words, words[1:], words[2:]))
    seeds = [i for i, t in enumerate(triples) if t in phrases]
    hits: list[dict] = []

    def add(hit: dict, at: int) -> None:
        hits.append({**hit, "found_at": at + hit["found_at"]})

    taken = []  # word ranges of exact wordings
    for i in seeds:
        if taken and i < taken[-1][1]:
            continue
        name = next((n for n, w in first.get(triples[i], ()) if words[i : i + len(w)] == w), None)
        if name:
            taken.append((i, i + len(_wordings()[0][name])))
            chars = tokens[taken[-1][1] - 1][2] - starts[i]
            add({"license": name, "share": 1.0, "missing": 0, "extra": 0, "exact": True, "found_at": 0, "found_chars": chars}, starts[i])
    near = sorted([(i, i + 3) for i in seeds] + [(bisect_left(starts, s), bisect_left(starts, e)) for s, e in runs])
    regions: list[list[int]] = []
    for lo, hi in near:
        lo, hi = max(0, lo - NEAR), min(len(words), hi + NEAR)
        if regions and lo <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], hi)
        else:
            regions.append([lo, hi])
    edges = [0, *(x for t in taken for x in t), len(words)]
    free = list(zip(edges[::2], edges[1::2]))  # what the exact wordings leave, in order
    k = 0
    for lo, hi in regions:
        while k and free[k][0] > lo:
            k -= 1
        while k < len(free) and free[k][0] < hi:
            a, b = max(lo, free[k][0]), min(hi, free[k][1])
            while a < b:
                end = min(b, a + WINDOW)
                found = _all(low, text, starts, tokens, seeds, a, end)
                after = end
                if end < b:
                    late = [x for x in found if x[1] > end - OVERLAP]
                    found = [x for x in found if x[1] <= end - OVERLAP]
                    after = max([min([end - OVERLAP, *(x[0] for x in late)]), a + 1, *(x[1] for x in found)])
                for i, j, hit in found:
                    add({**hit, "found_at": 0}, starts[i])
                a = after
            k += 1
        k = min(k, len(free) - 1)

    def touched(s: int, e: int) -> bool:
        i = bisect_left(order, s)
        return (i < len(order) and order[i] < e) or (i > 0 and ends[i - 1] > s)

    hits.sort(key=lambda h: h["found_at"])
    order, ends = [h["found_at"] for h in hits], [h["found_at"] + h["found_chars"] for h in hits]
    rows = []
    for s, e in runs:
        if not touched(s, e):
            hit = match_block(text[s:e])
            if hit:
                add(hit, s)
            else:
                rows.append({"start": s, "block_chars": e - s})
    run_starts = [s for s, _ in runs]
    for h in hits:
        s, e = h["found_at"], h["found_at"] + h["found_chars"]
        i = max(0, bisect_left(run_starts, s + 1) - 1)
        over = [r for r in runs[i : bisect_left(run_starts, e)] if r[1] > s]
        s, e = min([s, *(r[0] for r in over)]), max([e, *(r[1] for r in over)])
        reduction = next(r for r, name in _reductions(_flat(text[s:e])) if name == h["license"])
        rows.append({**h, "start": s, "block_chars": e - s, "reduction": reduction})
    return sorted(rows, key=lambda r: (r["start"], r.get("found_at", 0)))


def _all(low: str, text: str, starts: list, tokens: list, seeds: list, lo: int, hi: int) -> list[tuple[int, int, dict]]:
    """(first word, end word, match) of every confirmed template between two words."""
    out, left = [], [(lo, hi)]
    while left:
        a, b = left.pop()
        if a >= b:
            continue
        s, e = starts[a], tokens[b - 1][2]
        i = bisect_left(seeds, a)
        if not (i < len(seeds) and seeds[i] < b) and not any(c in low[s:e] for c in CUES):
            continue
        hit = match_block(text[s:e], True)
        if hit:
            i, j = bisect_left(starts, s + hit["found_at"]), bisect_left(starts, s + hit["found_at"] + hit["found_chars"])
            out.append((i, j, hit))
            left += [(a, i), (j, b)]
    return out


def candidate_blocks(text: str) -> list[tuple[int, str]]:
    """(character offset, block) of every run of lines that hold a cue; lines of a run are joined by newlines."""
    low = _lower(text)
    if not any(c in low for c in CUES):
        return []
    out: list[tuple[int, str]] = []
    at, run = 0, None
    for line in low.split("\n"):
        if any(c in line for c in CUES):
            run = at if run is None else run
        elif run is not None:
            out.append((run, text[run : at - 1]))
            run = None
        at += len(line) + 1
    if run is not None:
        out.append((run, text[run:]))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed template or unconfirmed block: doc_id, start, block_chars, license, reduction, share, missing, extra, exact, found_at, found_chars.

    Blocks that no template confirms have null in the template's columns.  Null and
    empty texts have no blocks; whole texts are read, however long, and a block may be
    as long as its text.  Repeated rows give their blocks each; null ids are kept; an
    empty table gives an empty result; other columns are not read.  The scan is one
    pass without a shuffle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"]])
    for name, kind in zip(FOUND, (T.LongType(), T.LongType(), T.StringType(), T.DoubleType(), T.DoubleType(), T.IntegerType(), T.IntegerType(), T.BooleanType(), T.LongType(), T.LongType())):
        schema = schema.add(name, kind)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            at, out = [], {c: [] for c in FOUND}
            for i, text in enumerate(b.column(1).to_pylist()):
                for row in find(text or ""):
                    at.append(i)
                    for c in FOUND:
                        out[c].append(row.get(c))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
            columns = [pa.array(out[c], k) for c, k in zip(FOUND, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *columns], names=schema.names)

    return map_texts(rows, run, schema)

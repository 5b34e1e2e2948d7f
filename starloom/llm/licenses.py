"""License notices found by conditional compression.

Candidate blocks are stretches of text whose two-word runs occur in a license
template, and that hold enough of a template's words. Each block is compressed alone and with each template as a raw
Zstandard dictionary; the template that makes it smallest, relative to its size
alone, is the likeliest source. The winner is confirmed by the exact wording: a
word-by-word alignment gives the words of the template that are missing and
those added, and the wording counts as that license if enough words agree. The
rest of the block, before and after the wording, is then searched again until
nothing is confirmed, so notices that follow each other are all found.

Templates are a parameter; the default holds short notices of common licenses.

Edge cases: null and empty texts hold no block; of templates with equal
reduction the first by name wins; repeated rows are searched as often as they
occur; a text may hold several blocks, and a block several notices.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import map_batches, texts_of
from starloom.llm.textscan import Words, chunks

# Usual wordings of notices.
TEMPLATES = {
    "All-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"
    ),
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available "
        "at https://www.eclipse.org/legal/epl-2.0"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
RUN = 2
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Scanning:
    # Runs of template words at most this many words apart belong to one block, which reaches as many words further.
    gap: int = 4
    margin: int = 3
    least_reduction: float = 0.3
    least_agreement: float = 0.8
    level: int = 9


@lru_cache(maxsize=4)
def prepared(templates: tuple[tuple[str, str], ...], level: int) -> tuple[np.ndarray, list]:
    """(sorted hashes of all two-word runs, (name, words, compressor) by name)."""
    scan = Words([text.encode() for _, text in templates], lower=True, words="alnum")
    ready = []
    for name, text in sorted(templates):
        dictionary = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        ready.append((name, WORD.findall(text.lower()), _compressor(level, dictionary)))
    return np.unique(scan.shingles(RUN)[0]), ready


def _compressor(level: int, dictionary=None) -> zstandard.ZstdCompressor:
    """Without a frame's header fields, so that short blocks can be compared."""
    settings = zstandard.ZstdCompressionParameters.from_level(
        level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary)


def blocks(scan: Words, known: np.ndarray, how: Scanning) -> list[tuple[int, int, int]]:
    """(text, first byte, last byte) of the stretches that template runs mark, within their text."""
    hashes, bounds = scan.shingles(RUN)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hits = np.flatnonzero(known[at] == hashes)
    found, texts = [], np.searchsorted(bounds, hits, "right") - 1
    places = scan.bounds[texts] + hits - bounds[texts]
    for text, place in zip(texts.tolist(), places.tolist(), strict=True):
        last = min(place + RUN - 1, int(scan.bounds[text + 1]) - 1)
        if found and found[-1][0] == text and place - found[-1][2] <= how.gap:
            found[-1][2] = last
        else:
            found.append([text, place, last])
    out = []
    for text, first, last in found:
        first = max(first - how.margin, int(scan.bounds[text]))
        last = min(last + how.margin, int(scan.bounds[text + 1]) - 1)
        out.append((text, int(scan.starts[first] - scan.offsets[text]), int(scan.ends[last] - scan.offsets[text])))
    return out


# ASCII letters alone, as in the scan: other letters may change their number of characters.
_FOLD = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def compare(block: str, ready: list, how: Scanning) -> tuple | None:
    """(license, reduction, agreement, missing, added, first, last word of the wording) of the winner, or None."""
    folded = block.translate(_FOLD)
    data = folded.encode("utf-8", "surrogatepass")
    alone = len(_plain(how.level).compress(data))
    ranked = sorted(((1 - len(packer.compress(data)) / alone, name, words) for name, words, packer in ready), key=lambda r: (-r[0], r[1]))
    found = [(m.group(), m.start(), m.end()) for m in WORD.finditer(folded)]
    own = [word for word, _, _ in found]
    # Reductions of nested wordings are close: all templates near the best are confirmed, and the best wording wins.
    best = None
    for reduction, name, words in ranked:
        if reduction < max(how.least_reduction, ranked[0][0] - 0.15):
            break
        steps = difflib.SequenceMatcher(None, words, own, autojunk=False).get_matching_blocks()
        same = sum(step.size for step in steps)
        if same < how.least_agreement * len(words):
            continue
        first, last = next(s.b for s in steps if s.size), max(s.b + s.size for s in steps if s.size)
        kept = {s.a + k for s in steps for k in range(s.size)}
        used = {s.b + k for s in steps for k in range(s.size)}
        missing = [w for k, w in enumerate(words) if k not in kept]
        added = [w for k, w in enumerate(own) if first <= k < last and k not in used]
        rank = (same - len(missing) - len(added), reduction)
        if best is None or rank > best[0]:
            best = (rank, (name, reduction, same / len(words), missing, added, found[first][1], found[last - 1][2]))
    return best and best[1]


def closest(block: str, ready: list, how: Scanning) -> tuple | None:
    """The winner of the block or, where other notices beside it hide its reduction, of a stretch that holds a wording."""
    found = [(m.group(), m.start(), m.end()) for m in WORD.finditer(block.translate(_FOLD))]
    own = [word for word, _, _ in found]
    # An alignment cannot have more words than both texts hold, in any order.
    held = Counter(own)
    near = [t for t in ready if (held & Counter(t[1])).total() >= how.least_agreement * len(t[1])]
    best = compare(block, ready, how) if near else None
    if best:
        return best
    for _, words, _ in near:
        steps = [s for s in difflib.SequenceMatcher(None, words, own, autojunk=False).get_matching_blocks() if s.size]
        if not steps or sum(s.size for s in steps) < how.least_agreement * len(words):
            continue
        start, end = found[steps[0].b][1], found[steps[-1].b + steps[-1].size - 1][2]
        inner = compare(block[start:end], ready, how) if end - start < len(block) else None
        if inner and (best is None or start + inner[5] < best[5]):
            best = (*inner[:5], start + inner[5], start + inner[6])
    return best


def compare_all(block: str, ready: list, how: Scanning) -> list[tuple]:
    """The winners of a block, as compare gives them, in the order of the text: after each one both rests are searched."""
    found, rests = [], [(0, len(block))]
    while rests:
        first, last = rests.pop()
        best = closest(block[first:last], ready, how) if WORD.search(block, first, last) else None
        if best:
            start, end = first + best[5], first + best[6]
            found.append((*best[:5], start, end))
            rests += [(first, start), (end, last)]
    return sorted(found, key=lambda f: f[5])


@lru_cache(maxsize=4)
def _plain(level: int) -> zstandard.ZstdCompressor:
    return _compressor(level)


def find_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, key: str = "doc_id", text: str = "text", how: Scanning = Scanning()) -> DataFrame:
    """One row per confirmed notice: (key, license, start, end, reduction, agreement, missing, added, wording).

    start and end are code points in the text, end exclusive; missing and added
    are the differing words in their order; wording is the notice's text.
    """
    listed = tuple(sorted(templates.items()))
    source = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch, "_text")]
        known, ready = prepared(listed, how.level)
        rows, found = [], []
        for first, last in chunks(texts):
            for k, a, b in blocks(Words(texts[first:last], lower=True, words="alnum"), known, how):
                data = texts[first + k]
                block, before = data[a:b].decode("utf-8", "replace"), len(data[:a].decode("utf-8", "replace"))
                for name, reduction, agreement, missing, added, start, end in compare_all(block, ready, how):
                    rows.append(first + k)
                    found.append((name, before + start, before + end, reduction, agreement, missing, added, block[start:end]))
        ids = batch.column("_id").take(pa.array(rows, pa.int64()))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
        columns = list(zip(*found, strict=True)) if found else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([ids, *(pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True))], names)

    names = ["_id", "license", "start", "end", "reduction", "agreement", "missing", "added", "wording"]
    kind = source.schema["_id"].dataType.simpleString()
    schema = (
        f"_id {kind}, license string, start long, end long, reduction double, agreement double, missing array<string>, "
        "added array<string>, wording string"
    )
    return map_batches(source, work, schema).withColumnRenamed("_id", key)

"""License scans: MinHash bands over overlapping windows find templates, shingle containment verifies.

Templates of similar length share a window size: blocks of at least as many shingles as
a template has, of which a window takes two, so that every template lies in a window
whole.  The number of one-row bands is set so that such a window misses no template but
once in a million.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, as_bytes, plain_words, slices

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
#: Public notices, as their licenses ask to state them.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def shingles(words: list[bytes], width: int = SHINGLE) -> list[tuple[bytes, ...]]:
    """Runs of ``width`` words; fewer words, but some, are one shingle."""
    if not words:
        return []
    return [tuple(words)] if len(words) < width else list(zip(*(words[i:] for i in range(width))))


def bands_for(count: int, block: int, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """One-row bands at which a window of two blocks that holds a template misses it with chance ``miss``."""
    shared = math.ceil(containment * count - 1e-9)
    similarity = shared / (2 * block + count - shared)
    return max(1, math.ceil(math.log(miss) / math.log(1 - similarity)))


class Templates:
    """Band values of all templates by block size."""

    def __init__(self, templates: dict[str, str], containment: float = CONTAINMENT):
        self.containment = containment
        self.sets = {name: frozenset(s) for name, text in sorted(templates.items())
                     if (s := shingles(plain_words(text.encode())))}
        self.words: dict[bytes, int] = {}
        self.bands: dict[int, int] = {}
        for found in self.sets.values():
            block = self.block(len(found))
            self.bands[block] = max(self.bands.get(block, 0), bands_for(len(found), block, containment))
        most = max(self.bands.values(), default=1)
        rng = np.random.default_rng(11)
        self.factors = rng.integers(1, 1 << 32, most, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.addends = rng.integers(0, 1 << 32, most, dtype=np.uint64).astype(np.uint32)
        self.values: dict[int, list[dict[int, list[str]]]] = {}
        self.marks: dict[int, np.ndarray] = {}
        for block, count in self.bands.items():
            self.values[block] = [{} for _ in range(count)]
            self.marks[block] = np.zeros((count, 1 << 16), bool)
        for name, found in self.sets.items():
            block = self.block(len(found))
            hashes = np.array([self.hash(s) for s in found], np.uint32)
            for band in range(self.bands[block]):
                value = int((hashes * self.factors[band] + self.addends[band]).min())
                self.values[block][band].setdefault(value, []).append(name)
                self.marks[block][band, value & 0xFFFF] = True

    @staticmethod
    def block(count: int) -> int:
        return 1 << (count - 1).bit_length()

    def number(self, word: bytes) -> int:
        if len(self.words) > 400_000:
            self.words.clear()
        self.words[word] = value = xxhash.xxh32_intdigest(word)
        return value

    def hash(self, shingle: tuple[bytes, ...]) -> int:
        return int(_hashes(np.array([xxhash.xxh32_intdigest(w) for w in shingle], np.uint32), len(shingle))[0])


def _hashes(numbers: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(max(0, len(numbers) - width + 1), np.uint32)
    for i in range(width):
        out = (out * np.uint32(0x01000193)) ^ numbers[i:len(numbers) - width + 1 + i]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    return out ^ (out >> np.uint32(13))


def matches(templates: Templates, texts: list[bytes | None]) -> list[dict[str, tuple[float, int, int]]]:
    """Of each text its templates, with containment and first and last word of the best match."""
    words_of = [plain_words(t) for t in texts]
    get, number = templates.words.get, templates.number
    parts, first, sizes, at = [], [], [], 0
    for words in words_of:
        numbers = np.array([get(w) or number(w) for w in words], np.uint32)
        hashes = _hashes(numbers, min(SHINGLE, len(numbers))) if len(numbers) else np.empty(0, np.uint32)
        parts.append(hashes)
        first.append(at)
        sizes.append(len(hashes))
        at += len(hashes)
    out: list[dict[str, tuple[float, int, int]]] = [{} for _ in texts]
    if not at:
        return out
    hashes, first, sizes = np.concatenate(parts), np.array(first), np.array(sizes)
    candidates: set[tuple[int, int, str]] = set()
    layouts = {}
    for block in templates.bands:
        counts = -(-sizes // block)
        owner = np.repeat(np.arange(len(sizes)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        layouts[block] = (owner, within, first[owner] + within * block, np.r_[owner[1:] == owner[:-1], False])
    for band in range(len(templates.factors)):
        permuted = hashes * templates.factors[band] + templates.addends[band]
        for block, (owner, within, starts, follows) in layouts.items():
            if band >= templates.bands[block]:
                continue
            least = permuted if block == 1 else np.minimum.reduceat(permuted, starts)
            window = np.where(follows, np.minimum(least, np.r_[least[1:], least[:1]]), least)
            known = templates.values[block][band]
            for i in np.flatnonzero(templates.marks[block][band][window & np.uint32(0xFFFF)]):
                for name in known.get(int(window[i]), ()):
                    candidates.add((int(owner[i]), int(within[i]) * block, name))
    for row, start, name in candidates:
        found = templates.sets[name]
        block = templates.block(len(found))
        words = words_of[row]
        low = max(0, start - block)
        region = shingles(words[low:start + 3 * block + SHINGLE - 1])
        hits = [i for i, s in enumerate(region) if s in found]
        share = len({region[i] for i in hits}) / len(found)
        if share >= templates.containment:
            width = min(SHINGLE, len(words))
            best = (share, low + hits[0], low + hits[-1] + width - 1)
            old = out[row].get(name)
            if old is None or (-best[0], best[1], best[2]) < (-old[0], old[1], old[2]):
                out[row][name] = best
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_column: str = "doc_id", text: str = "text",
         containment: float = CONTAINMENT) -> DataFrame:
    """(id, template, containment, first_word, last_word): each document's templates, best match each.

    A match is a stretch of text that holds ``containment`` of a template's five-word
    shingles; words are lower-case letters, digits and non-ASCII characters.  Templates
    are given with the call and so are bounded; they go to every task.  Whole texts are
    scanned in their partitions, without a shuffle.  Null and empty texts match nothing,
    rows repeat as they are, and no templates give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(TEMPLATES if templates is None else templates)
    made: list[Templates] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(Templates(shared.value, containment))
        found = []
        for part in slices(batch, "_text", 1 << 20):
            for match in matches(made[0], as_bytes(part.column("_text"))):
                found.append([{"template": n, "containment": m[0], "first_word": m[1], "last_word": m[2]}
                              for n, m in sorted(match.items())])
        return {"_id": batch.column("_id"), "found": found}

    inner = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    mapped = arrow_map(inner, run, f"_id {inner.dtypes[0][1]}, found array<struct<template: string, "
                       "containment: double, first_word: long, last_word: long>>")
    return mapped.select(F.col("_id").alias(id_column), F.explode("found").alias("f")).select(id_column, "f.*")

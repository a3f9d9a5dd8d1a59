"""License scan: MinHash bands over text windows retrieve templates, exact containment decides."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import WordHashes, map_batches, mix, text_bytes, window_codes
from promolens.llm.license_texts import LICENSE_TEXTS

# Well-known notices, (name, text).
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a "
     "copy of this software and associated documentation files, to deal in the Software without "
     "restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it "
     "under the terms of the GNU General Public License as published by the Free Software "
     "Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0."),
)
TEMPLATES = NOTICES + LICENSE_TEXTS
SHINGLE = 3
CONTAINMENT = 0.8
MISS = 1e-4
MAX_TEMPLATES = 10_000
GROUP = 128  # texts that go through the bands side by side
_PUNCTUATION = b".,;:!?\"'()[]{}<>*#|"


class _Words(WordHashes):
    """Hashes of words in lower case without punctuation at their ends."""

    def __missing__(self, word: bytes) -> int:
        plain = word.lower().strip(_PUNCTUATION) or word
        value = WordHashes.__missing__(self, plain)
        self[word] = value
        return value


def _codes(data: bytes, cache: _Words, n: int) -> np.ndarray:
    words = data.split()
    codes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    return window_codes(codes, n)


def bands_needed(jaccard: float, miss: float) -> int:
    """Single-row bands after which sets of this similarity collide but for ``miss``."""
    return 1 if jaccard >= 1 else math.ceil(math.log(miss) / math.log(1 - jaccard))


class _Class:
    """Templates of about one length, with their MinHash values in each band.

    ``places`` has the place of each shingle in the template, -1 for those it holds twice.
    """

    def __init__(self, block: int, templates: list, places: list, theta: float, miss: float):
        self.block, self.templates, self.places = block, templates, places
        # A window is two blocks of shingles, so it holds any run of up to a block whole.
        worst = min(
            math.ceil(theta * len(s)) / (2 * block + len(s) - math.ceil(theta * len(s)))
            for _, s in templates
        )
        self.bands = bands_needed(worst, miss)
        # Codes are mixed already, so an odd factor gives each band an order of its own.
        self.factors = mix(np.arange(1, self.bands + 1, dtype=np.uint64)) | np.uint64(1)
        self.values = [
            np.array([(s * factor).min() for _, s in templates]) for factor in self.factors
        ]

    def candidates(
        self, codes: np.ndarray, starts: np.ndarray, owner: np.ndarray
    ) -> set[tuple[int, int]]:
        """(window, template) that agree in at least one band.

        ``starts`` and ``owner`` are the place and the text of each block; window w is block w
        and, in the same text, the next.
        """
        found: set[tuple[int, int]] = set()
        after = np.append(owner[1:] == owner[:-1], False)
        for factor, values in zip(self.factors, self.values, strict=True):
            low = np.minimum.reduceat(codes * factor, starts)
            for b in np.flatnonzero(np.isin(low, values)).tolist():
                for t in np.flatnonzero(values == low[b]).tolist():
                    # The band value of a window is the smaller of its blocks' values.
                    if not after[b] or low[b + 1] >= low[b]:
                        found.add((b, t))
                    if b and after[b - 1] and low[b - 1] >= low[b]:
                        found.add((b - 1, t))
        return found


def _classes(templates, n: int, theta: float, miss: float) -> list[_Class]:
    cache, groups = _Words(), {}
    for number, (_, text) in enumerate(templates):
        codes, first, counts = np.unique(
            _codes((text or "").encode(), cache, n), return_index=True, return_counts=True
        )
        if len(codes):
            block = 1 << max(0, math.ceil(math.log2(len(codes))))
            held, places = groups.setdefault(block, ([], []))
            held.append((number, codes))
            places.append(np.where(counts == 1, first, -1))
    return [_Class(b, *g, theta, miss) for b, g in sorted(groups.items())]


def copies_in(
    window: np.ndarray, wanted: np.ndarray, places: np.ndarray, theta: float
) -> list[tuple[int, int, float]]:
    """(first shingle, last, containment) of each copy of a template in a window.

    The shingles found are cut where they go back by half the template or more, as they do where
    it starts again; parts that hold ``theta`` of it are its copies. If only all parts
    together do, as in a copy whose sentences changed places, they are one.
    """
    slot = np.minimum(np.searchsorted(wanted, window), len(wanted) - 1)
    at = np.flatnonzero(wanted[slot] == window)
    whole = len(np.unique(slot[at])) / len(wanted)
    if whole < theta:
        return []
    marks = np.flatnonzero(places[slot[at]] >= 0)
    place = places[slot[at[marks]]]
    again = marks[1:][place[:-1] - place[1:] >= places.max() / 2]
    parts = [
        (int(part[0]), int(part[-1]), len(np.unique(slot[part])) / len(wanted))
        for part in np.split(at, again)
    ]
    copies = [part for part in parts if part[2] >= theta]
    return copies or [(int(at[0]), int(at[-1]), whole)]


def find_templates(texts: list[np.ndarray], classes: list[_Class], theta: float) -> list[list]:
    """For each text's shingles: (template, first shingle, last, containment) of the windows."""
    spans: list[list] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts])
    if not sizes.sum():
        return spans
    codes, begin = np.concatenate(texts), np.cumsum(sizes) - sizes
    for c in classes:
        blocks = -(-sizes // c.block)
        owner = np.repeat(np.arange(len(texts)), blocks)
        step = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = begin[owner] + step * c.block
        for w, t in sorted(c.candidates(codes, starts, owner)):
            number, wanted = c.templates[t]
            text = int(owner[w])
            first, end = int(starts[w]), int(begin[text] + sizes[text])
            window = codes[first : min(first + 2 * c.block, end)]
            shift = first - int(begin[text])
            for low, high, share in copies_in(window, wanted, c.places[t], theta):
                spans[text].append((number, low + shift, high + shift, share))
    return spans


def merge_spans(spans: list[tuple]) -> dict[int, list[tuple[int, int, float]]]:
    """Per template its copies in order: first shingle, last, best containment.

    Neighbouring windows see one copy twice, so spans that overlap are one.
    """
    out: dict[int, list[tuple[int, int, float]]] = {}
    for number, first, last, share in sorted(spans):
        copies = out.setdefault(number, [])
        if copies and first <= copies[-1][1]:
            begin, end, best = copies[-1]
            copies[-1] = (begin, max(end, last), max(best, share))
        else:
            copies.append((first, last, share))
    return out


def scan_licenses(
    docs: DataFrame,
    templates=TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    containment: float = CONTAINMENT,
    miss: float = MISS,
) -> DataFrame:
    """Per document and template found: key, license, n_spans, first_word, containment, spans.

    Words are compared in lower case without punctuation at their ends. Every shingle of a text
    lies in two windows; a template is a candidate when it shares a MinHash value with a window
    in any band, and a match when at least ``containment`` of its distinct shingles are in the
    window. The number of bands follows from the worst similarity that a match can have, so that
    a match is missed with a probability of at most ``miss``. ``spans`` lists every copy with its
    first and last word, counted from 0, and its containment; copies side by side are several.

    ``templates`` is a fixed list of at most MAX_TEMPLATES (name, text), sent to every task;
    there is no shuffle. Empty and NULL texts and templates match nothing. Repeated rows are
    each reported, texts of any length are read whole, and an empty table gives an empty one. Of
    templates that are tied, or part of one another, each is reported. Only the named columns are read, so others cannot clash.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    names = [name for name, _ in templates]
    columns = ("_key", "license", "n_spans", "first_word", "containment", "spans")
    classes = _classes(templates, shingle, containment, miss)

    def scan(batches: Iterator[dict]) -> Iterator[dict]:
        cache = _Words()
        for batch in batches:
            out = {c: [] for c in columns}
            for at in range(0, len(batch["_key"]), GROUP):
                some = slice(at, at + GROUP)
                words = [len(data.split()) for data in batch["_data"][some]]
                texts = [_codes(data, cache, shingle) for data in batch["_data"][some]]
                found = find_templates(texts, classes, containment)
                for row, n, spans in zip(batch["_key"][some], words, found, strict=True):
                    for number, copies in sorted(merge_spans(spans).items()):
                        listed = [
                            {
                                "first_word": first,
                                "last_word": min(last + shingle, n) - 1,
                                "containment": share,
                            }
                            for first, last, share in copies
                        ]
                        best = max(share for *_, share in copies)
                        values = (row, names[number], len(copies), copies[0][0], best, listed)
                        for c, v in zip(columns, values, strict=True):
                            out[c].append(v)
            yield out

    rows = docs.select(F.col(key).alias("_key"), text_bytes(text).alias("_data"))
    kind = dict(rows.dtypes)["_key"]
    found = map_batches(
        rows,
        scan,
        f"_key {kind}, license string, n_spans long, first_word long, containment double, "
        "spans array<struct<first_word: long, last_word: long, containment: double>>",
    )
    return found.withColumnRenamed("_key", key)

"""License scans: MinHash bands over text windows find templates, exact containment confirms them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.support import Words, pieces, small_batches

SHINGLE = 5
PERCENT = 75  # of a template's shingles that a window holds, at least
BANDS = 80  # of one MinHash value each; see ``scan``
MAX_TEMPLATES = 4096

#: The usual wording of notices, as (license, text).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

_random = np.random.default_rng(8)
_XOR = _random.integers(0, 2**63, BANDS, dtype=np.uint64)
_MUL = _random.integers(0, 2**63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: What separates words here: every ASCII byte but letters and digits.
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each text in order, and where each text's begin; none for fewer words."""
    words = Words(data, offsets, lower=True, apart=_APART)
    found = words.windows(size)
    fits = words.fits(size)[: len(found)]
    return found[fits], np.searchsorted(words.doc[: len(found)][fits], np.arange(len(offsets)))


class Library:
    """Templates by the size class of their windows, with band tables and shingles."""

    def __init__(self, templates: list[tuple[str, str]]):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"{MAX_TEMPLATES} templates at most")
        self.names, self.sets, self.classes = [], [], {}
        for name, text in templates:
            data = np.frombuffer(text.encode(), np.uint8)
            own = np.unique(shingles(data, np.array([0, len(data)]))[0])
            if not len(own):
                raise ValueError(f"a template needs {SHINGLE} words: {text!r}")
            size = 1 << (len(own) - 1).bit_length()
            self.classes.setdefault(size, []).append(len(self.names))
            self.names.append(name)
            self.sets.append(own)
        self.least = [[int(((s ^ x) * m).min()) for x, m in zip(_XOR, _MUL)] for s in self.sets]

    def candidates(self, hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(template, text, window start, window end) where a band of a window of 2 * size shingles matches."""
        count = -(-np.diff(first) // size)
        doc = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = first[:-1][doc] + nth * size
        none = np.zeros(0, np.int64)
        if not len(start):
            return none, none, none, none
        last = np.append(doc[1:] != doc[:-1], True)
        members = self.classes[size]
        hit = np.zeros((len(members), len(start)), bool)
        for i, (x, m) in enumerate(zip(_XOR, _MUL)):
            least = np.minimum.reduceat((hashes ^ x) * m, start)
            least[:-1] = np.where(last[:-1], least[:-1], np.minimum(least[:-1], least[1:]))
            low = (least >> np.uint64(48)).astype(np.int64)
            table = np.zeros(1 << 16, bool)
            wanted = np.array([self.least[k][i] for k in members], np.uint64)
            table[(wanted >> np.uint64(48)).astype(np.int64)] = True
            some = np.flatnonzero(table[low])
            hit[:, some] |= least[some] == wanted[:, None]
        which, window = np.nonzero(hit)
        end = np.minimum(start + 2 * size, first[1:][doc])
        return np.array(members)[which], doc[window], start[window], end[window]

    def found(self, hashes: np.ndarray, first: np.ndarray) -> dict[tuple[int, str], tuple[float, int]]:
        """(text, license) to (containment, place of the first shingle), the best window's."""
        out: dict[tuple[int, str], tuple[float, int]] = {}
        for size in self.classes:
            for k, doc, low, high in zip(*self.candidates(hashes, first, size)):
                here = np.isin(hashes[low:high], self.sets[k])
                common = len(np.unique(hashes[low:high][here]))
                if 100 * common >= PERCENT * len(self.sets[k]):
                    new = (common / len(self.sets[k]), -int(low - first[doc] + np.argmax(here)))
                    key = (int(doc), self.names[k])
                    out[key] = max(out.get(key, new), new)
        return {key: (share, -place) for key, (share, place) in out.items()}


def _scanned(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library: Library = shared.value
        for batch in batches:
            own = batch.num_columns - 1
            for low, high, data, offsets in pieces(batch.column(own)):
                rows = sorted(library.found(*shingles(data, offsets)).items())
                take = pa.array([low + doc for (doc, _), _ in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).take(take) for i in range(own)],
                        pa.array([name for (_, name), _ in rows], pa.string()),
                        pa.array([share for _, (share, _) in rows], pa.float64()),
                        pa.array([place for _, (_, place) in rows], pa.int64()),
                    ],
                    names=[*batch.schema.names[:own], "license", "containment", "first_word"],
                )

    return run


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text: str = "text", carry: tuple = ()) -> DataFrame:
    """One row per document and license found: id, ``carry``, license, containment, first_word.

    Words are runs of ASCII letters, digits and other characters beyond ASCII,
    A-Z in lower case; sets hold 5-word shingles. A template of n shingles belongs
    to the class c, the next power of two. Texts are cut at every c-th shingle, and
    two neighbouring cuts make a window, so windows overlap by half and a passage of
    c shingles lies in one window. A window that holds 75 % of a template has at least
    0.176 of their union in common, so one of the ``BANDS`` single-value bands matches
    with probability 1 - 2e-7. What matches is compared shingle by shingle;
    ``containment`` is the template's share found, the highest of all windows and
    templates of the license, ``first_word`` the place of its first shingle
    (of equal windows the earliest).

    No shuffle; the whole text is read, half a megabyte at a time. The templates
    (``MAX_TEMPLATES`` at most) are broadcast.

    Null or empty text, or text without notices: no row. Null or repeated ids and
    repeated rows: rows of their own. No rows: no rows. Other columns are not read.
    """
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(Library(templates))
    cut = docs.select(F.col(id_col), *carry, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema[:-1]]
    return cut.mapInArrow(_scanned(shared), ", ".join([*fields, "license string", "containment double", "first_word long"]))

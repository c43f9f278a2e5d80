"""Repeated passages: level-wise doubling from short windows to long ones."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.support import Scratch, Words, mix, pieces, row_key, spans

WINDOW = 35


def levels(window: int) -> tuple[int, int, int]:
    """Lengths, each at most twice the one before: anchor, doubled anchor, window."""
    if window < 4:
        raise ValueError("a window has four words at least")
    half = (window + 1) // 2
    return (half + 1) // 2, half, window


class Anchors:
    """Anchors of texts: every window's least short run of words (ties: the first).

    Equal windows have their anchor at the same place, so a window can only be
    repeated if its anchor is. ``at`` are anchors (word indices), ``low``/``high``
    the first and last start of the windows that have each anchor.
    """

    def __init__(self, words: Words, window: int):
        short = levels(window)[0]
        self.hash = words.windows(short)
        reach = window - short + 1  # places of an anchor in a window
        starts = np.flatnonzero(words.fits(window))
        self.at = self.low = self.high = np.zeros(0, np.int64)
        if not len(starts):
            return
        best, pick = self.hash.copy(), np.arange(len(self.hash))
        done = 1
        while done < reach:  # least of 1, 2, 4, … places, then of ``reach``
            step = min(done, reach - done)
            a, b = best[:-step], best[step:]
            less = b < a
            best = np.where(less, b, a)
            pick = np.where(less, pick[step:], pick[:-step])
            done += step
        chosen = pick[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        self.at, self.low = chosen[first], starts[first]
        self.high = starts[np.append(first[1:], len(starts)) - 1]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _held(column: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, value) pairs of a list column's rows; null is an empty list."""
    part = column.slice(low, high - low)
    values, count = part.flatten(), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(high - low), count), values.to_numpy(zero_copy_only=False) if len(values) else np.zeros(0, np.int64)


def _keys(batch: pa.RecordBatch, low: int, doc: np.ndarray) -> list[pa.Array]:
    take = pa.array(doc + low)
    return [batch.column(0).take(take), batch.column(1).take(take)]


def _anchors(window: int):
    """(k1, k2, text) to every anchor: k1, k2, place in the text, hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2)):
                words = Words(data, offsets)
                found = Anchors(words, window)
                doc = words.doc[found.at]
                yield pa.RecordBatch.from_arrays(
                    [*_keys(batch, low, doc), pa.array((found.at - words.first[doc]).astype(np.int32)), _signed(found.hash[found.at])],
                    names=["k1", "k2", "place", "hash"],
                )

    return run


def _live(words: Words, found: Anchors, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Indices into the anchors of those given as (text, place)."""
    return np.searchsorted(found.at, words.first[doc] + place)


def _doubled(window: int):
    """(k1, k2, text, places) to both doubled runs of each live anchor: k1, k2, 2 * place + side, hash.

    Side 0 goes on to the right, side 1 starts to the left.
    """
    short, twice, _ = levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2)):
                words = Words(data, offsets)
                found = Anchors(words, window)
                doc, place = _held(batch.column(3), low, high)
                hashes, at = words.windows(twice), words.first[doc] + place
                for side, start in ((0, at), (1, at - (twice - short))):
                    ok = (start >= words.first[doc]) & (start + twice <= words.first[doc + 1])
                    yield pa.RecordBatch.from_arrays(
                        [*_keys(batch, low, doc[ok]), pa.array((2 * place[ok] + side).astype(np.int32)), _signed(mix(hashes[start[ok]] + np.uint64(side)))],
                        names=["k1", "k2", "place", "hash"],
                    )

    return run


def _ranges(words: Words, found: Anchors, doc: np.ndarray, code: np.ndarray, window: int):
    """Live (anchor, first start, last start) after doubling; ``code`` is 2 * place + side.

    A window whose anchor is early holds the right run, one whose anchor is late
    the left run, others hold both and need both.
    """
    short, twice, _ = levels(window)
    sides = np.zeros(len(found.at), np.int8)
    for side in (0, 1):
        those = code % 2 == side
        sides[_live(words, found, doc[those], code[those] // 2)] |= 1 << side
    # offset of the anchor in a window: at - start; right run fits up to window - twice, left run from twice - short on
    right, left = window - twice, twice - short
    low, high = found.low.copy(), found.high.copy()
    only_right, only_left = sides == 1, sides == 2
    low[only_right] = np.maximum(low[only_right], found.at[only_right] - (left - 1))
    high[only_left] = np.minimum(high[only_left], found.at[only_left] - (right + 1))
    live = np.flatnonzero((sides > 0) & (low <= high))
    return live, low[live], high[live]


def _stretches(window: int):
    """(k1, k2, text, codes) to stretches: all live windows of one anchor as one run of words.

    Yields k1, k2, place (of the anchor), hash (of the anchor), digest of the run (two longs).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2)):
                words = Words(data, offsets)
                found = Anchors(words, window)
                doc, code = _held(batch.column(3), low, high)
                live, first, last = _ranges(words, found, doc, code, window)
                size, at = last - first + window, found.at[live]
                d1, d2 = (_run_hash(words, which, first, size, at - first) for which in (1, 2))
                own = words.doc[at]
                yield pa.RecordBatch.from_arrays(
                    [*_keys(batch, low, own), pa.array((at - words.first[own]).astype(np.int32)), _signed(found.hash[at]), _signed(d1), _signed(d2)],
                    names=["k1", "k2", "place", "hash", "d1", "d2"],
                )

    return run


def _run_hash(words: Words, which: int, first: np.ndarray, size: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return mix(words.runs(first, size, which) + size.astype(np.uint64) + (offset.astype(np.uint64) << np.uint64(32)))


def _windows(window: int):
    """(k1, k2, text, codes, places) to single windows of the anchors in ``places``:
    k1, k2, place, start (in the text), digest of the window (two longs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2)):
                words = Words(data, offsets)
                found = Anchors(words, window)
                live, first, last = _ranges(words, found, *_held(batch.column(3), low, high), window)
                doc, place = _held(batch.column(4), low, high)
                chosen = np.searchsorted(live, np.unique(_live(words, found, doc, place)))
                count = last[chosen] - first[chosen] + 1
                start = spans(first[chosen], count)
                at = np.repeat(found.at[live[chosen]], count)
                own = words.doc[at]
                one, two = words.windows(window, 1), words.windows(window, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        *_keys(batch, low, own),
                        pa.array((at - words.first[own]).astype(np.int32)),
                        pa.array((start - words.first[own]).astype(np.int32)),
                        _signed(one[start]),
                        _signed(two[start]),
                    ],
                    names=["k1", "k2", "place", "start", "d1", "d2"],
                )

    return run


def _cleaned(window: int, with_text: bool):
    """(…, text, codes, whole, starts) to (…, n_words, n_removed, kept_sha256), and cleaned if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.num_columns - 4
            for low, high, data, offsets in pieces(batch.column(own)):
                words = Words(data, offsets)
                gone = np.zeros(len(words.start) + 1, np.int64)
                doc, start = _held(batch.column(own + 3), low, high)
                at = words.first[doc] + start
                np.add.at(gone, at, 1)
                np.add.at(gone, at + window, -1)
                whole_doc, whole = _held(batch.column(own + 2), low, high)
                if len(whole):
                    found = Anchors(words, window)
                    live, first, last = _ranges(words, found, *_held(batch.column(own + 1), low, high), window)
                    those = np.searchsorted(live, _live(words, found, whole_doc, whole))
                    np.add.at(gone, first[those], 1)
                    np.add.at(gone, last[those] + window, -1)
                covered = np.cumsum(gone[:-1]) > 0
                kept = []
                for t in range(high - low):
                    a, b = words.first[t], words.first[t + 1]
                    left = a + np.flatnonzero(~covered[a:b])
                    kept.append(b" ".join([data[x:y].tobytes() for x, y in zip(words.start[left], words.end[left])]))
                removed = np.add.reduceat(np.append(covered, False).astype(np.int64), np.minimum(words.first[:-1], len(covered))) * (words.counts > 0)
                clean = [x if n else data[a:b].tobytes() for x, n, a, b in zip(kept, removed, offsets[:-1], offsets[1:])] if with_text else []
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(low, high - low) for i in range(own)],
                        pa.array(words.counts, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                        *([pa.array([x.decode() for x in clean], pa.string())] if with_text else []),
                    ],
                    names=[*batch.schema.names[:own], "n_words", "n_removed", "kept_sha256", *(["cleaned"] if with_text else [])],
                )

    return run


KEYS = ["k1", "k2"]


def _repeated(rows: DataFrame, scratch: Scratch, name: str, *by: str) -> DataFrame:
    """Rows of ``rows`` whose value of ``by`` occurs more than once.

    The values are counted and written before they are joined back, so that both
    sides of the join are plain shuffles, of which Spark splits a hot value.
    """
    again = rows.groupBy(*by).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return rows.join(scratch.keep(again, name), list(by))


def _listed(rows: DataFrame, value: str, name: str) -> DataFrame:
    """One row per document with its values; never more than the document has words."""
    return rows.groupBy(*KEYS).agg(F.collect_set(value).alias(name))


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    carry: tuple = (),
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, ``carry``, n_words, n_removed, kept_sha256, with ``with_text`` also cleaned.

    A window is ``window`` consecutive words (runs of anything but ASCII white
    space) of one document. Words in a window that also starts elsewhere, same
    document included, are removed; the rest is joined by one space. ``cleaned`` is that text,
    or the text as it was where nothing is removed.

    Level-wise doubling. Every window has an anchor, its least run of a quarter
    of its length; about one word in fourteen begins one. Anchors that occur once
    are dropped. The others are extended to both sides to twice their length and
    dropped where that is unique, then to all windows that hold a surviving
    run. Longer levels cannot change which words are covered. Windows of one
    anchor are consecutive, so they are compared as one stretch first; only
    where stretches of an anchor differ are their windows compared singly, one
    copy of each distinct stretch. Anchors and runs are told apart by one hash
    (which can only keep a candidate too long), stretches and windows by two
    independent ones modulo 2^61 - 1: two of n words share both with probability (n / 2^61)^2.

    The texts are written once, bucketed by a hash of id and text. Each level reads
    them again and joins its short lists of positions, so texts are shuffled once.
    Counts are pre-aggregated; a passage that a third of the documents share is
    split by row when counts are joined back. No group of occurrences is gathered.

    Null or empty text: 0 words, kept text empty. Null or repeated ids: rows with
    equal id and text are copies like any others. Texts shorter than a window lose
    nothing. No rows: no rows. Columns beside id, text and ``carry`` are not read.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    own = docs.select(*row_key(id_col, text), F.col(id_col), *carry, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    held = scratch.keep_bucketed(own, "texts", KEYS)
    body = held.select(*KEYS, "_text")
    spot = "k1 long, k2 long, place int, hash long"

    anchors = scratch.keep(body.mapInArrow(_anchors(window), spot), "anchors")
    live = _listed(_repeated(anchors, scratch, "again-1", "hash"), "place", "places")
    runs = scratch.keep(body.join(live, KEYS).select(*KEYS, "_text", "places").mapInArrow(_doubled(window), spot), "runs")
    codes = scratch.keep(_listed(_repeated(runs, scratch, "again-2", "hash"), "place", "codes"), "codes")
    scratch.drop("anchors", "runs", "again-1", "again-2")

    alive = body.join(codes, KEYS).select(*KEYS, "_text", "codes")
    stretches = scratch.keep(alive.mapInArrow(_stretches(window), f"{spot}, d1 long, d2 long"), "stretches")
    same = ["hash", "d1", "d2"]
    one = F.min(F.struct(*KEYS, "place")).alias("one")
    distinct = scratch.keep(stretches.groupBy(*same).agg(F.count("*").alias("n"), one), "distinct")
    several = scratch.keep(distinct.where("n > 1").select(*same), "several")
    whole = _listed(stretches.join(several, same), "place", "whole")
    whole = scratch.keep(whole, "whole")
    scratch.drop("stretches", "several")
    differing = _repeated(distinct.select("hash", "one"), scratch, "again-4", "hash")
    singled = _listed(differing.select("one.*"), "place", "places")
    shape = "k1 long, k2 long, place int, start int, d1 long, d2 long"
    windows = alive.join(singled, KEYS).select(*KEYS, "_text", "codes", "places").mapInArrow(_windows(window), shape)
    windows = scratch.keep(windows, "windows")
    starts = scratch.keep(_listed(_repeated(windows, scratch, "again-3", "d1", "d2"), "start", "starts"), "starts")
    scratch.drop("distinct", "windows", "again-3", "again-4")

    told = held.join(codes, KEYS, "left").join(whole, KEYS, "left").join(starts, KEYS, "left")
    told = told.select(id_col, *carry, "_text", "codes", "whole", "starts")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in held.select(id_col, *carry).schema]
    out = [*fields, "n_words long", "n_removed long", "kept_sha256 string", *(["cleaned string"] if with_text else [])]
    return told.mapInArrow(_cleaned(window, with_text), ", ".join(out))

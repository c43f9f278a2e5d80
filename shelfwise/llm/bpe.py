"""Byte-level BPE: encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over all vocabulary entries that are text: a
pre-token found there is one id. Tier two merges the bytes of the others with a
heap over a linked list.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.support import mix, pieces, prefix, small_batches, spans

CACHE = 1 << 17  # pre-tokens outside the vocabulary whose ids a worker remembers
MAX_BYTES = 64 << 20  # of a rank file; it is broadcast
SPACE, LETTER, NUMBER, OTHER = range(4)


def character_classes() -> np.ndarray:
    """White space, letter, number or other, for every code point."""
    import regex

    points = np.arange(0x110000, dtype=np.uint32)
    points = points[(points < 0xD800) | (points > 0xDFFF)]
    every, out = points.tobytes().decode("utf-32-le"), np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[points[m.start() : m.end()]] = kind
    out[0x1C:0x20] = OTHER  # separators that only Python counts as white space
    return out


def point_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of code points."""
    total, down = prefix(mix(points.astype(np.uint64) + np.uint64(1)), 0)
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


class PerfectHash:
    """n different 64-bit keys to the numbers 0 … n - 1, one displacement for about four keys."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        self.shift = np.zeros(max(1, self.n // 4), np.int64)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        first = np.searchsorted(bucket[order], np.arange(len(self.shift) + 1))
        taken, tries = np.zeros(self.n, bool), np.arange(1, 2049, dtype=np.int64)
        sizes = np.diff(first)
        for b in np.argsort(-sizes, kind="stable"):
            own = keys[order[first[b] : first[b + 1]]]
            if len(own) < 2:
                break
            base = 0
            while True:
                slots = np.sort(self._slot(own[:, None], tries + base), axis=0)
                good = ~taken[slots].any(axis=0) & (slots[1:] != slots[:-1]).all(axis=0)
                if good.any():
                    pick = int(np.argmax(good))
                    self.shift[b] = tries[pick] + base
                    taken[slots[:, pick]] = True
                    break
                base += len(tries)
        single = np.flatnonzero(sizes == 1)
        self.shift[single] = -1 - np.flatnonzero(~taken)[: len(single)]

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(33)) % np.uint64(len(self.shift))).astype(np.int64)

    def _slot(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys ^ (shift.astype(np.uint64) << np.uint64(20))) % np.uint64(self.n)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        shift = self.shift[self._bucket(keys)]
        return np.where(shift < 0, -1 - shift, self._slot(keys, np.maximum(shift, 0)))


class Vocabulary:
    """Ranks of byte strings, ready for both tiers and for decoding."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        self.classes = character_classes()
        size = max(self.ranks.values()) + 1
        by_id = [b""] * size
        for token, i in self.ranks.items():
            by_id[i] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.decimals = [b"%d," % i for i in range(size)]
        texts, ids = [], []
        for token, i in self.ranks.items():
            try:
                texts.append(token.decode())
                ids.append(i)
            except UnicodeDecodeError:  # part of a character: never a whole pre-token
                continue
        lengths = np.array([len(t) for t in texts])
        ends = np.cumsum(lengths)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        keys = point_hashes(points, ends - lengths, ends)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("hash collision in the vocabulary")
        self.place = PerfectHash(keys)
        at = self.place(keys)
        self.slot_id, self.slot_start, self.slot_length, self.slot_key = (np.zeros(len(keys), t) for t in (np.int64, np.int64, np.int64, np.uint64))
        self.slot_id[at], self.slot_start[at], self.slot_length[at], self.slot_key[at] = ids, ends - lengths, lengths, keys
        self.points = points
        self.known: dict[bytes, list[int]] = {}

    def whole(self, points: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Id of each pre-token that is in the vocabulary, else -1; compared character by character."""
        slot = self.place(keys)
        length = end - start
        hit = np.flatnonzero((self.slot_key[slot] == keys) & (self.slot_length[slot] == length))
        ours, theirs = spans(start[hit], length[hit]), spans(self.slot_start[slot[hit]], length[hit])
        wrong = points[ours] != self.points[theirs]
        out = np.full(len(start), -1, np.int64)
        out[hit] = self.slot_id[slot[hit]]
        if wrong.any():
            out[np.repeat(hit, length[hit])[wrong]] = -1
        return out

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: least rank first, leftmost first, until no pair is in the vocabulary."""
        ranks, n = self.ranks, len(word)
        stop, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins here; -1: none does
        bits = n.bit_length()
        mask = (1 << bits) - 1
        heap = [((r << bits | p) << bits) | p + 2 for p in range(n - 1) if (r := ranks.get(word[p : p + 2])) is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            p, end = entry >> bits & mask, entry & mask
            middle = stop[p]
            if middle < 0 or middle >= n or stop[middle] != end:
                continue
            stop[p], stop[middle] = end, -1
            if end < n:
                before[end] = p
                if (r := ranks.get(word[p : stop[end]])) is not None:
                    heappush(heap, ((r << bits | p) << bits) | stop[end])
            q = before[p]
            if q >= 0 and (r := ranks.get(word[q:end])) is not None:
                heappush(heap, ((r << bits | q) << bits) | end)
        out, p = [], 0
        while p < n:
            out.append(ranks[word[p : stop[p]]])
            p = stop[p]
        return out

    def merged(self, word: bytes) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            ids = self.merge(word)
            if len(word) <= 64:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, and where each text's begin (one entry more)."""
        byte_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        edges = np.searchsorted(byte_at, offsets)
        start = pre_token_starts(points, self.classes, edges)
        end = np.append(start[1:], len(points))[: len(start)]
        keys = point_hashes(points, start, end)
        ids = self.whole(points, start, end, keys)
        missed = np.flatnonzero(ids < 0)
        count = np.ones(len(ids), np.int64)
        if len(missed):
            _, first, which = np.unique(keys[missed], return_index=True, return_inverse=True)
            text, a, b = data.tobytes(), byte_at[start[missed[first]]].tolist(), byte_at[end[missed[first]]].tolist()
            found = [self.merged(text[x:y]) for x, y in zip(a, b)]
            sizes = np.array([len(x) for x in found])
            flat = np.array([i for x in found for i in x], np.int64)
            count[missed] = sizes[which]
        place = np.cumsum(count) - count
        out = np.repeat(ids, count)
        if len(missed):
            begins = np.cumsum(sizes) - sizes
            out[spans(place[missed], count[missed])] = flat[spans(begins[which], sizes[which])]
        return out, np.append(place, len(out))[np.searchsorted(start, edges)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of consecutive id sequences, and where each one's begin."""
        length = self.lengths[ids]
        return self.bytes[spans(self.starts[ids], length)], np.append(0, np.cumsum(length))[first]


def _ahead(points: np.ndarray, new: np.ndarray, p: np.ndarray, k: int) -> np.ndarray:
    """The k-th character after each p, 0 beyond the end of its text."""
    inside = p + k < len(points)
    for j in range(1, k + 1):
        inside &= ~new[np.minimum(p + j, len(points))]
    return np.where(inside, points[np.minimum(p + k, len(points) - 1)], 0)


def pre_token_starts(points: np.ndarray, classes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, for the pattern of contractions, words, numbers, signs and white space.

    A run of letters, numbers or signs takes a space before it along. White space
    before anything else gives up its last character: a space goes to what
    follows, another character stands alone. An apostrophe that no space precedes
    takes one of s t m d re ve ll along.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[points]
    new = np.zeros(n + 1, bool)
    new[edges] = True  # begins a text
    changed = new[:n].copy()
    changed[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    follows = np.zeros(n, bool)  # a run of another class goes on from white space in the same text
    follows[1:] = ~space[1:] & space[:-1] & ~new[1:n]
    taken = np.zeros(n, bool)  # … whose last character is a space
    taken[1:] = follows[1:] & (points[:-1] == 0x20)
    starts = changed & ~taken
    last = np.flatnonzero(follows) - 1
    starts[last] = True

    p = np.flatnonzero((points == 0x27) & starts)
    one, two = (_ahead(points, new, p, k) for k in (1, 2))
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((one == ord("l")) & (two == ord("l")))
    for which, size in ((p[short], 2), (p[long], 3)):
        for k in range(1, size):
            starts[which + k] = False
        after = which + size
        after = after[after < n]
        starts[after[kind[after] == LETTER]] = True
    return np.flatnonzero(starts)


def _coded(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        decimals = vocabulary.decimals
        for batch in batches:
            own = batch.num_columns - 1
            for low, high, data, offsets in pieces(batch.column(own)):
                ids, first = vocabulary.encode(data, offsets)
                back, byte_at = vocabulary.decode(ids, first)
                written = []
                for a, b in zip(first[:-1], first[1:]):
                    text = b"".join([decimals[i] for i in ids[a:b].tolist()])
                    written.append(hashlib.sha256(text[:-1]).hexdigest())
                decoded = [hashlib.sha256(back[a:b].tobytes()).hexdigest() for a, b in zip(byte_at[:-1], byte_at[1:])]
                columns = [*[batch.column(i).slice(low, high - low) for i in range(own)], pa.array(np.diff(first), pa.int64()), pa.array(written), pa.array(decoded)]
                names = [*batch.schema.names[:own], "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _decoded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        for batch in batches:
            own = batch.num_columns - 1
            column = batch.column(own)
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            first = np.append(0, np.cumsum(sizes))
            back, at = vocabulary.decode(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), first)
            texts = [back[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:own], pa.array(texts, pa.binary())], names=[*batch.schema.names[:own], "bytes"])

    return run


def load(spark: SparkSession, path: str):
    """A broadcast ``Vocabulary`` from a rank file of at most ``MAX_BYTES``, read by the driver."""
    with open(path, "rb") as f:
        content = f.read(MAX_BYTES + 1)
    if len(content) > MAX_BYTES:
        raise ValueError(f"{path} is larger than {MAX_BYTES} bytes")
    return small_batches(spark).sparkContext.broadcast(Vocabulary(content))


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", carry: tuple = (), with_ids: bool = False) -> DataFrame:
    """One row per document: id, ``carry``, n_tokens, ids_sha256, decoded_sha256, with ``with_ids`` also ids.

    Every match of the byte-level pattern is encoded by the ranks in ``path``,
    without special tokens; ids are then decoded again. No shuffle: texts are
    worked on where they are read, half a megabyte at a time, a longer text as a
    whole. Pre-tokens are cut and looked up in arrays; those outside the vocabulary
    are merged once per step and remembered up to ``CACHE`` per worker.

    Null or empty text: no ids, digests of nothing. Null or repeated ids and
    repeated rows: one row each. No rows: no rows. Other columns are not read.
    """
    shared = load(docs.sparkSession, path)
    cut = docs.select(F.col(id_col), *carry, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema[:-1]]
    out = [*fields, "n_tokens long", "ids_sha256 string", "decoded_sha256 string", *(["ids array<int>"] if with_ids else [])]
    return cut.mapInArrow(_coded(shared, with_ids), ", ".join(out))


def decode_ids(coded: DataFrame, path: str, id_col: str = "doc_id", ids: str = "ids", carry: tuple = ()) -> DataFrame:
    """One row per row: id, ``carry``, bytes; null ids give no bytes."""
    shared = load(coded.sparkSession, path)
    cut = coded.select(F.col(id_col), *carry, F.col(ids).alias("_ids"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema[:-1]]
    return cut.mapInArrow(_decoded(shared), ", ".join([*fields, "bytes binary"]))

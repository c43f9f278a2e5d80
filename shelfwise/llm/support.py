"""What several operators share: word arrays over Arrow text, keys, written tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import fresh_path

#: A word is a run of anything but these six bytes.
WORD = r"[^\x20\x09-\x0D]+"

BATCH = 8 << 20  # bytes of rows that Spark hands to a Python worker at once, unless one row is longer
CHUNK = 1 << 19  # bytes of text that one numpy step holds, unless one text is longer


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches bounded by bytes, so that workers stay small however long texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return spark


class Scratch:
    """Written intermediate tables of one operator run, in the shared folder.

    ``keep`` writes and rereads a table: lineage ends there, so a lost executor
    costs no more than the tasks it ran. ``drop`` deletes tables that no later
    step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = small_batches(spark), label, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[name] = path
        return out

    def keep_bucketed(self, df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        """Like ``keep``, in as many hash buckets of ``keys`` as a shuffle has partitions:
        joins on the keys then move the other side only, as often as they are done."""
        path, buckets = fresh_path(self.spark, f"{self.label}-{name}"), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = "kept_" + path.rsplit("-", 1)[-1]
        laid = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        laid.option("path", path).format("parquet").saveAsTable(table)
        self.paths[name] = path
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)

    def drop_all_but(self, *names: str) -> None:
        self.drop(*[name for name in self.paths if name not in names])


def row_key(id_col: str, text_col: str = "text") -> list[Column]:
    """Two longs that only rows with equal id and equal text share; never null."""
    there = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.xxhash64(F.col(id_col).isNull(), there).alias("k1"),
        F.xxhash64(F.col(text_col).isNull(), text).alias("k2"),
    ]


def share(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASES = [0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4D, 0xA0761D6478BD642F]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size, base = 1 << max(10, (n - 1).bit_length()), _BASES[which]
        steps = np.full((2, size), 1, np.uint64)
        steps[0, 1:], steps[1, 1:] = base, pow(base, -1, 1 << 64)
        have = (np.cumprod(steps[0]), np.cumprod(steps[1]))
        if size <= 1 << 23:  # a single giant text does not stay in memory
            _powers[which] = have
    return have[0][:n], have[1][:n]


def prefix(values: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(which, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


#: Words and runs of words are hashed as polynomials modulo this prime. Different ones of n
#: values share a hash under a random base with probability n / PRIME, whatever they hold.
PRIME = np.uint64((1 << 61) - 1)
_POINTS = [0x0B5AD4ECEDA1CE2A, 0x1137A4F3C0F36D95, 0x06C8E9CF570932BD]  # bases, independent of each other
_LOW, _REST = np.uint64((1 << 32) - 1), np.uint64((1 << 29) - 1)
_STEP, LONG = 7, 56  # bytes of a word in one value; longer words are digested
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(_STEP + 1)], np.uint64)
_raised: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit value modulo ``PRIME``."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _shifted(x: np.ndarray) -> np.ndarray:
    """x * 2**32 modulo ``PRIME``, not fully reduced (below 2**61 + 2**32)."""
    return ((x & _REST) << np.uint64(32)) + (x >> np.uint64(29))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo ``PRIME``, both below it."""
    a_high, a_low, b_high, b_low = a >> np.uint64(32), a & _LOW, b >> np.uint64(32), b & _LOW
    low = a_low * b_low
    return reduced(((a_high * b_high) << np.uint64(3)) + _shifted(a_high * b_low + a_low * b_high) + (low & PRIME) + (low >> np.uint64(61)))


def raised(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo ``PRIME`` for i < n."""
    have = _raised.get(which)
    if have is None or len(have[0]) < n:
        size, prime = 1 << max(10, (n - 1).bit_length()), int(PRIME)
        made = []
        for base in (_POINTS[which], pow(_POINTS[which], -1, prime)):
            column, done = np.ones(size, np.uint64), 1
            while done < size:  # the next ``done`` powers from those before
                column[done : 2 * done] = times(column[:done], np.full(1, pow(base, done, prime), np.uint64))
                done *= 2
            made.append(column)
        have = (made[0], made[1])
        if size <= 1 << 23:  # a single giant text does not stay in memory
            _raised[which] = have
    return have[0][:n], have[1][:n]


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """A value below ``PRIME`` for each word: up to seven bytes, their bytes and number; else a hash.

    Seven bytes make one coefficient of a polynomial, the first one holds the length
    as well. Words beyond ``LONG`` bytes are digested instead.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    size = end - start
    out = (eight[start] & _KEEP[np.minimum(size, _STEP)]) + ((size.astype(np.uint64) & np.uint64(31)) << np.uint64(56))
    base, rows = np.full(1, _POINTS[which], np.uint64), np.flatnonzero((size > _STEP) & (size <= LONG))
    at = _STEP
    while len(rows):
        more = eight[start[rows] + at] & _KEEP[np.minimum(size[rows] - at, _STEP)]
        out[rows] = reduced(times(out[rows], base) + more)
        at += _STEP
        rows = rows[size[rows] > at]
    for i in np.flatnonzero(size > LONG):
        digest = hashlib.blake2b(data[start[i] : end[i]], digest_size=8, salt=bytes([which])).digest()
        out[i] = int.from_bytes(digest, "little") % int(PRIME)
    return out


class Words:
    """Words of consecutive texts, as positions and hashes.

    ``doc[i]`` is the text of word i, ``first`` the first word of each text
    (one entry more than texts), ``start``/``end`` its bytes in ``data``. ``apart``
    says of each byte whether it separates words. ``which`` chooses one of the
    independent hash functions.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, apart: np.ndarray = _IS_SPACE):
        self.data, self.offsets = data, offsets
        word = ~apart[data]
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            full = offsets[1:] > offsets[:-1]
            before[offsets[:-1][full]] = False
            after[offsets[1:][full] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self._plain = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data) if lower else data
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def hash(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return mix(self.codes(1))

    def codes(self, which: int) -> np.ndarray:
        return word_codes(self._plain, self.start, self.end, which)

    def sums(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of codes times powers of the base, and powers of its inverse."""
        if which not in self._sums:
            up, down = raised(which, len(self.start) + 1)
            values = times(self.codes(which), up[:-1])
            total = np.zeros(len(values) + 1, np.uint64)
            high, low = np.cumsum(values >> np.uint64(32)), np.cumsum(values & _LOW)
            total[1:] = reduced(_shifted(reduced(high)) + reduced(low))
            self._sums[which] = (total, down)
        return self._sums[which]

    def windows(self, size: int, which: int = 1) -> np.ndarray:
        """Hash of the ``size`` words from each word on; only where they fit the array."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total, down = self.sums(which)
        return mix(times(reduced(total[size:] + (PRIME - total[:-size])), down[:n]))

    def runs(self, first: np.ndarray, size: np.ndarray, which: int = 1) -> np.ndarray:
        """Hash of ``size`` words from word ``first`` on, for each pair."""
        total, down = self.sums(which)
        return mix(times(reduced(total[first + size] + (PRIME - total[first])), down[first]))

    def fits(self, size: int) -> np.ndarray:
        """For each word, whether ``size`` words from it on lie in its text."""
        return self.first[1:][self.doc] - np.arange(len(self.doc)) >= size


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def cuts(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes together, or of one longer text."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def pieces(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(low, high, bytes, offsets) for each run of texts of a column."""
    data, offsets = texts(column)
    for low, high in cuts(offsets, limit):
        at = offsets[low : high + 1]
        yield low, high, data[at[0] : at[-1]], at - at[0]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each (start, length), one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def least_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n things the least one that the links (a, b) reach."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[label]
        if (label == before).all():
            return label


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that are sorted by their first column, as one table for each of its values."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        value = batch.column(0).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(value[1:] != value[:-1]) + 1
        for low, high in zip([0, *edges], [*edges, batch.num_rows]):
            if high == low:
                continue
            if held and value[low] != current:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            current = value[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()

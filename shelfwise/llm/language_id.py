"""Language identification by a byte convolutional network, trained here in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.support import pieces, share, small_batches

WINDOW = 256  # bytes the network sees at once
WIDTHS = (2, 3, 4)  # of its filters
FILTERS = 16  # of each width
SAMPLE = 1500  # documents per language that it learns from at most
TOTAL = 24000  # documents of all languages that it learns from at most
SPOTS = 3  # windows of each of them
LANGUAGES = 256  # that are learned at most, the most frequent ones
EPOCHS = 6
PAD, NEVER = 256, -1e9
STEP = 128  # windows worked on together


_LETTER = np.zeros(256, bool)  # bytes of a-z and of characters beyond ASCII
_LETTER[[*range(97, 123), *range(128, 256)]] = True
SLACK, DEVIATIONS, FEW = 0.1, 4.0, 3.0  # added to the share, the standard error and the number of unseen runs that are borne


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of three letter bytes (A-Z in lower case) as numbers, and the text each is from."""
    if len(data) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    letter = _LETTER[low]
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    at = np.flatnonzero(letter[:-2] & letter[1:-1] & letter[2:] & (doc[:-2] == doc[2:]))
    wide = low.astype(np.int32)
    return (wide[at] << 16) | (wide[at + 1] << 8) | wide[at + 2], doc[at]


@dataclass
class Familiar:
    """Letter runs of the learned languages, and the share of unseen ones that a text of theirs may have."""

    seen: np.ndarray  # 2^24 bits
    usual: float

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(share of unseen runs, whether it is beyond chance) of each text."""
        runs, doc = letter_runs(data, offsets)
        n = np.bincount(doc, minlength=len(offsets) - 1)
        there = (self.seen[runs >> 3] >> (7 - (runs & 7)).astype(np.uint8)) & np.uint8(1)
        new = np.bincount(doc[there == 0], minlength=len(offsets) - 1)
        expected = (self.usual + SLACK) * n
        return new / np.maximum(n, 1), new > expected + DEVIATIONS * np.sqrt(expected) + FEW


def _flat(windows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [w.encode() for w in windows]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def familiar(windows: list[tuple[str, str]]) -> Familiar:
    """From (id, window) pairs: the usual share is the 99 % quantile over windows of a fifth
    of the documents against the runs of the others; the runs of all are kept."""
    held = np.array([zlib.crc32(f"run {i}".encode()) % 5 == 0 for i, _ in windows], bool)
    data, offsets = _flat([w for _, w in windows])
    runs, doc = letter_runs(data, offsets)
    table = np.zeros(1 << 24, bool)
    table[runs[~held[doc]]] = True
    n, new = np.bincount(doc, minlength=len(windows)), np.bincount(doc[~table[runs]], minlength=len(windows))
    told = held & (n > 0)
    usual = float(np.quantile(new[told] / n[told], 0.99)) if told.any() else 0.0
    table[runs] = True
    return Familiar(np.packbits(table), usual)


class Network:
    """Filters of several widths over bytes, the largest response of each, a softmax.

    A filter of width w is w tables of one number per byte; its response at a
    place is the sum of the tables at the bytes there. Places are not padded to the
    left; a filter may reach over the end of a text, where tables give 0, but no
    place begins there.
    """

    def __init__(self, languages: list[str], seed: int = 1):
        r = np.random.default_rng(seed)
        self.languages, total = languages, FILTERS * len(WIDTHS)
        self.width = max(WIDTHS)
        self.tables = np.zeros((self.width, PAD + 1, total), np.float32)
        self.used = np.zeros_like(self.tables, bool)
        for i, w in enumerate(WIDTHS):
            self.used[:w, :PAD, i * FILTERS : (i + 1) * FILTERS] = True
        self.tables[self.used] = r.normal(0, 0.3, int(self.used.sum()))
        self.tables[0, PAD] = NEVER
        self.bias = np.zeros(total, np.float32)
        self.out = r.normal(0, 0.1, (total, len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def responses(self, x: np.ndarray) -> np.ndarray:
        """(windows, places, filters) for byte rows ``x`` that hold ``width - 1`` more than the places."""
        places = x.shape[1] - self.width + 1
        out = self.tables[0][x[:, :places]]
        for k in range(1, self.width):
            low = next(i for i, w in enumerate(WIDTHS) if w > k) * FILTERS  # shorter filters end before
            out[:, :, low:] += self.tables[k][:, low:][x[:, k : k + places]]
        return out

    def pooled(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self.responses(x).max(axis=1) + self.bias, 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.einsum("wf,fl->wl", self.pooled(x), self.out) + self.offset  # each row alone, so that it does not matter what it is batched with
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, batch: int = 64, seed: int = 2) -> None:
        """Adam on the cross-entropy; only the winning place of each filter gets a gradient."""
        r = np.random.default_rng(seed)
        values = [self.tables, self.bias, self.out, self.offset]
        first, second = ([np.zeros_like(v) for v in values] for _ in range(2))
        total, t = len(self.bias), 0
        filters = np.arange(total)
        for _ in range(epochs):
            order = r.permutation(len(y))
            for low in range(0, len(y), batch):
                rows = order[low : low + batch]
                part, truth = x[rows], y[rows]
                seen = self.responses(part)
                at = seen.argmax(axis=1)
                top = np.take_along_axis(seen, at[:, None, :], 1)[:, 0] + self.bias
                features = np.maximum(top, 0)
                z = features @ self.out + self.offset
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                z[np.arange(len(rows)), truth] -= 1
                z /= len(rows)
                back = (z @ self.out.T) * (top > 0)
                tables = np.zeros_like(self.tables)
                for k in range(self.width):
                    byte = np.take_along_axis(part, at + k, 1).astype(np.int64)
                    sums = np.bincount((byte * total + filters).ravel(), back.ravel(), (PAD + 1) * total)
                    tables[k] = sums.reshape(PAD + 1, total)
                tables *= self.used
                t += 1
                for i, g in enumerate((tables, back.sum(0), features.T @ z, z.sum(0))):
                    first[i] += 0.1 * (g - first[i])
                    second[i] += 0.001 * (g * g - second[i])
                    values[i] -= (rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def window_rows(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as byte windows, one after the other: (rows, text of each row, bytes in it)."""
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][doc] + nth * WINDOW
    at = start[:, None] + np.arange(WINDOW + width - 1)
    end = offsets[1:][doc]
    rows = np.where(at < end[:, None], data[np.minimum(at, max(len(data) - 1, 0))], PAD) if len(doc) else np.zeros((0, WINDOW + width - 1))
    return rows.astype(np.int16), doc, np.minimum(end - start, WINDOW)


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, known = shared.value
        for batch in batches:
            own = batch.num_columns - 2
            for low, high, data, offsets in pieces(batch.column(own + 1)):
                letters = batch.column(own).slice(low, high - low).to_numpy(zero_copy_only=False).astype(bool)
                best, score = np.zeros(high - low, np.int64), np.zeros(high - low)
                names = ["und"] * (high - low)
                if network is not None:
                    rows, doc, size = window_rows(data, offsets, network.width)
                    sums = np.zeros((high - low, len(network.languages)))
                    for a in range(0, len(rows), STEP):
                        chances = network.probabilities(rows[a : a + STEP])
                        np.add.at(sums, doc[a : a + STEP], chances * size[a : a + STEP, None])
                    sums /= np.maximum(np.diff(offsets), 1)[:, None]
                    best, score = sums.argmax(axis=1), np.where(letters, np.minimum(sums.max(axis=1), 1.0), 0.0)
                    names = [network.languages[k] if ok else "und" for k, ok in zip(best, letters)]
                unseen, foreign = known.judge(data, offsets)
                foreign &= network is not None
                columns = [*(batch.column(i).slice(low, high - low) for i in range(own)), pa.array(names, pa.string()), pa.array(score), pa.array(unseen), pa.array(foreign)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:own], "lang_pred", "score", "unseen", "foreign"])

    return run


def training_windows(
    docs: DataFrame, id_col: str, text: str, lang: str, sample: int, held: int, parts: int, total: int = TOTAL, languages: int = LANGUAGES
) -> DataFrame:
    """(_id, _lang, window): ``SPOTS`` windows at hashed places of at most ``sample`` documents per language.

    The least hashes of ids are taken, after a cut by hash to about twice as many,
    so that ranking a language with most of the documents stays small. Chosen ids and
    their languages (``total`` at most) are broadcast; only rows that bear both are read.
    Rows that repeat an id and a language share its ``SPOTS`` windows, those of least hash.
    """
    docs = docs.select(F.col(id_col).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_named"))
    known = docs.where(F.col("_named").isNotNull() & (share("_key", parts) != held)).select(F.col("_key").alias("_id"), F.col("_named").alias("_lang"))
    counts = known.groupBy("_lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_lang").limit(languages)
    sample = max(1, min(sample, total // max(1, counts.count())))
    spread = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("sample")), F.lit(1 << 30))
    cut = known.join(F.broadcast(counts), "_lang").withColumn("_h", spread).where((F.col("_h").cast("double") * F.col("n")) <= F.lit(2.0 * sample * (1 << 30)))
    nth = F.row_number().over(W.partitionBy("_lang").orderBy("_h", "_id"))
    chosen = cut.distinct().withColumn("_nth", nth).where(F.col("_nth") <= sample).select("_id", "_lang")
    body = F.coalesce("_text", F.lit(""))
    room = F.greatest(F.length(body) - WINDOW, F.lit(1))
    spot = [(F.pmod(F.xxhash64(F.col("_key").cast("string"), F.lit(k)), room) + 1).cast("int") for k in range(SPOTS)]
    spots = F.array_distinct(F.array(*[F.substring(body, at, F.lit(WINDOW)) for at in spot]))
    same = (F.col("_key") == F.col("_id")) & (F.col("_named") == F.col("_lang"))
    windows = docs.where(body.rlike(r"\p{L}")).join(F.broadcast(chosen), same).select("_id", "_lang", F.explode(spots).alias("window"))
    place = F.row_number().over(W.partitionBy("_id", "_lang").orderBy(F.xxhash64("window"), "window"))
    return windows.withColumn("_place", place).where(F.col("_place") <= SPOTS).drop("_place")


def learn(windows: list[tuple[str, str]], epochs: int = EPOCHS) -> Network | None:
    """A network from (language, text window) pairs; None without any."""
    if not windows:
        return None
    languages = sorted({lang for lang, _ in windows})
    network = Network(languages)
    rows = np.full((len(windows), WINDOW + network.width - 1), PAD, np.int16)
    for i, (_, window) in enumerate(windows):
        data = np.frombuffer(window.encode()[:WINDOW], np.uint8)
        rows[i, : len(data)] = data
    network.fit(rows, np.array([languages.index(lang) for lang, _ in windows]), epochs)
    return network


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    held: int = 2,
    parts: int = 4,
    carry: tuple = (),
    total: int = TOTAL,
    languages: int = LANGUAGES,
) -> DataFrame:
    """One row per document: id, ``carry``, held_out, lang_pred, score, unseen, foreign.

    Learns from ``text`` and non-null ``lang`` of documents whose crc32(id as text)
    modulo ``parts`` is not ``held``; at most ``sample`` documents per language,
    ``total`` documents and ``languages`` languages (the most frequent) are used,
    everything else of the corpus is only predicted. The network sees fixed windows of bytes, side by
    side over the whole text; ``score`` is the mean probability of the predicted
    language over the windows, weighted by their bytes. No shuffle of texts; the
    network (some hundred kilobytes) is broadcast.

    The network has to name a learned language whatever it reads. ``unseen`` is the share
    of a text's runs of three letter bytes that no training window holds; ``foreign`` says
    that there are more of them than a text of the learned languages has by chance: more than
    the usual share (fitted on windows of held-back documents) plus a tenth, four standard
    errors and three. So a handful of odd words never decides.

    Null or empty text, or text without letters: ``und``, score 0. Null id:
    held_out false, predicted but not learned from. Nothing to learn from: all
    ``und``. Equal scores: the first language by name. Repeated rows: one row
    each. No rows: no rows. Other columns are not read.
    """
    pairs = training_windows(docs, id_col, text, lang, sample, held, parts, total, languages)
    rows = sorted(((r["_lang"], r["window"], str(r["_id"])) for r in pairs.collect()))
    model = learn([row[:2] for row in rows]), familiar([(i, window) for _, window, i in rows])
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(model)
    body = F.coalesce(F.col(text), F.lit(""))
    out = F.coalesce(share(id_col, parts) == held, F.lit(False)).alias("held_out")
    cut = docs.select(F.col(id_col), *carry, out, body.rlike(r"\p{L}").alias("_letters"), body.alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema[:-2]]
    return cut.mapInArrow(_predicted(shared), ", ".join([*fields, "lang_pred string", "score double", "unseen double", "foreign boolean"]))

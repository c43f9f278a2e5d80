"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.support import Words, pieces, share, small_batches

SLOTS = 1 << 20  # of the hashed terms
FACTORS = 4  # of the interactions
SAMPLE = 6000  # labelled documents of each class that it learns from at most
LEAST = 3  # documents of the sample a term must occur in
SIGNIFICANT = 5.0  # standard errors between a term's rates in either class, at least
EPOCHS = 30
THRESHOLD = 0.7

#: What separates terms: every ASCII byte but letters and digits.
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def term_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each text's terms (A-Z in lower case), sorted, and where each text's begin."""
    words = Words(data, offsets, lower=True, apart=_APART)
    pairs = np.unique((words.doc.astype(np.int64) << 32) | (words.hash & np.uint64(SLOTS - 1)).astype(np.int64))
    return pairs & (SLOTS - 1), np.searchsorted(pairs >> 32, np.arange(len(offsets)))


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in pieces(batch.column(2)):
            slots, first = term_slots(data, offsets)
            packed = [slots[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(low, high - low) for i in (0, 1)], pa.array(packed, pa.binary())], names=["_id", "label", "slots"])


class Machine:
    """score = sigmoid(bias + sum of weights + sum of products of factor vectors over pairs of terms).

    Terms count once per text. ``row`` leads from a slot to its parameters, 0 for
    slots that were not learned: their weight and factors are 0.
    """

    def __init__(self, slots: np.ndarray, seed: int = 5):
        r = np.random.default_rng(seed)
        self.row = np.zeros(SLOTS, np.int32)
        self.row[slots] = np.arange(1, len(slots) + 1)
        self.bias = 0.0
        self.weights = np.zeros(len(slots) + 1)
        self.factors = r.normal(0, 0.02, (len(slots) + 1, FACTORS))
        self.factors[0] = 0

    def margins(self, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the sigmoid, and each text's sum of factors."""
        texts = len(first) - 1
        doc = np.repeat(np.arange(texts), np.diff(first))
        linear = np.bincount(doc, self.weights[rows], texts)
        v = self.factors[rows]
        sums = np.stack([np.bincount(doc, v[:, f], texts) for f in range(FACTORS)], 1)
        squares = np.bincount(doc, (v * v).sum(1), texts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def scores(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        rows = self.row[slots]
        known = rows > 0
        kept = np.append(0, np.cumsum(known))[first]
        return 1 / (1 + np.exp(-np.clip(self.margins(rows[known], kept)[0], -40, 40)))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.3, ridge: float = 1e-5, batch: int = 128, seed: int = 6) -> None:
        """AdaGrad on the log loss with a small ridge, texts in a seeded order."""
        r = np.random.default_rng(seed)
        rows = [self.row[t][self.row[t] > 0] for t in texts]
        seen_w, seen_v, seen_b = np.full(len(self.weights), 1e-8), np.full(self.factors.shape, 1e-8), 1e-8
        for _ in range(epochs):
            order = r.permutation(len(rows))
            for low in range(0, len(order), batch):
                those = order[low : low + batch]
                part = [rows[i] for i in those]
                first = np.append(0, np.cumsum([len(p) for p in part]))
                flat = np.concatenate(part) if first[-1] else np.zeros(0, np.int32)
                margin, sums = self.margins(flat, first)
                slope = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[those]) / len(those)
                each = np.repeat(slope, np.diff(first))
                used, at = np.unique(flat, return_inverse=True)
                grad_w = np.bincount(at, each, len(used)) + ridge * self.weights[used]
                inner = np.repeat(sums, np.diff(first), axis=0) - self.factors[flat]
                grad_v = np.stack([np.bincount(at, each * inner[:, f], len(used)) for f in range(FACTORS)], 1) + ridge * self.factors[used]
                seen_w[used] += grad_w**2
                seen_v[used] += grad_v**2
                seen_b += slope.sum() ** 2
                self.weights[used] -= rate * grad_w / np.sqrt(seen_w[used])
                self.factors[used] -= 0.2 * rate * grad_v / np.sqrt(seen_v[used])
                self.bias -= rate * slope.sum() / np.sqrt(seen_b)


def telling_slots(texts: list[np.ndarray], labels: np.ndarray, least: int = LEAST, significant: float = SIGNIFICANT) -> np.ndarray:
    """Slots whose rates in toxic and other texts differ by ``significant`` standard errors.

    Without this, words that are rare in the sample would be learned by heart.
    """
    slots = np.unique(np.concatenate(texts))
    toxic, other = (np.bincount(np.searchsorted(slots, np.concatenate([t for t, l in zip(texts, labels) if l == k])), minlength=len(slots)) for k in (1, 0))
    n_toxic, n_other = labels.sum(), (1 - labels).sum()
    rate = (toxic + other) / len(labels)
    error = np.sqrt(rate * (1 - rate) * (1 / n_toxic + 1 / n_other)) + 1e-12
    apart = np.abs(toxic / n_toxic - other / n_other) / error
    return slots[(toxic + other >= least) & (apart >= significant)]


def learn(texts: list[np.ndarray], labels: np.ndarray) -> Machine | None:
    """A machine from term slots and 0/1 labels; None unless both labels occur.

    Texts with the same terms and label count once, or copies would make their words telling.
    """
    different = {(t.tobytes(), int(k)): i for i, (t, k) in reversed(list(enumerate(zip(texts, labels))))}
    those = sorted(different.values())
    texts, labels = [texts[i] for i in those], labels[those]
    if len(set(labels.tolist())) < 2:
        return None
    machine = Machine(telling_slots(texts, labels))
    machine.fit(texts, labels)
    return machine


def training_terms(docs: DataFrame, labels: DataFrame, id_col: str, text: str, sample: int, held: int, parts: int) -> DataFrame:
    """(_id, label, slots) of at most ``sample`` documents of either label.

    Least hashes of ids first, cut by hash to about twice as many before they are
    ordered. The chosen ids are broadcast, so texts are not shuffled.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & (share(id_col, parts) != held)).select(F.col(id_col).alias("_id"), F.col("toxic").alias("label"))
    spread = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("toxic")), F.lit(1 << 30))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label, n in sorted(counts.items()):
        some = known.where(F.col("label") == label).withColumn("_h", spread).where(F.col("_h").cast("double") * F.lit(n) <= F.lit(2.0 * sample * (1 << 30)))
        some = some.dropDuplicates(["_id"]).orderBy("_h", "_id").limit(sample).select("_id", "label")
        chosen = some if chosen is None else chosen.union(some)
    if chosen is None:
        chosen = known.limit(0)
    there = docs.select(F.col(id_col).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(chosen), F.col("_key") == F.col("_id"))
    cut = there.select("_id", F.col("label").cast("int").alias("label"), "_text").mapInArrow(_slots, f"_id {dict(known.dtypes)['_id']}, label int, slots binary")
    return cut.orderBy(F.xxhash64("_id", "slots"), "_id", "slots").limit(2 * sample)  # ids that repeat: the same rows in each run


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine | None = shared.value
        for batch in batches:
            own = batch.num_columns - 1
            for low, high, data, offsets in pieces(batch.column(own)):
                score = np.zeros(high - low)
                if machine is not None:
                    score = machine.scores(*term_slots(data, offsets))
                columns = [batch.column(i).slice(low, high - low) for i in range(own)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*batch.schema.names[:own], "score"])

    return run


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    held: int = 1,
    parts: int = 3,
    threshold: float = THRESHOLD,
    carry: tuple = (),
) -> DataFrame:
    """One row per document: id, ``carry``, held_out, score, predicted (1 if score >= ``threshold``).

    A factorization machine over hashed terms (whole words, once per text): besides
    a weight per term it learns a factor vector per term, whose products weigh
    pairs, so an insult together with the mention of a group can count more than
    both alone. Learned from ``labels`` (id, toxic) of documents whose crc32(id as
    text) modulo ``parts`` is not ``held``, at most ``sample`` of each label; every
    document is scored, over its whole text, where it is read.

    Null or empty text: the score of no terms. Null id: held_out false, scored but
    not learned from; labels other than 0 and 1 are not used; repeated labels count
    once. Labels of one kind only: score 0 for all. Repeated rows: one row each. No
    rows: no rows. Other columns are not read.
    """
    rows = training_terms(docs, labels, id_col, text, sample, held, parts).collect()
    rows.sort(key=lambda r: (str(r["_id"]), r["slots"]))
    terms, truth = [np.frombuffer(r["slots"], np.int32) for r in rows], np.array([r["label"] for r in rows])
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(learn(terms, truth))
    out = F.coalesce(share(id_col, parts) == held, F.lit(False)).alias("held_out")
    cut = docs.select(F.col(id_col), *carry, out, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema[:-1]]
    scored = cut.mapInArrow(_scored(shared), ", ".join([*fields, "score double"]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

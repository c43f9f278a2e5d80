"""Term weights and the review score: first right-singular direction of TF-IDF.

A document is a listing; its text may be spread over many review rows, so the
counts are combined per (listing, term) before the shuffle and no listing's text
is ever put together. Everything after the counts works on the fitted vocabulary
(at most ``max_features`` terms, 1000 by default).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfwise.functions.text import words
from shelfwise.session import materialize

MAX_FEATURES = 1000
CHUNK = 512  # documents multiplied at a time within a task
MAX_STEPS = 200  # scans of the documents; no fit within them is an error
TIE = 1e-9  # relative distance up to which singular values squared count as equal
LEXICON_ROWS = 1 << 17  # a lexicon of at most so many words is sent to every task


def tokens(texts: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per word occurrence."""
    return texts.select(*keep, F.explode(words(text)).alias("term"))


def term_stats(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (term, tf, df): occurrences and number of documents."""
    per_doc = tokens(texts, text, key).groupBy("term", key).agg(F.count("*").alias("n"))
    return per_doc.groupBy("term").agg(F.sum("n").alias("tf"), F.count("*").alias("df"))


def top_terms(term_counts: DataFrame, n: int = MAX_FEATURES) -> DataFrame:
    """The ``n`` terms with the highest ``tf`` (ties by term) and their rank from 0."""
    first = term_counts.orderBy(F.desc("tf"), "term").limit(n)
    rank = F.row_number().over(W.orderBy(F.desc("tf"), "term")) - 1
    return first.withColumn("idx", rank.cast("int"))


def document_copies(frame: DataFrame, key: str) -> DataFrame:
    """Rows (key, copies): a listing that occurs several times counts that often."""
    return frame.groupBy(key).agg(F.count("*").alias("copies"))


def known_counts(texts: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, term, idx, n): occurrences of the given terms per document. Terms are
    few and always broadcast to the words.

    Each task counts its words first and sends counts by (key, term), never text;
    a document with most of the words is spread by term.
    """
    met = tokens(texts, text, key).join(F.broadcast(terms.select("term", "idx")), "term")
    return met.groupBy(key, "term", "idx").agg(F.count("*").alias("n"))


def _vocabulary(
    texts: DataFrame, key: str, text: str, copies: DataFrame, max_features: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(terms, copies, counts of the terms in all documents of ``texts``), written."""
    copies = materialize(copies, "copies")
    words_of = tokens(texts.select(key, text).join(copies, key), text, "copies")
    first = materialize(top_terms(words_of.groupBy("term").agg(F.sum("copies").alias("tf")), max_features), "first-terms")
    counts = materialize(known_counts(texts, first, key, text), "term-counts")
    n_docs = copies.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    df = counts.join(copies, key).groupBy("term").agg(F.sum("copies").alias("df"))
    idf = (F.ln(F.lit(1.0 + n_docs) / (1 + F.col("df"))) + 1).alias("idf")
    return materialize(first.join(df, "term").select("term", "tf", "df", "idx", idf), "terms"), copies, counts


def fit_vocabulary(
    texts: DataFrame, key: str, text: str, copies: DataFrame, max_features: int = MAX_FEATURES
) -> tuple[DataFrame, DataFrame]:
    """(terms, counts): terms (term, idx, tf, df, idf) and the counts
    (key, copies, term, idx, n) of those terms.

    ``copies`` lists every document, also those without any text. Words are first summed
    up by term alone, a row per term and task; only the chosen terms are then counted
    per document, so of all other words nothing is sent or written by document.
    """
    terms, copies, counts = _vocabulary(texts, key, text, copies, max_features)
    return terms, counts.join(copies, key)


def weigh(counts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Rows (key, term, weight): ``n * idf``, scaled to length 1 per document.

    A document has at most ``max_features`` terms, which bounds the window.
    """
    raw = counts.join(F.broadcast(terms.select("term", "idf")), "term").withColumn(
        "_w", F.col("n") * F.col("idf")
    )
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(key)))
    return raw.select(key, "copies", "term", "idx", (F.col("_w") / length).alias("weight"))


def document_vectors(weights: DataFrame, key: str) -> DataFrame:
    """One row (key, copies, idx, weight) per document: parallel arrays by idx."""
    packed = weights.groupBy(key, "copies").agg(
        F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("v")
    )
    return packed.select(key, "copies", F.col("v.idx").alias("idx"), F.col("v.weight").alias("weight"))


def _pulled(vectors: DataFrame, block: np.ndarray) -> np.ndarray:
    """``XᵀX @ block`` in one scan: each task multiplies its documents and emits at
    most ``width`` rows per direction."""
    width, sides = block.shape

    def partial(batches):
        total = np.zeros((width, sides))
        for batch in (b.iloc[i : i + CHUNK] for b in batches for i in range(0, len(b), CHUNK)):
            sizes = batch["idx"].map(len).to_numpy()
            idx, w = np.concatenate(batch["idx"].to_numpy()), np.concatenate(batch["weight"].to_numpy())
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            dots = np.add.reduceat(w[:, None] * block[idx], starts) * batch["copies"].to_numpy()[:, None]
            spread = w[:, None] * np.repeat(dots, sizes, axis=0)
            for j in range(sides):
                total[:, j] += np.bincount(idx, weights=spread[:, j], minlength=width)
        rows, cols = np.nonzero(total)
        yield pd.DataFrame({"i": rows, "j": cols, "x": total[rows, cols]})

    sums = vectors.select("copies", "idx", "weight").mapInPandas(partial, "i int, j int, x double")
    out = np.zeros((width, sides))
    for row in sums.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        out[row.i, row.j] = row.x
    return out


class Unconverged(RuntimeError):
    """The scans did not suffice for the leading direction."""


def _power_steps(vectors: DataFrame, width: int, steps: int, sides: int) -> np.ndarray:
    """The direction after exactly ``steps`` scans of subspace iteration, converged or not."""
    draw = np.random.default_rng(0)
    block = np.column_stack([np.ones(width), *(draw.standard_normal(width) for _ in range(sides - 1))])
    lead = block[:, 0] / math.sqrt(width)
    for _ in range(steps):
        block, _ = np.linalg.qr(block)
        pulled = _pulled(vectors, block)
        # Best direction within the block (Rayleigh-Ritz), then one step further.
        _, mix = np.linalg.eigh(block.T @ pulled)
        block = pulled @ mix[:, ::-1]
        norm = np.linalg.norm(block[:, 0])
        if norm == 0:
            return np.zeros(width)
        lead = block[:, 0] / norm * (1.0 if block[:, 0].sum() >= 0 else -1.0)
    return lead


def principal_direction(
    vectors: DataFrame, width: int, steps: int = MAX_STEPS, tolerance: float | None = 1e-7, extra: int = 7
) -> np.ndarray:
    """First right-singular vector of the document vectors, certified; ``Unconverged`` beyond ``steps`` scans.

    Block Lanczos: each scan multiplies ``1 + extra`` new directions, which are kept
    orthogonal to all before them; the best direction is sought among all of these. The
    residual of the equation that it should solve, divided by the distance to the next
    singular value (squared), bounds its angle to the true one, and the search ends when
    that is at most ``tolerance``. Directions that share the largest value count as one: the
    one nearest to equal weights is taken. After ``width / (1 + extra)`` scans the
    directions span everything, so values lying close together cost scans, not accuracy.
    The driver holds at most ``2 * width`` directions of ``width`` (at most ``max_features``)
    numbers. All weights are non-negative, which fixes the sign; without any, zeros.

    ``tolerance=None`` is plain subspace iteration of exactly ``steps`` scans.
    """
    sides = min(1 + extra, width)
    if tolerance is None:
        return _power_steps(vectors, width, steps, sides)
    draw, ones = np.random.default_rng(0), np.ones(width)
    block = np.column_stack([ones, *(draw.standard_normal(width) for _ in range(sides - 1))])
    basis, pulled = np.zeros((width, 0)), np.zeros((width, 0))
    angle = math.inf
    for _ in range(steps):
        for _ in range(2):  # once more for the rounding of the first time
            block = block - basis @ (basis.T @ block)
            size = np.linalg.norm(block, axis=0)
            block = block[:, size > 1e-10 * max(float(size.max(initial=0.0)), 1e-300)]
            block, triangle = np.linalg.qr(block)
            block = block[:, np.abs(np.diag(triangle)) > 1e-10]
        block = block[:, : width - basis.shape[1]]
        fresh = _pulled(vectors, block)
        basis, pulled = np.column_stack([basis, block]), np.column_stack([pulled, fresh])
        inner = basis.T @ pulled
        values, mix = np.linalg.eigh((inner + inner.T) / 2)
        top = values[-1]
        if top <= 0:
            return np.zeros(width)
        shared = values >= top * (1 - TIE)
        found = basis @ mix[:, shared]
        residual = np.linalg.norm(pulled @ mix[:, shared] - found * values[shared], axis=0).max()
        rest = values[~shared].max(initial=0.0)
        angle = residual / (top - rest)
        if angle <= tolerance or basis.shape[1] == width:
            lead = found @ (found.T @ ones) if shared.sum() > 1 else found[:, 0]
            lead = lead if np.linalg.norm(lead) > 1e-12 else found[:, 0]
            return lead / np.linalg.norm(lead) * (1.0 if lead.sum() >= 0 else -1.0)
        block = fresh
    raise Unconverged(f"the leading direction is known to an angle of {angle:.2g} after {steps} scans")


def fit_and_count(
    texts: DataFrame,
    key: str = "game_id",
    text: str = "review",
    copies: DataFrame | None = None,
    max_features: int = MAX_FEATURES,
    steps: int = MAX_STEPS,
    tolerance: float | None = 1e-7,
    extra: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """(state as ``fit_review_score`` gives it, counts of its terms in all of ``texts``): scores of
    the same texts come from the counts, without another look at the texts."""
    copies = copies if copies is not None else texts.select(key).distinct().withColumn("copies", F.lit(1))
    terms, copies, counts = _vocabulary(texts, key, text, copies, max_features)
    vectors = materialize(document_vectors(weigh(counts.join(copies, key), terms, key), key), "vectors")
    width = terms.agg(F.coalesce(F.max("idx"), F.lit(-1)) + 1).first()[0]
    if width == 0:
        return terms.withColumn("direction", F.lit(0.0)), counts
    v = principal_direction(vectors, width, steps, tolerance, extra)
    rows = pd.DataFrame({"idx": range(width), "direction": v})
    directions = texts.sparkSession.createDataFrame(rows, "idx int, direction double")
    return materialize(terms.join(F.broadcast(directions), "idx"), "review-score"), counts


def fit_review_score(
    texts: DataFrame,
    key: str = "game_id",
    text: str = "review",
    copies: DataFrame | None = None,
    max_features: int = MAX_FEATURES,
    steps: int = MAX_STEPS,
    tolerance: float | None = 1e-7,
    extra: int = 7,
) -> DataFrame:
    """Fitted state (term, idx, tf, df, idf, direction): at most ``max_features`` rows."""
    return fit_and_count(texts, key, text, copies, max_features, steps, tolerance, extra)[0]


def review_scores(
    texts: DataFrame, state: DataFrame, key: str = "game_id", text: str = "review", counts: DataFrame | None = None
) -> DataFrame:
    """Rows (key, review_score) for documents with at least one known term; ``counts`` are
    those of the texts, where they are at hand."""
    counts = known_counts(texts, state, key, text) if counts is None else counts
    counts = counts.select(key, "term", "n").join(F.broadcast(state.select("term", "idf", "direction")), "term")
    w = F.col("n") * F.col("idf")
    return counts.groupBy(key).agg(
        (F.sum(w * F.col("direction")) / F.sqrt(F.sum(w * w))).alias("review_score")
    )


def add_review_score(
    frame: DataFrame, texts: DataFrame, state: DataFrame, key: str = "game_id", text: str = "review",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add ``review_score``; a listing without known words scores 0."""
    scores = review_scores(texts, state, key, text, counts)
    return frame.join(scores, key, "left").select(
        *frame.columns, F.coalesce("review_score", F.lit(0.0)).alias("review_score")
    )


def lexicon_sentiment(
    reviews: DataFrame, lexicon: DataFrame, key: str, text: str, name: str = "sentiment"
) -> DataFrame:
    """Rows (key, sentiment): mean weight of the words found in the lexicon (term,
    weight), 0 without any.

    One scan splits the texts. A lexicon of at most ``LEXICON_ROWS`` words, counted once
    written, goes to every task, so of the words only a sum and a count per key are shuffled. With a
    larger one the ``LEXICON_ROWS`` most frequent words of the texts, in the lexicon or not, are settled
    that way; only rarer ones are counted by (key, term) and joined with the whole lexicon.
    Keys whose texts have no words, or none at all, have 0; a null key is a key.
    """
    known = materialize(lexicon.select("term", "weight").where("weight is not null"), "lexicon")
    split = reviews.select(key, F.explode_outer(words(text)).alias("term"))
    if known.count() <= LEXICON_ROWS:
        met = split.join(F.broadcast(known), "term", "left")
        sums = met.select(key, F.col("weight").alias("_sum"), F.when(F.col("weight").isNotNull(), 1).alias("_rows"))
    else:
        summed = known.groupBy("term").agg(F.sum("weight").alias("_sum"), F.count("*").alias("_rows"))
        often = split.where("term is not null").groupBy("term").agg(F.count("*").alias("n"))
        frequent = often.join(summed, "term", "left").orderBy(F.desc("n"), "term").limit(LEXICON_ROWS)
        frequent = materialize(frequent.select("term", "_sum", F.coalesce("_rows", F.lit(0)).alias("_rows")), "frequent-words")
        met = split.join(F.broadcast(frequent), "term", "left")
        rare = F.when(F.col("_rows").isNull(), F.col("term")).alias("term")
        totals = [F.sum("_sum").alias("_sum"), F.sum("_rows").alias("_rows"), F.count("*").alias("n")]
        counted = materialize(met.groupBy(key, rare).agg(*totals), "word-counts")
        rest = counted.select(key, "term", "n").join(summed, "term")
        rest = rest.select(key, (F.col("n") * F.col("_sum")).alias("_sum"), (F.col("n") * F.col("_rows")).alias("_rows"))
        sums = counted.select(key, "_sum", "_rows").unionByName(rest)
    mean = F.try_divide(F.sum("_sum"), F.sum("_rows"))
    return sums.groupBy(key).agg(F.coalesce(mean, F.lit(0.0)).alias(name))

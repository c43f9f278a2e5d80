"""Vocabularies, multi-hot encoding, scaling and the train/hold-out split."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import hash_int
from shelfwise.schemas import DERIVED_FEATURES, NUMERIC_FEATURES, SEED

# A dense or sparse feature vector is held in memory per row and per task, so its
# width must be bounded; wider vocabularies belong to the long form.
MAX_WIDTH = 1 << 20


def vocabulary(df: DataFrame, column: str, item: str = "item") -> DataFrame:
    """Distinct list items in order."""
    return df.select(F.explode(column).alias(item)).distinct().orderBy(item)


def vocabulary_items(vocab: DataFrame, item: str = "item", limit: int = MAX_WIDTH) -> list[str]:
    """The items as feature-column order; refuses vocabularies wider than a vector may be."""
    rows = vocab.orderBy(item).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} items: use multi_hot_long")
    return [row[item] for row in rows]


def multi_hot(column: str, items: list[str]) -> Column:
    """0/1 per item in the given order; unknown items are ignored, repeats count once."""
    wanted = F.array(*[F.lit(i) for i in items]) if items else F.array().cast("array<string>")
    return F.transform(wanted, lambda i: F.array_contains(F.col(column), i).cast("int"))


def multi_hot_wide(df: DataFrame, column: str, items: list[str]) -> DataFrame:
    """One 0/1 column per item, named after it, beside the row's own columns."""
    flags = [F.coalesce(F.array_contains(column, i).cast("int"), F.lit(0)).alias(i) for i in items]
    return df.select("*", *flags)


def multi_hot_long(df: DataFrame, key: str, column: str, vocab: DataFrame, item: str = "item") -> DataFrame:
    """Rows (key, item) for every known item of a row: the form without width limit."""
    return (
        df.select(key, F.explode(F.array_distinct(column)).alias(item))
        .join(vocab.select(item), item, "left_semi")
        .select(key, item)
    )


def multi_hot_vectorizer(column: str, items: list[str], output: str) -> CountVectorizerModel:
    """Sparse 0/1 vectors over the given items."""
    model = CountVectorizerModel.from_vocabulary(items, inputCol=column, outputCol=output)
    return model.setBinary(True)


def scaler_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row ``mean_<c>``, ``scale_<c>``: mean and population deviation; a
    constant column gets scale 1."""
    aggs = []
    for c in columns or NUMERIC_FEATURES:
        x = F.col(c).cast("double")
        spread = F.stddev_pop(x)
        aggs += [F.avg(x).alias(f"mean_{c}"), F.when(spread == 0, 1.0).otherwise(spread).alias(f"scale_{c}")]
    return df.agg(*aggs)


def standard_scale(df: DataFrame, stats: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace the columns by ``(x - mean) / scale``; the one-row statistics are a
    scalar subquery, so no join is planned."""
    one = stats.select(F.struct("*").alias("s")).scalar()
    scaled = {
        c: (F.col(c).cast("double") - one[f"mean_{c}"]) / one[f"scale_{c}"] for c in columns or NUMERIC_FEATURES
    }
    return df.withColumns(scaled)


def holdout_flag(key: str | Column, share: float = 0.2, seed: int = SEED) -> Column:
    """True for the hold-out share. Depends on the key only, never on the plan, so
    repeated and retried runs agree and copies of a listing stay together."""
    return hash_int(key, F.lit(seed)) < F.lit(int(share * 2**32))


def split(df: DataFrame, key: str = "game_id", share: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, hold-out)."""
    flag = holdout_flag(key, share, seed)
    return df.where(~flag), df.where(flag)


def feature_names(kind: str = "full") -> list[str]:
    """Numeric inputs: ``full``, or ``plain`` without review score and competitor price."""
    if kind not in ("full", "plain"):
        raise ValueError(kind)
    return NUMERIC_FEATURES + (DERIVED_FEATURES if kind == "full" else [])

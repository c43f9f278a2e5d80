"""Competitor price: what listings with the same tags cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.ranks import approx_quantile, exact_quantile
from shelfwise.session import materialize


def exploded(df: DataFrame, column: str, name: str, *keep: str) -> DataFrame:
    """One row per list item."""
    return df.select(*keep, F.explode(column).alias(name))


def tag_median_prices(
    df: DataFrame, tags: str = "tags", price: str = "current_price", approx: bool = False
) -> DataFrame:
    """Rows (tag, median_price); a tag repeated within one row counts twice."""
    quantile = approx_quantile if approx else exact_quantile
    return quantile(exploded(df, tags, "tag", price), ["tag"], price, name="median_price")


def per_list(df: DataFrame, column: str) -> DataFrame:
    """Distinct item lists. Work done per distinct list and joined back needs no
    row id, and a list shared by a third of the rows is handled once. What is joined back
    is written before: a join of two plain shuffles, which the runtime splits at hot lists."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def competitor_price(
    df: DataFrame,
    tag_prices: DataFrame,
    tags: str = "tags",
    price: str = "current_price",
    name: str = "competitor_pricing",
) -> DataFrame:
    """Add the mean of the tags' median prices; without any known tag, the median
    price of the frame at hand (not of the frame the medians were fitted on)."""
    lists = per_list(df, tags)
    means = (
        exploded(lists, tags, "tag", tags)
        .join(tag_prices, "tag", "left")
        .groupBy(tags)
        .agg(F.avg("median_price").alias(name))
    )
    means = materialize(means, "list-means")
    fallback = exact_quantile(df, [], price).scalar()
    return df.join(means, tags, "left").select(*df.columns, F.coalesce(F.col(name), fallback).alias(name))


def restrict_to_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame, item: str = "item") -> DataFrame:
    """Keep only the list items found in the vocabulary, in their own order."""
    lists = per_list(df, column)
    known = (
        lists.select(column, F.posexplode(column).alias("_pos", item))
        .join(vocabulary.select(item), item, "left_semi")
        .groupBy(column)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", item))).alias("_kept"))
        .select(column, F.col(f"_kept.{item}").alias("_kept"))
    )
    known = materialize(known, "known-items")
    kept = F.when(F.col(column).isNotNull(), F.coalesce("_kept", F.array().cast("array<string>")))
    return df.join(known, column, "left").select(
        *[kept.alias(c) if c == column else F.col(c) for c in df.columns]
    )


def unseen_items(df: DataFrame, column: str, vocabulary: DataFrame, item: str = "item") -> DataFrame:
    """Rows (item, n_rows): items no vocabulary entry covers, which encoders ignore."""
    counts = exploded(df, column, item).groupBy(item).agg(F.count("*").alias("n_rows"))
    return counts.join(vocabulary.select(item), item, "left_anti")

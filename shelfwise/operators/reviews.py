"""Review feeds: latest-N per listing and text aggregation per listing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.operators.ranks import running_totals

PART_BYTES = 16 * 1024 * 1024  # of the text of a listing; a Spark value holds less than 2 GB


def cap_reviews(
    df: DataFrame, n: int = 5, key: str = "game_id", recent: str = "timestamp_created", tie: str = "review"
) -> DataFrame:
    """The ``n`` most recent reviews of each listing.

    The rank filter is applied per task before the shuffle (window group limit),
    so a listing with a third of all reviews sends at most ``n`` rows per task.
    """
    line = W.partitionBy(key).orderBy(F.col(recent).desc_nulls_last(), F.col(tie).asc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(line)).where(F.col("_rn") <= n).drop("_rn")


def aggregate_reviews(
    reviews: DataFrame,
    key: str = "game_id",
    text: str = "review",
    order: str = "timestamp_created",
    prepare: Callable[[Column], Column] | None = None,
    name: str = "all_reviews",
) -> DataFrame:
    """(key, all_reviews): the texts of a listing as one string, joined by one space in
    (order, text) order; nulls are skipped and a listing with nothing but nulls
    gives null.

    One row per listing, whatever its size, so a listing's text must fit one value
    (2 GB). ``review_text_parts`` is the form for feeds that may have longer ones;
    ``combine`` leaves such listings out before it comes here.

    ``prepare`` runs after the one shuffle, so costly cleaning is spread evenly
    however few files the reviews came in.
    """
    placed = reviews.select(key, order, text).repartition(key)
    if prepare is not None:
        placed = placed.withColumn(text, prepare(F.col(text)))
    joined = F.expr(f"string_agg(`{text}`, ' ') WITHIN GROUP (ORDER BY `{order}`, `{text}`)")
    return placed.groupBy(key).agg(joined.alias(name))


def review_text_parts(
    reviews: DataFrame,
    key: str = "game_id",
    text: str = "review",
    order: str = "timestamp_created",
    prepare: Callable[[Column], Column] | None = None,
    part_bytes: int = PART_BYTES,
    name: str = "review",
) -> DataFrame:
    """(key, part, text) of every listing that has text, by one rule at every size.

    A listing's texts in (order, text) order, null orders first, with one byte
    between them, are cut where they pass a multiple of ``part_bytes``; a text goes
    to the part in which it begins. Parts joined by a space in part order are what
    ``aggregate_reviews`` gives. No part is longer than ``part_bytes`` and one text.
    Rows are cut one by one, so very many texts of one moment, or without any
    timestamp, are cut like all others; no task holds a whole listing.
    """
    body = F.col(text) if prepare is None else prepare(F.col(text))
    rows = reviews.select(key, order, body.alias(name)).where(F.col(name).isNotNull())
    spot = F.struct(F.col(order), F.col(name), F.monotonically_increasing_id().alias("row"))
    sized = rows.select(key, spot.alias("_at"), (F.octet_length(name).cast("bigint") + 1).alias("_bytes"))
    placed = running_totals(sized, [key], "_at", ["_bytes"])
    part = F.floor((F.col("cum__bytes") - F.col("_bytes")) / F.lit(part_bytes)).cast("bigint")
    cut = placed.select(key, part.alias("part"), F.col(f"_at.{order}").alias("_order"), F.col(f"_at.{name}").alias(name))
    joined = F.expr(f"string_agg(`{name}`, ' ') WITHIN GROUP (ORDER BY `_order`, `{name}`)")
    return cut.groupBy(key, "part").agg(joined.alias(name))

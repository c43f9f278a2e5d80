"""Flagship: one table per listing from listings, owner feed and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import days_since, parse_owners, parse_release_date
from shelfwise.functions.text import clean_review
from shelfwise.operators.cleaning import exclude_free
from shelfwise.operators.reviews import PART_BYTES, aggregate_reviews, review_text_parts
from shelfwise.schemas import COMBINED
from shelfwise.session import materialize

WHOLE_BYTES = 256 * 1024 * 1024  # of the reviews of a listing: up to here their text is also given as one value


def cleaned_text(review: Column) -> Column:
    """Clean text, null where none is left.

    Cleaning a joined text equals joining the cleaned texts that are not empty, so
    single reviews are cleaned, in parallel.
    """
    return F.nullif(clean_review(review), F.lit(""))


def cleaned_reviews(reviews: DataFrame) -> DataFrame:
    """(game_id, review) of the reviews that have text left after cleaning."""
    clean = reviews.select("game_id", cleaned_text(F.col("review")).alias("review"))
    return clean.where(F.col("review").isNotNull())


def combine_rows(listings: DataFrame, owners: DataFrame, as_of: str, keep_free: bool = False) -> DataFrame:
    """Listings with their owner range and age, without review text.

    The join is left outer and keeps duplicates: n copies of a listing times m
    owner rows. The free filter is on the kept side and runs before the join.
    """
    base = listings if keep_free else exclude_free(listings)
    base = base.withColumn("release_date", parse_release_date("release_date"))
    joined = base.join(owners.select("game_id", "owners"), "game_id", "left")
    return joined.select(
        "game_id", "name", "release_date", "total_reviews", "positive_percent", "genres", "tags",
        "current_price", "discounted_price", "owners",
        days_since("release_date", as_of).alias("days_after_publish"),
        F.inline(F.array(parse_owners("owners"))),  # parsed once, whatever filters follow
    )


def combine(
    listings: DataFrame, owners: DataFrame, reviews: DataFrame, as_of: str, keep_free: bool = False,
    whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """Listings with their owner range and review text; free listings left out.

    Exactly one row per combined listing, whatever the size of its text. The text is
    empty without any, and null where the reviews have more than ``whole_bytes``
    bytes: then only ``combined_texts`` holds it, in parts. Sizes are summed per
    task before any text moves; cleaning never lengthens a text, so no task gathers
    more than ``whole_bytes`` of a listing. Readers that need all text take
    ``combine_rows`` and ``combined_texts``, as the features do.
    """
    rows = combine_rows(listings, owners, as_of, keep_free)
    size = F.sum(F.octet_length("review").cast("bigint") + 1).alias("size")
    sizes = reviews.where(F.col("game_id").isNotNull()).groupBy("game_id").agg(size)
    long = materialize(sizes.where(F.col("size") > whole_bytes).select("game_id", F.lit(True).alias("_long")), "long-texts")
    short = reviews.where(F.col("game_id").isNotNull()).join(long, "game_id", "left_anti")
    texts = aggregate_reviews(short, prepare=cleaned_text, name="review")
    joined = rows.join(texts, "game_id", "left").join(long, "game_id", "left")
    review = F.when(F.col("_long").isNull(), F.coalesce("review", F.lit(""))).alias("review")
    return joined.select(*[c if c != "review" else review for c in COMBINED.names])


def combined_texts(reviews: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(game_id, part, review): the clean text of each listing in parts of bounded size."""
    return review_text_parts(reviews, prepare=cleaned_text, part_bytes=part_bytes)

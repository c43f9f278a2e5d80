"""Typed columns from JSON payloads and raw listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.scalars import (
    _col,
    first_present,
    flag_list,
    release_year,
    safe_long,
    strip,
    thousands_long,
)

# Where ids, review counts and prices stand in a listing page.
ID_IN_LINK = r"/app/(\d+)"
REVIEW_COUNT = r"([\d,]+) user reviews"
POSITIVE_SHARE = r"(\d+)% of the"
GENRE_LINK = r"(?s)<a.*?href=.*?genre.*?>(.*?)</a>"
NO_PRICE = "Free To Play"
PLATFORMS = {"win": "Windows", "mac": "Mac", "linux": "Linux"}


def parse_owner_payload(df: DataFrame, column: str = "payload", key: str = "game_id") -> DataFrame:
    """JSON owner record → 13 typed columns; absent owners give empty text, numbers
    that do not parse give null."""
    record = df.select(key, F.from_json(column, schemas.OWNER_PAYLOAD).alias("r"))
    return record.select(
        F.col(key).cast("bigint").alias("game_id"),
        F.coalesce("r.owners", F.lit("")).alias("owners"),
        *[
            safe_long(f"r.{f.name}").alias(f.name)
            for f in schemas.OWNERS.fields
            if f.name not in ("game_id", "owners")
        ],
    )


def explode_reviews(df: DataFrame, column: str = "payload", key: str = "game_id") -> DataFrame:
    """JSON review page → one row per review with the listing key; absent text is empty."""
    page = df.select(key, F.from_json(column, schemas.REVIEW_PAGE).alias("p"))
    rows = page.select(key, F.explode("p.reviews").alias("r"))
    return rows.select(
        key,
        F.coalesce("r.review", F.lit("")).alias("review"),
        F.col("r.timestamp_created").alias("timestamp_created"),
        F.col("r.voted_up").alias("voted_up"),
    )


def _found(c: Column | str, pattern: str) -> Column:
    """First group of the pattern, null when it does not occur."""
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def extract_listing(
    df: DataFrame, html: str = "html", url: str = "url", id_pattern: str = ID_IN_LINK,
    count_pattern: str = REVIEW_COUNT, share_pattern: str = POSITIVE_SHARE,
) -> DataFrame:
    """Add id, review count and positive share; counts default to 0 when absent."""
    return df.withColumns(
        {
            "game_id": safe_long(_found(url, id_pattern)),
            "total_reviews": F.coalesce(thousands_long(_found(html, count_pattern)), F.lit(0).cast("bigint")),
            "positive_percent": F.coalesce(_found(html, share_pattern).try_cast("int"), F.lit(0)),
        }
    )


def anchor_texts(html: Column | str, pattern: str = GENRE_LINK, distinct: bool = True) -> Column:
    """Trimmed, non-empty texts of the matching links (distinct unless told otherwise)."""
    texts = F.transform(F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(1)), strip)
    texts = F.filter(texts, lambda x: x != "")
    return F.array_distinct(texts) if distinct else texts


def usable_listings(df: DataFrame, key: str = "game_id", released: str = "release_date") -> DataFrame:
    """Add the release year and keep listings that have both an id and a year."""
    return df.withColumn("release_year", release_year(released)).where(
        F.col(key).isNotNull() & F.col("release_year").isNotNull()
    )


def resolve_price(df: DataFrame, original: str, final: str, percent: str, single: str) -> DataFrame:
    """Price columns: a discount (all three parts), else the single price twice,
    else free."""
    parts = [F.nullif(F.col(c), F.lit("")) for c in (original, final, percent)]
    discounted = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    plain = first_present(F.col(single), F.lit(NO_PRICE))
    return df.withColumns(
        {
            "current_price": F.when(discounted, parts[0]).otherwise(plain),
            "discounted_price": F.when(discounted, parts[1]).otherwise(plain),
            "discount_percent": F.when(discounted, parts[2]).otherwise(F.lit("")),
        }
    )


def platform_names(classes: Column | str) -> Column:
    """Sorted platform names found in the icon classes."""
    return flag_list(classes, PLATFORMS)

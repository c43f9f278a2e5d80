"""Dated sample batches with a built-in, growing drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.scalars import append_text, floor_at, format_price, hash_int, parse_price, scale_by_day
from shelfwise.schemas import SEED

# Fixed values of the drift recipe.
EXTRA_TAG = ";Experimental"
EXTRA_REVIEW = " Some recent issues make it less enjoyable."
SCORE_FLOOR = 40
PRICE_RATE = 0.1
REPEATS = 5


def sample_per_day(
    df: DataFrame, key: str, days: int = 6, n: int = 5, seed: int = SEED, tie: tuple[str, ...] = ()
) -> DataFrame:
    """``n`` rows for each day 0..days-1, drawn with the seed ``seed + day``.

    The order is a hash of key and seed, so it does not depend on partitioning,
    and the rank filter cuts every task to ``n`` rows per day before the shuffle.
    """
    dated = df.withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    draw = F.md5(F.concat_ws("-", F.col(key).cast("string"), (F.lit(seed) + F.col("day")).cast("string")))
    line = W.partitionBy("day").orderBy(draw, key, *tie)
    return dated.withColumn("_rn", F.row_number().over(line)).where(F.col("_rn") <= n).drop("_rn")


def repeat_if_few(df: DataFrame, least: int = 5, times: int = REPEATS) -> DataFrame:
    """Every row ``times`` times when there are fewer than ``least`` rows (``copy_no`` 0..)."""
    few = df.limit(least).agg(F.count("*") < least).scalar()
    last = F.when(few, F.lit(times - 1)).otherwise(F.lit(0))
    return df.withColumn("copy_no", F.explode(F.sequence(F.lit(0), last)))


def synthesize_drift(
    df: DataFrame, days: int = 6, n: int = 5, seed: int = SEED, key: str = "game_id", tie: tuple[str, ...] = ()
) -> DataFrame:
    """Sampled listings older than five days, re-dated to day 0..days-1 with rising
    prices, an extra tag, a lower score and a remark after the review."""
    pool = repeat_if_few(df.where(F.col("days_after_publish") > 5), n)
    drawn = sample_per_day(pool, key, days, n, seed, (*tie, "copy_no"))
    cut = F.lit(2) + hash_int(F.col(key), F.col("day"), F.col("copy_no"), F.lit(seed)) % 3
    return drawn.select(
        *[c for c in df.columns if c not in ("days_after_publish", "current_price", "tags", "positive_percent", "review")],
        F.col("day").alias("days_after_publish"),
        format_price(scale_by_day(parse_price("current_price"), "day", PRICE_RATE)).alias("current_price"),
        append_text("tags", EXTRA_TAG).alias("tags"),
        floor_at("positive_percent", cut, SCORE_FLOOR).cast("int").alias("positive_percent"),
        append_text("review", EXTRA_REVIEW).alias("review"),
    )

"""Running totals and exact quantiles over groups of any size.

A window over a whole group would put that group into one task, so neither
operator here uses one on raw rows:

* ``running_totals`` range-partitions the rows and cumulates the totals of the
  partitions (one small row each); only rows of one partition meet in a window.
* ``exact_quantile`` brackets the quantile with a mergeable sketch and ranks only
  the few values inside the bracket, by running totals too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.session import materialize

ACCURACY = 10000


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per (keys, value) as ``n``; pre-aggregated before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def running_totals(
    rows: DataFrame, keys: list[str], order: str, measures: list[str], slices: int | None = None
) -> DataFrame:
    """Add ``cum_<m>``, the total up to and including the row, for each measure
    and ``next_<order>``, the following value in the group (null on the last row).

    ``rows`` should hold each (keys, order) once. The range partition of each row
    is written down with it, so later readers agree on the slices. ``slices``
    fixes their number; otherwise the session's shuffle partitions decide.
    """
    span = [F.col(c) for c in (*keys, order)]
    ranged = rows.repartitionByRange(slices, *span) if slices else rows.repartitionByRange(*span)
    cut = materialize(ranged.withColumn("_slice", F.spark_partition_id()), "ranged")
    line = W.partitionBy(*keys).orderBy("_slice")
    before = line.rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_slice")
        .agg(F.min(order).alias("_first"), *[F.sum(m).alias(f"_t_{m}") for m in measures])
        .select(
            *keys,
            "_slice",
            F.lead("_first").over(line).alias("_next"),
            *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures],
        )
    )
    here = W.partitionBy(*keys, "_slice").orderBy(order)
    upto = here.rowsBetween(W.unboundedPreceding, 0)
    same = [F.col(f"cut.{k}").eqNullSafe(F.col(f"offsets.{k}")) for k in (*keys, "_slice")]
    placed = cut.alias("cut").join(offsets.alias("offsets"), same).select("cut.*", "_next", *[f"_o_{m}" for m in measures])
    return placed.select(
        *rows.columns,
        *[(F.col(f"_o_{m}") + F.sum(m).over(upto)).alias(f"cum_{m}") for m in measures],
        F.coalesce(F.lead(order).over(here), F.col("_next")).alias(f"next_{order}"),
    )


def exact_quantile(
    df: DataFrame, keys: list[str], value: str, q: float = 0.5, name: str = "median", accuracy: int = ACCURACY
) -> DataFrame:
    """Exact interpolated quantile per group; nulls and NaN are left out, and with
    them groups that hold nothing else. A null key is a group of its own.

    The sketch errs by at most ``1/accuracy`` of the ranks, so a bracket of
    ``2/accuracy`` either side always holds the quantile once a group has
    ``2 * accuracy`` rows; smaller groups are ranked whole. The brackets are written
    (one row per group), which lets the planner broadcast them only when they are
    small. Equal values are counted before anything is shuffled by group, so
    a group with most of the rows is spread by value. One count is kept for
    everything below the bracket, what lies above it is dropped, and the rest is
    ranked by ``running_totals``, in as many tasks as it needs.
    """
    grouped = keys or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(1))
    known = rows.select(*grouped, F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    margin = 2.0 / accuracy
    spread = [max(0.0, q - margin), min(1.0, q + margin)]
    large, endless = F.col("_size") >= 2 * accuracy, F.lit(float("inf"))
    brackets = materialize(
        known.groupBy(*grouped)
        .agg(F.percentile_approx("_v", spread, accuracy).alias("_b"), F.count("*").alias("_size"))
        .select(
            *grouped,
            F.when(large, F.col("_b")[0]).otherwise(-endless).alias("_lo"),
            F.when(large, F.col("_b")[1]).otherwise(endless).alias("_hi"),
            "_size",
        ),
        "brackets",
    )
    counted = known.groupBy(*grouped, "_v").agg(F.count("*").alias("_n"))
    same = [F.col(f"counted.{k}").eqNullSafe(F.col(f"brackets.{k}")) for k in grouped]
    bounded = counted.alias("counted").join(brackets.alias("brackets"), same).select("counted.*", "_lo", "_hi", "_size")
    inside = (
        bounded.where(F.col("_v") <= F.col("_hi"))
        .groupBy(*grouped, "_size", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v"))
        .agg(F.sum("_n").alias("_n"))
    )
    ranked = running_totals(inside, grouped, "_v", ["_n"]).withColumnRenamed("cum__n", "_cum")
    spot = (F.col("_size") - 1) * F.lit(float(q))

    def at(rank: Column) -> Column:
        held = (F.col("_cum") - F.col("_n") <= rank) & (rank < F.col("_cum"))
        return F.max(F.when(held, F.col("_v")))

    ends = ranked.groupBy(*grouped).agg(
        at(F.floor(spot)).alias("_a"), at(F.ceil(spot)).alias("_b"), F.max(spot - F.floor(spot)).alias("_f")
    )
    missed = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    exact = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")
    return ends.select(*keys, F.coalesce(exact, missed).alias(name))


def approx_quantile(
    df: DataFrame, keys: list[str], value: str, q: float = 0.5, name: str = "median", accuracy: int = ACCURACY
) -> DataFrame:
    """Sketch-based quantile per group: one mergeable aggregate, bounded state."""
    return df.groupBy(*keys).agg(F.percentile_approx(value, q, accuracy).cast("double").alias(name))

"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.support import WORD, Scratch
from shelfwise.operators.ranks import running_totals

WEIGHTS = (3, 1, 2)
BUDGET = 1.5  # of all sizes
REPEATS = 2  # a document is taken this often at most


def source_targets(
    sizes: DataFrame, source: str = "source", weights: tuple = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS
) -> DataFrame:
    """One row per source: source, source_size, target, _nth (its place), share of ``budget`` times all sizes.

    Sources in order of code point, null last, have ``weights`` in turn. A target
    stops at ``repeats`` times its source's size; what is over goes to the others
    by weight. Sources fill up in the order of limit / weight, so one running sum
    over the sources (one row each) finds the level at which the rest stand.
    """
    total = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    line = W.orderBy(F.col(source).asc_nulls_last())
    nth = (F.row_number().over(line) - 1) % len(weights)
    cases = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))
    limited = total.select(source, "source_size", cases.alias("_w"), (F.col("source_size") * float(repeats)).alias("_limit"))
    order = W.orderBy(F.col("_limit") / F.col("_w"), F.col(source).asc_nulls_last())
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    level = (
        F.sum("source_size").over(W.partitionBy()) * float(budget) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    ) / F.sum("_w").over(rest)
    filled = limited.withColumn("_level", level).withColumn("_full", F.col("_limit") <= F.col("_level") * F.col("_w"))
    common = F.max(F.when(~F.col("_full"), F.col("_level"))).over(W.partitionBy())
    return filled.select(
        source,
        "source_size",
        F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("_w") * common).alias("target"),
        F.row_number().over(line).alias("_nth"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = REPEATS,
    carry: tuple = (),
) -> DataFrame:
    """One row per document: id, source, ``carry``, size, source_size, target, taken.

    Weighted fair queueing: each source offers its documents in a hashed order,
    then all of them again, ``repeats`` times. A document's virtual finish time is
    the source's words up to it, divided by the source's target. All offers are
    sorted by finish time and taken while their total is within the budget.
    Documents are taken whole, so a source misses its target by about one
    document. The order hashes the id, so reruns agree.

    Both running sums (per source, over all) go through ``running_totals``:
    a source with a third of all rows is cut by range, no window spans it, and
    only the last join carries what ``carry`` names. The words are counted once.

    Null or empty text: size 0, taken 0. Null source is a source of its own.
    Null or repeated ids: such rows differ by size and then by a row number that
    is written once; equal rows are interchangeable. No rows: no rows. Other
    columns named like the added ones are left behind.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sized = docs.select(
        F.col(id_col),
        F.col(source),
        *[F.col(c) for c in carry],
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("_row"),
    )
    sized = scratch.keep(sized, "sizes")
    targets = scratch.keep(source_targets(sized, source, weights, budget, repeats), "targets")
    mine = F.col(f"t.{source}").eqNullSafe(F.col(f"s.{source}"))

    def with_target(rows: DataFrame) -> DataFrame:
        return rows.alias("s").join(targets.alias("t"), mine, "left").select("s.*", "source_size", "target", "_nth")

    turn = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    label = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    offers = (
        with_target(sized.where("size > 0"))
        .select("_nth", "target", "size", "_row", label.alias("_id"), turn.alias("_turn"))
        .select(
            "_nth",
            "target",
            "size",
            F.struct("_turn", F.md5(F.concat_ws("/", "_turn", "_id").cast("binary")), "size", "_row").alias("_at"),
        )
    )
    queued = running_totals(offers, ["_nth"], "_at", ["size"])
    finish = F.col("cum_size") / F.col("target")
    timed = queued.select("size", F.struct(finish, "_nth", "_at").alias("_time"), "_at")
    merged = running_totals(timed, [], "_time", ["size"])
    allowed = sized.agg((F.coalesce(F.sum("size"), F.lit(0)) * float(budget)).alias("_budget"))
    taken = (
        merged.where(F.col("cum_size") <= allowed.scalar())
        .groupBy(F.col("_at._row").alias("_row"))
        .agg(F.sum("size").alias("taken"))
    )
    return (
        with_target(sized)
        .join(taken, "_row", "left")
        .select(id_col, source, *carry, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )

"""Drift from mergeable quantile sketches: bounded state per column, stated errors.

A sketch of ``size`` k tells the share of rows up to a value to within ``rank_error(k)``,
however many rows it has seen, in some k numbers. Partial sketches of tasks,
micro-batches or days merge without loss of that bound, so the same operators
serve batches and streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.drift import DISTANCE_LIMIT, KS_FACTOR, MIN_SPREAD, SMALL_REFERENCE

SIZE = 1000  # of a sketch
POINTS = 500  # equally likely values that stand for one side of a comparison


def rank_error(size: int = SIZE) -> float:
    """How far the share of rows between two values may be off, in 99 of 100 sketches."""
    return 2.446 / size**0.9433


def distance_error(size: int = SIZE, points: int = POINTS) -> float:
    """Error bound of ``ks_distance``; times the width of the pooled values, that of the distance in ``wasserstein``."""
    return 2 * (rank_error(size) + 0.5 / points)


def melted(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """Rows (``keep``, column_name, value); NaN becomes null. The columns kept stay as they are, so that a
    stream's watermark goes along."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]
    long = df.select(*keep, F.explode(F.array(*cells)).alias("_cell")).select(*keep, "_cell.*")
    return long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def _summary(size: int) -> list[Column]:
    return [
        F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"),
        F.count("*").alias("n_cells"),
        F.count("value").alias("n_rows"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("spread"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    ]


def sketch_columns(df: DataFrame, columns: list[str], *by: str | Column, keep: tuple[str, ...] = (), size: int = SIZE) -> DataFrame:
    """One row per (``by``, column_name): sketch, n_cells, n_rows (with a value), mean, spread, least, most.

    ``by`` are expressions over the columns in ``keep`` (names of kept columns need no entry). Tasks
    sketch their rows before the shuffle, so a hot key sends one sketch per task. No row without cells.
    """
    kept = tuple(dict.fromkeys([*keep, *[b for b in by if isinstance(b, str)]]))
    return melted(df, columns, *kept).groupBy(*by, "column_name").agg(*_summary(size))


def merge_sketches(sketches: DataFrame, *by: str, size: int = SIZE) -> DataFrame:
    """Rows of ``sketch_columns`` put together by (``by``, column_name), as if the rows had been sketched at once."""
    n, mean = F.sum("n_rows"), F.try_divide(F.sum(F.col("n_rows") * F.col("mean")), F.sum("n_rows"))
    square = F.try_divide(F.sum(F.col("n_rows") * (F.pow("spread", F.lit(2.0)) + F.pow("mean", F.lit(2.0)))), F.sum("n_rows"))
    return sketches.groupBy(*by, "column_name").agg(
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"),
        F.sum("n_cells").alias("n_cells"),
        n.alias("n_rows"),
        mean.alias("mean"),
        F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("spread"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )


def _values(sketch: str, rows: str, points: int) -> Column:
    """Values at the middles of ``points`` equal shares; null without rows."""
    at = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])
    return F.when(F.col(rows) > 0, F.kll_sketch_get_quantile_double(sketch, at))


def _largest_gap(ref: Column, cur: Column, points: int) -> Column:
    """Largest distance of the two step functions; equal values step together."""
    up = F.transform(ref, lambda x: F.struct(x.alias("value"), F.lit(1).alias("step")))
    down = F.transform(cur, lambda x: F.struct(x.alias("value"), F.lit(-1).alias("step")))

    def walk(s: Column, x: Column) -> Column:
        seen = F.when(x["value"] > s["value"], F.greatest(s["most"], F.abs(s["height"]))).otherwise(s["most"])
        return F.struct(x["value"].alias("value"), (s["height"] + x["step"]).alias("height"), seen.alias("most"))

    start = F.struct(F.lit(float("-inf")).alias("value"), F.lit(0).alias("height"), F.lit(0).alias("most"))
    found = F.aggregate(F.array_sort(F.concat(up, down)), start, walk, lambda s: F.greatest(s["most"], F.abs(s["height"])))
    return found / float(points)


def sketch_drift(reference: DataFrame, current: DataFrame, *by: str, points: int = POINTS) -> DataFrame:
    """One row per (``by``, column_name) of ``current`` that the reference has: distances, test, score, limit, drifted.

    ``ks_distance`` and ``wasserstein`` (divided by the reference's spread) are those of
    ``points`` equally likely values of either side, within ``distance_error`` of the exact
    ones. Small references use the first, larger ones the second, as
    ``drift.numeric_drift`` does; sketches count no distinct values, so its tests for columns
    of few values are left to it. A side without values: distances null, not drifted.
    Infinite values may give an undefined ``wasserstein``. ``n_rows`` of both sides stay exact.
    """
    ref = reference.select(
        "column_name", F.col("n_rows").alias("ref_rows"), F.col("spread").alias("ref_spread"), _values("sketch", "n_rows", points).alias("_ref")
    )
    own = [c for c in current.columns if c not in ("sketch", "n_rows")]
    cur = current.select(*own, F.col("n_rows").alias("cur_rows"), _values("sketch", "n_rows", points).alias("_cur"))
    both = cur.join(ref, "column_name")
    apart = F.aggregate(F.zip_with("_ref", "_cur", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x) / float(points)
    n, m = F.col("ref_rows").cast("double"), F.col("cur_rows").cast("double")
    told = both.withColumns(
        {
            "ks_distance": F.when(F.col("_ref").isNotNull() & F.col("_cur").isNotNull(), _largest_gap(F.col("_ref"), F.col("_cur"), points)),
            "wasserstein": apart / F.greatest(F.col("ref_spread"), F.lit(MIN_SPREAD)),
            "test": F.when(F.col("ref_rows") <= SMALL_REFERENCE, "ks").otherwise("wasserstein"),
        }
    )
    ks = F.col("test") == "ks"
    score = F.when(ks, F.col("ks_distance")).otherwise(F.col("wasserstein"))
    limit = F.when(ks, KS_FACTOR * F.sqrt(F.try_divide(n + m, n * m))).otherwise(DISTANCE_LIMIT)
    told = told.withColumns({"score": score, "limit": limit})
    beyond = F.when(ks, F.col("score") > F.col("limit")).otherwise(F.col("score") >= F.col("limit"))
    return told.withColumn("drifted", F.coalesce(beyond, F.lit(False))).drop("_ref", "_cur", "ref_spread")

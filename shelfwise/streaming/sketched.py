"""Monitoring as a stream: sketches of arriving rows, compared and stored window by window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.sketches import SIZE, sketch_columns, sketch_drift
from shelfwise.session import materialize
from shelfwise.sources import tables
from shelfwise.streaming.feeds import run_batches


def window_sketches(
    stream: DataFrame, columns: list[str], ts: str, width: str = "5 days", delay: str = "1 day", size: int = SIZE
) -> DataFrame:
    """Rows of ``sketch_columns`` per window (window_start, window_end), each emitted once, when ``delay`` has passed.

    State is one sketch per (open window, column), whatever the number of rows. Rows later
    than ``delay`` behind the newest one, and rows without a time, are dropped.
    """
    found = sketch_columns(stream.withWatermark(ts, delay), columns, F.window(ts, width).alias("_window"), keep=(ts,), size=size)
    own = [c for c in found.columns if c != "_window"]
    return found.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *own)


def window_metrics(
    drift: DataFrame, prediction: str = "prediction", price: str = "current_price", ranged: str = "positive_percent"
) -> DataFrame:
    """Metric rows (the stored metric table's columns) from compared windows, one per window.

    The median is that of the sketch, the other values are exact; ``mean_abs_corr`` needs pairs of
    columns, which sketches do not hold, and is null.
    """
    feature = F.col("column_name") != prediction
    return drift.groupBy(F.col("window_start").alias("timestamp")).agg(
        F.max(F.when(~feature, F.col("score"))).alias("prediction_drift"),
        F.sum((feature & F.col("drifted")).cast("bigint")).alias("num_drifted_columns"),
        (1 - F.try_divide(F.sum(F.when(feature, F.col("cur_rows"))), F.sum(F.when(feature, F.col("n_cells"))))).alias("share_missing_values"),
        F.max(F.when(F.col("column_name") == ranged, F.col("most") - F.col("least"))).alias("positive_percent_range"),
        F.max(F.when(F.col("column_name") == price, F.col("middle"))).alias("median_current_price"),
        F.lit(None).cast("double").alias("mean_abs_corr"),
    )


def monitor_stream(
    stream: DataFrame, reference: DataFrame, columns: list[str], ts: str, label: str, path: str | None = None,
    width: str = "5 days", delay: str = "1 day", size: int = SIZE,
) -> DataFrame:
    """Compare each closed window of ``stream`` with ``reference``; returns all compared windows.

    Score the stream before (``model.transform`` takes streams) and name its prediction among the
    ``columns``. The reference is sketched once. Each micro-batch stores the windows it
    closes and, given ``path``, appends their metric rows there; a micro-batch that is
    repeated after a failure leaves neither twice.
    """
    still = materialize(sketch_columns(reference, columns, size=size), "reference-sketches")
    closed = window_sketches(stream, columns, ts, width, delay, size)
    middle = F.when(F.col("n_rows") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))

    def compare(batch: DataFrame) -> DataFrame:
        return sketch_drift(still, batch.withColumn("middle", middle))

    def handle(batch: DataFrame, _: int) -> DataFrame:
        found = materialize(compare(batch), "compared")
        if path is not None:
            tables.append_metrics(window_metrics(found), path)
        return found

    return run_batches(closed, handle, label, compare(closed).schema)

"""Monitoring replay: every dated batch against one reference slice, in one pass."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import bucket_of
from shelfwise.operators.cleaning import non_constant_columns, reference_slice
from shelfwise.operators.drift import batch_metrics, numeric_drift
from shelfwise.plans.train import as_vectors
from shelfwise.session import materialize
from shelfwise.sources import tables

# Width of a batch in days, last day of the reference slice, and
# the compared columns of which a metric is reported by name.
BATCH_DAYS = 5
REFERENCE_LAST_DAY = 5


def replay(
    reference_pool: DataFrame,
    batches: DataFrame,
    columns: list[str],
    day: str = "days_after_publish",
    order: tuple[str, ...] = ("game_id",),
    prediction: str = "prediction",
    raw: DataFrame | None = None,
) -> DataFrame:
    """One metric row per consecutive batch of five days, from day 0 up to the first
    batch without rows.

    Columns that are constant on either side are left out of the comparison.
    """
    reference = reference_slice(reference_pool, day, REFERENCE_LAST_DAY, *order)
    dated = batches.withColumn("bucket", bucket_of(day, BATCH_DAYS))
    compared = non_constant_columns(reference, dated, [c for c in columns if c != prediction])
    raw = None if raw is None else raw.withColumn("bucket", bucket_of(day, BATCH_DAYS))
    return batch_metrics(reference, dated, compared, "bucket", prediction, raw=raw)


def wide_column_drift(
    frame: DataFrame, columns: list[tuple[str, Column]], day: str = "days_after_publish", batch_days: int = BATCH_DAYS,
    last_day: int = REFERENCE_LAST_DAY,
) -> DataFrame:
    """Drift of any number of named expressions, such as one per genre and tag, batch by batch.

    Rows before day 0 are left out, rows up to ``last_day`` are the reference. Expressions are
    compared under short names and named again in the result, as items may hold dots or quotes
    or differ by case only. The comparison is on (column, value) counts, so 0/1 columns cost two rows each.
    """
    names = {f"c{i}": name for i, (name, _) in enumerate(columns)}
    plain = [c.cast("double").alias(k) for k, (_, c) in zip(names, columns)]
    dated = frame.where(F.col(day) >= 0).select(F.col(day).alias("_day"), bucket_of(day, batch_days).alias("bucket"), *plain)
    dated = materialize(dated, "dated")
    drift = numeric_drift(dated.where(F.col("_day") <= last_day), dated, list(names), "bucket")
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return drift.withColumn("column_name", F.element_at(named, F.col("column_name")))


def metric_rows(metrics: DataFrame, first: str) -> DataFrame:
    """Metric table rows: one timestamp per batch, counted in minutes from ``first``."""
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(first).cast("timestamp")) + F.col("bucket") * 60)
    return metrics.select(
        at.alias("timestamp"),
        "prediction_drift",
        "num_drifted_columns",
        "share_missing_values",
        "positive_percent_range",
        "median_current_price",
        "mean_abs_corr",
    )


# Field names of the metric document.
DOCUMENT = {
    "num_drifted_columns": "num_drifted_columns",
    "share_drifted_columns": "share_drifted_columns",
    "share_missing_values": "missing_values_share",
    "prediction_drift": "prediction_drift_score",
    "prediction_drift_detected": "prediction_drift_detected",
    "median_current_price": "median_current_price",
    "positive_percent_range": "positive_percent_range",
    "mean_abs_corr": "mean_abs_correlation",
}


def metric_documents(metrics: DataFrame, first: str) -> DataFrame:
    """The full metric document of each batch, one column per field, with its timestamp."""
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(first).cast("timestamp")) + F.col("bucket") * 60)
    return metrics.select(*[F.col(c).alias(name) for c, name in DOCUMENT.items()], at.alias("timestamp"))


def monitor_batches(
    rows: DataFrame, model: Any, features: list[str], columns: list[str], path: str, first: str,
    day: str = "days_after_publish", order: tuple[str, ...] = ("game_id",), raw: DataFrame | None = None,
) -> DataFrame:
    """Prepared rows to stored metrics: predict with a loaded model, replay the dated
    batches against the reference slice, append the metric rows below ``path``/metrics
    (each timestamp once) and write one JSON document per batch to ``path``/documents.
    Returns the metric table."""
    scored = model.transform(as_vectors(rows.drop("prediction"), features)).drop("features")
    scored = materialize(scored, "predicted")
    metrics = materialize(replay(scored, scored, columns, day, order, raw=raw), "metrics")
    tables.write_metrics_json(metric_documents(metrics, first), f"{path}/documents")
    return tables.append_metrics(metric_rows(metrics, first), f"{path}/metrics")


def metric_series(metrics: DataFrame, metric: str) -> DataFrame:
    """A metric over time."""
    return metrics.select(F.col("timestamp").alias("time"), metric).orderBy("time")


def latest_metric(metrics: DataFrame, metric: str) -> DataFrame:
    """The newest value of a metric."""
    return metrics.select(F.col("timestamp").alias("time"), F.col(metric).alias("value")).orderBy(F.desc("time")).limit(1)

"""Streams: tumbling metrics, review feeds, batch replay, progressive output."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.drift import contiguous_buckets
from shelfwise.session import fresh_path


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet", per_trigger: int | None = None
) -> DataFrame:
    """Parquet folder as a stream; the schema is always declared."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def tumbling_metrics(stream: DataFrame, ts: str, value: str, width: str = "5 days", delay: str = "1 day") -> DataFrame:
    """Per window: rows, mean, smallest and largest value, missing share. Rows later
    than ``delay`` behind the newest one are dropped; state is one row per open window."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("w"))
        .agg(
            F.count("*").alias("n_rows"),
            F.avg(value).alias("mean_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.avg(F.isnull(value).cast("double")).alias("missing_share"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows", "mean_value",
                "min_value", "max_value", "missing_share")
    )


def dedup_reviews(
    stream: DataFrame, key: str = "game_id", ts: str = "created_at", text: str = "review", delay: str = "7 days"
) -> DataFrame:
    """Drop reviews fetched again; the state forgets them after ``delay``.

    A hash stands for the text, so that the state does not hold review texts.
    """
    marked = stream.withWatermark(ts, delay).withColumn("_text", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return marked.dropDuplicatesWithinWatermark([key, ts, "_text"]).drop("_text")


def run_to_files(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Drain what is there into Parquet files, checkpointed in the shared folder, and
    read the files back. Exactly-once: a restart goes on from the checkpoint."""
    spark = stream.sparkSession
    path, state = fresh_path(spark, label), fresh_path(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], DataFrame], label: str, schema: T.StructType
) -> DataFrame:
    """Apply ``handle`` to each micro-batch and store its rows under the batch number.

    The folder of a batch is overwritten when the batch is repeated after a failure,
    so a repeat leaves no duplicates.
    """
    spark = stream.sparkSession
    path, state = fresh_path(spark, label), fresh_path(spark, f"{label}-state")

    def store(batch: DataFrame, number: int) -> None:
        handle(batch, number).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    return spark.read.schema(with_batch).parquet(path)


def compare_with_reference(
    stream: DataFrame, reference: Any, compare: Callable[[Any, DataFrame], DataFrame], label: str, schema: T.StructType
) -> DataFrame:
    """Static reference against each arriving batch. What ``compare`` needs of the
    reference should be prepared before (``drift.count_reference``): a batch then
    reads its counts and counts nothing but itself."""
    return run_batches(stream, lambda batch, _: compare(reference, batch), label, schema)


def replay_buckets(
    batches: DataFrame, reference: Any, compare: Callable[[Any, DataFrame], DataFrame], label: str,
    schema: T.StructType, bucket: str = "bucket",
) -> DataFrame:
    """Replay dated batches one at a time against a static reference, from bucket 0 up
    to the first missing one; a restart goes on with the next batch.

    The stream carries one small marker file per bucket. The rows of a batch are read
    from ``batches``, best a table partitioned by the bucket, with all its tasks.
    """
    spark = batches.sparkSession
    path = fresh_path(spark, f"{label}-markers")
    markers = contiguous_buckets(batches, bucket).select(bucket, F.col(bucket).alias("due"))
    markers.write.partitionBy(bucket).parquet(path)
    stream = read_stream(spark, path, markers.schema, per_trigger=1)

    def handle(marker: DataFrame, _: int) -> DataFrame:
        due = [row.due for row in marker.select("due").collect()]
        return compare(reference, batches.where(F.col(bucket).isin(due)))

    return run_batches(stream, handle, label, schema)

"""Readers and writers for CSV, Parquet, JDBC and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas
from shelfwise.functions.scalars import iso_text, safe_double


def read_csv(spark: SparkSession, path: str, schema: T.StructType, escape: str = '"') -> DataFrame:
    """CSV with a header and a declared schema; quoted fields may hold newlines."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", escape)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.LISTINGS)


def read_owners(spark: SparkSession, path: str) -> DataFrame:
    """Owner feed; counts may be written as ``6999.0`` and are read as text first."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.OWNERS.fields])
    raw = read_csv(spark, path, as_text)
    return raw.select(
        *[
            F.col(f.name) if f.name == "owners" else safe_double(f.name).cast("bigint").alias(f.name)
            for f in schemas.OWNERS.fields
        ]
    )


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.REVIEWS)


def read_combined(spark: SparkSession, path: str, escape: str = "\\") -> DataFrame:
    return read_csv(spark, path, schemas.COMBINED, escape)


def write_csv(df: DataFrame, path: str, escape: str = '"') -> None:
    """Overwrite ``path`` with CSV files; lists and maps must be text already."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", escape)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def replace_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Drop-and-reload a catalog table; partition columns serve later pruning."""
    df.write.mode("overwrite").format("parquet").partitionBy(*partition_by).saveAsTable(name)
    return df.sparkSession.table(name)


def replace_files(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """As ``replace_table`` for a plain Parquet folder."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str | None = None, low: int = 0, high: int = 0,
    partitions: int = 1, **options: str,
) -> DataFrame:
    """Database table; with a key column the read is split into parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if column:
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table).options(**options).save()


def append_metrics(df: DataFrame, path: str) -> DataFrame:
    """Append metric rows whose timestamp is not stored yet; returns the table.

    The timestamp is the key of the table: a retried append adds nothing.
    """
    spark = df.sparkSession
    schema = schemas.METRICS
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).dropDuplicates(["timestamp"])
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    rows.join(stored.select("timestamp"), "timestamp", "left_anti").select(*schema.names).write.mode(
        "append"
    ).parquet(path)
    return spark.read.schema(schema).parquet(path)


def metric_documents(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """One flat JSON document per metric row, ISO timestamp, as column ``document``."""
    fields = [iso_text(c).alias(c) if c == timestamp else F.col(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("document"))


def write_metrics_json(df: DataFrame, path: str, timestamp: str = "timestamp") -> None:
    """JSON lines, one document per batch."""
    metric_documents(df, timestamp).write.mode("overwrite").text(path)


def append_feeds(*feeds: DataFrame) -> DataFrame:
    """Stack feeds fetched for different keys; absent columns become null."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out

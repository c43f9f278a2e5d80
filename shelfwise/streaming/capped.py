"""Deduplicated and capped review feed, kept in bounded state per listing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shelfwise.session import fresh_path

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ZERO = datetime(1970, 1, 1, tzinfo=timezone.utc)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """State of queries started inside is kept by RocksDB, which keyed timers need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class _Newest(StatefulProcessor):
    """Keeps the ``n`` newest reviews of a listing as (microseconds, mark), newest first."""

    def __init__(self, n: int, retention_ms: int):
        self.n, self.retention_ms = n, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("newest", "at array<bigint>, mark array<string>, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, due = [], None
        if self.state.exists():
            at, mark, due = self.state.get()
            held = list(zip(at, mark))
        before, texts, newest = set(held), {}, list(held)
        for row in rows:
            entry = (row["_at"], row["_mark"])
            if entry in texts or entry in before:
                continue
            texts[entry] = row["review"]
            newest.append(entry)
            if len(newest) > 4 * self.n + 16:  # a burst does not gather
                newest = self._cut(newest)
                texts = {e: texts[e] for e in newest if e in texts}
        newest = self._cut(newest)
        now = set(newest)
        for entry in newest:
            if entry not in before:
                yield self._change(key, entry, "add", texts[entry])
        for entry in held:
            if entry not in now:
                yield self._change(key, entry, "drop", None)
        end = newest[0][0] // 1000 + self.retention_ms
        if end != due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(end)
        self.state.update(([e[0] for e in newest], [e[1] for e in newest], end))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass

    def _cut(self, entries: list[tuple[int, str]]) -> list[tuple[int, str]]:
        return sorted(entries, key=lambda e: (-e[0], e[1]))[: self.n]

    @staticmethod
    def _change(key, entry: tuple[int, str], what: str, review: str | None) -> Row:
        at = ZERO + timedelta(microseconds=entry[0])
        return Row(game_id=key[0], created_at=at, mark=entry[1], change=what, review=review)


def _newest_of_batches(n: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            once = rows.drop_duplicates(["game_id", "_at", "_mark"]).sort_values(["_at", "_mark"], ascending=[False, True])
            yield once.groupby("game_id", sort=False, dropna=False).head(n)

    return cut


def capped_reviews(
    stream: DataFrame, n: int = 5, key: str = "game_id", ts: str = "created_at", text: str = "review",
    delay: str = "7 days", retention_days: int = 30,
) -> DataFrame:
    """Changes of the ``n`` newest distinct reviews of each listing: game_id, created_at, mark, change, review.

    ``change`` is ``add`` (with the text) or ``drop`` (pushed out by a newer one); ``mark`` is
    the SHA-256 of the text. A review is its listing, time and text; fetched again it
    changes nothing: it is either among those held or older than all of them, and a dropped
    one never returns. So ``n`` times and marks per listing are all the state that removing
    repeats and capping need, and no text is in it. Equal times go by mark.

    Rows later than ``delay`` behind the newest one are dropped. ``retention_days`` after its
    newest review, measured by that clock, a listing's state is forgotten by a timer (what
    was added stays valid); choose it longer than ``delay``, so that no row of a forgotten
    listing can still arrive.

    Each task first cuts its own batches to ``n`` rows a listing, so a listing with a third of
    all reviews sends few. Rows without listing or time are left out; a null text counts as empty.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    body = F.coalesce(F.col(text), F.lit(""))
    known = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rows = known.select(F.col(key).alias("game_id"), at.alias("_at"), F.sha2(body, 256).alias("_mark"), body.alias("review"))
    few = rows.mapInPandas(_newest_of_batches(n), rows.schema)
    timed = few.withColumn("_time", F.timestamp_micros("_at")).withWatermark("_time", delay)
    kind = rows.schema["game_id"].dataType.simpleString()
    out = f"game_id {kind}, created_at timestamp, mark string, change string, review string"
    return timed.groupBy("game_id").transformWithState(_Newest(n, retention_days * 86_400_000), out, "Append", "EventTime")


def run_capped(changes: DataFrame, path: str | None = None, state: str | None = None) -> DataFrame:
    """Drain what is there and return all changes so far. With the ``path`` and ``state`` of an
    earlier run it goes on where that one ended; files and state agree after a failure."""
    spark = changes.sparkSession
    path, state = path or fresh_path(spark, "capped"), state or fresh_path(spark, "capped-state")
    with state_on_disk(spark):
        query = (
            changes.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(changes.schema).parquet(path)


def current_reviews(changes: DataFrame) -> DataFrame:
    """(game_id, created_at, review): what the changes leave. One aggregate; each review was added once
    and dropped once at most."""
    left = changes.groupBy("game_id", "created_at", "mark").agg(
        F.sum(F.when(F.col("change") == "add", 1).otherwise(-1)).alias("_n"), F.max("review").alias("review")
    )
    return left.where("_n > 0").select("game_id", "created_at", "review")


def newest_reviews(reviews: DataFrame, n: int = 5, key: str = "game_id", ts: str = "created_at", text: str = "review") -> DataFrame:
    """The same rows from a batch: distinct reviews, newest first, equal times by the text's SHA-256."""
    body = F.coalesce(F.col(text), F.lit(""))
    known = reviews.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    once = known.select(F.col(key).alias("game_id"), F.col(ts).cast("timestamp").alias("created_at"), body.alias("review")).distinct()
    line = W.partitionBy("game_id").orderBy(F.col("created_at").desc(), F.sha2("review", 256))
    return once.withColumn("_rn", F.row_number().over(line)).where(F.col("_rn") <= n).drop("_rn")

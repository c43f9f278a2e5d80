"""The capped review feed against the batch cap: repeats, late rows, bursts, restarts, expiry."""

import random
from datetime import datetime, timedelta

import pytest

from shelfwise.streaming import capped, feeds

SCHEMA = "game_id long, created_at timestamp, review string"
START = datetime(2024, 1, 1)


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return feeds.read_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, per_trigger=1)


def plain(df):
    return sorted(map(tuple, df.select("game_id", "created_at", "review").collect()))


def random_reviews(seed, n=400):
    r = random.Random(seed)
    rows = [(r.choice([1, 1, 2, 3, 4]), START + timedelta(hours=r.randint(0, 60)), r.choice("abcdefgh") * r.randint(1, 3)) for _ in range(n)]
    return rows + r.sample(rows, 50)


def test_equals_the_batch_cap_over_batches_and_a_restart(spark, tmp_path):
    rows = random_reviews(1) + [(1, START, None), (None, START, "x"), (5, None, "y")]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    put(spark, source, rows[:150])
    put(spark, source, rows[100:300])  # 50 of them again
    first = capped.run_capped(capped.capped_reviews(stream(spark, source), 5, delay="10 days"), out, state)
    assert plain(capped.current_reviews(first)) == plain(capped.newest_reviews(spark.createDataFrame(rows[:300], SCHEMA)))
    put(spark, source, rows[300:] + rows[:40])
    again = capped.run_capped(capped.capped_reviews(stream(spark, source), 5, delay="10 days"), out, state)
    assert plain(capped.current_reviews(again)) == plain(capped.newest_reviews(spark.createDataFrame(rows, SCHEMA)))
    counts = again.groupBy("game_id", "created_at", "mark", "change").count()
    assert counts.where("count > 1").count() == 0
    assert again.where("change = 'drop' and review is not null").count() == 0


def test_late_reviews_are_dropped_and_state_expires(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    day = lambda n: START + timedelta(days=n)
    put(spark, source, [(1, day(0), "old"), (1, day(1), "newer"), (2, day(20), "two")])
    changes = lambda: capped.capped_reviews(stream(spark, source), 2, delay="3 days", retention_days=5)
    capped.run_capped(changes(), out, state)
    put(spark, source, [(1, day(2), "too late"), (2, day(19), "in time"), (3, day(21), "three")])
    got = capped.run_capped(changes(), out, state)
    assert plain(capped.current_reviews(got)) == sorted(
        [(1, day(0), "old"), (1, day(1), "newer"), (2, day(20), "two"), (2, day(19), "in time"), (3, day(21), "three")]
    )
    put(spark, source, [(1, day(22), "after the timer"), (1, day(23), "more")])  # listing 1 is forgotten: nothing is dropped
    got = capped.run_capped(changes(), out, state)
    assert got.where("change = 'drop'").count() == 0 and got.where("game_id = 1 and change = 'add'").count() == 4


def test_a_burst_for_one_listing(spark, tmp_path):
    rows = [(7, START + timedelta(seconds=k % 1000), f"r{k % 700}") for k in range(5000)]
    source = str(tmp_path / "in")
    put(spark, source, rows)
    got = capped.run_capped(capped.capped_reviews(stream(spark, source), 3))
    assert got.count() == 3
    assert plain(capped.current_reviews(got)) == plain(capped.newest_reviews(spark.createDataFrame(rows, SCHEMA), 3))


def test_setting_is_put_back(spark):
    before = spark.conf.get(capped.PROVIDER)
    with pytest.raises(RuntimeError), capped.state_on_disk(spark):
        assert spark.conf.get(capped.PROVIDER) == capped.ROCKSDB
        raise RuntimeError
    assert spark.conf.get(capped.PROVIDER) == before

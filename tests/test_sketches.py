"""Sketched drift beside the exact one: errors, merging, bounded stream state, restart, odd rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import drift, sketches
from shelfwise.streaming import feeds, sketched

ZERO = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """40,000 rows a side: a shifted normal, a skewed one, few values, a constant, a third of one value."""
    root = tmp_path_factory.mktemp("sides")
    out = []
    for k in (0, 1):
        rows = spark.range(0, 40000, 1, 6).select(
            (F.randn(1 + k) + 0.3 * k).alias("shifted"),
            F.exp(F.randn(11 + k)).alias("skewed"),
            F.floor(F.rand(21 + k) * (3 + k)).alias("few"),
            F.lit(5).alias("same"),
            F.when(F.rand(31 + k) < 0.33, 0.0).otherwise(F.rand(41 + k)).alias("hot"),
        )
        rows.write.parquet(f"{root}/{k}")
        out.append(spark.read.parquet(f"{root}/{k}"))
    return out


COLUMNS = ["shifted", "skewed", "few", "same", "hot"]


def test_distances_are_within_the_stated_error(spark, sides):
    ref, cur = sides
    exact = {r.column_name: r for r in drift.numeric_drift(ref, cur, COLUMNS).collect()}
    told = sketches.sketch_drift(sketches.sketch_columns(ref, COLUMNS), sketches.sketch_columns(cur, COLUMNS)).collect()
    assert {r.column_name for r in told} == set(COLUMNS)
    bound = sketches.distance_error()
    pooled = ref.union(cur).agg(*[(F.max(c) - F.min(c)).alias(c) for c in COLUMNS]).first()
    spread = {r.column_name: max(r.spread, drift.MIN_SPREAD) for r in drift.reference_spread(ref, COLUMNS).collect()}
    for r in told:
        e = exact[r.column_name]
        assert (r.ref_rows, r.cur_rows) == (e.ref_rows, e.cur_rows)
        assert abs(r.ks_distance - e.ks_distance) <= bound
        assert abs(r.wasserstein - e.wasserstein) <= bound * pooled[r.column_name] / spread[r.column_name]
    flags = {r.column_name: r.drifted for r in told}
    assert flags["shifted"] and not flags["same"] and not flags["hot"]


def test_merged_parts_equal_the_whole(spark, sides):
    ref = sides[0].withColumn("part", F.spark_partition_id() % 5)
    parts = sketches.sketch_columns(ref, COLUMNS, "part")
    got = {r.column_name: r for r in sketches.merge_sketches(parts).collect()}
    for r in sketches.sketch_columns(ref, COLUMNS).collect():
        m = got[r.column_name]
        assert (m.n_rows, m.n_cells, m.least, m.most) == (r.n_rows, r.n_cells, r.least, r.most)
        assert m.mean == pytest.approx(r.mean, abs=1e-9) and m.spread == pytest.approx(r.spread, abs=1e-6)
    apart = sketches.sketch_drift(sketches.sketch_columns(ref, COLUMNS), sketches.merge_sketches(parts)).collect()
    assert all(r.ks_distance <= sketches.distance_error() for r in apart)


def test_few_rows_are_exact_and_odd_rows_defined(spark):
    ref = spark.createDataFrame([(float(i % 7), None) for i in range(70)] + [(float("nan"), None), (None, None)], "x double, y double")
    cur = spark.createDataFrame([(float(i % 5), 1.0) for i in range(50)], "x double, y double")
    got = {r.column_name: r for r in sketches.sketch_drift(*[sketches.sketch_columns(d, ["x", "y"]) for d in (ref, cur)]).collect()}
    assert got["x"].ref_rows == 70 and abs(got["x"].ks_distance - 2 / 7) <= 2 / sketches.POINTS
    assert got["y"].ks_distance is None and got["y"].drifted is False and got["y"].ref_rows == 0
    none = sketches.sketch_columns(ref.limit(0), ["x", "y"])
    assert none.count() == 0 and sketches.sketch_drift(none, none).count() == 0


def feed(spark, path, day, rows, seed):
    """One file: ``rows`` rows of one day."""
    rng = np.random.default_rng(seed)
    at = [ZERO + dt.timedelta(days=day, seconds=int(s)) for s in rng.integers(0, 86400, rows)]
    x, price = rng.normal(day / 10, 1, rows), rng.integers(1, 60, rows)
    data = [(t, float(a), float(p), float(a) / 2, float(p % 10)) for t, a, p in zip(at, x, price)]
    frame = spark.createDataFrame(data, "ts timestamp, x double, current_price double, prediction double, positive_percent double")
    frame.coalesce(1).write.mode("append").parquet(path)
    return frame


NAMES = ["x", "current_price", "prediction", "positive_percent"]


def test_windows_equal_a_batch_and_metrics_are_appended_once(spark, tmp_path):
    path, kept = str(tmp_path / "in"), str(tmp_path / "metrics")
    frames = [feed(spark, path, day, 300, day) for day in (0, 5, 11, 17)]
    reference = frames[0]
    stream = feeds.read_stream(spark, path, reference.schema, per_trigger=1)
    got = sketched.monitor_stream(stream, reference, NAMES, "ts", "monitored", kept).collect()
    again = sketched.monitor_stream(stream, reference, NAMES, "ts", "monitored", kept)
    rows_of = {}
    for r in spark.read.parquet(path).withColumn("w", F.window("ts", "5 days")["start"]).collect():
        rows_of.setdefault(r.w, []).append(r)
    base, last = reference.collect(), max(r.ts for rows in rows_of.values() for r in rows)
    closed = {w for w in rows_of if w + dt.timedelta(days=6) <= last}
    assert len(closed) == 3 and {(r.window_start, r.column_name) for r in got} == {(w, c) for w in closed for c in NAMES}
    assert again.count() == len(got)
    for r in got:
        x, y = (np.sort([q[r.column_name] for q in side]) for side in (base, rows_of[r.window_start]))
        at = np.concatenate([x, y])
        gap = np.abs(np.searchsorted(x, at, "right") / len(x) - np.searchsorted(y, at, "right") / len(y)).max()
        assert r.cur_rows == len(y) and abs(r.ks_distance - gap) <= sketches.distance_error()
    stored = spark.read.parquet(kept).orderBy("timestamp").collect()
    assert [r.timestamp for r in stored] == sorted({r.window_start for r in got})  # two runs, each window once
    for r in stored:
        rows = [g for g in got if g.window_start == r.timestamp]
        assert r.prediction_drift == next(g.score for g in rows if g.column_name == "prediction")
        assert r.num_drifted_columns == sum(g.drifted for g in rows if g.column_name != "prediction")
        assert r.share_missing_values == 0 and r.positive_percent_range == 9 and r.mean_abs_corr is None
        prices = [q.current_price for q in rows_of[r.timestamp]]
        assert abs(r.median_current_price - np.median(prices)) <= 1


def test_state_does_not_grow_with_rows_and_restarts(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    sizes, seen = [], 0
    schema = feed(spark, path, 0, 3000, 99).schema
    for k in range(4):
        if k:
            feed(spark, path, k % 4, 3000, k)
        found = sketched.window_sketches(feeds.read_stream(spark, path, schema), NAMES, "ts", "30 days", "5 days", size=200)
        query = found.writeStream.format("noop").outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()  # each turn starts the query anew from its checkpoint
        operators = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        sizes.append(operators[-1]["numRowsTotal"])
        seen += sum(p["numInputRows"] for p in query.recentProgress)
    assert seen == 4 * 3000 and sizes[-1] == sizes[1] <= 2 * len(NAMES)
    lengths = [sketches.sketch_columns(spark.read.parquet(path).crossJoin(spark.range(n)), ["x"], size=200).select(F.length("sketch")).first()[0] for n in (1, 8)]
    assert lengths[1] <= 1.5 * lengths[0] < 8 * 18000

"""Operators that must hold for groups of any size, against brute force."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import pricing, ranks, reviews
from shelfwise.operators.ranks import exact_quantile, running_totals, value_counts
from shelfwise.plans.combine import combine, combined_texts


def lopsided(n=4000, seed=1):
    """A third of all rows in one group, values from tiny to huge."""
    draw = np.random.default_rng(seed)
    group = np.where(draw.random(n) < 0.34, "hot", draw.integers(0, 50, n).astype(str))
    value = np.exp(draw.normal(0, 6, n)).round(3)
    value[draw.random(n) < 0.3] = 7.0
    return pd.DataFrame({"g": group, "v": value})


@pytest.mark.parametrize("q", [0.0, 0.31, 0.5, 1.0])
@pytest.mark.parametrize("accuracy", [50, 10000])
def test_exact_quantile_of_skewed_groups(spark, q, accuracy):
    pdf = lopsided()
    df = spark.createDataFrame(pdf).repartition(7)
    got = {r.g: r.median for r in exact_quantile(df, ["g"], "v", q, accuracy=accuracy).collect()}
    wanted = pdf.groupby("g")["v"].quantile(q)
    assert got.keys() == set(wanted.index)
    for g, w in wanted.items():
        assert got[g] == pytest.approx(w, rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([0.0, 1.0, 1.5, 2.0, -3.0, 1e9]), min_size=1, max_size=30))
def test_exact_median_of_any_list(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantile(df, [], "v").first()[0] == pytest.approx(float(np.median(values)))


def test_running_totals_match_a_plain_window(spark):
    pdf = lopsided()
    counts = value_counts(spark.createDataFrame(pdf), ["g"], "v")
    got = running_totals(counts, ["g"], "v", ["n"], slices=5).toPandas().sort_values(["g", "v"]).reset_index(drop=True)
    wanted = pdf.groupby(["g", "v"]).size().rename("n").reset_index()
    assert (got["cum_n"] == wanted.groupby("g")["n"].cumsum()).all()
    following = wanted.groupby("g")["v"].shift(-1)
    assert ((got["next_v"] == following) | (got["next_v"].isna() & following.isna())).all()


def feed(spark, n=600):
    rows = [(1 if i % 3 == 0 else 2 + i % 20, i * 1800, None if i % 17 == 0 else f"text {i} é") for i in range(n)]
    return spark.createDataFrame(rows, "game_id bigint, timestamp_created bigint, review string")


def hot_feed(spark):
    """A listing with most of the reviews, all of one moment or of none."""
    rows = [(1, None if i % 2 else 77, f"text {i % 90} é") for i in range(900)] + [(2, 5, None), (3, 1, "only"), (None, 1, "a"), (None, None, "b")]
    return spark.createDataFrame(rows, "game_id bigint, timestamp_created bigint, review string")


@pytest.mark.parametrize("source", [feed, hot_feed])
def test_texts_in_parts_of_bounded_size(spark, source):
    whole = {r.game_id: r.all_reviews for r in reviews.aggregate_reviews(source(spark)).collect() if r.all_reviews is not None}
    parts = reviews.review_text_parts(source(spark), part_bytes=400).collect()
    assert max(len(p.review.encode()) for p in parts) <= 400 + 20 and max(p.part for p in parts) > 3
    got = {}
    for p in sorted(parts, key=lambda p: p.part):
        got.setdefault(p.game_id, []).append(p.review)
    assert {k: " ".join(v) for k, v in got.items()} == whole


def test_all_null_texts_stay_null(spark):
    df = spark.createDataFrame([(5, 1, None), (6, 1, "x"), (6, 2, None)], "game_id bigint, timestamp_created bigint, review string")
    assert {r.game_id: r.all_reviews for r in reviews.aggregate_reviews(df).collect()} == {5: None, 6: "x"}


def test_combine_has_one_row_per_listing(spark):
    listings = spark.createDataFrame(
        [(g, "n", "1 Jan, 2020", 5, 50, "A", "A", "$5.00", "$4.00") for g in (1, 2, 99)],
        "game_id bigint, name string, release_date string, total_reviews bigint, positive_percent int, genres string, "
        "tags string, current_price string, discounted_price string",
    )
    owners = spark.createDataFrame([(1, "1 .. 2")], "game_id bigint, owners string")
    out = combine(listings, owners, feed(spark), "2025-01-01 00:00:00")
    assert sorted(r.game_id for r in out.collect()) == [1, 2, 99]
    texts = combined_texts(feed(spark), part_bytes=400).where("game_id = 1").orderBy("part").collect()
    assert len(texts) > 3 and " ".join(t.review for t in texts) == out.where("game_id = 1").first().review
    assert out.where("game_id = 99").first().review == ""


def test_combine_keeps_rows_of_listings_with_long_texts(spark):
    """Long text stays in parts: no task joins more of a listing than the bound, and no row is lost."""
    listings = spark.createDataFrame(
        [(g, "n", "1 Jan, 2020", 5, 50, "A", "A", "$5.00", "$4.00") for g in (1, 1, 3, 99)],
        "game_id bigint, name string, release_date string, total_reviews bigint, positive_percent int, genres string, "
        "tags string, current_price string, discounted_price string",
    )
    owners = spark.createDataFrame([(1, "1 .. 2")], "game_id bigint, owners string")
    out = combine(listings, owners, hot_feed(spark), "2025-01-01 00:00:00", whole_bytes=400)
    assert sorted(((r.game_id, r.review) for r in out.collect()), key=str) == [(1, None), (1, None), (3, "only"), (99, "")]
    parts = combined_texts(hot_feed(spark), part_bytes=400).where("game_id = 1").orderBy("part").collect()
    whole = reviews.aggregate_reviews(hot_feed(spark)).where("game_id = 1").first().all_reviews
    assert " ".join(p.review for p in parts) == whole and len(parts) > 3
    wide = combine(listings, owners, hot_feed(spark), "2025-01-01 00:00:00", whole_bytes=1 << 20)
    assert wide.where("game_id = 1").first().review == whole


def test_latest_reviews_are_cut_before_the_shuffle(spark):
    capped = reviews.cap_reviews(feed(spark), 5)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    got = capped.groupBy("game_id").agg(F.count("*").alias("n"), F.min("timestamp_created").alias("t"))
    pdf = feed(spark).toPandas().sort_values("timestamp_created").groupby("game_id").tail(5)
    wanted = pdf.groupby("game_id")["timestamp_created"].agg(["size", "min"])
    assert {(r.game_id, r.n, r.t) for r in got.collect()} == {(g, s, t) for g, s, t in wanted.itertuples()}


def test_hot_tag_list(spark):
    rows = [(i, ["Action", "Indie"] if i % 3 else ["Action", "Action", f"t{i % 40}"], float(i % 11)) for i in range(900)]
    df = spark.createDataFrame(rows, "game_id bigint, tags array<string>, current_price double")
    medians = {r.tag: r.median_price for r in pricing.tag_median_prices(df).collect()}
    flat = df.toPandas().explode("tags").groupby("tags")["current_price"].median()
    assert medians == flat.to_dict()
    got = pricing.competitor_price(df, pricing.tag_median_prices(df)).toPandas()
    assert len(got) == 900
    wanted = got["tags"].map(lambda ts: np.mean([flat[t] for t in ts]))
    assert np.allclose(got["competitor_pricing"], wanted)


def test_quantile_leaves_nan_out_and_keeps_null_groups(spark):
    nan = float("nan")
    rows = [("a", 1.0), ("a", 2.0), ("a", nan), ("b", 1.0), ("b", nan), ("b", nan), ("c", nan), ("d", None), (None, 4.0), (None, 6.0), (None, nan)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert {r.k: r.median for r in exact_quantile(df, ["k"], "v").collect()} == {"a": 1.5, "b": 1.0, None: 5.0}
    assert exact_quantile(df, [], "v").first().median == 2.0


def test_quantile_counts_values_before_groups_are_joined(spark, monkeypatch):
    monkeypatch.setattr(ranks, "running_totals", lambda rows, keys, order, measures: rows.withColumn("cum__n", F.col("_n")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select(F.col("id") % 3, F.col("id").cast("double").alias("v")).toDF("k", "v")
        plan = exact_quantile(df, ["k"], "v")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan.index("SortMergeJoin")
    assert "partial_count(1)" in plan[join:] and "k#" in plan[join:]

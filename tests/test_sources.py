"""Files, payloads, pages and streams."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.plans import monitor
from shelfwise.sources import payloads, tables
from shelfwise.streaming import feeds


def test_csv_with_newlines_quotes_and_float_counts(spark, tmp_path):
    (tmp_path / "owners.csv").write_text(
        ",".join(schemas.OWNERS.names) + '\n730,"100,000 .. 200,000",1,2,3,4,,,6999.0,0.0,5,7,\n'
    )
    row = tables.read_owners(spark, str(tmp_path / "owners.csv")).first()
    assert (row.owners, row.price, row.initialprice, row.followers) == ("100,000 .. 200,000", 6999, 0, None)
    texts = spark.createDataFrame([("a\n\"b\", c", 0.5, 1, True, 9)], schemas.REVIEWS)
    tables.write_csv(texts, str(tmp_path / "reviews"))
    assert tables.read_reviews(spark, str(tmp_path / "reviews")).first() == texts.first()


def test_backslash_escaped_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text(",".join(schemas.COMBINED.names) + '\n1,n,2020-01-02,5,50,"A, B",A,$1,$1,,3,"say \\"hi\\"",,,\n')
    row = tables.read_combined(spark, str(tmp_path / "c.csv")).first()
    assert row.review == 'say "hi"' and row.release_date == dt.date(2020, 1, 2) and row.owner_min is None


def test_replace_table(spark):
    df = spark.range(3).withColumn("day", F.col("id") % 2)
    tables.replace_table(df, "replaced_listings", ("day",))
    again = tables.replace_table(df.where("id > 0"), "replaced_listings", ("day",))
    assert again.count() == 2
    spark.sql("DROP TABLE replaced_listings")


def test_metric_timestamps_stay_unique(spark, tmp_path):
    def row(minute, value):
        return (dt.datetime(2025, 1, 1, 0, minute), value, 1, 0.0, 1.0, 2.0, 0.1)

    one = spark.createDataFrame([row(0, 0.1)], schemas.METRICS)
    two = spark.createDataFrame([row(0, 0.9), row(1, 0.2), row(1, 0.2)], schemas.METRICS)
    tables.append_metrics(one, str(tmp_path / "m"))
    out = tables.append_metrics(two, str(tmp_path / "m"))
    assert sorted(r.prediction_drift for r in out.collect()) == [0.1, 0.2]
    assert monitor.latest_metric(out, "prediction_drift").first().value == 0.2
    tables.write_metrics_json(out, str(tmp_path / "json"))
    text = sorted(r.value for r in spark.read.text(str(tmp_path / "json")).collect())[0]
    assert '"timestamp":"2025-01-01T00:00:00Z"' in text


def test_owner_payload_defaults(spark):
    df = spark.createDataFrame([(1, '{"owners":"1 .. 2","price":"12","ccu":3}'), (2, "{}"), (3, "broken")], "game_id bigint, payload string")
    rows = {r.game_id: r for r in payloads.parse_owner_payload(df).collect()}
    assert (rows[1].price, rows[1].ccu, rows[1].followers) == (12, 3, None)
    assert rows[2].owners == "" and rows[3].owners == ""


def test_review_page(spark):
    page = '{"cursor":"x","reviews":[{"review":"a","timestamp_created":5,"voted_up":true},{"timestamp_created":6}]}'
    df = spark.createDataFrame([(1, page), (2, '{"reviews":[]}')], "game_id bigint, payload string")
    assert sorted((r.game_id, r.review, r.voted_up is True) for r in payloads.explode_reviews(df).collect()) == [(1, "", False), (1, "a", True)]


def test_listing_page(spark):
    html = '<a\nhref="/genre/1">Action</a> <a href="/genre/2"> Indie </a><a href="/genre/1">Action</a><p>86% of the 1,234 user reviews'
    df = spark.createDataFrame([("http://x/app/730/y", html), ("http://x/bundle/5", "")], "url string, html string")
    rows = payloads.extract_listing(df).withColumn("genres", payloads.anchor_texts("html")).collect()
    assert (rows[0].game_id, rows[0].total_reviews, rows[0].positive_percent) == (730, 1234, 86)
    assert rows[0].genres == ["Action", "Indie"]
    assert (rows[1].game_id, rows[1].total_reviews, rows[1].positive_percent, rows[1].genres) == (None, 0, 0, [])


def test_price_chain(spark):
    df = spark.createDataFrame(
        [("$20", "$10", "-50%", None), ("$20", "", "-50%", "$7"), (None, None, None, "")], "o string, f string, p string, s string"
    )
    out = payloads.resolve_price(df, "o", "f", "p", "s").select("current_price", "discounted_price", "discount_percent").collect()
    assert [tuple(r) for r in out] == [("$20", "$10", "-50%"), ("$7", "$7", ""), ("Free To Play", "Free To Play", "")]


def events(spark, path, rows):
    spark.createDataFrame(rows, "ts timestamp, value double").coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_dropped_from_closed_windows(spark, tmp_path):
    path, day = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], "ts timestamp, value double").schema
    events(spark, path, [(day, 1.0), (day + dt.timedelta(days=1), 3.0), (day + dt.timedelta(days=12), 9.0)])
    out = feeds.run_to_files(feeds.tumbling_metrics(feeds.read_stream(spark, path, schema), "ts", "value"), "w")
    rows = out.orderBy("window_start").collect()
    assert sum(r.n_rows for r in rows) == 2
    assert all(r.window_end <= day + dt.timedelta(days=11) for r in rows)


def test_refetched_reviews_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = [(1, dt.datetime(2024, 1, 1, 0, i), f"r{i}") for i in range(5)]
    for _ in range(2):
        spark.createDataFrame(rows, "game_id bigint, created_at timestamp, review string").coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    stream = feeds.read_stream(spark, path, schema, per_trigger=1)
    assert feeds.run_to_files(feeds.dedup_reviews(stream), "dedup").count() == 5

"""Steps that many queries share: what is parsed, counted and written only once."""

import datetime

import pytest
from pyspark.sql import functions as F

from checks import q_models
from shelfwise.functions.scalars import parse_owners, parse_release_date
from shelfwise.operators import cleaning, tfidf
from shelfwise.plans import features
from shelfwise.plans.combine import combine_rows


@pytest.fixture
def written(monkeypatch):
    """Rows of each table that the text score writes."""
    rows, put = {}, tfidf.materialize

    def counted(df, label):
        out = put(df, label)
        rows[label] = out.count()
        return out

    monkeypatch.setattr(tfidf, "materialize", counted)
    return rows


def test_prices_and_owners_are_parsed_once_a_row(spark):
    listings = spark.createDataFrame(
        [(1, "a", "5 Jan, 2020", 3, 90, "x,y", "p;q", "$4.00", "$1.00 USD"), (None, "b", "Coming soon", 3, 90, "x", "p", "abc", "$1")],
        "game_id long, name string, release_date string, total_reviews long, positive_percent int, genres string, tags string, "
        "current_price string, discounted_price string",
    )
    owners = spark.createDataFrame([(1, "10 .. 1,000"), (1, None)], "game_id long, owners string")
    frame = features.clean_frame(combine_rows(listings, owners, "2025-06-16 12:00:00"))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 4  # release date, number of an owner range, two prices
    assert [(r.game_id, r.owner_max, r.discount_pct, r.tags) for r in frame.collect()] == [(1, 1000.0, 0.75, ["p", "q"])]


def test_parsing_keeps_odd_values(spark):
    texts = ["0 .. 20", "1..2..3", "", None, "a .. 5", "10 .. 1,000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_owners("t").alias("o"))
    got = [(r.o.owner_min, r.o.owner_max, None if r.o.owners_log_mean is None else round(r.o.owners_log_mean, 6)) for r in df.collect()]
    assert got == [(0.0, 20.0, 0.0), (None,) * 3, (None,) * 3, (None,) * 3, (None,) * 3, (10.0, 1000.0, 100.0)]
    days = spark.createDataFrame([(t,) for t in ("5 Jan, 2020", "Jan 5, 2020", "2020-01-05", "Coming soon", None)], "t string")
    day = datetime.date(2020, 1, 5)
    assert [r[0] for r in days.select(parse_release_date("t")).collect()] == [day, day, day, None, None]
    odd = spark.createDataFrame([("$1", None, 7), ("$1", "$2", 8)], "current_price string, discounted_price string, `a.b` int")
    assert [tuple(r) for r in cleaning.parse_prices(odd).collect()] == [(1.0, 2.0, 8)]


def test_only_chosen_terms_are_counted_by_document(spark, written):
    texts = spark.createDataFrame(
        [(1, "aa aa bb once"), (2, "aa bb more"), (2, "aa"), (3, "cc cc cc cc cc cc cc cc"), (None, "aa")], "game_id long, review string"
    )
    copies = spark.createDataFrame([(1, 1), (2, 2), (4, 1)], "game_id long, copies long")
    state, counts = tfidf.fit_and_count(texts, copies=copies, max_features=2)
    assert [(r.term, r.tf, r.df) for r in state.orderBy("idx").collect()] == [("aa", 6, 3), ("bb", 3, 3)]
    assert written["term-counts"] == 5  # aa and bb of 1 and 2, aa of the null key
    plain = {tuple(r) for r in tfidf.review_scores(texts, state).collect()}
    assert {tuple(r) for r in tfidf.review_scores(texts, state, counts=counts).collect()} == plain


def test_frequent_words_are_not_sent_by_document(spark, monkeypatch, written):
    reviews = spark.createDataFrame([(k, f"good often only{k}") for k in range(20)] + [(20, None), (None, "good bad")], "k long, t string")
    lexicon = spark.createDataFrame([("good", 1.0), ("good", 0.5), ("only3", -1.0), ("bad", -2.0), (None, 9.0)], "term string, weight double")
    whole = {r[0]: r[1] for r in tfidf.lexicon_sentiment(reviews, lexicon, "k", "t").collect()}
    monkeypatch.setattr(tfidf, "LEXICON_ROWS", 2)
    split = {r[0]: r[1] for r in tfidf.lexicon_sentiment(reviews, lexicon, "k", "t").collect()}
    assert split == pytest.approx(whole) and len(split) == 22
    assert whole[3] == pytest.approx(0.5 / 3) and whole[20] == 0.0 and whole[None] == pytest.approx(-0.5 / 3)
    assert written["word-counts"] == 22 + 20 + 1  # one row a key, and its rare words


def test_ablation_makes_the_feature_frame_once(spark, monkeypatch):
    calls, rows = [], spark.range(50).select(F.col("id").alias("game_id"), F.lit(0).alias("features"), F.lit(0.5).alias("discount_pct"))

    class Same:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.25))

    monkeypatch.setattr(q_models, "training", lambda *_: calls.append(1) or (rows, None))
    monkeypatch.setattr(q_models.features, "vectorizer", lambda *_: Same())
    monkeypatch.setattr(q_models.train, "fit_model", lambda *_: Same())
    got = {r.kind: r.mae for r in q_models.ablation_models(spark, "").collect()}
    assert got == {"full": 0.25, "plain": 0.25} and len(calls) == 1

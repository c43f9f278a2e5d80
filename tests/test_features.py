"""Pricing, encoding, text score, training and estimators."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from shelfwise.operators import cleaning, encoding, evaluation, pricing, tfidf
from shelfwise.plans import features, monitor, train
from shelfwise.plans.estimators import CompetitorPricing, CompetitorPricingModel, DropColumns, ReviewScore, ReviewScoreModel, scoring_pipeline


def tagged(spark, rows):
    return spark.createDataFrame(rows, "game_id bigint, tags array<string>, current_price double")


def test_repeated_tag_counts_twice_in_the_median(spark):
    df = tagged(spark, [(1, ["A", "A"], 10.0), (2, ["A"], 40.0), (3, ["B"], None)])
    assert [(r.tag, r.median_price) for r in pricing.tag_median_prices(df).collect()] == [("A", 10.0)]


def test_unknown_tags_fall_back_to_the_current_frame(spark):
    fitted = pricing.tag_median_prices(tagged(spark, [(1, ["A"], 10.0)]))
    rows = tagged(spark, [(1, ["Z"], 30.0), (2, ["A", "Z"], 50.0), (3, [], 70.0), (4, None, 90.0)])
    got = {r.game_id: r.competitor_pricing for r in pricing.competitor_price(rows, fitted).collect()}
    assert got == {1: 60.0, 2: 10.0, 3: 60.0, 4: 60.0}


def test_vocabulary_and_multi_hot(spark):
    df = tagged(spark, [(1, ["B", "A", "A"], 1.0), (2, ["C"], 1.0)])
    vocab = encoding.vocabulary(df, "tags")
    items = encoding.vocabulary_items(vocab)
    assert items == ["A", "B", "C"]
    rows = tagged(spark, [(1, ["A", "A", "X"], 1.0), (2, [], 1.0)])
    assert [r[0] for r in rows.select(encoding.multi_hot("tags", items)).collect()] == [[1, 0, 0], [0, 0, 0]]
    assert rows.select("tags").count() == encoding.multi_hot_wide(rows, "tags", items).count()
    assert [(r.game_id, r.item) for r in encoding.multi_hot_long(rows, "game_id", "tags", vocab).collect()] == [(1, "A")]
    assert [(r.item, r.n_rows) for r in pricing.unseen_items(rows, "tags", vocab).collect()] == [("X", 1)]
    kept = pricing.restrict_to_vocabulary(rows, "tags", vocab).orderBy("game_id").collect()
    assert [r.tags for r in kept] == [["A", "A"], []]
    with pytest.raises(ValueError):
        encoding.vocabulary_items(vocab, limit=2)


def test_scaler(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "a double, b double")
    scaled = encoding.standard_scale(df, encoding.scaler_stats(df, ["a", "b"]), ["a", "b"])
    row = scaled.agg(F.avg("a"), F.stddev_pop("a"), F.max("b")).first()
    assert row[0] == pytest.approx(0) and row[1] == pytest.approx(1) and row[2] == 0


def test_split_is_disjoint_and_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "game_id")
    known, held = encoding.split(df)
    assert known.join(held, "game_id").count() == 0 and known.count() + held.count() == 2000
    assert 330 < held.count() < 470
    assert {r[0] for r in held.collect()} == {r[0] for r in encoding.split(df.repartition(5))[1].collect()}


REVIEWS = ["quiet puzzle, fair price", "crashes at sunset", "fair music", "", "quiet quiet evenings and fair music for everyone", "crashes crashes and dull music"]


def text_frame(spark):
    return spark.createDataFrame(list(enumerate(REVIEWS)), "game_id bigint, review string")


def dense_tfidf():
    import re

    docs = [re.findall(r"\b\w\w+\b", t.lower()) for t in REVIEWS]
    terms = sorted({t for d in docs for t in d})
    tf = np.array([[d.count(t) for t in terms] for d in docs], float)
    idf = np.log((1 + len(docs)) / (1 + (tf > 0).sum(0))) + 1
    x = tf * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


@pytest.mark.parametrize("extra", [0, 7])
def test_review_score_is_the_first_singular_direction(spark, extra):
    df = text_frame(spark)
    state = tfidf.fit_review_score(df, steps=200, tolerance=1e-12, extra=extra)
    got = {r.game_id: r.review_score for r in tfidf.add_review_score(df, df, state).collect()}
    x = dense_tfidf()
    v = np.linalg.svd(x)[2][0]
    wanted = x @ (v * np.sign(v.sum()))
    assert [got[i] for i in range(6)] == pytest.approx(list(wanted), abs=1e-6)
    assert got[3] == 0


def test_texts_spread_over_rows_score_like_joined_texts(spark):
    whole = text_frame(spark)
    split_up = whole.select("game_id", F.explode(F.split("review", " ")).alias("review"))
    a, b = (
        {r.term: round(r.direction, 9) for r in tfidf.fit_review_score(t, copies=tfidf.document_copies(whole, "game_id")).collect()}
        for t in (whole, split_up)
    )
    assert a == b


def test_weights_have_length_one(spark):
    df = text_frame(spark)
    terms, counts = tfidf.fit_vocabulary(df, "game_id", "review", tfidf.document_copies(df, "game_id"))
    rows = tfidf.weigh(counts, terms, "game_id").groupBy("game_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert [r.s for r in rows] == pytest.approx([1.0] * 5)


def test_repeated_listings_count_as_documents(spark):
    df = text_frame(spark)
    copies = tfidf.document_copies(df.unionAll(df.where("game_id = 0")), "game_id")
    terms = {r.term: r for r in tfidf.fit_review_score(df, copies=copies).collect()}
    assert (terms["quiet"].df, terms["quiet"].tf) == (3, 4)
    assert terms["quiet"].idf == pytest.approx(math.log(8 / 4) + 1)


def combined_rows(spark, n=300):
    rows = [
        (g, 10 + g % 7, 40 + g % 50, "A, B" if g % 2 else "C", f"t{g % 5};t{g % 3}", f"${20 + g % 9}.00",
         f"${10 + g % 9 + (g % 2) * 3}.00", 100.0 + g, g % 400, f"word{g % 4} good game number{g % 3}")
        for g in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "game_id bigint, total_reviews bigint, positive_percent int, genres string, tags string, current_price string, "
        "discounted_price string, owners_log_mean double, days_after_publish int, review string",
    )


@pytest.fixture(scope="module")
def trained(spark):
    frame, state = features.training_frame(combined_rows(spark), fit_on="train", max_terms=50)
    fitted = features.vectorizer(encoding.split(frame)[0], state)
    known, held = encoding.split(fitted.transform(frame))
    return frame, state, fitted, known.cache(), held.cache()


def test_state_round_trip_and_scoring(spark, trained, tmp_path):
    frame, state, fitted, known, _ = trained
    state.save(str(tmp_path / "state"))
    back = features.FeatureState.load(spark, str(tmp_path / "state"))
    again = features.add_features(features.clean_frame(features.listing_rows(combined_rows(spark))), features.review_texts(combined_rows(spark)), back)
    model = train.fit_model(known, train.Trial("RandomForest", {"trees": 5, "depth": 4}))
    one = {r[0]: r[1] for r in train.score(frame, fitted, model).collect()}
    two = {r[0]: r[1] for r in train.score(again, fitted, model).collect()}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)


def test_every_family_beats_the_mean(trained):
    _, _, _, known, held = trained
    guess = evaluation.regression_metrics(evaluation.group_mean_baseline(known, held, "discount_pct", []), "discount_pct", "prediction").first().mae
    trials = [
        train.Trial("RandomForest", {"trees": 20, "depth": 8}), train.Trial("GBT", {"trees": 15, "depth": 4, "leaves": 20}),
        train.Trial("ExtraTrees", {"trees": 20, "depth": 8}), train.Trial("LinearSVR", {"epsilon": 0.001, "c": 10.0}),
    ]
    runs = train.run_trials(known, held, trials)
    assert {r.model_type for r in runs.collect()} == set(train.FAMILIES)
    assert {r.model_type: r.mae for r in runs.collect() if r.mae >= guess} == {}
    model, row = train.finalize(known, held, runs)
    assert row.first().mae == pytest.approx(evaluation.best_trial(runs).first().mae)
    registry = runs.limit(0).selectExpr("run_id AS name", "1 AS version", "rmse", "mae")
    first = train.evaluate_and_record(model, held, registry, "m")
    assert [r.version for r in train.evaluate_and_record(model, held, first, "m").orderBy("version").collect()] == [1, 2]


def test_linear_svr_model_round_trip(spark, trained, tmp_path):
    _, _, _, known, held = trained
    model = train.fit_linear_svr(known)
    train.save_model(model, str(tmp_path / "svr"), spark)
    assert train.load_model(str(tmp_path / "svr"), "LinearSVR", spark).weights == model.weights


def test_trials_cover_the_families_within_their_ranges():
    trials = train.sample_trials(20)
    assert {t.family for t in trials[:4]} == set(train.FAMILIES)
    for t in trials:
        for name, value in t.params.items():
            low, high, _ = train.SEARCH_SPACE[t.family][name]
            assert low <= value <= high


def test_estimators_in_a_pipeline(spark, tmp_path):
    df = spark.createDataFrame([(i, ["A"], float(i), REVIEWS[i]) for i in range(6)], "game_id bigint, tags array<string>, current_price double, review string")
    model = Pipeline(stages=[ReviewScore(), CompetitorPricing(), DropColumns("review", "absent")]).fit(df)
    out = model.transform(df)
    assert out.columns == ["game_id", "tags", "current_price", "review_score", "competitor_pricing"]
    assert out.where("review_score IS NULL OR competitor_pricing IS NULL").count() == 0
    scorer, pricer = model.stages[0], model.stages[1]
    scorer.save_state(str(tmp_path / "a"))
    pricer.save_state(str(tmp_path / "b"))
    same = CompetitorPricingModel.load_state(spark, str(tmp_path / "b")).transform(ReviewScoreModel.load_state(spark, str(tmp_path / "a")).transform(df))
    assert sorted(r.review_score for r in same.collect()) == pytest.approx(sorted(r.review_score for r in out.collect()))


def test_estimators_are_stored_by_the_pipeline(spark, tmp_path):
    df = spark.createDataFrame([(i % 5, ["A", "B"][: i % 3], float(i), REVIEWS[i % 5]) for i in range(12)], "game_id bigint, tags array<string>, current_price double, review string")
    pipeline = Pipeline(stages=[ReviewScore(max_features=50), CompetitorPricing(outputCol="others"), DropColumns("review", "absent")])
    pipeline.write().save(str(tmp_path / "unfitted"))
    model = Pipeline.load(str(tmp_path / "unfitted")).fit(df)
    model.write().save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    assert [s.uid for s in again.stages] == [s.uid for s in model.stages] and again.stages[1].getOutputCol() == "others"
    one, two = (sorted(map(str, m.transform(df).collect())) for m in (model, again))
    assert one == two and "others" in model.transform(df).columns


def test_copies_of_a_listing_count_in_the_fitted_score(spark):
    rows = [(1, REVIEWS[0]), (2, REVIEWS[1]), (3, REVIEWS[4])]
    once, thrice = (spark.createDataFrame(rows + [rows[2]] * n, "game_id bigint, review string") for n in (0, 2))
    states = [{r.term: r for r in ReviewScore().fit(df).state.collect()} for df in (once, thrice)]
    assert (states[0]["quiet"].tf, states[0]["quiet"].df) == (3, 2) and (states[1]["quiet"].tf, states[1]["quiet"].df) == (7, 4)
    assert states[1]["quiet"].direction > states[0]["quiet"].direction


@pytest.mark.parametrize("family,params", [("LinearSVR", {}), ("ExtraTrees", {"trees": 5, "depth": 4}), ("RandomForest", {"trees": 5, "depth": 4})])
def test_one_saved_pipeline_scores_raw_rows(spark, trained, tmp_path, family, params):
    _, state, fitted, known, _ = trained
    model = train.fit_model(known, train.Trial(family, params))
    raw = combined_rows(spark)
    scoring_pipeline(state, fitted, family, model).write().save(str(tmp_path / "p"))
    got = {r.game_id: r.prediction for r in PipelineModel.load(str(tmp_path / "p")).transform(raw).collect()}
    ready = features.scoring_frame(features.listing_rows(raw), features.review_texts(raw), state)
    wanted = {r[0]: r[1] for r in train.score(ready, fitted, model).collect()}
    assert got.keys() == wanted.keys() and all(got[k] == pytest.approx(wanted[k]) for k in got)


def test_monitoring_frame_has_no_gaps(spark, trained):
    _, state, *_ = trained
    frame = features.monitoring_frame(combined_rows(spark), features.review_texts(combined_rows(spark)), state, wide=True)
    assert {"A", "B", "C", "t0", "discounted_price"} <= set(frame.columns)
    assert frame.count() == 300 and frame.na.drop().count() == 300


def test_items_that_differ_by_case_only(spark):
    words = lambda *items: spark.createDataFrame([(i,) for i in items], "item string")
    state = features.FeatureState(words("Action", "a.b"), words("Action", "ACTION", "tags", "Review_Score", "q`r"), None, None)
    assert features.item_columns(state) == [
        ("Action", "genres", "Action"), ("a.b", "genres", "a.b"), ("ACTION (tags)", "tags", "ACTION"),
        ("Review_Score (tags)", "tags", "Review_Score"), ("q`r", "tags", "q`r"), ("tags (tags)", "tags", "tags"),
    ]
    rows = [(d, ["Action"] if d < 40 else ["a.b"], ["q`r"]) for d in range(-5, 80)]
    df = spark.createDataFrame(rows, "days_after_publish int, genres array<string>, tags array<string>")
    flags = [(i, features.item_flag(c, i)) for _, c, i in features.item_columns(state)]
    got = {(r.bucket, r.column_name): r for r in monitor.wide_column_drift(df, flags, batch_days=40, last_day=39).collect()}
    assert len(got) == 12 and {k for k, r in got.items() if r.drifted} == {(1, "Action"), (1, "a.b")}


def test_missing_features_are_named(spark):
    with pytest.raises(ValueError, match="b, c"):
        cleaning.require_columns(spark.range(1).withColumnRenamed("id", "a"), ["a", "b", "c"])


def test_linear_fit_raises_without_convergence(spark):
    rows = [(float(i % 7), float(i % 5), (i % 7) / 10 + (i % 5) / 20) for i in range(70)]
    df = train.as_vectors(spark.createDataFrame(rows, "a double, b double, discount_pct double"), ["a", "b"])
    with pytest.raises(RuntimeError):
        train.fit_linear_svr(df, steps=1)
    model = train.fit_linear_svr(df, epsilon=0.0, c=1000.0)
    assert max(abs(r.discount_pct - r.prediction) for r in model.transform(df).collect()) < 0.02


def test_trials_record_what_is_fitted():
    drawn = train.sample_trials(40)
    assert all(t.params.get("depth", 5) <= train.MAX_DEPTH and t == train.used(t) for t in drawn)
    assert train.used(train.Trial("GBT", {"depth": 9, "leaves": 20})).params == {"depth": 5}
    with pytest.raises(ValueError):
        train.used(train.Trial("RandomForest", {"depth": 40}))


@pytest.mark.parametrize("name", ["run_trials", "final_model"])
def test_search_queries_try_twenty_draws(monkeypatch, name):
    """Draws of every family from inside the search ranges, not fixed settings."""
    from checks import q_models

    tried = []
    monkeypatch.setattr(q_models, "vectors", lambda spark, sf: (None, None, None, None))
    monkeypatch.setattr(train, "run_trials", lambda known, held, trials: tried.extend(trials))
    monkeypatch.setattr(train, "finalize", lambda known, held, runs: (None, None))
    getattr(q_models, name)(None, None)
    assert tried == train.sample_trials(20) and {t.family for t in tried} == set(train.FAMILIES)

"""The leading direction with its certificate, and sentiment by either lexicon path."""

import numpy as np
import pytest

from shelfwise.operators import tfidf
from shelfwise.functions.text import words

VECTORS = "key long, copies long, idx array<int>, weight array<double>"


def diagonal(spark, values):
    return spark.createDataFrame([(i, int(c), [i], [1.0]) for i, c in enumerate(values)], VECTORS)


def test_values_close_together(spark):
    values = [100_000 - 3 * i for i in range(40)]
    df = diagonal(spark, values)
    exact = tfidf.principal_direction(df, 40)
    assert exact == pytest.approx(np.eye(40)[0], abs=1e-6)
    rough = tfidf.principal_direction(df, 40, steps=12, tolerance=None)
    assert np.abs(rough - np.eye(40)[0]).max() > 0.01  # where a fixed number of steps is wrong
    with pytest.raises(tfidf.Unconverged):
        tfidf.principal_direction(df, 40, steps=2)


def test_equal_values_take_the_direction_nearest_to_equal_weights(spark):
    got = tfidf.principal_direction(diagonal(spark, [7, 7, 7, 2, 1]), 5)
    assert got == pytest.approx(np.array([1, 1, 1, 0, 0]) / np.sqrt(3), abs=1e-7)


def test_equals_the_full_decomposition(spark):
    r = np.random.default_rng(4)
    x = np.where(r.random((300, 60)) < 0.1, r.random((300, 60)), 0.0)
    x[:, 0] += 0.01
    rows = [(i, 1 + i % 3, [int(j) for j in np.flatnonzero(a)], [float(v) for v in a[a > 0]]) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    wanted = np.linalg.svd(x * np.sqrt(1 + np.arange(300) % 3)[:, None])[2][0]
    for extra in (0, 7):
        got = tfidf.principal_direction(df, 60, extra=extra)
        assert got == pytest.approx(wanted * np.sign(wanted.sum()), abs=1e-6)


def test_no_weights_give_zeros(spark):
    df = spark.createDataFrame([(1, 1, [0], [0.0])], VECTORS)
    assert tfidf.principal_direction(df, 3).tolist() == [0.0, 0.0, 0.0]


@pytest.mark.parametrize("rows", [1 << 17, 0])
def test_sentiment_by_both_paths(spark, monkeypatch, rows):
    monkeypatch.setattr(tfidf, "LEXICON_ROWS", rows)
    texts = [(1, "good good bad thing"), (1, "other"), (2, None), (3, ""), (None, "bad"), (4, "unknown words only"), (5, "odd good")]
    texts += [(6, "good " * 2000)]
    weights = {"good": 1.0, "bad": -0.5, "odd": None}
    reviews = spark.createDataFrame(texts, "game_id long, review string")
    lexicon = spark.createDataFrame(list(weights.items()), "term string, weight double")
    got = {r[0]: r[1] for r in tfidf.lexicon_sentiment(reviews, lexicon, "game_id", "review").collect()}
    said = spark.createDataFrame(texts, "game_id long, review string").select("game_id", words("review").alias("w")).collect()
    wanted = {}
    for r in said:
        wanted.setdefault(r.game_id, []).extend(weights[w] for w in r.w or [] if weights.get(w) is not None)
    assert got == pytest.approx({k: sum(v) / len(v) if v else 0.0 for k, v in wanted.items()})

"""Drift statistics: invariants, brute force and edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import cleaning, drift, synthetic
from shelfwise.plans import monitor


def column(spark, values, name="x", kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def stats(spark, ref, cur):
    return drift.numeric_drift(column(spark, ref), column(spark, cur), ["x"]).first()


def test_a_sample_against_itself(spark):
    values = [float(v) for v in np.random.default_rng(0).normal(size=300)]
    row = stats(spark, values, values)
    assert (row.ks_distance, row.wasserstein, row.js_distance, row.drifted) == (0, 0, 0, False)


def test_shift_moves_wasserstein_by_the_shift(spark):
    values = [float(v) for v in np.random.default_rng(0).normal(size=300)]
    row = stats(spark, values, [v + 2.5 for v in values])
    assert row.wasserstein == pytest.approx(2.5 / np.std(values))
    assert row.test == "ks" and row.drifted


def test_ks_matches_brute_force(spark):
    draw = np.random.default_rng(3)
    ref, cur = draw.normal(size=200).round(1), draw.normal(0.4, 1, size=150).round(1)
    grid = np.union1d(ref, cur)
    wanted = max(abs((ref <= g).mean() - (cur <= g).mean()) for g in grid)
    assert stats(spark, ref.tolist(), cur.tolist()).ks_distance == pytest.approx(wanted)


def test_choice_of_test(spark):
    two, few = [0.0, 1.0] * 50, [0.0, 1.0, 2.0, 3.0] * 25
    many = [float(i) for i in range(100)]
    assert [stats(spark, v, v).test for v in (two, few, many)] == ["z", "chi_square", "ks"]
    assert [stats(spark, v * 20, v).test for v in (two, few, many)] == ["js", "js", "wasserstein"]


def test_proportion_and_category_scores(spark):
    row = stats(spark, [0.0] * 50 + [1.0] * 50, [0.0] * 20 + [1.0] * 80)
    pooled = 130 / 200
    assert row.z_score == pytest.approx((0.5 - 0.8) / np.sqrt(pooled * (1 - pooled) * 2 / 100))
    assert row.drifted
    row = stats(spark, [0.0, 1.0, 2.0] * 20, [0.0] * 30 + [1.0] * 20 + [2.0] * 10)
    assert row.chi_square == pytest.approx((10**2 + 0 + 10**2) / 20)
    unseen = stats(spark, [0.0, 1.0, 2.0] * 20, [0.0, 1.0, 2.0] * 20 + [9.0])
    assert unseen.new_values == 1 and unseen.drifted


def test_disjoint_categories_have_distance_one(spark):
    row = drift.category_drift(column(spark, ["a"] * 5, kind="string"), column(spark, ["b"] * 4, kind="string"), ["x"]).first()
    assert row.js_distance == pytest.approx(1.0)


def test_buckets_stop_at_the_first_gap(spark):
    df = column(spark, [-1, 0, 1, 3], "bucket", "bigint")
    assert sorted(r[0] for r in drift.contiguous_buckets(df).collect()) == [0, 1]
    assert drift.bucket_list(df) == [0, 1]
    late = column(spark, [1, 2], "bucket", "bigint")
    assert drift.contiguous_buckets(late).count() == 0 and drift.bucket_list(late) == []


def days(spark, n=400):
    rows = [(i, i % 20, float(i % 37), 40 + i % 50, float(i % 13) / 13 + (i % 20) / 10, 1) for i in range(n)]
    return spark.createDataFrame(
        rows, "game_id bigint, days_after_publish int, current_price double, positive_percent int, prediction double, same int"
    )


def test_replay_gives_one_row_per_batch(spark):
    rows = days(spark).where("days_after_publish NOT BETWEEN 10 AND 14")
    out = monitor.replay(rows, rows, ["current_price", "positive_percent", "same"])
    got = {r.bucket: r for r in out.collect()}
    assert set(got) == {0, 1}
    assert got[0].num_drifted_columns <= 2 and got[1].prediction_drift_detected
    table = monitor.metric_rows(out, "2025-01-01 00:00:00")
    assert monitor.latest_metric(table, "mean_abs_corr").first().time.minute == 1
    assert [r.time.minute for r in monitor.metric_series(table, "prediction_drift").collect()] == [0, 1]


def test_replay_without_young_rows_uses_the_first_hundred(spark):
    rows = days(spark).withColumn("days_after_publish", F.col("days_after_publish") + 6)
    assert cleaning.reference_slice(rows, "days_after_publish", 5, "game_id").count() == 100


def test_constant_column_is_left_out(spark):
    rows = days(spark)
    assert cleaning.non_constant_columns(rows, rows, ["current_price", "same"]) == ["current_price"]
    holes = rows.withColumn("same", F.when(F.col("game_id") > 3, F.col("same")))
    assert cleaning.non_constant_columns(holes, holes, ["same"]) == ["same"]
    corr = drift.correlations(rows, "current_price", ["positive_percent", "same"]).collect()
    assert [r.correlation is None for r in sorted(corr, key=lambda r: r.column_name)] == [False, True]


def test_mean_abs_corr_is_the_matrix_mean(spark):
    pdf = days(spark).toPandas()[["current_price", "positive_percent", "prediction"]]
    matrix = pdf.corr().abs().to_numpy()
    np.fill_diagonal(matrix, 0)
    got = days(spark).agg(drift.mean_abs_corr(list(pdf.columns))).first()[0]
    assert got == pytest.approx(matrix.mean())


def test_synthetic_batches(spark):
    rows = days(spark).selectExpr(
        "game_id", "days_after_publish", "concat('$', current_price) AS current_price", "'A' AS tags", "positive_percent",
        "CAST(NULL AS STRING) AS review",
    )
    out = synthetic.synthesize_drift(rows).toPandas()
    assert out.groupby("days_after_publish").size().to_dict() == {d: 5 for d in range(6)}
    assert (out["tags"] == "A;Experimental").all() and (out["positive_percent"] >= 40).all()
    assert out["review"].str.startswith(" Some recent").all()
    few = synthetic.synthesize_drift(rows.where("game_id IN (7, 8)"))
    assert few.count() == 30


def test_duplicate_column_names(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    both = left.join(left.withColumnRenamed("v", "w"), left.k == left.k)
    out = cleaning.first_of_duplicate_columns(both)
    assert out.columns == ["k", "v", "w"]
    assert cleaning.common_columns(left, both, ("k",)) == ["v"]

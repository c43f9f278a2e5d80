"""How the trials of a search are run; their results are tested with the families."""

import threading

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfwise.plans import train
from shelfwise.plans.svr import Unfinished
from shelfwise.plans.train import Trial
from shelfwise.schemas import RUNS


def vectors(spark, n):
    x = F.array(F.col("id") * 0.5, (F.col("id") % 3).cast("double"))
    return spark.range(n).coalesce(1).select(array_to_vector(x).alias("features"), (F.col("id") % 7 / 10).alias("discount_pct"))


def parts(df):
    return df.rdd.glom().map(lambda rows: [(float(r.features[0]), r.discount_pct) for r in rows]).collect()


def test_many_rows_are_spread_evenly_and_again_alike(spark):
    df, cores = vectors(spark, 5 * train.ROWS_A_TASK), spark.sparkContext.defaultParallelism
    one, two = parts(train.spread(df, "a")), parts(train.spread(df, "b"))
    assert len(one) == min(cores, 5) and one == two
    assert max(map(len, one)) < 1.1 * min(map(len, one)) + 10
    assert sorted(r for p in one for r in p) == sorted(r for p in parts(df) for r in p)


def test_few_rows_stay_as_they_are(spark):
    df = vectors(spark, 100)
    assert parts(train.spread(df, "a")) == parts(df)
    assert train.spread(df.limit(0), "a").count() == 0


def test_large_trials_begin_first_and_are_listed_in_order(spark, monkeypatch):
    begun, df = [], vectors(spark, 50)

    def fit(rows, trial, label):
        begun.append((trial, rows.rdd.getNumPartitions()))
        raise Unfinished(0.5, 1)

    monkeypatch.setattr(train, "fit_model", fit)
    monkeypatch.setattr(train, "ROWS_A_TASK", 10, raising=False)
    trials = [Trial("LinearSVR", {"c": 1.0}), Trial("GBT", {"trees": 50, "depth": 3}), Trial("RandomForest", {"trees": 500, "depth": 9}), Trial("GBT", {"trees": 90, "depth": 3})]
    runs = train.run_trials(df, df, trials, parallelism=1).collect()
    assert [t for t, _ in begun] == [trials[i] for i in (2, 3, 1, 0)]
    assert {n for _, n in begun} == {min(5, spark.sparkContext.defaultParallelism)}
    assert [(r.run_id, r.model_type) for r in runs] == [(f"trial-{i:04d}", t.family) for i, t in enumerate(trials)]
    assert all(np.isclose(float(r.params["unfinished_gap"]), 0.5) and r.rmse is None for r in runs)


def test_the_refit_is_spread_too(spark, monkeypatch):
    begun, df = [], vectors(spark, 50)

    def fit(rows, trial, label):
        begun.append((trial.family, rows.rdd.getNumPartitions(), rows.count()))
        raise Unfinished(0.5, 1)

    monkeypatch.setattr(train, "fit_model", fit)
    monkeypatch.setattr(train, "ROWS_A_TASK", 10, raising=False)
    runs = spark.createDataFrame([("a", "b", "GBT", {"trees": "5"}, 1.0, 1.0, 1.0)], RUNS)
    with pytest.raises(Unfinished):
        train.finalize(df, df, runs)
    assert begun == [("GBT", min(5, spark.sparkContext.defaultParallelism), 50)]


def test_chained_trials_overlap_on_fewer_parts_after_the_forests(spark, monkeypatch):
    """Five parts of ten rows; boosting reads two of them as one, and no row is lost."""
    begun, df, cores = [], vectors(spark, 50), spark.sparkContext.defaultParallelism
    if cores < 5:
        pytest.skip("the parts follow the cores")
    together = threading.Barrier(5)

    def fit(rows, trial, label):
        begun.append((trial.family, rows.rdd.getNumPartitions(), rows.count()))
        if trial.family == "GBT":
            together.wait(20)
        raise Unfinished(0.5, 1)

    monkeypatch.setattr(train, "fit_model", fit)
    monkeypatch.setattr(train, "ROWS_A_TASK", 10)
    monkeypatch.setattr(train, "ROWS_A_ROUND", 25, raising=False)
    boosted = [Trial("GBT", {"trees": 500, "depth": d}) for d in range(20, 25)]
    runs = train.run_trials(df, df, [*boosted, Trial("ExtraTrees", {"trees": 5, "depth": 2})], parallelism=2).collect()
    assert begun[0] == ("ExtraTrees", 5, 50) and sorted(begun[1:]) == [("GBT", 2, 50)] * 5
    assert [r.model_type for r in runs] == ["GBT"] * 5 + ["ExtraTrees"]


def test_trials_over_few_parts_share_the_cores(spark):
    df, cores = vectors(spark, 50), spark.sparkContext.defaultParallelism
    assert train.at_once(2, df) == 2 * cores and train.at_once(1, df) == 1
    assert train.at_once(2, df.repartition(cores)) == 2 and train.at_once(2, df.repartition(3 * cores)) == 2


def test_an_unknown_family_is_still_an_error(spark):
    df = vectors(spark, 50)
    with pytest.raises(ValueError):
        train.run_trials(df, df, [Trial("Ridge")])

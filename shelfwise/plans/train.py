"""Regression models for the discount fraction: trials, refit, scoring, runs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.evaluation import best_run, best_trial, regression_metrics
from shelfwise.plans.extra_trees import ExtraTreesModel, fit_extra_trees
from shelfwise.plans.svr import ROUNDS, LinearSVRModel, Unfinished, fit_linear_svr
from shelfwise.schemas import RUNS, SEED
from shelfwise.session import materialize

# Model families and their search ranges (low, high, step or "log"). Depth ends
# at 30, where Spark's trees end; deeper draws would be fitted at 30 anyhow.
FAMILIES = ("RandomForest", "GBT", "ExtraTrees", "LinearSVR")
SEARCH_SPACE = {
    "RandomForest": {"trees": (50, 500, 25), "depth": (5, 30, 1), "min_split": (2, 20, 1)},
    "GBT": {"trees": (50, 500, 25), "depth": (3, 30, 1), "rate": (0.001, 0.3, "log"), "leaves": (20, 100, 1)},
    "ExtraTrees": {"trees": (50, 500, 25), "depth": (5, 30, 1), "min_split": (2, 20, 1)},
    "LinearSVR": {"epsilon": (1e-4, 0.1, "log"), "c": (0.01, 100.0, "log")},
}
FORESTS = ("RandomForest", "ExtraTrees")  # whose trees are grown side by side, by few large jobs
MAX_DEPTH = 30
ROWS_A_TASK = 1 << 13  # training rows that are worth a task
ROWS_A_ROUND = 1 << 17  # those that are worth a task of boosting, whose rounds are small jobs one after another


@dataclass(frozen=True)
class Trial:
    """A model family with its parameters."""

    family: str
    params: dict = field(default_factory=dict)


def used(trial: Trial) -> Trial:
    """The trial with the parameters that are fitted and recorded.

    Boosting grows by level, so a leaf limit is the depth that holds that many
    leaves. A minimum split of n becomes a minimum leaf of
    n/2 when a random forest is fitted. Depths beyond Spark's limit are refused.
    """
    p = dict(trial.params)
    if trial.family == "GBT" and "leaves" in p:
        p["depth"] = min(int(p.get("depth", MAX_DEPTH)), int(np.ceil(np.log2(p.pop("leaves")))))
    if p.get("depth", 0) > MAX_DEPTH:
        raise ValueError(f"depth {p['depth']} is beyond {MAX_DEPTH}")
    return Trial(trial.family, p)


def fit_model(train: DataFrame, trial: Trial, label: str = "discount_pct", seed: int = SEED):
    """Fit one family with the parameters of ``used(trial)``."""
    p = used(trial).params
    depth, leaf = int(p.get("depth", 5)), max(1, int(p.get("min_split", 2)) // 2)
    common = dict(featuresCol="features", labelCol=label, seed=seed)
    if trial.family == "RandomForest":
        return RandomForestRegressor(
            numTrees=int(p.get("trees", 100)), maxDepth=depth, minInstancesPerNode=leaf,
            featureSubsetStrategy="all", **common,
        ).fit(train)
    if trial.family == "ExtraTrees":
        return fit_extra_trees(train, int(p.get("trees", 100)), depth, int(p.get("min_split", 2)), label, seed)
    if trial.family == "GBT":
        return GBTRegressor(
            maxIter=int(p.get("trees", 100)), maxDepth=depth, stepSize=float(p.get("rate", 0.1)), **common
        ).fit(train)
    if trial.family == "LinearSVR":
        return fit_linear_svr(
            train, float(p.get("epsilon", 0.01)), float(p.get("c", 1.0)), int(p.get("steps", ROUNDS)), label
        )
    raise ValueError(trial.family)


def sample_trials(n: int, seed: int = SEED) -> list[Trial]:
    """``n`` seeded draws from the search ranges; the families take turns, so each is
    tried as soon as ``n`` reaches their number."""
    draw = np.random.default_rng(seed)

    def value(low, high, step):
        if step == "log":
            return float(np.exp(draw.uniform(np.log(low), np.log(high))))
        return int(low + step * draw.integers(0, (high - low) // step + 1))

    picks = [FAMILIES[i % len(FAMILIES)] for i in range(n)]
    return [used(Trial(f, {k: value(*r) for k, r in SEARCH_SPACE[f].items()})) for f in picks]


def run_row(spark: SparkSession, run_id: str, name: str, trial: Trial, scores: dict) -> DataFrame:
    params = {k: str(v) for k, v in used(trial).params.items()}
    row = (run_id, name, trial.family, params, scores["rmse"], scores["mae"], scores["mape"])
    return spark.createDataFrame([row], RUNS)


def spread(df: DataFrame, label: str) -> DataFrame:
    """The written rows, in even parts for all cores if they are many. A fit passes over them
    hundreds of times, so file sizes say little about its work. Reruns give the same parts."""
    rows = materialize(df, label)
    parts, cores = rows.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    even = min(cores * -(-parts // cores), -(-rows.count() // ROWS_A_TASK))
    if even <= parts:
        return rows
    return materialize(rows.repartition(even).sortWithinPartitions(F.xxhash64(*rows.columns)), label)


def at_once(parallelism: int, rows: DataFrame) -> int:
    """How many fits over ``rows`` overlap if ``parallelism`` of them do whose parts take all cores."""
    cores, parts = rows.sparkSession.sparkContext.defaultParallelism, max(1, rows.rdd.getNumPartitions())
    return max(parallelism, parallelism * cores // parts) if parallelism > 1 else 1


def run_trials(
    train: DataFrame, holdout: DataFrame, trials: list[Trial], label: str = "discount_pct", parallelism: int = 2,
    store: str | None = None,
) -> DataFrame:
    """Runs table with one row per trial. The vectors are written once and every
    trial reads them; trials overlap so that small stages do not leave the cluster idle, and those
    of many and deep trees begin first so that none of them runs alone at the end.

    ``parallelism`` trials share the cores if their rows have as many parts; with fewer parts more of them
    do, but none overlap if it is 1. Boosting and the linear fits, chains of small jobs, come after the
    forests, whose long tasks would hold up each of their jobs. Of many rows boosting reads fewer parts.

    A fit that does not finish is recorded without metrics, so it is never ranked, and with
    the gap it reached. With ``store`` every fitted model is saved in a folder of its run
    there, from which ``stored_model`` loads the best one without another fit.
    """
    columns = ["features", label]
    spark = train.sparkSession
    train, holdout = spread(train.select(*columns), "train"), materialize(holdout.select(*columns), "holdout")
    parts, rounds = train.rdd.getNumPartitions(), -(-train.count() // ROWS_A_ROUND)
    chained = train.coalesce(rounds) if 1 < rounds < parts and parallelism > 1 else train

    def attempt(numbered: tuple[int, Trial]) -> tuple:
        i, trial = numbered
        run, params = f"trial-{i:04d}", {k: str(v) for k, v in used(trial).params.items()}
        try:
            model = fit_model(chained if trial.family == "GBT" else train, trial, label)
        except Unfinished as e:
            return (run, f"search_{trial.family}", trial.family, {**params, "unfinished_gap": str(e.gap)}, None, None, None)
        if store:
            save_model(model, f"{store}/{run}", spark)
        s = regression_metrics(model.transform(holdout), label, "prediction").first()
        return (run, f"search_{trial.family}", trial.family, params, s.rmse, s.mae, s.mape)

    def size(i: int) -> int:
        p = used(trials[i]).params
        return int(p.get("trees", 0)) * int(p.get("depth", 0))

    order, done = sorted(range(len(trials)), key=size, reverse=True), {}
    for forests, shared in ((True, train), (False, chained)):
        turn = [i for i in order if (trials[i].family in FORESTS) is forests]
        with ThreadPoolExecutor(at_once(parallelism, shared)) as pool:
            done.update(zip(turn, pool.map(attempt, [(i, trials[i]) for i in turn])))
    rows = [done[i] for i in range(len(trials))]
    return spark.createDataFrame(rows, RUNS)


def stored_model(runs: DataFrame, store: str, metric: str = "rmse"):
    """(model, run): the run with the smallest metric and its model as ``run_trials`` stored it."""
    best = best_run(runs, metric).first()
    if best is None:
        raise ValueError(f"no run has {metric}")
    return load_model(f"{store}/{best.run_id}", best.model_type, runs.sparkSession), best


def finalize(train: DataFrame, holdout: DataFrame, runs: DataFrame, label: str = "discount_pct"):
    """(model, run row): refit the trial with the smallest MAE and evaluate it."""
    best = best_trial(runs).first()
    trial = Trial(best.model_type, {k: float(v) for k, v in best.params.items()})
    model = fit_model(spread(train.select("features", label), "refit"), trial, label)
    scores = regression_metrics(model.transform(holdout), label, "prediction").first().asDict()
    return model, run_row(train.sparkSession, "final", "final_model_run", trial, scores)


def save_model(model, path: str, spark: SparkSession) -> None:
    """Store any of the four families."""
    if isinstance(model, ExtraTreesModel):
        model.save(path, spark)
    elif isinstance(model, LinearSVRModel):
        weights = spark.createDataFrame([(model.weights,)], "weights array<double>")
        weights.write.mode("overwrite").parquet(path)
    else:
        PipelineModel(stages=[model]).write().overwrite().save(path)


def load_model(path: str, family: str, spark: SparkSession):
    if family == "LinearSVR":
        return LinearSVRModel(list(spark.read.parquet(path).first().weights))
    if family == "ExtraTrees":
        return ExtraTreesModel.load(path, spark)
    return PipelineModel.load(path)


def evaluate_and_record(model, holdout: DataFrame, registry: DataFrame, name: str, label: str = "discount_pct") -> DataFrame:
    """Registry rows plus the model's next version with its hold-out metrics.

    ``registry`` has name, version, rmse, mae.
    """
    scores = regression_metrics(model.transform(holdout), label, "prediction")
    last = registry.where(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0))).scalar()
    new = scores.select(F.lit(name).alias("name"), (last + 1).cast("int").alias("version"), "rmse", "mae")
    return registry.select("name", "version", "rmse", "mae").unionByName(new)


def score(rows: DataFrame, vectors: PipelineModel, model, key: str = "game_id") -> DataFrame:
    """Batch scoring: (key, predicted_discount_pct) of feature rows."""
    return model.transform(vectors.transform(rows)).select(key, F.col("prediction").alias("predicted_discount_pct"))


def as_vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    """Plain numeric columns as a feature vector."""
    return df.withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))

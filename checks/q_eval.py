"""Prediction quality, baselines and run selection over line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import d6, d_holdout, query, r6
from checks.views import view
from shelfwise.operators import encoding, evaluation

_GROUPS = {
    "flag": "l_returnflag",
    "flag_status": "l_returnflag || '-' || l_linestatus",
    "part": "cast(l_partkey AS string)",
    "overall": "'all'",
}
# Every model's group key per row, in long form.
LONG_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS run_id, l_orderkey, {expr} AS grp, y FROM predictions" for name, expr in _GROUPS.items()
)
SCORED_SQL = f"""
long AS ({LONG_SQL}), means AS (SELECT run_id, grp, avg(y) AS m FROM long WHERE NOT ({d_holdout('l_orderkey')}) GROUP BY run_id, grp),
scored AS (SELECT l.run_id, l.l_orderkey, l.y, coalesce(m, (SELECT avg(y) FROM predictions WHERE NOT ({d_holdout('l_orderkey')}))) AS prediction
  FROM long l LEFT JOIN means USING (run_id, grp) WHERE {d_holdout('l.l_orderkey')})
"""
_METRICS = """sqrt(avg((y - prediction) * (y - prediction))) AS rmse, avg(abs(y - prediction)) AS mae,
  100 * avg(CASE WHEN y <> 0 THEN abs((y - prediction) / y) END) AS mape"""
RUNS_SQL = f"{SCORED_SQL}, runs AS (SELECT run_id, {_METRICS} FROM scored GROUP BY run_id)"
_ROUNDED = ", ".join(f"round({m}, 6) + 0.0 AS {m}" for m in ("rmse", "mae", "mape"))


def scored(spark, sf):
    """Hold-out predictions of four group-mean models, all in one pass."""
    models = F.array(*[F.struct(F.lit(n).alias("run_id"), F.expr(e).alias("grp")) for n, e in _GROUPS.items()])
    long = view(spark, sf, "predictions").select("l_orderkey", "y", F.explode(models).alias("m")).select("l_orderkey", "y", "m.*")
    train, test = encoding.split(long, "l_orderkey")
    return evaluation.group_mean_baseline(train, test, "y", ["run_id", "grp"])


def runs(spark, sf):
    return evaluation.regression_metrics(scored(spark, sf), "y", "prediction", "run_id")


def rounded(df):
    return df.withColumns({m: r6(m) for m in ("rmse", "mae", "mape") if m in df.columns})


@query("regression_metrics", f"WITH {RUNS_SQL} SELECT run_id, {_ROUNDED} FROM runs", "predictions")
def regression_metrics(spark, sf):
    return rounded(runs(spark, sf))


@query(
    "mape_nonzero",
    f"WITH {SCORED_SQL} SELECT {d6('100 * avg(abs((y - prediction) / y))')} AS mape FROM scored WHERE run_id = 'flag' AND y <> 0",
    "predictions",
)
def mape_nonzero(spark, sf):
    train, test = encoding.split(view(spark, sf, "predictions"), "l_orderkey")
    done = evaluation.group_mean_baseline(train, test, "y", ["l_returnflag"])
    return rounded(evaluation.regression_metrics(done, "y", "prediction").select("mape"))


@query("group_mean_baseline", f"WITH {SCORED_SQL} SELECT run_id, l_orderkey, y, round(prediction, 9) + 0.0 AS prediction FROM scored", "predictions")
def group_mean_baseline(spark, sf):
    # Means of few two-decimal values end on a 5 in the seventh digit: compare nine.
    return scored(spark, sf).select("run_id", "l_orderkey", "y", F.round("prediction", 9).alias("prediction"))


@query(
    "leaderboard",
    f"WITH {RUNS_SQL} SELECT run_id, {_ROUNDED}, rank() OVER (ORDER BY rmse) AS position FROM runs ORDER BY runs.rmse LIMIT 100",
    "predictions",
)
def leaderboard(spark, sf):
    return rounded(evaluation.leaderboard(runs(spark, sf)))


@query("best_run", f"WITH {RUNS_SQL} SELECT run_id, {_ROUNDED} FROM runs ORDER BY runs.rmse, runs.run_id LIMIT 1", "predictions")
def best_run(spark, sf):
    return rounded(evaluation.best_run(runs(spark, sf)))


@query("best_trial", f"WITH {RUNS_SQL} SELECT run_id, {_ROUNDED} FROM runs ORDER BY runs.mae, runs.run_id LIMIT 1", "predictions")
def best_trial(spark, sf):
    return rounded(evaluation.best_trial(runs(spark, sf)))


@query(
    "runs_with_metric",
    f"""WITH {RUNS_SQL} SELECT run_id, round(rmse, 6) + 0.0 AS rmse FROM (SELECT run_id, CASE WHEN run_id = 'overall' THEN NULL ELSE rmse END AS rmse
    FROM runs) r WHERE rmse IS NOT NULL""",
    "predictions",
)
def runs_with_metric(spark, sf):
    holed = runs(spark, sf).withColumn("rmse", F.when(F.col("run_id") != "overall", F.col("rmse")))
    return evaluation.leaderboard(holed).select("run_id", r6("rmse").alias("rmse"))


@query(
    "ablation_compare",
    f"""WITH {RUNS_SQL} SELECT round(a.mae, 6) + 0.0 AS with_features, round(b.mae, 6) + 0.0 AS without_features,
    round((b.mae - a.mae) / b.mae, 6) + 0.0 AS gain FROM runs a, runs b WHERE a.run_id = 'part' AND b.run_id = 'overall'""",
    "predictions",
)
def ablation_compare(spark, sf):
    table = runs(spark, sf)
    gain = evaluation.improvement(table.where("run_id = 'part'"), table.where("run_id = 'overall'"))
    return gain.select(*[r6(c).alias(c) for c in gain.columns])

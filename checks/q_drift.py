"""Batch metrics and drift over dated events."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.q_listings import COMBINED_SQL, COMBINED_VIEWS, combined
from checks.registry import d6, d_hash, d_price, query, r6
from checks.views import table, view
from shelfwise.functions.scalars import bucket_of
from shelfwise.operators import cleaning, drift, synthetic
from shelfwise.plans import monitor, train
from shelfwise.session import fresh_path
from shelfwise.sources import tables

NUMERIC = ["current_price", "discounted_price", "positive_percent", "stars", "on_sale"]
TESTED = NUMERIC + ["prediction"]
BUCKET = "CAST(floor(days_after_publish / 5) AS BIGINT)"


def days(spark, sf):
    return view(spark, sf, "metric_days").withColumn("bucket", bucket_of("days_after_publish"))


def sides(spark, sf):
    rows = days(spark, sf)
    return cleaning.keep_below(rows, "days_after_publish", 5), rows


# Value counts of every column on both sides, batch by batch, in long form.
COUNTS_SQL = (
    f"m AS (SELECT *, {BUCKET} AS bucket FROM metric_days), "
    "refv AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, count(*) AS n FROM m WHERE days_after_publish <= 5 GROUP BY ALL" for c in TESTED
    ) + "), curv AS (" + " UNION ALL ".join(
        f"SELECT bucket, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, count(*) AS n FROM m GROUP BY ALL" for c in TESTED
    ) + """), counts AS (SELECT bucket, column_name, value, sum(r)::BIGINT AS n_ref, sum(c)::BIGINT AS n_cur FROM (
    SELECT b.bucket, column_name, value, n AS r, 0 AS c FROM refv, (SELECT DISTINCT bucket FROM m) b
    UNION ALL SELECT bucket, column_name, value, 0, n FROM curv) u GROUP BY ALL),
totals AS (SELECT bucket, column_name, sum(n_ref)::BIGINT AS ref_rows, sum(n_cur)::BIGINT AS cur_rows, count(*) AS n_distinct, max(value) AS top FROM counts GROUP BY ALL),
spread AS (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, stddev_pop(CAST({c} AS DOUBLE)) AS s FROM m WHERE days_after_publish <= 5" for c in TESTED
    ) + """),
ranked AS (SELECT *, sum(n_ref) OVER w AS f, sum(n_cur) OVER w AS g, lead(value) OVER w AS nxt FROM counts
  WINDOW w AS (PARTITION BY bucket, column_name ORDER BY value)),
shares AS (SELECT r.*, t.ref_rows, t.cur_rows, t.n_distinct, t.top, s.s, abs(f / t.ref_rows - g / t.cur_rows) AS gap,
  n_ref / t.ref_rows AS p, n_cur / t.cur_rows AS q, n_ref * t.cur_rows / t.ref_rows AS e
  FROM ranked r JOIN totals t USING (bucket, column_name) JOIN spread s USING (column_name)),
stats AS (SELECT bucket, column_name, ref_rows, cur_rows, n_distinct, max(gap) AS ks_distance,
  sum(gap * coalesce(nxt - value, 0)) / greatest(max(s), 0.001) AS wasserstein,
  sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END / 2 + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END / 2), 0)) AS js_distance,
  sum(CASE WHEN e > 0 THEN (n_cur - e) * (n_cur - e) / e END) AS chi_square,
  count(*) FILTER (n_ref = 0) AS new_values, sum(n_ref) FILTER (value = top) AS tr, sum(n_cur) FILTER (value = top) AS tc FROM shares GROUP BY ALL),
zed AS (SELECT *, (tr + tc) / (ref_rows + cur_rows) AS pool FROM stats),
zs AS (SELECT *, CASE WHEN pool * (1 - pool) > 0 THEN (tr / ref_rows - tc / cur_rows) / sqrt(pool * (1 - pool) * (1.0 / ref_rows + 1.0 / cur_rows)) END AS z_score FROM zed),
tested AS (SELECT *, CASE WHEN ref_rows <= 1000 AND n_distinct <= 2 THEN 'z' WHEN ref_rows <= 1000 AND n_distinct <= 5 THEN 'chi_square'
  WHEN ref_rows <= 1000 THEN 'ks' WHEN n_distinct <= 5 THEN 'js' ELSE 'wasserstein' END AS test FROM zs),
judged AS (SELECT *, CASE test WHEN 'z' THEN abs(z_score) WHEN 'chi_square' THEN chi_square WHEN 'js' THEN js_distance WHEN 'ks' THEN ks_distance ELSE wasserstein END AS score,
  CASE test WHEN 'z' THEN 1.959964 WHEN 'chi_square' THEN CASE n_distinct WHEN 2 THEN 3.841459 WHEN 3 THEN 5.991465 WHEN 4 THEN 7.814728 WHEN 5 THEN 9.487729 ELSE 3.841459 END
    WHEN 'ks' THEN 1.3581 * sqrt((ref_rows + cur_rows) / (ref_rows * cur_rows)) ELSE 0.1 END AS lim FROM tested),
drift AS (SELECT *, coalesce(CASE WHEN test IN ('js', 'wasserstein') THEN score >= lim ELSE score > lim END, false) OR (test = 'chi_square' AND new_values > 0) AS drifted FROM judged)"""
)


def column_drift(spark, sf, columns=TESTED):
    reference, current = sides(spark, sf)
    return drift.numeric_drift(reference, current, columns, "bucket")


def _measure(name: str, column: str):
    @query(name, f"WITH {COUNTS_SQL} SELECT bucket, column_name, {d6(column)} AS {column} FROM drift", "metric_days")
    def run(spark, sf):
        return column_drift(spark, sf).select("bucket", "column_name", r6(column).alias(column))


for _name, _column in (
    ("ks_distance", "ks_distance"), ("wasserstein", "wasserstein"), ("js_distance", "js_distance"),
    ("chi_square", "chi_square"), ("two_proportion_z", "z_score"),
):
    _measure(_name, _column)


@query(
    "column_drift",
    f"WITH {COUNTS_SQL} SELECT bucket, column_name, test, {d6('score')} AS score, {d6('lim')} AS limit_value, new_values, drifted FROM drift",
    "metric_days",
)
def column_drift_rows(spark, sf):
    rows = column_drift(spark, sf)
    return rows.select(
        "bucket", "column_name", "test", r6("score").alias("score"), r6("limit").alias("limit_value"), "new_values", "drifted"
    )


@query(
    "dataset_drift",
    f"""WITH {COUNTS_SQL} SELECT bucket, sum(CAST(drifted AS INT))::BIGINT AS num_drifted_columns,
    round(avg(CAST(drifted AS INT)), 6) + 0.0 AS share_drifted_columns, avg(CAST(drifted AS INT)) >= 0.5 AS dataset_drift
    FROM drift WHERE column_name <> 'prediction' GROUP BY bucket""",
    "metric_days",
)
def dataset_drift(spark, sf):
    return drift.dataset_drift(column_drift(spark, sf, NUMERIC)).withColumn(
        "share_drifted_columns", r6("share_drifted_columns")
    )


@query(
    "category_drift",
    f"""WITH m AS (SELECT *, {BUCKET} AS bucket FROM metric_days), n AS (SELECT bucket, count(*) AS cur_rows FROM m GROUP BY bucket),
    t AS (SELECT count(*) AS ref_rows FROM m WHERE days_after_publish <= 5), k AS (SELECT DISTINCT bucket, event_type FROM (SELECT b.bucket, event_type FROM m,
    (SELECT DISTINCT bucket FROM m) b WHERE days_after_publish <= 5 UNION ALL SELECT bucket, event_type FROM m) u),
    c AS (SELECT k.bucket, k.event_type, (SELECT count(*) FROM m WHERE days_after_publish <= 5 AND m.event_type = k.event_type) AS r,
    (SELECT count(*) FROM m WHERE m.bucket = k.bucket AND m.event_type = k.event_type) AS g FROM k),
    s AS (SELECT bucket, r / ref_rows AS p, g / cur_rows AS q, g, r * cur_rows / ref_rows AS e FROM c JOIN n USING (bucket), t)
    SELECT bucket, 'event_type' AS column_name, round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END / 2
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END / 2), 0)), 6) + 0.0 AS js_distance,
    round(sum(CASE WHEN e > 0 THEN (g - e) * (g - e) / e END), 6) + 0.0 AS chi_square FROM s GROUP BY bucket""",
    "metric_days",
)
def category_drift(spark, sf):
    reference, current = sides(spark, sf)
    rows = drift.category_drift(reference, current, ["event_type"], "bucket")
    return rows.select(
        "bucket", "column_name", r6("js_distance").alias("js_distance"), r6("chi_square").alias("chi_square")
    )


@query(
    "empirical_cdf",
    """WITH c AS (SELECT current_price, count(*) AS n FROM metric_days GROUP BY current_price)
    SELECT current_price, n, sum(n) OVER (ORDER BY current_price)::BIGINT AS cum_n, lead(current_price) OVER (ORDER BY current_price) AS next_current_price FROM c""",
    "metric_days",
)
def empirical_cdf(spark, sf):
    from shelfwise.operators.ranks import running_totals, value_counts

    counts = value_counts(view(spark, sf, "metric_days").withColumn("side", F.lit("cur")), ["side"], "current_price")
    return running_totals(counts, ["side"], "current_price", ["n"]).drop("side")


@query("median_price", f"SELECT {BUCKET} AS bucket, {d6('median(current_price)')} AS median_price FROM metric_days GROUP BY 1", "metric_days")
def median_price(spark, sf):
    from shelfwise.operators.ranks import exact_quantile

    return exact_quantile(days(spark, sf), ["bucket"], "current_price", name="median_price").withColumn(
        "median_price", r6("median_price")
    )


@query(
    "value_range",
    f"""WITH e AS (SELECT min(current_price) AS lo, max(current_price) AS hi FROM metric_days WHERE days_after_publish <= 5)
    SELECT {BUCKET} AS bucket, min(current_price) AS min_value, max(current_price) AS max_value, round(max(current_price) - min(current_price), 6) + 0.0 AS width,
    round(avg(CASE WHEN current_price BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS share_in_reference FROM metric_days, e GROUP BY 1""",
    "metric_days",
)
def value_range(spark, sf):
    reference, current = sides(spark, sf)
    rows = drift.value_range(reference, current, "current_price", "bucket")
    return rows.withColumns({c: r6(c) for c in ("width", "share_in_reference")})


_PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :]]


def _corr(a: str, b: str) -> str:
    return f"coalesce(abs(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)), 0)"


MEAN_CORR_SQL = f"2 * ({' + '.join(_corr(a, b) for a, b in _PAIRS)}) / {len(NUMERIC) ** 2}"


@query("mean_abs_corr", f"SELECT {BUCKET} AS bucket, {d6(MEAN_CORR_SQL)} AS mean_abs_corr FROM metric_days GROUP BY 1", "metric_days")
def mean_abs_corr(spark, sf):
    return days(spark, sf).groupBy("bucket").agg(r6(drift.mean_abs_corr(NUMERIC)).alias("mean_abs_corr"))


WIDE = 100


@query(
    "mean_abs_corr_wide",
    f"""WITH v AS (SELECT c_nationkey % 3 AS bucket, c_custkey AS r, j, ((c_custkey * (2 * j + 3)) % (11 + j))::DOUBLE AS x FROM customer, range({WIDE}) t(j)),
    p AS (SELECT a.bucket, covar_pop(a.x, b.x) / nullif(stddev_pop(a.x) * stddev_pop(b.x), 0) AS c FROM v a JOIN v b ON a.r = b.r AND a.bucket = b.bucket
      AND a.j < b.j GROUP BY a.bucket, a.j, b.j)
    SELECT bucket, {d6(f"2 * sum(coalesce(abs(c), 0)) / {WIDE**2}")} AS mean_abs_corr FROM p GROUP BY bucket""",
)
def mean_abs_corr_wide(spark, sf):
    """A hundred columns made from the customer keys."""
    columns = {f"x.{j}": ((F.col("c_custkey") * (2 * j + 3)) % (11 + j)).cast("double") for j in range(WIDE)}
    rows = view(spark, sf, "customer").select((F.col("c_nationkey") % 3).alias("bucket"), *[c.alias(n) for n, c in columns.items()])
    return drift.mean_abs_corr_by(rows, list(columns), "bucket").withColumn("mean_abs_corr", r6("mean_abs_corr"))


@query(
    "price_correlations",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(covar_pop(current_price, {c}) / nullif(stddev_pop(current_price) * stddev_pop({c}), 0), 6) + 0.0 AS correlation FROM metric_days"
        for c in [*NUMERIC[1:], "constant_one"]
    ),
    "metric_days",
)
def price_correlations(spark, sf):
    rows = drift.correlations(view(spark, sf, "metric_days"), "current_price", [*NUMERIC[1:], "constant_one"])
    return rows.withColumn("correlation", r6("correlation"))


@query(
    "missing_share",
    f"""SELECT {BUCKET} AS bucket, round((2 * count(*) - count(raw_value) - count(current_price)) / (2 * count(*)), 6) + 0.0 AS share_missing_values
    FROM metric_days GROUP BY 1""",
    "metric_days",
)
def missing_share(spark, sf):
    rows = drift.missing_share(days(spark, sf), ["raw_value", "current_price"], "bucket")
    return rows.withColumn("share_missing_values", r6("share_missing_values"))


@query("row_counts", f"SELECT {BUCKET} AS bucket, count(*) AS n_rows, count(*) = 0 AS is_empty FROM metric_days GROUP BY 1", "metric_days")
def row_counts(spark, sf):
    return days(spark, sf).groupBy("bucket").agg(F.count("*").alias("n_rows"), (F.count("*") == 0).alias("is_empty"))


@query(
    "contiguous_buckets",
    """SELECT bucket FROM (SELECT bucket, row_number() OVER (ORDER BY bucket) - 1 AS rn FROM (SELECT DISTINCT CAST(days_after_publish // 2 AS BIGINT) AS bucket
    FROM metric_days WHERE days_after_publish <> 12 AND days_after_publish <> 13) d) r WHERE rn = bucket""",
    "metric_days",
)
def contiguous_buckets(spark, sf):
    rows = view(spark, sf, "metric_days").where("days_after_publish NOT IN (12, 13)")
    return drift.contiguous_buckets(rows.select(bucket_of("days_after_publish", 2).alias("bucket")))


@query(
    "align_sides",
    """SELECT 'ref' AS side, event_id, stars, 0 AS extra FROM metric_days WHERE days_after_publish <= 5
    UNION ALL SELECT 'cur', event_id, stars, on_sale FROM metric_days WHERE days_after_publish > 5""",
    "metric_days",
)
def align_sides(spark, sf):
    rows = view(spark, sf, "metric_days")
    reference = cleaning.keep_below(rows, "days_after_publish", 5).select("event_id", "stars")
    current = cleaning.keep_above(rows, "days_after_publish", 5).withColumn("extra", F.col("on_sale"))
    return cleaning.align(reference, current, ["event_id", "stars", "extra"])


# The replay leaves out columns that are constant on either side (none here).
METRICS_SQL = f"""WITH {COUNTS_SQL}, plain AS (SELECT bucket, count(*) AS n_rows, CAST(max(positive_percent) - min(positive_percent) AS DOUBLE) AS positive_percent_range,
  {d6(MEAN_CORR_SQL)} AS mean_abs_corr, median(current_price) AS median_current_price,
  (5 * count(*) - {' - '.join(f'count({c})' for c in NUMERIC)}) / (5 * count(*)) AS share_missing_values FROM m GROUP BY bucket),
flags AS (SELECT bucket, sum(CAST(drifted AS INT))::BIGINT AS num_drifted_columns, avg(CAST(drifted AS INT)) AS share_drifted_columns FROM drift WHERE column_name <> 'prediction' GROUP BY bucket),
pred AS (SELECT bucket, score, drifted FROM drift WHERE column_name = 'prediction')"""


def replayed(spark, sf):
    rows = view(spark, sf, "metric_days")
    return monitor.replay(rows, rows, NUMERIC, order=("event_id",))


@query(
    "bucket_metrics",
    f"""{METRICS_SQL} SELECT bucket, n_rows, positive_percent_range, mean_abs_corr, {d6('median_current_price')} AS median_current_price,
    {d6('share_missing_values')} AS share_missing_values, num_drifted_columns, {d6('share_drifted_columns')} AS share_drifted_columns,
    share_drifted_columns >= 0.5 AS dataset_drift, {d6('score')} AS prediction_drift, drifted AS prediction_drift_detected
    FROM plain JOIN flags USING (bucket) JOIN pred USING (bucket)""",
    "metric_days",
)
def bucket_metrics(spark, sf):
    doubles = ("mean_abs_corr", "median_current_price", "share_missing_values", "share_drifted_columns", "prediction_drift")
    return replayed(spark, sf).withColumns({c: r6(c) for c in doubles})


ROWS_SQL = f"""{METRICS_SQL}, metrics AS (SELECT TIMESTAMP '2025-06-16 00:00:00' + bucket * INTERVAL 1 MINUTE AS timestamp, {d6('score')} AS prediction_drift, num_drifted_columns,
{d6('share_missing_values')} AS share_missing_values, positive_percent_range, {d6('median_current_price')} AS median_current_price, mean_abs_corr
FROM plain JOIN flags USING (bucket) JOIN pred USING (bucket))"""


def metric_table(spark, sf):
    rows = monitor.metric_rows(replayed(spark, sf), "2025-06-16 00:00:00")
    doubles = ("prediction_drift", "share_missing_values", "median_current_price", "mean_abs_corr")
    return rows.withColumns({c: r6(c) for c in doubles})


def plain_time(df, column):
    """Timestamps without a zone, as the oracle has them."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


_PREDICTED = "((0.25::DOUBLE + current_price * 0.004::DOUBLE) + positive_percent * -0.002::DOUBLE) + stars * 0.05::DOUBLE"
_SCORED = f"FROM (SELECT * REPLACE ({_PREDICTED} AS prediction) FROM metric_days)"


@query(
    "monitor_end_to_end",
    f"""{METRICS_SQL.replace('FROM metric_days', _SCORED, 1)}, metrics AS (SELECT TIMESTAMP '2025-06-16 00:00:00' + bucket * INTERVAL 1 MINUTE AS timestamp,
    {d6('score')} AS prediction_drift_score, drifted AS prediction_drift_detected, num_drifted_columns, {d6('share_drifted_columns')} AS share_drifted_columns,
    {d6('share_missing_values')} AS missing_values_share, positive_percent_range, {d6('median_current_price')} AS median_current_price,
    mean_abs_corr AS mean_abs_correlation FROM plain JOIN flags USING (bucket) JOIN pred USING (bucket))
    SELECT *, prediction_drift_score AS stored_drift, num_drifted_columns AS stored_columns FROM metrics""",
    "metric_days",
)
def monitor_end_to_end(spark, sf):
    """A saved model's predictions, replayed, stored as metric rows and as documents; both are read back."""
    path = fresh_path(spark, "monitoring")
    train.save_model(train.LinearSVRModel([0.004, -0.002, 0.05, 0.25]), f"{path}/model", spark)
    model = train.load_model(f"{path}/model", "LinearSVR", spark)
    rows = view(spark, sf, "metric_days")
    features = ["current_price", "positive_percent", "stars"]
    monitor.monitor_batches(rows, model, features, NUMERIC, path, "2025-06-16 00:00:00", order=("event_id",))
    stored = monitor.monitor_batches(rows, model, features, NUMERIC, path, "2025-06-16 00:00:00", order=("event_id",))
    fields = """num_drifted_columns long, share_drifted_columns double, missing_values_share double, prediction_drift_score double,
    prediction_drift_detected boolean, median_current_price double, positive_percent_range double, mean_abs_correlation double, timestamp timestamp"""
    documents = spark.read.schema(fields).json(f"{path}/documents")
    kept = stored.select("timestamp", F.col("prediction_drift").alias("stored_drift"), F.col("num_drifted_columns").alias("stored_columns"))
    both = documents.join(kept, "timestamp")
    doubles = ("prediction_drift_score", "share_drifted_columns", "missing_values_share", "median_current_price", "mean_abs_correlation", "stored_drift")
    return plain_time(both.withColumns({c: r6(c) for c in doubles}), "timestamp")


@query("append_metrics", f"{ROWS_SQL} SELECT * FROM metrics", "metric_days")
def append_metrics(spark, sf):
    path, rows = fresh_path(spark, "metrics"), metric_table(spark, sf)
    tables.append_metrics(rows.where("num_drifted_columns > 0"), path)
    return plain_time(tables.append_metrics(rows, path), "timestamp")


@query("metric_series", f"{ROWS_SQL} SELECT timestamp AS time, prediction_drift FROM metrics ORDER BY time", "metric_days")
def metric_series(spark, sf):
    return plain_time(monitor.metric_series(metric_table(spark, sf), "prediction_drift"), "time")


@query("latest_metric", f"{ROWS_SQL} SELECT timestamp AS time, num_drifted_columns AS value FROM metrics ORDER BY time DESC LIMIT 1", "metric_days")
def latest_metric(spark, sf):
    return plain_time(monitor.latest_metric(metric_table(spark, sf), "num_drifted_columns"), "time")


@query(
    "metrics_json",
    """SELECT '{"bucket":' || bucket || ',"n_rows":' || n || ',"timestamp":"2025-06-16T00:0' || bucket || ':00Z"}' AS document
    FROM (SELECT CAST(floor(days_after_publish / 5) AS BIGINT) AS bucket, count(*) AS n FROM metric_days GROUP BY 1) b""",
    "metric_days",
)
def metrics_json(spark, sf):
    path = fresh_path(spark, "metrics-json")
    rows = days(spark, sf).groupBy("bucket").agg(F.count("*").alias("n_rows"))
    at = F.timestamp_seconds(F.unix_timestamp(F.lit("2025-06-16 00:00:00").cast("timestamp")) + F.col("bucket") * 60)
    tables.write_metrics_json(rows.withColumn("timestamp", at), path)
    return spark.read.text(path).withColumnRenamed("value", "document")


_DRAW = "row_number() OVER (PARTITION BY day ORDER BY md5(event_id || '-' || (42 + day)), event_id)"


@query(
    "sample_per_day",
    f"SELECT day, event_id FROM (SELECT day, event_id, {_DRAW} AS rn FROM metric_days, (SELECT unnest(range(6))::INT AS day) d) s WHERE rn <= 5",
    "metric_days",
)
def sample_per_day(spark, sf):
    rows = view(spark, sf, "metric_days").select("event_id")
    return synthetic.sample_per_day(rows, "event_id").select("day", "event_id")


@query(
    "repeat_if_few",
    """SELECT event_id, CAST(copy_no AS INT) AS copy_no FROM (SELECT event_id FROM metric_days WHERE current_price >= (SELECT max(current_price) FROM metric_days)) f,
    (SELECT unnest(range(5)) AS copy_no) c UNION ALL SELECT event_id, 0 FROM metric_days WHERE stars = 3""",
    "metric_days",
)
def repeat_if_few(spark, sf):
    rows = view(spark, sf, "metric_days").select("event_id", "current_price", "stars")
    top = rows.agg(F.max("current_price")).scalar()
    few = synthetic.repeat_if_few(rows.where(F.col("current_price") >= top).select("event_id"))
    return few.unionByName(synthetic.repeat_if_few(rows.where("stars = 3").select("event_id")))


_TIE = "name, total_reviews, owners NULLS FIRST"


@query(
    "synthesize_drift",
    f"""WITH pool AS (SELECT * FROM ({COMBINED_SQL}) c WHERE days_after_publish > 5), dated AS (SELECT *, row_number() OVER (PARTITION BY day
    ORDER BY md5(game_id || '-' || (42 + day)), game_id, {_TIE}) AS rn FROM pool, (SELECT unnest(range(6))::INT AS day) d)
    SELECT game_id, name, day AS days_after_publish, printf('$%.2f', round({d_price('current_price')} * (1 + 0.1 * day), 2)) AS current_price,
    coalesce(tags, '') || ';Experimental' AS tags, CAST(greatest(positive_percent - (2 + {d_hash("game_id || '-' || day || '-0-42'")} % 3), 40) AS INT) AS positive_percent,
    coalesce(review, '') || ' Some recent issues make it less enjoyable.' AS review FROM dated WHERE rn <= 5""",
    *COMBINED_VIEWS,
)
def synthesize_drift(spark, sf):
    """A text that only the parts hold stays null; the remark alone would pass for all of it."""
    rows = combined(spark, sf).withColumn("in_parts", F.col("review").isNull())
    rows = synthetic.synthesize_drift(rows, tie=("name", "total_reviews", "owners"))
    review = F.when(~F.col("in_parts"), F.col("review")).alias("review")
    return rows.select("game_id", "name", "days_after_publish", "current_price", "tags", "positive_percent", review)


#: Suppliers against the customers of each market segment: a balance, the region, and whether in debt.
BALANCES = ["balance", "region", "in_debt"]
_ERFC = "list_reduce(list_concat([0.0::DOUBLE], list_reverse(range(1, 400))::DOUBLE[]), lambda c, k: k / 2.0 / ({x} + c))"
P_SQL = f"""
WITH r AS (SELECT s_acctbal AS balance, n_regionkey AS region, CAST(s_acctbal < 0 AS INT) AS in_debt FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS bucket, c_acctbal AS balance, n_regionkey AS region, CAST(c_acctbal < 0 AS INT) AS in_debt
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT DISTINCT bucket FROM g), nn AS (SELECT count(*) AS n FROM r), mm AS (SELECT bucket, count(*) AS m FROM g GROUP BY bucket),
v AS (SELECT bucket, balance AS x, 1 AS ref, 0 AS cur FROM r, b UNION ALL SELECT bucket, balance, 0, 1 FROM g),
w AS (SELECT bucket, x, sum(sum(ref)) OVER o AS cr, sum(sum(cur)) OVER o AS cc FROM v GROUP BY bucket, x WINDOW o AS (PARTITION BY bucket ORDER BY x)),
k AS (SELECT bucket, n, m, max(abs(cr * m - cc * n)) AS reach, max(abs(cr / n - cc / m)) AS d FROM w JOIN mm USING (bucket), nn GROUP BY bucket, n, m),
e AS (SELECT bucket, d, list_reduce(list_concat([list_transform(range(0, least(n, m) + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0 END)],
    list_transform(range(1, n + m + 1), lambda s: [s::DOUBLE])), lambda f, s: list_transform(range(0, least(n, m) + 1), lambda i:
      CASE WHEN s[1] - i BETWEEN 0 AND greatest(n, m) AND abs(i * greatest(n, m) - (s[1] - i) * least(n, m)) < reach
      THEN (CASE WHEN i > 0 THEN f[i] ELSE 0 END * i + f[i + 1] * (s[1] - i)) / s[1] ELSE 0.0 END))[-1] AS stay FROM k),
c AS (SELECT bucket, region, (SELECT count(*) FROM r WHERE r.region = g.region) AS a, count(*) AS o FROM g GROUP BY bucket, region),
q AS (SELECT bucket, sum(power(o - a * m / n::DOUBLE, 2) / (a * m / n::DOUBLE)) AS x FROM c JOIN mm USING (bucket), nn GROUP BY bucket),
t AS (SELECT bucket, (SELECT sum(in_debt) FROM r) AS p1, sum(in_debt) AS p2, any_value(n) AS n, any_value(m) AS m FROM g JOIN mm USING (bucket), nn GROUP BY bucket),
z AS (SELECT bucket, abs(p1 / n - p2 / m) / sqrt((p1 + p2) / (n + m) * (1 - (p1 + p2) / (n + m)) * (1.0 / n + 1.0 / m)) / sqrt(2.0) AS y FROM t),
j AS (SELECT bucket, y, CASE WHEN y < 2 THEN 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 60), lambda k: power(-1, k) * power(y, 2 * k + 1) / (gamma(k + 1.0) * (2 * k + 1))))
  ELSE exp(-y * y) / sqrt(pi()) / (y + {_ERFC.format(x="y")}) END AS p FROM z)
SELECT bucket::BIGINT AS bucket, 'balance' AS column_name, 'ks' AS test, round(1 - stay, 6) + 0.0 AS p_value, 1 - stay < 0.05 AS drifted FROM e
UNION ALL SELECT bucket, 'region', 'chi_square', round(exp(-x / 2) * (1 + x / 2), 6) + 0.0, exp(-x / 2) * (1 + x / 2) < 0.05 FROM q
UNION ALL SELECT bucket, 'in_debt', 'z', round(p, 6) + 0.0, p < 0.05 FROM j
"""


@query("drift_p_values", P_SQL)
def drift_p_values(spark, sf):
    """Suppliers as a small reference: every test with its p-value."""
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("region"))

    def side(name, prefix, *keep):
        rows = table(spark, sf, name).join(nations, F.col(f"{prefix}_nationkey") == F.col("n_nationkey"))
        balance = F.col(f"{prefix}_acctbal")
        return rows.select(*keep, balance.cast("double").alias("balance"), "region", (balance < 0).cast("int").alias("in_debt"))

    customers = side("customer", "c", F.col("c_mktsegment").alias("segment"))
    segments = customers.select("segment").distinct()
    before = segments.select(F.col("segment").alias("other"))
    places = segments.join(before, F.col("other") < F.col("segment"), "left").groupBy("segment").agg(F.count("other").alias("bucket"))
    current = customers.join(F.broadcast(places), "segment")  # five segments
    told = drift.with_p_values(drift.numeric_drift(side("supplier", "s"), current, BALANCES, "bucket"))
    return told.select("bucket", "column_name", "test", r6("p_value").alias("p_value"), F.col("drifted_by_p").alias("drifted"))

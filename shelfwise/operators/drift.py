"""Comparison of current batches with a reference slice.

Everything works on value counts per (batch, column, value) that are combined
before the shuffle: a value filling a third of the rows costs one row per task.
Where values must be ordered (KS, Wasserstein) the running totals are cut into
range partitions, so that no column or batch has to fit into one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import takewhile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.metrics import population_corr
from shelfwise.functions.survival import chi_square_tail, distance_tail, normal_tails
from shelfwise.operators.ranks import exact_quantile, running_totals
from shelfwise.session import materialize

# Decision limits at the 5 % level and for the two distance
# measures, the size from which distances replace tests, and the distinct counts
# up to which a numeric column is compared by proportion or by category.
KS_FACTOR = 1.3581
Z_LIMIT = 1.959964
Z_NORMAL_95 = 1.644854
CHI_SQUARE_LIMITS = {1: 3.841459, 2: 5.991465, 3: 7.814728, 4: 9.487729}
DISTANCE_LIMIT = 0.1
SMALL_REFERENCE = 1000
FEW_VALUES = 5
TWO_VALUES = 2
DATASET_SHARE = 0.5
MIN_SPREAD = 0.001
P_LEVEL = 0.05


def contiguous_buckets(buckets: DataFrame, column: str = "bucket") -> DataFrame:
    """Distinct buckets 0, 1, 2, … up to the first one that is missing.

    A bucket without a successor ends the run; looking for the smallest such
    bucket needs no global window.
    """
    seen = buckets.select(F.col(column).cast("bigint").alias(column)).where(F.col(column) >= 0).distinct()
    following = seen.select((F.col(column) - 1).alias(column))
    last = seen.join(following, column, "left_anti").agg(F.min(column)).scalar()
    first = seen.agg(F.min(column)).scalar()
    return seen.where((first == 0) & (F.col(column) <= last))


def bucket_list(df: DataFrame, column: str = "bucket") -> list[int]:
    """The replayed buckets in order: one number per dated batch, the same choice as
    ``contiguous_buckets``, read in one job to plan the comparison."""
    seen = {row[0] for row in df.select(column).where(F.col(column) >= 0).distinct().collect()}
    return list(takewhile(seen.__contains__, range(len(seen))))


@dataclass(frozen=True)
class CountedReference:
    """A static reference, counted once: (column_name, value, n_ref) and (column_name, spread)."""

    counts: DataFrame
    spread: DataFrame


def _long(df: DataFrame, columns: list[str], kind: str, *keep: Column) -> DataFrame:
    picked = df.select(*keep, *[F.col(c).cast(kind).alias(c) for c in columns])
    names = [c for c in picked.columns if c not in columns]
    melted = picked.unpivot(names, columns, "column_name", "value").where(F.col("value").isNotNull())
    return melted.where(~F.isnan("value")) if kind == "double" else melted


def count_reference(reference: DataFrame, columns: list[str]) -> CountedReference:
    """Numeric columns of a reference that many batches are compared with, counted and written."""
    counts = _long(reference, columns, "double").groupBy("column_name", "value").agg(F.count("*").alias("n_ref"))
    return CountedReference(materialize(counts, "reference-counts"), materialize(reference_spread(reference, columns), "reference-spread"))


def side_counts(
    reference: DataFrame | CountedReference,
    current: DataFrame,
    columns: list[str],
    bucket: str | None = None,
    buckets: list[int] | None = None,
    kind: str = "double",
) -> DataFrame:
    """Rows (bucket, column_name, value, n_ref, n_cur); nulls and NaN left out.

    Without ``bucket`` all of ``current`` is one batch 0. The reference counts are
    repeated for each batch only after they have been combined.
    """
    batches = [0] if bucket is None else (buckets if buckets is not None else bucket_list(current, bucket))
    listed = F.array(*[F.lit(int(b)) for b in batches]).cast("array<bigint>")
    tag = F.lit(0) if bucket is None else F.col(bucket)

    group = ["bucket", "column_name", "value"]
    if isinstance(reference, CountedReference):
        ref = reference.counts
    else:
        ref = _long(reference, columns, kind).groupBy("column_name", "value").agg(F.count("*").alias("n_ref"))
    ref = ref.withColumn("bucket", F.explode(listed)).withColumn("n_cur", F.lit(0).cast("bigint"))
    kept = current if bucket is None else current.where(F.col(bucket).isin(batches))
    cur = _long(kept, columns, kind, tag.cast("bigint").alias("bucket")).groupBy(*group).agg(F.count("*").alias("n_cur"))
    cur = cur.withColumn("n_ref", F.lit(0).cast("bigint"))
    return ref.unionByName(cur).groupBy(*group).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("bucket", "column_name").agg(
        F.sum("n_ref").alias("ref_rows"),
        F.sum("n_cur").alias("cur_rows"),
        F.count("*").alias("n_distinct"),
        F.max("value").alias("_top"),
    )


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole))


def _divergence(p: Column, q: Column) -> Column:
    """One category's share of the Jensen-Shannon divergence (base 2)."""
    middle = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0) / 2 + F.when(
        q > 0, q * F.log2(q / middle)
    ).otherwise(0.0) / 2


def _category_stats() -> list[Column]:
    p, q = _share("n_ref", "ref_rows"), _share("n_cur", "cur_rows")
    expected = F.col("n_ref") * _share("cur_rows", "ref_rows")
    at_top = F.col("value") == F.col("_top")
    return [
        F.sqrt(F.greatest(F.sum(_divergence(p, q)), F.lit(0.0))).alias("js_distance"),
        F.sum(F.try_divide(F.pow(F.col("n_cur") - expected, F.lit(2.0)), expected)).alias("chi_square"),
        F.sum(F.when(F.col("n_ref") == 0, 1).otherwise(0)).cast("bigint").alias("new_values"),
        F.sum(F.when(at_top, F.col("n_ref")).otherwise(0)).alias("_top_ref"),
        F.sum(F.when(at_top, F.col("n_cur")).otherwise(0)).alias("_top_cur"),
    ]


def _z_score() -> Column:
    """Two-proportion z of the larger of two values."""
    n, m = F.col("ref_rows"), F.col("cur_rows")
    pooled = F.try_divide((F.col("_top_ref") + F.col("_top_cur")).cast("double"), n + m)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), m)))
    return F.try_divide(_share("_top_ref", "ref_rows") - _share("_top_cur", "cur_rows"), error)


def chi_square_limit(freedom: Column) -> Column:
    """95 % point: exact values up to 4 degrees, Wilson-Hilferty beyond."""
    step = F.lit(2.0) / (F.lit(9.0) * freedom)
    limit = freedom * F.pow(1 - step + F.lit(Z_NORMAL_95) * F.sqrt(step), F.lit(3.0))
    for degrees, value in CHI_SQUARE_LIMITS.items():
        limit = F.when(freedom == degrees, F.lit(value)).otherwise(limit)
    return limit


def _verdict(stats: DataFrame, numeric: bool) -> DataFrame:
    """Choose the test by reference size and distinct count; add score and flag."""
    small = F.col("ref_rows") <= SMALL_REFERENCE
    few = F.col("n_distinct") <= FEW_VALUES if numeric else F.lit(True)
    two = F.col("n_distinct") <= TWO_VALUES
    test = (
        F.when(small & few & two, "z")
        .when(small & few, "chi_square")
        .when(small, "ks")
        .when(few, "js")
        .otherwise("wasserstein")
    )
    n, m = F.col("ref_rows"), F.col("cur_rows")
    ks_limit = F.lit(KS_FACTOR) * F.sqrt(F.try_divide((n + m).cast("double"), n * m))
    limit = (
        F.when(F.col("test") == "z", F.lit(Z_LIMIT))
        .when(F.col("test") == "chi_square", chi_square_limit(F.greatest(F.col("n_distinct") - 1, F.lit(1)).cast("double")))
        .when(F.col("test") == "ks", ks_limit)
        .otherwise(F.lit(DISTANCE_LIMIT))
    )
    score = (
        F.when(F.col("test") == "z", F.abs("z_score"))
        .when(F.col("test") == "chi_square", F.col("chi_square"))
        .when(F.col("test") == "js", F.col("js_distance"))
    )
    if numeric:
        score = score.when(F.col("test") == "ks", F.col("ks_distance")).otherwise(F.col("wasserstein"))
    distance = F.col("test").isin("js", "wasserstein")
    beyond = F.when(distance, F.col("score") >= F.col("limit")).otherwise(F.col("score") > F.col("limit"))
    unseen = (F.col("test") == "chi_square") & (F.col("new_values") > 0)
    return (
        stats.withColumn("test", test)
        .withColumn("score", score)
        .withColumn("limit", limit)
        .withColumn("drifted", F.coalesce(beyond, F.lit(False)) | unseen)
    )


def reference_spread(reference: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column_name, spread): population deviation of each reference column."""
    row = reference.agg(
        *[F.stddev_pop(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(c) for c in columns]
    )
    return row.unpivot([], columns, "column_name", "spread")


def numeric_drift(
    reference: DataFrame | CountedReference,
    current: DataFrame,
    columns: list[str],
    bucket: str | None = None,
    buckets: list[int] | None = None,
) -> DataFrame:
    """One row per (bucket, column_name) with every distance, the chosen test, its
    score and limit, and the drift flag. Give ``count_reference`` of a reference that
    is compared again and again."""
    spread = reference.spread if isinstance(reference, CountedReference) else reference_spread(reference, columns)
    counts = materialize(side_counts(reference, current, columns, bucket, buckets), "side-counts")
    totals = materialize(
        _totals(counts).join(spread, "column_name"), "side-totals"
    )
    ordered = running_totals(counts, ["bucket", "column_name"], "value", ["n_ref", "n_cur"])
    gap = F.abs(_share("cum_n_ref", "ref_rows") - _share("cum_n_cur", "cur_rows"))
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    group = ["bucket", "column_name", "ref_rows", "cur_rows", "n_distinct"]
    stats = (
        ordered.join(totals, ["bucket", "column_name"])
        .groupBy(*group)
        .agg(
            F.max(gap).alias("ks_distance"),
            (F.sum(gap * width) / F.max(F.greatest(F.col("spread"), F.lit(MIN_SPREAD)))).alias("wasserstein"),
            *_category_stats(),
        )
        .withColumn("z_score", _z_score())
        .drop("_top_ref", "_top_cur")
    )
    return _verdict(stats, numeric=True)


def category_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str],
    bucket: str | None = None,
    buckets: list[int] | None = None,
) -> DataFrame:
    """As ``numeric_drift`` for text columns: category tests and distances only."""
    counts = materialize(side_counts(reference, current, columns, bucket, buckets, "string"), "side-counts")
    group = ["bucket", "column_name", "ref_rows", "cur_rows", "n_distinct"]
    stats = (
        counts.join(_totals(counts), ["bucket", "column_name"])
        .groupBy(*group)
        .agg(*_category_stats())
        .withColumn("z_score", _z_score())
        .drop("_top_ref", "_top_cur")
    )
    return _verdict(stats, numeric=False)


def with_p_values(column_drift: DataFrame, level: float = P_LEVEL) -> DataFrame:
    """Rows of ``numeric_drift`` or ``category_drift`` with p_value, drift_score and drifted_by_p.

    ``p_value``: how likely a test statistic at least this large is without drift: both
    tails of the normal for z, the chi-square tail, the exact two-sample distance for samples
    of up to a million pairs and its limit beyond. Null for distances. Values that the
    reference lacks make a chi-square p-value 0; a statistic that cannot be formed has none.
    ``drift_score`` is the p-value of a test or the distance; a p-value below ``level``
    or a distance of at least its limit is drift.
    """
    test = F.col("test")
    freedom = F.greatest(F.col("n_distinct") - 1, F.lit(1))
    tail = F.when(F.col("new_values") > 0, F.lit(0.0)).otherwise(chi_square_tail(F.col("chi_square"), freedom))
    p = F.when(test == "z", normal_tails(F.col("z_score"))).when(test == "chi_square", tail)
    if "ks_distance" in column_drift.columns:
        p = p.when(test == "ks", distance_tail(F.col("ks_distance"), F.col("ref_rows"), F.col("cur_rows")))
    distance = test.isin("js", "wasserstein")
    return (
        column_drift.withColumn("p_value", p)
        .withColumn("drift_score", F.when(distance, F.col("score")).otherwise(F.col("p_value")))
        .withColumn(
            "drifted_by_p",
            F.coalesce(F.when(distance, F.col("score") >= F.col("limit")).otherwise(F.col("p_value") < level), F.lit(False)),
        )
    )


def dataset_drift(column_drift: DataFrame) -> DataFrame:
    """Per batch: number and share of drifted columns and the dataset flag."""
    drifted = F.sum(F.col("drifted").cast("bigint"))
    share = drifted / F.count("*")
    return column_drift.groupBy("bucket").agg(
        drifted.alias("num_drifted_columns"),
        share.alias("share_drifted_columns"),
        (share >= DATASET_SHARE).alias("dataset_drift"),
    )


def value_range(reference: DataFrame, current: DataFrame, column: str, *by: str) -> DataFrame:
    """Smallest, largest and width of a column, and the share of current rows that
    lie inside the reference range."""
    edge = reference.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    x = F.col(column)
    inside = F.when(x.isNotNull(), ((x >= edge["lo"]) & (x <= edge["hi"])).cast("double"))
    return current.groupBy(*by).agg(
        F.min(x).alias("min_value"),
        F.max(x).alias("max_value"),
        (F.max(x) - F.min(x)).alias("width"),
        F.avg(inside).alias("share_in_reference"),
    )


def missing_cells(columns: list[str]) -> Column:
    """Aggregate: missing cells / all cells of the given columns."""
    missing = sum((F.count(F.lit(1)) - F.count(c) for c in columns), F.lit(0))
    return F.try_divide(missing.cast("double"), F.count(F.lit(1)) * len(columns))


def missing_share(df: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """Share of missing cells, to be measured on raw input."""
    return df.groupBy(*by).agg(missing_cells(columns).alias("share_missing_values"))


def correlations(df: DataFrame, column: str, others: list[str], *by: str) -> DataFrame:
    """Rows (column_name, correlation) of one column with each of the others."""
    row = df.groupBy(*by).agg(*[population_corr(column, c).alias(c) for c in others])
    return row.unpivot(list(by), others, "column_name", "correlation")


def mean_abs_corr(columns: list[str]) -> Column:
    """Aggregate: mean of the absolute correlation matrix with a zeroed diagonal
    (divided by all k*k cells); undefined correlations are left out."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    total = sum((F.coalesce(F.abs(population_corr(a, b)), F.lit(0.0)) for a, b in pairs), F.lit(0.0))
    return 2 * total / (len(columns) ** 2)


def mean_abs_corr_by(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """(by, mean_abs_corr) as ``mean_abs_corr``, for any number of columns.

    Each task adds up products of columns, k * k sums per group, over rows where
    both are there; sums meet by (group, pair). Columns are shifted by their mean
    before, which keeps the sums exact enough.
    """
    k = len(columns)
    shift = np.array([x or 0.0 for x in df.agg(*[F.avg(F.col(f"`{c}`").cast("double")) for c in columns]).first()])
    first, second = np.triu_indices(k, 1)
    kind = df.schema[by].dataType.simpleString()

    def partial(batches):
        held: dict = {}
        for batch in batches:
            values = batch.iloc[:, 1:].to_numpy(float) - shift
            groups = batch.iloc[:, 0]
            for group in groups.unique():
                x = values[(groups.isna() if pd.isna(group) else groups == group).to_numpy()]
                there = ~np.isnan(x)
                x, m = np.where(there, x, 0.0), there.astype(float)
                left, square = x.T @ m, (x * x).T @ m
                parts = (m.T @ m, left, left.T, square, square.T, x.T @ x)
                old = held.get(group, [0.0] * 6)
                held[group] = [o + p[first, second] for o, p in zip(old, parts)]
        for group, sums in held.items():
            yield pd.DataFrame({by: [group] * len(first), "i": first, "j": second, **{n: v for n, v in zip(_SUMS, sums)}})

    rows = df.select(by, *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    sums = rows.mapInPandas(partial, f"`{by}` {kind}, i long, j long, " + ", ".join(f"{n} double" for n in _SUMS))
    total = sums.groupBy(by, "i", "j").agg(*[F.sum(n).alias(n) for n in _SUMS])
    var_a, var_b = (F.expr(f"if({q} - {s} * {s} / n > 1e-12 * {q}, {q} - {s} * {s} / n, null)") for s, q in (("sa", "saa"), ("sb", "sbb")))
    corr = F.abs((F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")) / F.sqrt(var_a * var_b))
    valid = F.when(F.col("n") > 0, corr)
    return total.groupBy(by).agg((2 * F.coalesce(F.sum(valid), F.lit(0.0)) / k**2).alias("mean_abs_corr"))


_SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")


def batch_metrics(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str],
    bucket: str = "bucket",
    prediction: str = "prediction",
    price: str = "current_price",
    ranged: str = "positive_percent",
    raw: DataFrame | None = None,
) -> DataFrame:
    """One metric row per replayed batch, all batches together.

    ``raw`` (with the same bucket column) is the input before missing values were
    filled, so that the missing share means something.
    """
    batches = bucket_list(current, bucket)
    current = current.where(F.col(bucket).isin(batches))
    tested = columns + ([prediction] if prediction not in columns else [])
    drift = materialize(numeric_drift(reference, current, tested, bucket, batches), "drift")
    features = drift.where(F.col("column_name") != prediction) if prediction not in columns else drift
    scored = drift.where(F.col("column_name") == prediction).select(
        F.col("bucket").alias(bucket),
        F.col("score").alias("prediction_drift"),
        F.col("drifted").alias("prediction_drift_detected"),
    )
    plain = current.groupBy(bucket).agg(
        F.count("*").alias("n_rows"),
        (F.max(ranged) - F.min(ranged)).cast("double").alias("positive_percent_range"),
        *([missing_cells(columns).alias("share_missing_values")] if raw is None else []),
    )
    median = exact_quantile(current, [bucket], price, name="median_current_price")
    whole = dataset_drift(features).withColumnRenamed("bucket", bucket)
    parts = [mean_abs_corr_by(current, columns, bucket), scored, whole, median]
    if raw is not None:
        parts.append(missing_share(raw.where(F.col(bucket).isin(batches)), columns, bucket))
    out = plain
    for part in parts:
        out = out.join(part, bucket, "left")
    return out


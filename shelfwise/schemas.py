"""Declared schemas of every input and output table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "params": T.MapType(T.StringType(), T.StringType()),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = (field.split() for field in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LISTINGS = _struct(
    "game_id bigint, name string, release_date string, release_year int, total_reviews bigint, "
    "positive_percent int, developer string, publisher string, genres string, tags string, "
    "platforms string, current_price string, discounted_price string, discount_percent string"
)

# The owner feed is read as text first: the files write counts as 6999.0 when any row is null.
OWNERS = _struct(
    "game_id bigint, owners string, average_forever bigint, average_2weeks bigint, "
    "median_forever bigint, median_2weeks bigint, players_forever bigint, players_2weeks bigint, "
    "price bigint, initialprice bigint, discount bigint, ccu bigint, followers bigint"
)

REVIEWS = _struct(
    "review string, sentiment double, timestamp_created bigint, voted_up boolean, game_id bigint"
)

COMBINED = _struct(
    "game_id bigint, name string, release_date date, total_reviews bigint, positive_percent int, "
    "genres string, tags string, current_price string, discounted_price string, owners string, "
    "days_after_publish int, review string, owner_min double, owner_max double, "
    "owners_log_mean double"
)

# Owner payload: every key optional, numbers may arrive as numbers or text.
OWNER_PAYLOAD = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in OWNERS.fields if f.name != "game_id"]
)

REVIEW_PAGE = T.StructType(
    [
        T.StructField("cursor", T.StringType()),
        T.StructField("reviews", T.ArrayType(_struct("review string, timestamp_created bigint, voted_up boolean"))),
    ]
)

METRICS = _struct(
    "timestamp timestamp, prediction_drift double, num_drifted_columns bigint, "
    "share_missing_values double, positive_percent_range double, median_current_price double, "
    "mean_abs_corr double"
)

RUNS = _struct(
    "run_id string, run_name string, model_type string, params params, "
    "rmse double, mae double, mape double"
)

# The five scaled numeric features, the raw columns a training row
# must have, and the compared columns of a monitoring frame.
NUMERIC_FEATURES = [
    "total_reviews",
    "positive_percent",
    "current_price",
    "owners_log_mean",
    "days_after_publish",
]
DERIVED_FEATURES = ["review_score", "competitor_pricing"]
REQUIRED_COLUMNS = [
    "total_reviews",
    "positive_percent",
    "genres",
    "tags",
    "current_price",
    "discounted_price",
    "owners_log_mean",
    "days_after_publish",
]
MONITORED_FEATURES = [
    "total_reviews",
    "positive_percent",
    "current_price",
    "discounted_price",
    "owners_log_mean",
    "days_after_publish",
    "review_score",
    "competitor_pricing",
]
SEED = 42

"""Filters, fills and schema conformance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.scalars import finite_or_zero, mentions, parse_price
from shelfwise.schemas import REQUIRED_COLUMNS

# Fixed value: columns that never reach a monitoring frame.
TEXT_COLUMNS = ("genres", "tags", "review")


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep rows where none of the required columns is null."""
    return df.na.drop(subset=columns or REQUIRED_COLUMNS)


def parse_prices(df: DataFrame) -> DataFrame:
    """Turn both price texts into numbers and drop rows where either fails.

    Inlined, texts are parsed once a row: filters on a projection would be moved below it
    and parse them again, once for each mention of a price.
    """
    prices = ("current_price", "discounted_price")
    both = F.struct(*[parse_price(c).alias(f"_parsed_{c}") for c in prices])
    parsed = df.select("*", F.inline(F.array(both))).withColumns({c: F.col(f"_parsed_{c}") for c in prices})
    return parsed.drop(*[f"_parsed_{c}" for c in prices]).na.drop(subset=list(prices))


def exclude_free(df: DataFrame, column: str = "current_price") -> DataFrame:
    """Drop listings whose price text mentions "free"; a null price is kept."""
    return df.where(~mentions(column, "free"))


def keep_below(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.where(F.col(column) <= bound)


def keep_above(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.where(F.col(column) > bound)


def keep_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Half-open range ``low <= x < high``."""
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def fill_text(df: DataFrame, *columns: str) -> DataFrame:
    """Null text becomes empty text; an absent column is added as empty text."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in columns}
    )


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)


def first_of_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns that share a name."""
    names = df.columns
    unique = df.toDF(*[f"_{i}" for i in range(len(names))])
    firsts = {name: i for i, name in reversed(list(enumerate(names)))}
    return unique.select(*[F.col(f"_{i}").alias(n) for n, i in sorted(firsts.items(), key=lambda x: x[1])])


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def common_columns(left: DataFrame, right: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    """Sorted names present on both sides."""
    return sorted((set(left.columns) & set(right.columns)) - set(without))


def require_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Select the wanted columns; fail with the names of those that are absent."""
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise ValueError(f"missing features: {', '.join(absent)}")
    return df.select(*wanted)


def conform(df: DataFrame, schema: T.StructType, default: object = None) -> DataFrame:
    """Select the schema's columns in order, adding absent ones with a default."""

    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in df.columns else F.lit(default)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def align(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Stack both frames over the given columns with a ``side`` label; a column
    absent on one side counts as 0 there."""

    def side(df: DataFrame, label: str) -> DataFrame:
        picked = [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns]
        return df.select(F.lit(label).alias("side"), *picked)

    return side(reference, "ref").unionByName(side(current, "cur"))


def sanitize(df: DataFrame, *columns: str) -> DataFrame:
    """Replace null, NaN and infinities by 0 in the given (or all numeric) columns."""
    names = columns or tuple(numeric_columns(df))
    return df.withColumns({c: finite_or_zero(c) for c in names})


def dedupe_listings(df: DataFrame, key: str = "game_id", prefer: str = "total_reviews") -> DataFrame:
    """One row per key: the one with most reviews, ties by the remaining columns.

    The rank filter lets Spark cut each key to one row before the shuffle.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in (key, prefer)]
    line = W.partitionBy(key).orderBy(F.col(prefer).desc_nulls_last(), *rest)
    return df.withColumn("_rn", F.row_number().over(line)).where("_rn = 1").drop("_rn")


def head_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def constancy(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of booleans: does the column take more than one value (null is a value)?

    Smallest against largest value answers this without counting distinct values.
    """
    return df.agg(
        *[
            F.coalesce(
                (F.min(c) != F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))), F.lit(False)
            ).alias(c)
            for c in columns
        ]
    )


def non_constant_flags(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column_name, varies): does the column vary on both sides?"""

    def long(df: DataFrame) -> DataFrame:
        return constancy(df, columns).unpivot([], columns, "column_name", "varies")

    both = long(reference).unionAll(long(current))
    return both.groupBy("column_name").agg(F.min("varies").alias("varies"))


def non_constant_columns(reference: DataFrame, current: DataFrame, columns: list[str]) -> list[str]:
    """Names of the columns that vary on both sides (one boolean per column is read)."""
    flags = non_constant_flags(reference, current, columns).where("varies").collect()
    varying = {row.column_name for row in flags}
    return [c for c in columns if c in varying]


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column_name, n_distinct) counting null as a value.

    Long form with two-step grouping: every (column, value) is combined before
    the shuffle, so a value filling a third of the rows costs one row per task.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], columns, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.lit(1).alias("one")).groupBy("column_name").agg(
        F.count("*").alias("n_distinct")
    )


def reference_slice(df: DataFrame, column: str, bound: float, *order: str, fallback: int = 100) -> DataFrame:
    """Rows with ``column <= bound``; when there are none, the first ``fallback`` rows."""
    chosen = df.where(F.col(column) <= bound)
    hit = chosen.limit(1).agg((F.count("*") > 0).alias("hit")).scalar()
    return chosen.unionByName(head_rows(df, fallback, *order).where(~hit))

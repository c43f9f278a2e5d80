"""Registry of checked queries and the SQL fragments their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import with_views
from shelfwise.functions.scalars import INTEGER, NUMBER
from shelfwise.functions.text import BLANK, KEPT, WORD
from shelfwise.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Register a query and, where SQL can state it, its DuckDB equivalent."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(configure(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn

    return add


def r6(c: Column | str) -> Column:
    """Six decimals, never a negative zero: engines add up in different orders."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


# DuckDB fragments.
BLANK_CHARS = "(' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160))"


def d6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def d_strip(x: str) -> str:
    return f"trim({x}, {BLANK_CHARS})"


def d_long(x: str) -> str:
    t = d_strip(x)
    return f"CASE WHEN regexp_matches({t}, '{INTEGER}') THEN TRY_CAST({t} AS BIGINT) END"


def d_price(x: str) -> str:
    t = d_strip(f"replace(replace({x}, '$', ''), 'USD', '')")
    return f"CASE WHEN regexp_matches({t}, '{NUMBER}') THEN TRY_CAST({t} AS DOUBLE) END"


def d_date(x: str) -> str:
    forms = ("%d %b, %Y", "%b %d, %Y", "%Y-%m-%d")
    return "CAST(coalesce(" + ", ".join(f"try_strptime({x}, '{f}')" for f in forms) + ") AS DATE)"


def d_days(date: str, as_of: str) -> str:
    return f"CAST((epoch(TIMESTAMP '{as_of}')::BIGINT - epoch({date})::BIGINT) // 86400 AS INT)"


def d_clean(x: str) -> str:
    kept = KEPT.replace("'", "''")
    one = f"regexp_replace(coalesce({x}, ''), '[\\r\\n\\t]+', ' ', 'g')"
    two = f"regexp_replace({one}, '[^{kept}{BLANK}]+', '', 'g')"
    return f"trim(regexp_replace({two}, '[{BLANK}]+', ' ', 'g'))"


def d_split(x: str, sep: str, drop_empty: bool = False) -> str:
    items = f"list_transform(string_split(coalesce({x}, ''), '{sep}'), lambda i: {d_strip('i')})"
    return f"list_filter({items}, lambda i: i <> '')" if drop_empty else items


def d_words(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '{WORD}')"


def d_hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def d_holdout(key: str, seed: int = 42) -> str:
    return f"{d_hash(f'cast({key} AS string) || $${-seed}$$')} < {int(0.2 * 2**32)}"


OWNER_PARTS = f"""
SELECT *, CASE WHEN ok THEN lo::DOUBLE END AS owner_min, CASE WHEN ok THEN hi::DOUBLE END AS owner_max,
  CASE WHEN ok THEN CASE WHEN lo = 0 OR hi = 0 THEN 0.0 ELSE exp((ln(lo) + ln(hi)) / 2) END END AS owners_log_mean
FROM (SELECT *, coalesce(len(e) = 2 AND lo IS NOT NULL AND hi IS NOT NULL, false) AS ok FROM (
  SELECT *, {d_long('e[1]')} AS lo, {d_long('e[2]')} AS hi FROM (
    SELECT *, string_split(replace(owners, ',', ''), '..') AS e FROM #src#) a) b) c
"""


def d_owners(src: str) -> str:
    """Relation with owner_min, owner_max, owners_log_mean added to ``src``."""
    return "(" + OWNER_PARTS.replace("#src#", src) + ")"

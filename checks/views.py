"""Input views over the given tables, as SQL text that Spark and DuckDB both run.

The given tables have no listings, owner feed or price texts; these views derive
them from part, documents, lineitem and events by fixed arithmetic on the keys,
including the odd values the operators must handle (free and monthly prices,
missing and malformed text, repeated keys, future dates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import configure

AS_OF = "2025-06-16 12:00:00"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_PRICED = f"""
SELECT p_partkey AS game_id, p_name AS name, p_type, p_size, copy_no,
  p_type || ';' || substr(p_name, 1, instr(p_name, ' ') - 1) || ';' || substr(p_name, instr(p_name, ' ') + 1)
    || CASE WHEN p_partkey % 31 = 0 THEN ';' WHEN p_partkey % 37 = 0 THEN ';' || p_type ELSE '' END AS tags,
  p_type || ', ' || substr(p_name, instr(p_name, ' ') + 1) AS genres,
  cast(round(p_retailprice * 100) AS bigint) - 1500 * p_size AS cents,
  CASE WHEN p_partkey % 13 = 0 THEN 'Coming soon'
       ELSE cast(1 + p_partkey % 28 AS string) || ' '
         || substr('{MONTHS}', cast(1 + 3 * (p_partkey % 12) AS int), 3) || ', '
         || cast(2008 + p_partkey % 18 AS string) END AS release_date,
  cast(CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 2008 + p_partkey % 18 END AS int) AS release_year,
  (p_partkey * 37) % 5000 + copy_no AS total_reviews, cast(40 + p_size AS int) AS positive_percent
FROM (SELECT *, 0 AS copy_no FROM #part# UNION ALL SELECT *, 1 AS copy_no FROM #part# WHERE p_partkey % 19 = 0) p
"""


def _dollars(cents: str) -> str:
    whole = f"cast(cast(floor(({cents}) / 100) AS bigint) AS string)"
    return f"'$' || {whole} || '.' || lpad(cast(({cents}) % 100 AS string), 2, '0') || ' USD'"


_CUT = "cast(floor(cents * (100 - 10 * (p_size % 5)) / 100) AS bigint)"

LISTINGS = f"""
SELECT game_id, name, release_date, release_year, total_reviews, positive_percent,
  CASE WHEN game_id % 3 = 0 THEN '' ELSE 'Studio ' || cast(game_id % 50 AS string) END AS developer,
  cast(NULL AS string) AS publisher,
  CASE WHEN game_id % 41 = 0 THEN NULL ELSE genres END AS genres,
  CASE WHEN game_id % 43 = 0 THEN NULL ELSE tags END AS tags,
  CASE WHEN p_size % 2 = 0 THEN 'Linux, Windows' ELSE 'Windows' END AS platforms,
  CASE WHEN game_id % 7 = 0 THEN 'Free To Play' WHEN game_id % 11 = 0 THEN '$7.99 USD / month'
       WHEN game_id % 17 = 0 THEN NULL WHEN game_id % 29 = 0 THEN '$0.00'
       ELSE {_dollars('cents')} END AS current_price,
  CASE WHEN game_id % 7 = 0 THEN 'Free To Play' WHEN game_id % 11 = 0 THEN '$7.99 USD / month'
       WHEN game_id % 17 = 0 THEN NULL ELSE {_dollars(_CUT)} END AS discounted_price,
  CASE WHEN p_size % 5 = 0 THEN '' ELSE '-' || cast(10 * (p_size % 5) AS string) || '%' END AS discount_percent
FROM ({_PRICED}) priced
"""

OWNERS = """
SELECT p_partkey AS game_id,
  CASE p_size % 10 WHEN 0 THEN '0 .. 20,000' WHEN 1 THEN '20,000 .. 50,000' WHEN 2 THEN '100,000,000 .. 200,000,000'
    WHEN 3 THEN '50000..100000' WHEN 4 THEN 'abc' WHEN 5 THEN '1 .. 2 .. 3' WHEN 6 THEN '' WHEN 7 THEN NULL
    WHEN 8 THEN '200,000 .. 500,000' ELSE '1,000,000 .. 2,000,000' END AS owners
FROM (SELECT * FROM #part# WHERE p_partkey % 5 <> 0 UNION ALL SELECT * FROM #part# WHERE p_partkey % 19 = 0) p
"""

REVIEWS = """
SELECT doc_id % (SELECT cast(floor(count(*) / 10) AS bigint) FROM #part#) AS game_id,
  CASE WHEN doc_id % 23 = 0 THEN NULL ELSE text END AS review,
  1700000000 + (doc_id * 7919) % 1000003 AS timestamp_created, doc_id % 2 = 0 AS voted_up, doc_id
FROM #documents#
"""

METRIC_DAYS = """
SELECT event_id, event_type, ts, cast(dayofyear(ts) - 1 + 366 * (year(ts) - 2024) AS int) AS days_after_publish,
  value AS current_price, round(value * (100 - event_id % 40)) / 100 AS discounted_price,
  cast(40 + user_id % 50 AS int) AS positive_percent, cast(event_id % 4 AS int) AS stars,
  cast(CASE WHEN event_id % 10 < 3 + dayofyear(ts) / 10 THEN 1 ELSE 0 END AS int) AS on_sale,
  cast(1 AS int) AS constant_one,
  cast(event_id % 97 AS double) / 97 + cast(dayofyear(ts) AS double) / 100 AS prediction,
  CASE WHEN event_id % 12 = 0 THEN NULL ELSE value END AS raw_value
FROM #events#
"""

PREDICTIONS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, l_discount AS y, l_quantity
FROM #lineitem#
"""

VIEWS = {
    "listings": LISTINGS,
    "owners": OWNERS,
    "reviews": REVIEWS,
    "metric_days": METRIC_DAYS,
    "predictions": PREDICTIONS,
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table or a derived view."""
    if name not in VIEWS:
        return table(spark, sf, name)
    text, used = VIEWS[name], {}
    for t in TABLES:
        if f"#{t}#" in text:
            text, used[t] = text.replace(f"#{t}#", "{" + t + "}"), table(spark, sf, t)
    return spark.sql(text, **used)


def with_views(sql: str, *names: str) -> str:
    """DuckDB query with the named views as leading CTEs."""
    ctes = []
    for n in names:
        text = VIEWS[n]
        for t in TABLES:
            text = text.replace(f"#{t}#", t)
        ctes.append(f"{n} AS ({text})")
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"WITH {', '.join(ctes)}, {body[5:]}" if ctes else body
    return f"WITH {', '.join(ctes)} {body}" if ctes else body

"""Scalars, filters and the combined table over the listing views."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import d6, d_clean, d_date, d_days, d_hash, d_long, d_owners, d_price, d_split, d_words, query, r6
from checks.views import AS_OF, view
from shelfwise import schemas
from shelfwise.functions import scalars, text
from shelfwise.operators import cleaning
from shelfwise.plans.combine import combine, combine_rows
from shelfwise.session import fresh_path
from shelfwise.sources import payloads, tables

COMBINED_SQL = f"""
SELECT l.game_id, l.name, {d_date('l.release_date')} AS release_date, l.total_reviews, l.positive_percent, l.genres,
  l.tags, l.current_price, l.discounted_price, o.owners, {d_days(d_date('l.release_date'), AS_OF)} AS days_after_publish,
  {d_clean('a.all_reviews')} AS review, o.owner_min, o.owner_max, o.owners_log_mean
FROM listings l LEFT JOIN {d_owners('owners')} o ON l.game_id = o.game_id
LEFT JOIN (SELECT game_id, string_agg(review, ' ' ORDER BY timestamp_created, review) AS all_reviews
           FROM reviews GROUP BY game_id) a ON l.game_id = a.game_id
WHERE NOT coalesce(contains(lower(l.current_price), 'free'), false)
"""
COMBINED_VIEWS = ("listings", "owners", "reviews")


def combined(spark, sf, **options):
    return combine(view(spark, sf, "listings"), view(spark, sf, "owners"), view(spark, sf, "reviews"), AS_OF, **options)


def combined_rows(spark, sf):
    return combine_rows(view(spark, sf, "listings"), view(spark, sf, "owners"), AS_OF)


def listings(spark, sf):
    return view(spark, sf, "listings")


@query(
    "combine_listings",
    f"""SELECT game_id, name, release_date, total_reviews, positive_percent, genres, tags, current_price, discounted_price,
    owners, days_after_publish, review, owner_min, owner_max, {d6('owners_log_mean')} AS owners_log_mean FROM ({COMBINED_SQL}) c""",
    *COMBINED_VIEWS,
)
def combine_listings(spark, sf):
    return combined(spark, sf).withColumn("owners_log_mean", r6("owners_log_mean"))


@query(
    "parse_price",
    f"""SELECT game_id, current_price, {d_price('current_price')} AS current_value,
    {d_price('discounted_price')} AS discounted_value FROM listings""",
    "listings",
)
def parse_price(spark, sf):
    return listings(spark, sf).select(
        "game_id", "current_price", scalars.parse_price("current_price").alias("current_value"),
        scalars.parse_price("discounted_price").alias("discounted_value"),
    )


@query(
    "parse_owners",
    f"SELECT game_id, owners, owner_min, owner_max, {d6('owners_log_mean')} AS owners_log_mean FROM {d_owners('owners')} o",
    "owners",
)
def parse_owners(spark, sf):
    parsed = view(spark, sf, "owners").select("game_id", "owners", scalars.parse_owners("owners").alias("o"))
    return parsed.select("game_id", "owners", "o.*").withColumn("owners_log_mean", r6("owners_log_mean"))


@query(
    "parse_release_date",
    f"""SELECT game_id, release_date, {d_date('release_date')} AS released,
    strftime({d_date('release_date')}, '%Y-%m-%d') AS released_text FROM listings""",
    "listings",
)
def parse_release_date(spark, sf):
    released = scalars.parse_release_date("release_date")
    return listings(spark, sf).select(
        "game_id", "release_date", released.alias("released"), scalars.date_text(released).alias("released_text")
    )


@query(
    "release_year",
    f"""SELECT game_id, coalesce(CAST(year({d_date('release_date')}) AS INT),
    TRY_CAST(regexp_extract(release_date, '((?:19|20)\\d{{2}})', 1) AS INT)) AS found_year FROM listings""",
    "listings",
)
def release_year(spark, sf):
    return listings(spark, sf).select("game_id", scalars.release_year("release_date").alias("found_year"))


@query(
    "days_since_release",
    f"SELECT game_id, {d_days(d_date('release_date'), AS_OF)} AS days_after_publish FROM listings",
    "listings",
)
def days_since_release(spark, sf):
    released = scalars.parse_release_date("release_date")
    days = F.when(released.isNotNull(), scalars.days_since(released, AS_OF))
    return listings(spark, sf).select("game_id", days.alias("days_after_publish"))


@query(
    "discount_fraction",
    f"""SELECT game_id, round(1 - CASE WHEN c <> 0 THEN d / c END, 6) + 0.0 AS discount_pct
    FROM (SELECT game_id, {d_price('current_price')} AS c, {d_price('discounted_price')} AS d FROM listings) p""",
    "listings",
)
def discount_fraction(spark, sf):
    prices = [scalars.parse_price(c) for c in ("current_price", "discounted_price")]
    return listings(spark, sf).select("game_id", r6(scalars.discount_fraction(*prices)).alias("discount_pct"))


@query("format_price", "SELECT p_partkey AS game_id, printf('$%.2f', p_retailprice) AS price_text FROM part")
def format_price(spark, sf):
    return view(spark, sf, "part").select(
        F.col("p_partkey").alias("game_id"), scalars.format_price("p_retailprice").alias("price_text")
    )


@query(
    "text_rules",
    """SELECT game_id, lower(name) AS lowered, contains(lower(name), 'ring') AS has_ring, replace(name, ' ', '_') AS joined,
    trim('  ' || name || ' ') AS stripped, coalesce(tags, '') || ';Experimental' AS tagged FROM listings""",
    "listings",
)
def text_rules(spark, sf):
    return listings(spark, sf).select(
        "game_id", F.lower("name").alias("lowered"), scalars.mentions("name", "Ring").alias("has_ring"),
        F.replace("name", F.lit(" "), F.lit("_")).alias("joined"),
        scalars.strip(F.concat(F.lit("  "), F.col("name"), F.lit(" "))).alias("stripped"),
        scalars.append_text("tags", ";Experimental").alias("tagged"),
    )


_ODD = "CASE p_size % 6 WHEN 0 THEN '1,299' WHEN 1 THEN ' 12 ' WHEN 2 THEN '5d' WHEN 3 THEN '1_0' WHEN 4 THEN '-7.5e2' ELSE cast(p_partkey AS string) END"


@query(
    "safe_casts",
    f"""SELECT p_partkey AS game_id, {d_long(_ODD)} AS as_long, {d_price(_ODD)} AS as_double,
    {d_long(f"replace({_ODD}, ',', '')")} AS with_commas FROM part""",
)
def safe_casts(spark, sf):
    odd = F.expr(_ODD)
    return view(spark, sf, "part").select(
        F.col("p_partkey").alias("game_id"), scalars.safe_long(odd).alias("as_long"),
        scalars.safe_double(odd).alias("as_double"), scalars.thousands_long(odd).alias("with_commas"),
    )


@query(
    "drift_arithmetic",
    f"""SELECT event_id, {d6('current_price * (1 + 0.1 * days_after_publish)')} AS raised,
    greatest(positive_percent - (2 + {d_hash("event_id || '-42'")} % 3), 40) AS lowered FROM metric_days""",
    "metric_days",
)
def drift_arithmetic(spark, sf):
    cut = F.lit(2) + scalars.hash_int("event_id", F.lit(42)) % 3
    return view(spark, sf, "metric_days").select(
        "event_id", r6(scalars.scale_by_day("current_price", "days_after_publish")).alias("raised"),
        scalars.floor_at("positive_percent", cut, 40).alias("lowered"),
    )


@query("bucket_of_day", "SELECT event_id, CAST(floor((days_after_publish - 3) / 5) AS BIGINT) AS bucket FROM metric_days", "metric_days")
def bucket_of_day(spark, sf):
    return view(spark, sf, "metric_days").select(
        "event_id", scalars.bucket_of(F.col("days_after_publish") - 3).alias("bucket")
    )


@query(
    "split_trim_list",
    f"""SELECT game_id, array_to_string({d_split('tags', ';')}, '|') AS tag_list, len({d_split('tags', ';')})::INT AS n_tags,
    array_to_string({d_split('tags', ';', True)}, '|') AS kept_tags, len({d_split('genres', ',', True)})::INT AS n_genres FROM listings""",
    "listings",
)
def split_trim_list(spark, sf):
    tags, kept = text.split_trim("tags", ";"), text.split_trim("tags", ";", drop_empty=True)
    return listings(spark, sf).select(
        "game_id", text.join_items(tags, "|").alias("tag_list"), F.size(tags).alias("n_tags"),
        text.join_items(kept, "|").alias("kept_tags"), F.size(text.split_trim("genres", ",", True)).alias("n_genres"),
    )


@query("clean_review_text", f"SELECT doc_id, {d_clean('review')} AS review FROM reviews", "reviews")
def clean_review_text(spark, sf):
    return view(spark, sf, "reviews").select("doc_id", text.clean_review("review").alias("review"))


@query(
    "tokenize_words",
    f"SELECT doc_id, array_to_string({d_words('review')}, ' ') AS word_text, len({d_words('review')})::INT AS n_words FROM reviews",
    "reviews",
)
def tokenize_words(spark, sf):
    found = text.words("review")
    return view(spark, sf, "reviews").select(
        "doc_id", F.array_join(found, " ").alias("word_text"), F.size(found).alias("n_words")
    )


@query(
    "positional_pairs",
    """SELECT game_id, CASE WHEN game_id % 3 = 0 THEN '' ELSE developer END AS found FROM listings""",
    "listings",
)
def positional_pairs(spark, sf):
    labels = F.array(F.lit(" Developer: "), F.lit("Publisher"))
    values = F.array("developer", F.coalesce("publisher", F.lit("")))
    return listings(spark, sf).select("game_id", text.pair_value(labels, values, "developer").alias("found"))


@query("project_rename", "SELECT game_id, name AS title, genres, tags AS labels FROM listings", "listings")
def project_rename(spark, sf):
    return listings(spark, sf).select("game_id", F.col("name").alias("title"), "genres", F.col("tags").alias("labels"))


_REQUIRED = "total_reviews positive_percent genres tags current_price discounted_price owners_log_mean days_after_publish".split()
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _REQUIRED)


@query(
    "drop_incomplete",
    f"SELECT game_id, name, total_reviews, owners FROM ({COMBINED_SQL}) c WHERE {_COMPLETE}",
    *COMBINED_VIEWS,
)
def drop_incomplete(spark, sf):
    return cleaning.drop_incomplete(combined_rows(spark, sf)).select("game_id", "name", "total_reviews", "owners")


@query(
    "drop_unparsed_prices",
    f"""SELECT * FROM (SELECT game_id, name, {d_price('current_price')} AS current_price,
    {d_price('discounted_price')} AS discounted_price FROM listings) p
    WHERE current_price IS NOT NULL AND discounted_price IS NOT NULL""",
    "listings",
)
def drop_unparsed_prices(spark, sf):
    return cleaning.parse_prices(listings(spark, sf).select("game_id", "name", "current_price", "discounted_price"))


@query(
    "exclude_free",
    "SELECT game_id, current_price FROM listings WHERE NOT coalesce(contains(lower(current_price), 'free'), false)",
    "listings",
)
def exclude_free(spark, sf):
    return cleaning.exclude_free(listings(spark, sf)).select("game_id", "current_price")


@query(
    "threshold_filters",
    """SELECT event_id, 'reference' AS kind FROM metric_days WHERE days_after_publish <= 5
    UNION ALL SELECT event_id, 'candidate' FROM metric_days WHERE days_after_publish > 5""",
    "metric_days",
)
def threshold_filters(spark, sf):
    days = view(spark, sf, "metric_days").select("event_id", "days_after_publish")
    low = cleaning.keep_below(days, "days_after_publish", 5).select("event_id", F.lit("reference").alias("kind"))
    high = cleaning.keep_above(days, "days_after_publish", 5).select("event_id", F.lit("candidate").alias("kind"))
    return low.unionByName(high)


@query(
    "range_filter",
    "SELECT event_id, days_after_publish FROM metric_days WHERE days_after_publish >= 5 AND days_after_publish < 10",
    "metric_days",
)
def range_filter(spark, sf):
    days = view(spark, sf, "metric_days").select("event_id", "days_after_publish")
    return cleaning.keep_range(days, "days_after_publish", 5, 10)


_SLICE = "SELECT event_id, days_after_publish FROM metric_days WHERE days_after_publish <= "
_FIRST = "(SELECT event_id, days_after_publish FROM metric_days ORDER BY event_id LIMIT 100)"


@query(
    "reference_slice",
    f"""{_SLICE}5 UNION ALL SELECT * FROM {_FIRST} f WHERE NOT EXISTS ({_SLICE}5)""",
    "metric_days",
)
def reference_slice(spark, sf):
    days = view(spark, sf, "metric_days").select("event_id", "days_after_publish")
    return cleaning.reference_slice(days, "days_after_publish", 5, "event_id")


@query(
    "reference_slice_fallback",
    f"""{_SLICE}-1 UNION ALL SELECT * FROM {_FIRST} f WHERE NOT EXISTS ({_SLICE}-1)""",
    "metric_days",
)
def reference_slice_fallback(spark, sf):
    days = view(spark, sf, "metric_days").select("event_id", "days_after_publish")
    return cleaning.reference_slice(days, "days_after_publish", -1, "event_id")


@query("drop_columns", "SELECT game_id, name, owners FROM (SELECT l.game_id, name, owners, tags FROM listings l JOIN owners o ON l.game_id = o.game_id) j", "listings", "owners")
def drop_columns(spark, sf):
    joined = listings(spark, sf).select("game_id", "name", "tags").join(view(spark, sf, "owners"), "game_id")
    return cleaning.drop_columns(joined, "tags", "review", "no_such_column")


@query("first_of_duplicate_columns", "SELECT l.game_id, name, owners FROM listings l JOIN owners o ON l.game_id = o.game_id", "listings", "owners")
def first_of_duplicate_columns(spark, sf):
    left, right = listings(spark, sf).select("game_id", "name"), view(spark, sf, "owners")
    return cleaning.first_of_duplicate_columns(left.join(right, left.game_id == right.game_id))


_VARIES = "coalesce(min({c}) <> max({c}) OR (count({c}) > 0 AND count({c}) < count(*)), false)"
_CHECKED = ["constant_one", "current_price", "days_after_publish", "stars", "raw_value"]


@query(
    "non_constant_columns",
    "SELECT column_name, bool_and(varies) AS varies FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {_VARIES.format(c=c)} AS varies FROM metric_days WHERE days_after_publish {op} 5"
        for c in _CHECKED
        for op in ("<=", ">")
    )
    + ") v GROUP BY column_name",
    "metric_days",
)
def non_constant_columns(spark, sf):
    days = view(spark, sf, "metric_days")
    return cleaning.non_constant_flags(
        cleaning.keep_below(days, "days_after_publish", 5), cleaning.keep_above(days, "days_after_publish", 5), _CHECKED
    )


@query(
    "distinct_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM metric_days"
        for c in ("event_type", "positive_percent", "raw_value", "constant_one")
    ),
    "metric_days",
)
def distinct_values(spark, sf):
    return cleaning.distinct_values(
        view(spark, sf, "metric_days"), ["event_type", "positive_percent", "raw_value", "constant_one"]
    )


@query("numeric_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def numeric_columns(spark, sf):
    orders = view(spark, sf, "orders")
    return orders.select(*cleaning.numeric_columns(orders))


_HOLED = "CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 10 THEN {inf} WHEN l_quantity < 12 THEN {nan} ELSE l_tax END"


@query(
    "sanitize_numeric",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 12 THEN 0.0 ELSE l_tax END AS tax FROM lineitem""",
)
def sanitize_numeric(spark, sf):
    holed = F.expr(_HOLED.format(inf="double('-infinity')", nan="double('NaN')"))
    rows = view(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", holed.alias("tax"))
    return cleaning.sanitize(rows, "tax")


@query(
    "fill_text",
    "SELECT game_id, coalesce(tags, '') AS tags, coalesce(publisher, '') AS publisher, '' AS review FROM listings",
    "listings",
)
def fill_text(spark, sf):
    rows = listings(spark, sf).select("game_id", "tags", "publisher")
    return cleaning.fill_text(rows, "tags", "publisher", "review")


@query(
    "conform_schema",
    """SELECT game_id, name, CAST(NULL AS STRING) AS release_date, CAST(NULL AS INT) AS release_year, total_reviews, positive_percent,
    CAST(NULL AS STRING) AS developer, CAST(NULL AS STRING) AS publisher, genres, tags, CAST(NULL AS STRING) AS platforms,
    current_price, CAST(NULL AS STRING) AS discounted_price, CAST(NULL AS STRING) AS discount_percent FROM listings""",
    "listings",
)
def conform_schema(spark, sf):
    some = listings(spark, sf).select("tags", "genres", "name", "game_id", "current_price", "positive_percent", "total_reviews")
    return cleaning.conform(some, schemas.LISTINGS)


@query(
    "usable_listings",
    f"""SELECT * FROM (SELECT game_id, name, coalesce(CAST(year({d_date('release_date')}) AS INT),
    TRY_CAST(regexp_extract(release_date, '((?:19|20)\\d{{2}})', 1) AS INT)) AS release_year FROM listings) u
    WHERE game_id IS NOT NULL AND release_year IS NOT NULL""",
    "listings",
)
def usable_listings(spark, sf):
    rows = listings(spark, sf).select("game_id", "name", "release_date")
    return payloads.usable_listings(rows).drop("release_date")


@query(
    "dedupe_listings",
    """SELECT game_id, name, total_reviews, current_price FROM (SELECT *, row_number() OVER (PARTITION BY game_id
    ORDER BY total_reviews DESC) AS rn FROM listings) r WHERE rn = 1""",
    "listings",
)
def dedupe_listings(spark, sf):
    return cleaning.dedupe_listings(listings(spark, sf).select("game_id", "name", "total_reviews", "current_price"))


@query(
    "head_listings",
    "SELECT game_id, name, total_reviews FROM listings ORDER BY total_reviews DESC, game_id, name LIMIT 200",
    "listings",
)
def head_listings(spark, sf):
    rows = listings(spark, sf).select("game_id", "name", "total_reviews")
    return cleaning.head_rows(rows, 200, F.desc("total_reviews"), "game_id", "name")


@query(
    "price_fallback",
    """SELECT game_id, CASE WHEN k < 2 THEN orig ELSE CASE WHEN k < 4 THEN single ELSE 'Free To Play' END END AS current_price,
    CASE WHEN k < 2 THEN fin WHEN k < 4 THEN single ELSE 'Free To Play' END AS discounted_price,
    CASE WHEN k < 2 THEN pct ELSE '' END AS discount_percent FROM (SELECT game_id, game_id % 6 AS k, '$' || game_id AS orig,
    '$' || (game_id % 10) AS fin, '-5%' AS pct, '$1' || game_id AS single FROM listings) s""",
    "listings",
)
def price_fallback(spark, sf):
    k = F.col("game_id") % 6
    gid = F.col("game_id").cast("string")
    rows = listings(spark, sf).select(
        "game_id",
        F.when(k < 2, F.concat(F.lit("$"), gid)).alias("original"),
        F.when(k < 2, F.concat(F.lit("$"), (F.col("game_id") % 10).cast("string"))).otherwise("").alias("final"),
        F.when(k < 2, F.lit("-5%")).alias("percent"),
        F.when((k >= 2) & (k < 4), F.concat(F.lit("$1"), gid)).otherwise(F.when(k == 4, F.lit(""))).alias("single"),
    )
    resolved = payloads.resolve_price(rows, "original", "final", "percent", "single")
    return resolved.select("game_id", "current_price", "discounted_price", "discount_percent")


@query(
    "platform_flags",
    """SELECT p_partkey AS game_id, CASE p_size % 4 WHEN 0 THEN 'Linux, Windows' WHEN 1 THEN 'Mac' WHEN 2 THEN ''
    ELSE 'Linux, Mac, Windows' END AS platforms FROM part""",
)
def platform_flags(spark, sf):
    classes = F.expr(
        "CASE p_size % 4 WHEN 0 THEN 'icon win | icon linux | icon win' WHEN 1 THEN 'icon mac' WHEN 2 THEN 'icon' "
        "ELSE 'mac linux win' END"
    )
    return view(spark, sf, "part").select(
        F.col("p_partkey").alias("game_id"), payloads.platform_names(classes).alias("platforms")
    )


@query("csv_round_trip", "SELECT * FROM listings", "listings")
def csv_round_trip(spark, sf):
    path = fresh_path(spark, "listings-csv")
    tables.write_csv(listings(spark, sf), path)
    back = tables.read_listings(spark, path)
    return cleaning.fill_text(back, "developer", "discount_percent").select(*back.columns)


@query(
    "combined_csv_round_trip",
    f"SELECT game_id, name, release_date, days_after_publish, review FROM ({COMBINED_SQL}) c",
    *COMBINED_VIEWS,
)
def combined_csv_round_trip(spark, sf):
    path = fresh_path(spark, "combined-csv")
    tables.write_csv(combined(spark, sf).select(*schemas.COMBINED.names), path, escape="\\")
    back = tables.read_combined(spark, path)
    return back.select(
        "game_id", "name", "release_date", "days_after_publish", F.coalesce("review", F.lit("")).alias("review")
    )


@query("replace_load", "SELECT game_id, owners FROM owners", "owners")
def replace_load(spark, sf):
    path = fresh_path(spark, "owners-table")
    rows = view(spark, sf, "owners")
    tables.replace_files(rows.limit(1), path)
    return tables.replace_files(rows, path)


@query(
    "append_feeds",
    "SELECT game_id, review, CAST(NULL AS BOOLEAN) AS voted_up FROM reviews WHERE voted_up UNION ALL SELECT game_id, review, voted_up FROM reviews WHERE NOT voted_up",
    "reviews",
)
def append_feeds(spark, sf):
    rows = view(spark, sf, "reviews")
    return tables.append_feeds(
        rows.where("voted_up").select("game_id", "review"), rows.where("NOT voted_up").select("game_id", "review", "voted_up")
    )

"""Payload and page parsing over events, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import d_long, query
from checks.views import view
from shelfwise.functions import scalars
from shelfwise.schemas import OWNERS
from shelfwise.sources import payloads

_NUMBERS = [f.name for f in OWNERS.fields if f.name not in ("game_id", "owners")]


@query(
    "payload_fields",
    f"""SELECT event_id, {d_long("json_extract_string(props, '$.k')")} AS k, coalesce(json_extract_string(props, '$.owners'), '') AS owners,
    json_extract_string(props, '$.price') AS price FROM events""",
)
def payload_fields(spark, sf):
    return view(spark, sf, "events").select(
        "event_id", scalars.safe_long(scalars.json_field("props", "k")).alias("k"),
        scalars.json_field("props", "owners", "").alias("owners"), scalars.json_field("props", "price").alias("price"),
    )


# A record per event built from its own columns; odd event types lack keys or hold bad numbers.
_PAYLOAD = """CASE event_type WHEN 'error' THEN '{"price": "n/a", "ccu": 7}'
  WHEN 'signup' THEN '{"owners": "0 .. 20,000", "ccu": ' || cast(user_id AS string) || '}'
  ELSE '{"owners": "20,000 .. 50,000", "price": "' || cast(event_id % 5000 AS string) || '", "discount": ' || cast(event_id % 90 AS string) || ', "other": [1]}' END"""


@query(
    "parse_owner_payload",
    f"""SELECT event_id AS game_id, coalesce(json_extract_string(j, '$.owners'), '') AS owners, """
    + ", ".join(f"{d_long(f'json_extract_string(j, {chr(39)}$.{c}{chr(39)})')} AS {c}" for c in _NUMBERS)
    + f" FROM (SELECT event_id, {_PAYLOAD} AS j FROM events) e",
)
def parse_owner_payload(spark, sf):
    rows = view(spark, sf, "events").select("event_id", F.expr(_PAYLOAD).alias("payload"))
    return payloads.parse_owner_payload(rows, key="event_id")


@query(
    "explode_review_pages",
    """SELECT conv_id, coalesce(text, '') AS review, turn AS timestamp_created, role = 'user' AS voted_up FROM conversations""",
)
def explode_review_pages(spark, sf):
    entry = F.struct(
        F.col("text").alias("review"), F.col("turn").alias("timestamp_created"), (F.col("role") == "user").alias("voted_up")
    )
    page = F.to_json(F.struct(F.lit("*").alias("cursor"), F.array(entry).alias("reviews")))
    pages = view(spark, sf, "conversations").select("conv_id", page.alias("payload"))
    return payloads.explode_reviews(pages, key="conv_id")


@query(
    "html_extract",
    f"""SELECT page_id, {d_long("nullif(regexp_extract(url, '/(\\d+)', 1), '')")} AS game_id,
    coalesce({d_long("replace(nullif(regexp_extract(html, '([\\d,]+)[)];</script>', 1), ''), ',', '')")}, 0) AS total_reviews,
    coalesce(TRY_CAST(nullif(regexp_extract(html, '(\\d+)% of the', 1), '') AS INT), 0) AS positive_percent FROM pages""",
)
def html_extract(spark, sf):
    found = payloads.extract_listing(
        view(spark, sf, "pages"), id_pattern=r"/(\d+)", count_pattern=r"([\d,]+)[)];</script>"
    )
    return found.select("page_id", "game_id", "total_reviews", "positive_percent")


@query(
    "listing_page_extract",
    f"""SELECT page_id, {d_long("nullif(regexp_extract(u, '/app/(\\d+)', 1), '')")} AS game_id, CASE WHEN page_id % 2 = 0 THEN 1000 + page_id ELSE 0 END AS total_reviews,
    CAST(CASE WHEN page_id % 2 = 0 THEN page_id % 101 ELSE 0 END AS INT) AS positive_percent FROM (SELECT page_id, url || '/app/' || page_id AS u FROM pages) p""",
)
def listing_page_extract(spark, sf):
    rows = view(spark, sf, "pages").withColumn("url", F.concat("url", F.lit("/app/"), F.col("page_id").cast("string")))
    tip = F.concat(
        (F.col("page_id") % 101).cast("string"), F.lit("% of the "),
        F.format_number((F.col("page_id") + 1000).cast("bigint"), 0), F.lit(" user reviews are good"),
    )
    rows = rows.withColumn("html", F.when(F.col("page_id") % 2 == 0, F.concat(tip, F.col("html"))).otherwise(F.col("html")))
    return payloads.extract_listing(rows).select("page_id", "game_id", "total_reviews", "positive_percent")


_ANCHORS = '(?s)<a.*?href=.*?/.*?>(.*?)</a>'
_ANCHOR_TEXTS = f"list_filter(list_transform(regexp_extract_all(html, '{_ANCHORS}', 1), lambda i: trim(i)), lambda i: i <> '')"


@query(
    "anchor_texts",
    f"""SELECT page_id, array_to_string(list_sort(list_distinct({_ANCHOR_TEXTS})), '|') AS distinct_texts,
    array_to_string({_ANCHOR_TEXTS}, ', ') AS all_texts FROM pages""",
)
def anchor_texts(spark, sf):
    return view(spark, sf, "pages").select(
        "page_id", F.array_join(F.array_sort(payloads.anchor_texts("html", _ANCHORS)), "|").alias("distinct_texts"),
        F.array_join(payloads.anchor_texts("html", _ANCHORS, distinct=False), ", ").alias("all_texts"),
    )

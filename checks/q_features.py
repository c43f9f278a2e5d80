"""Pricing, encoding, text and model features."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.q_listings import _COMPLETE, COMBINED_SQL, COMBINED_VIEWS, combined_rows, listings
from checks.registry import d6, d_holdout, d_price, d_split, d_words, query, r6
from checks.views import view
from shelfwise.functions import text
from shelfwise.operators import cleaning, encoding, pricing, reviews, tfidf
from shelfwise.plans import features, monitor
from shelfwise.plans.combine import cleaned_reviews
from shelfwise.session import materialize

# Parsed listings: numeric prices and item lists.
PRICED_SQL = f"""
SELECT * FROM (SELECT game_id, total_reviews, {d_price('current_price')} AS current_price, {d_split('tags', ';')} AS tags,
  {d_split('genres', ',')} AS genres FROM listings WHERE tags IS NOT NULL AND genres IS NOT NULL) p
WHERE current_price IS NOT NULL
"""
MEDIANS_SQL = "SELECT tag, median(current_price) AS median_price FROM (SELECT unnest(tags) AS tag, current_price FROM priced) t GROUP BY tag"


def priced(spark, sf):
    rows = cleaning.parse_prices(listings(spark, sf)).na.drop(subset=["tags", "genres"])
    return rows.select(
        "game_id", "total_reviews", "current_price", text.split_trim("tags", ";").alias("tags"),
        text.split_trim("genres", ",").alias("genres"),
    )


@query("tag_median_price", f"WITH priced AS ({PRICED_SQL}), m AS ({MEDIANS_SQL}) SELECT tag, {d6('median_price')} AS median_price FROM m", "listings")
def tag_median_price(spark, sf):
    return pricing.tag_median_prices(priced(spark, sf)).withColumn("median_price", r6("median_price"))


@query(
    "competitor_price",
    f"""WITH priced AS ({PRICED_SQL}), fitted AS (SELECT * FROM priced WHERE NOT ({d_holdout('game_id')})),
    m AS ({MEDIANS_SQL.replace('priced', 'fitted')}), rowed AS (SELECT *, row_number() OVER () AS rid FROM priced),
    means AS (SELECT rid, avg(median_price) AS v FROM (SELECT rid, unnest(tags) AS tag FROM rowed) x JOIN m USING (tag) GROUP BY rid)
    SELECT game_id, total_reviews, round(coalesce(v, (SELECT median(current_price) FROM priced)), 6) + 0.0 AS competitor_pricing
    FROM rowed LEFT JOIN means USING (rid)""",
    "listings",
)
def competitor_price(spark, sf):
    rows = materialize(priced(spark, sf), "priced")
    fitted = pricing.tag_median_prices(encoding.split(rows)[0])
    out = pricing.competitor_price(rows, fitted)
    return out.select("game_id", "total_reviews", r6("competitor_pricing").alias("competitor_pricing"))


# Genres cover the type and the second name word, so that first words stay unknown.
_VOCAB = "SELECT DISTINCT unnest(genres) AS item FROM priced"


def genre_vocabulary(spark, sf):
    return encoding.vocabulary(priced(spark, sf), "genres")


@query("vocabulary", f"WITH priced AS ({PRICED_SQL}) SELECT DISTINCT unnest(tags) AS item FROM priced", "listings")
def vocabulary(spark, sf):
    return encoding.vocabulary(priced(spark, sf), "tags")


@query(
    "restrict_to_vocabulary",
    f"""WITH priced AS ({PRICED_SQL}), v AS (SELECT list(item) AS items FROM ({_VOCAB}) d)
    SELECT game_id, total_reviews, array_to_string(list_filter(tags, lambda t: list_contains(items, t)), '|') AS kept FROM priced, v""",
    "listings",
)
def restrict_to_vocabulary(spark, sf):
    out = pricing.restrict_to_vocabulary(priced(spark, sf), "tags", genre_vocabulary(spark, sf))
    return out.select("game_id", "total_reviews", F.array_join("tags", "|").alias("kept"))


@query(
    "unseen_items",
    f"""WITH priced AS ({PRICED_SQL}) SELECT item, count(*) AS n_rows FROM (SELECT unnest(tags) AS item FROM priced) t
    WHERE item NOT IN ({_VOCAB}) GROUP BY item""",
    "listings",
)
def unseen_items(spark, sf):
    return pricing.unseen_items(priced(spark, sf), "tags", genre_vocabulary(spark, sf))


@query(
    "known_item_rows",
    f"""WITH priced AS ({PRICED_SQL}) SELECT DISTINCT game_id, total_reviews FROM (SELECT game_id, total_reviews, unnest(tags) AS item
    FROM priced) t WHERE item IN ({_VOCAB})""",
    "listings",
)
def known_item_rows(spark, sf):
    items = pricing.exploded(priced(spark, sf), "tags", "item", "game_id", "total_reviews")
    return items.join(genre_vocabulary(spark, sf), "item", "left_semi").select("game_id", "total_reviews").distinct()


@query(
    "missing_features",
    f"""WITH priced AS ({PRICED_SQL}) SELECT item FROM (SELECT DISTINCT unnest(tags) AS item FROM priced) a
    EXCEPT SELECT item FROM ({_VOCAB}) b""",
    "listings",
)
def missing_features(spark, sf):
    return encoding.vocabulary(priced(spark, sf), "tags").exceptAll(genre_vocabulary(spark, sf))


@query(
    "multi_hot",
    f"""WITH priced AS ({PRICED_SQL}), v AS (SELECT list(item ORDER BY item) AS items FROM (SELECT DISTINCT unnest(genres) AS item FROM priced) d)
    SELECT game_id, total_reviews, array_to_string(list_transform(items, lambda i: CAST(list_contains(genres, i) AS INT)), '') AS hot FROM priced, v""",
    "listings",
)
def multi_hot(spark, sf):
    rows = priced(spark, sf)
    items = encoding.vocabulary_items(encoding.vocabulary(rows, "genres"))
    hot = F.array_join(encoding.multi_hot("genres", items).cast("array<string>"), "")
    return rows.select("game_id", "total_reviews", hot.alias("hot"))


_WIDE = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "multi_hot_wide",
    f"WITH priced AS ({PRICED_SQL}) SELECT game_id, total_reviews, "
    + ", ".join(f"CAST(list_contains(genres, '{g}') AS INT) AS \"{g}\"" for g in _WIDE)
    + " FROM priced",
    "listings",
)
def multi_hot_wide(spark, sf):
    rows = priced(spark, sf)
    wide = encoding.multi_hot_wide(rows, "genres", _WIDE)
    return wide.select("game_id", "total_reviews", *_WIDE)


@query(
    "multi_hot_long",
    f"""WITH priced AS ({PRICED_SQL}) SELECT game_id, item FROM (SELECT game_id, unnest(list_distinct(tags)) AS item FROM priced) t
    WHERE item IN ({_VOCAB})""",
    "listings",
)
def multi_hot_long(spark, sf):
    return encoding.multi_hot_long(priced(spark, sf), "game_id", "tags", genre_vocabulary(spark, sf))


@query(
    "scaler_stats",
    f"""SELECT {d6('avg(o_totalprice)')} AS mean_o_totalprice, {d6('stddev_pop(o_totalprice)')} AS scale_o_totalprice,
    1.0::DOUBLE AS mean_one, 1.0::DOUBLE AS scale_one FROM orders""",
)
def scaler_stats(spark, sf):
    rows = view(spark, sf, "orders").withColumn("one", F.lit(1))
    stats = encoding.scaler_stats(rows, ["o_totalprice", "one"])
    return stats.select(*[r6(c).alias(c) for c in stats.columns])


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) + 0.0 AS o_totalprice
    FROM orders""",
)
def standard_scale(spark, sf):
    rows = view(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    scaled = encoding.standard_scale(rows, encoding.scaler_stats(rows, ["o_totalprice"]), ["o_totalprice"])
    return scaled.withColumn("o_totalprice", r6("o_totalprice"))


@query("hash_split", f"SELECT o_orderkey, {d_holdout('o_orderkey')} AS holdout FROM orders")
def hash_split(spark, sf):
    return view(spark, sf, "orders").select("o_orderkey", encoding.holdout_flag("o_orderkey").alias("holdout"))


@query(
    "aggregate_reviews",
    """SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS all_reviews FROM
    (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 OR conv_id % 11 = 0 THEN NULL ELSE text END AS text FROM conversations) c GROUP BY conv_id""",
)
def aggregate_reviews(spark, sf):
    turns = view(spark, sf, "conversations").select(
        "conv_id", "turn", F.expr("CASE WHEN turn % 5 = 4 OR conv_id % 11 = 0 THEN NULL ELSE text END AS text")
    )
    return reviews.aggregate_reviews(turns, "conv_id", "text", "turn")


@query(
    "review_text_parts",
    """WITH t AS (SELECT conv_id % 3 AS hot, CASE WHEN turn % 2 = 0 THEN turn END AS moment, text, row_number() OVER (PARTITION BY conv_id % 3
      ORDER BY CASE WHEN turn % 2 = 0 THEN turn END NULLS FIRST, text) AS nth FROM conversations WHERE text IS NOT NULL),
    s AS (SELECT *, sum(strlen(text) + 1) OVER (PARTITION BY hot ORDER BY nth) - strlen(text) - 1 AS before FROM t)
    SELECT hot, CAST(before // 4000 AS BIGINT) AS part, string_agg(text, ' ' ORDER BY nth) AS review FROM s GROUP BY 1, 2""",
)
def review_text_parts(spark, sf):
    """Three groups of turns, half of them without a moment, in parts of 4000 bytes."""
    moment = F.expr("CASE WHEN turn % 2 = 0 THEN turn END").alias("moment")
    turns = view(spark, sf, "conversations").select((F.col("conv_id") % 3).alias("hot"), moment, "text")
    return reviews.review_text_parts(turns, "hot", "text", "moment", part_bytes=4000)


@query(
    "cap_reviews_per_key",
    """SELECT game_id, doc_id, timestamp_created FROM (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY
    timestamp_created DESC, review ASC NULLS LAST) AS rn FROM reviews) r WHERE rn <= 5""",
    "reviews",
)
def cap_reviews_per_key(spark, sf):
    return reviews.cap_reviews(view(spark, sf, "reviews")).select("game_id", "doc_id", "timestamp_created")


TOKENS_SQL = f"SELECT game_id, unnest({d_words('review')}) AS term FROM reviews"


@query(
    "term_stats",
    f"SELECT term, count(*) AS tf, count(DISTINCT game_id) AS df FROM ({TOKENS_SQL}) t GROUP BY term",
    "reviews",
)
def term_stats(spark, sf):
    return tfidf.term_stats(view(spark, sf, "reviews"), "game_id", "review")


TERMS_SQL = f"""
SELECT term, tf, CAST(row_number() OVER (ORDER BY tf DESC, term) - 1 AS INT) AS idx
FROM (SELECT term, count(*) AS tf FROM ({TOKENS_SQL}) t GROUP BY term ORDER BY tf DESC, term LIMIT 1000) c
"""


@query("top_terms", TERMS_SQL, "reviews")
def top_terms(spark, sf):
    counts = tfidf.tokens(view(spark, sf, "reviews"), "review").groupBy("term").agg(F.count("*").alias("tf"))
    return tfidf.top_terms(counts)


WEIGHTS_SQL = f"""
tok AS ({TOKENS_SQL}), terms AS ({TERMS_SQL}), docs AS (SELECT DISTINCT game_id FROM reviews),
cnt AS (SELECT game_id, term, count(*) AS n FROM tok JOIN terms USING (term) GROUP BY game_id, term),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM docs)) / (1 + count(*))) + 1 AS idf FROM cnt GROUP BY term),
raw AS (SELECT game_id, term, n * idf AS w FROM cnt JOIN idf USING (term)),
x AS (SELECT game_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY game_id)) AS w FROM raw)
"""


def _fit(spark, sf):
    rows = view(spark, sf, "reviews")
    copies = rows.select("game_id").distinct().withColumn("copies", F.lit(1))
    return rows, tfidf.fit_vocabulary(rows, "game_id", "review", copies)


@query("tfidf_weights", f"WITH {WEIGHTS_SQL} SELECT game_id, term, {d6('w')} AS weight FROM x", "reviews")
def tfidf_weights(spark, sf):
    _, (terms, counts) = _fit(spark, sf)
    return tfidf.weigh(counts, terms, "game_id").select("game_id", "term", r6("weight").alias("weight"))


def _step(k: int) -> str:
    return f"""
s{k} AS (SELECT game_id, sum(w * v) AS s FROM x JOIN v{k - 1} USING (term) GROUP BY game_id),
u{k} AS (SELECT term, sum(w * s) AS v FROM x JOIN s{k} USING (game_id) GROUP BY term),
v{k} AS (SELECT term, v / sqrt((SELECT sum(v * v) FROM u{k})) AS v FROM u{k})"""


@query(
    "review_score_k_steps",
    f"""WITH {WEIGHTS_SQL}, v0 AS (SELECT DISTINCT term, 1.0 / sqrt((SELECT count(*) FROM terms)) AS v FROM terms),
    {', '.join(_step(k) for k in (1, 2, 3))}, s AS (SELECT game_id, sum(w * v) AS s FROM x JOIN v3 USING (term) GROUP BY game_id)
    SELECT game_id, round(coalesce(s, 0), 6) + 0.0 AS review_score FROM docs LEFT JOIN s USING (game_id)""",
    "reviews",
)
def review_score_k_steps(spark, sf):
    rows = view(spark, sf, "reviews")
    state = tfidf.fit_review_score(rows, steps=3, tolerance=None, extra=0)
    scored = tfidf.add_review_score(rows.select("game_id").distinct(), rows, state)
    return scored.withColumn("review_score", r6("review_score"))


@query("review_score", None)
def review_score(spark, sf):
    rows = view(spark, sf, "reviews")
    state, counts = tfidf.fit_and_count(rows)
    return tfidf.add_review_score(rows.select("game_id").distinct(), rows, state, counts=counts)


_LEXICON = f"""
SELECT term, avg(2.0 * quality - 1) AS weight FROM (SELECT DISTINCT doc_id, quality, term FROM (
  SELECT d.doc_id, quality, unnest({d_words('d.text')}) AS term FROM documents d JOIN labels l ON d.doc_id = l.doc_id) a) b
GROUP BY term HAVING count(*) >= 5
"""


@query(
    "lexicon_sentiment",
    f"""WITH lex AS ({_LEXICON}), tok AS (SELECT doc_id, unnest({d_words('review')}) AS term FROM reviews),
    m AS (SELECT doc_id, avg(weight) AS s FROM tok JOIN lex USING (term) GROUP BY doc_id)
    SELECT doc_id, round(coalesce(s, 0), 6) + 0.0 AS sentiment FROM reviews LEFT JOIN m USING (doc_id)""",
    "reviews",
)
def lexicon_sentiment(spark, sf):
    labelled = view(spark, sf, "documents").join(view(spark, sf, "labels"), "doc_id")
    seen = labelled.select("doc_id", "quality", F.explode(F.array_distinct(text.words("text"))).alias("term"))
    lexicon = seen.groupBy("term").agg(F.avg(2.0 * F.col("quality") - 1).alias("weight"), F.count("*").alias("n"))
    found = tfidf.lexicon_sentiment(view(spark, sf, "reviews"), lexicon.where("n >= 5"), "doc_id", "review")
    return found.withColumn("sentiment", r6("sentiment"))


FRAME_SQL = f"""
SELECT * FROM (SELECT game_id, total_reviews, positive_percent, owners_log_mean, days_after_publish, {d_price('current_price')} AS current_price,
  {d_price('discounted_price')} AS discounted_price, {d_split('tags', ';')} AS tags, {d_split('genres', ',')} AS genres, owners
  FROM ({COMBINED_SQL}) c WHERE total_reviews IS NOT NULL AND positive_percent IS NOT NULL AND genres IS NOT NULL AND tags IS NOT NULL
  AND owners_log_mean IS NOT NULL AND days_after_publish IS NOT NULL) f
WHERE current_price IS NOT NULL AND discounted_price IS NOT NULL AND current_price <> 0
"""


@query(
    "feature_table",
    f"""WITH priced AS ({FRAME_SQL}), m AS ({MEDIANS_SQL}), rowed AS (SELECT *, row_number() OVER () AS rid FROM priced),
    means AS (SELECT rid, avg(median_price) AS v FROM (SELECT rid, unnest(tags) AS tag FROM rowed) x JOIN m USING (tag) GROUP BY rid)
    SELECT game_id, total_reviews, positive_percent, current_price, {d6('owners_log_mean')} AS owners_log_mean, days_after_publish,
    round(1 - discounted_price / current_price, 6) + 0.0 AS discount_pct, array_to_string(genres, '|') AS genres,
    array_to_string(tags, '|') AS tags, round(coalesce(v, (SELECT median(current_price) FROM priced)), 6) + 0.0 AS competitor_pricing
    FROM rowed LEFT JOIN means USING (rid)""",
    *COMBINED_VIEWS,
)
def feature_table(spark, sf):
    frame = features.clean_frame(combined_rows(spark, sf)).where("discount_pct IS NOT NULL")
    frame = materialize(frame, "frame")
    out = pricing.competitor_price(frame, pricing.tag_median_prices(frame))
    return out.select(
        "game_id", "total_reviews", "positive_percent", "current_price", r6("owners_log_mean").alias("owners_log_mean"),
        "days_after_publish", r6("discount_pct").alias("discount_pct"), F.array_join("genres", "|").alias("genres"),
        F.array_join("tags", "|").alias("tags"), r6("competitor_pricing").alias("competitor_pricing"),
    )


def clean_texts(spark, sf):
    """Single cleaned reviews, written once and read by every fitting pass."""
    return materialize(cleaned_reviews(view(spark, sf, "reviews")), "texts")


def training(spark, sf, **options):
    """(frame with all features, state)."""
    return features.training_frame(combined_rows(spark, sf), clean_texts(spark, sf), **options)


@query("training_frame", None)
def training_frame(spark, sf):
    frame, _ = training(spark, sf, fit_on="train")
    return frame.select(
        "game_id", *encoding.feature_names("full"), "discount_pct", F.array_join("genres", "|").alias("genres"),
        F.array_join("tags", "|").alias("tags"),
    )


@query("monitoring_frame", None)
def monitoring_frame(spark, sf):
    texts = clean_texts(spark, sf)
    _, state = features.training_frame(combined_rows(spark, sf), texts)
    return features.monitoring_frame(combined_rows(spark, sf), texts, state)


WIDE_SQL = f"""
WITH ok AS (SELECT * FROM (SELECT days_after_publish AS d, {d_price('current_price')} AS p, {d_price('discounted_price')} AS q,
  {d_split('genres', ',', True)} AS g, {d_split('tags', ';', True)} AS t, {d_split('genres', ',')} AS fitted_g, {d_split('tags', ';')} AS fitted_t
  FROM ({COMBINED_SQL}) c WHERE {_COMPLETE}) c WHERE p IS NOT NULL AND q IS NOT NULL),
vg AS (SELECT DISTINCT unnest(fitted_g) AS item FROM ok WHERE p <> 0), vt AS (SELECT DISTINCT unnest(fitted_t) AS item FROM ok WHERE p <> 0),
i AS (SELECT item, true AS genre FROM vg UNION ALL SELECT item, false FROM vt WHERE item NOT IN (SELECT item FROM vg)),
x AS (SELECT CAST(floor(d / 1000) AS BIGINT) AS bucket, item, count(*)::DOUBLE AS n, count(*) FILTER (list_contains(CASE WHEN genre THEN g ELSE t END, item))::DOUBLE AS k
  FROM ok, i WHERE d >= 0 GROUP BY ALL),
y AS (SELECT x.*, r.n AS rn, r.k AS rk, (r.k + x.k) / (r.n + x.n) AS pool FROM x JOIN x r ON r.item = x.item AND r.bucket = 0),
z AS (SELECT *, CASE WHEN rn <= 1000 THEN 'z' ELSE 'js' END AS test,
  CASE WHEN pool > 0 AND pool < 1 THEN abs(rk / rn - k / n) / sqrt(pool * (1 - pool) * (1 / rn + 1 / n)) END AS zs,
  sqrt(greatest(list_sum(list_transform([[rk / rn, k / n], [1 - rk / rn, 1 - k / n]], lambda s: CASE WHEN s[1] > 0 THEN s[1] * log2(s[1] / ((s[1] + s[2]) / 2)) / 2 ELSE 0 END
    + CASE WHEN s[2] > 0 THEN s[2] * log2(s[2] / ((s[1] + s[2]) / 2)) / 2 ELSE 0 END)), 0)) AS js FROM y)
SELECT bucket, item AS column_name, test, {d6("CASE WHEN test = 'z' THEN zs ELSE js END")} AS score,
  coalesce(CASE WHEN test = 'z' THEN zs > 1.959964 ELSE js >= 0.1 END, false) AS drifted FROM z
"""


@query("wide_column_drift", WIDE_SQL, *COMBINED_VIEWS)
def wide_column_drift(spark, sf):
    """Every genre and tag column of the monitoring frame, a thousand days a batch."""
    texts = clean_texts(spark, sf)
    _, state = features.training_frame(combined_rows(spark, sf), texts)
    frame = features.monitoring_frame(combined_rows(spark, sf), texts, state, lists=True)
    flags = [(item, features.item_flag(column, item)) for _, column, item in features.item_columns(state)]
    found = monitor.wide_column_drift(frame, flags, batch_days=1000, last_day=999)
    return found.select("bucket", "column_name", "test", r6("score").alias("score"), "drifted")


@query(
    "feature_sets",
    "SELECT 'full' AS kind, 7::BIGINT AS n_numeric, count(*) AS n_rows FROM listings UNION ALL SELECT 'plain', 5, count(*) FROM listings",
    "listings",
)
def feature_sets(spark, sf):
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(len(encoding.feature_names(k))).cast("bigint").alias("n_numeric"))
        for k in ("full", "plain")
    ])
    rows = listings(spark, sf).select(F.explode(kinds).alias("k"))
    return rows.groupBy("k.kind", "k.n_numeric").agg(F.count("*").alias("n_rows"))

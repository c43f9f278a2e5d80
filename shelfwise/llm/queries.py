"""One query per operator, over whole tables, and SQL where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.license_scan import TEMPLATES
from shelfwise.llm.registry import ORACLES, QUERIES, query  # noqa: F401


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

URL_SQL = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (
  SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p) d JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN u ON p.host = u.host AND p.path = u.path
"""


@query("op4_url_filters", URL_SQL)
def url_filters(spark, sf):
    from shelfwise.llm.url_filters import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op7_quality_rules")
def quality_rules(spark, sf):
    from shelfwise.llm.quality_rules import judge_quality

    return judge_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 2.0 AS lim,
    [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS nth
  FROM d GROUP BY source),
l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(lim) OVER (ORDER BY lim / w, nth ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY lim / w, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM s),
t AS (
  SELECT source, nth, source_size, CASE WHEN lim <= lev * w THEN lim ELSE w * max(CASE WHEN lim > lev * w THEN lev END) OVER () END AS target
  FROM l),
o AS (
  SELECT d.doc_id, d.size, t.target, t.nth, turn, md5(turn || '/' || coalesce(d.doc_id::VARCHAR, '')) AS mark
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (0), (1)) v(turn) WHERE d.size > 0),
f AS (SELECT *, (sum(size) OVER (PARTITION BY nth ORDER BY turn, mark, size))::DOUBLE / target AS finish FROM o),
m AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, nth, turn, mark, size) AS upto FROM f),
k AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM m WHERE upto::DOUBLE <= (SELECT sum(size)::DOUBLE * 1.5::DOUBLE FROM d) GROUP BY doc_id)
SELECT d.doc_id, d.source, d.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM d LEFT JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN k USING (doc_id)
"""


@query("op10_mixing", MIX_SQL)
def mixing(spark, sf):
    from shelfwise.llm.mixing import mix_sources

    return mix_sources(table(spark, sf, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


SHINGLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION SELECT d, y FROM reach JOIN links ON r = x),
least AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN least ON d = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""


@query("op9_minhash", SHINGLE_SQL)
def minhash(spark, sf):
    from shelfwise.llm.minhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf, "documents")).drop("first")


REPEAT_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS h
  FROM w WHERE len(w) >= 35),
r AS (SELECT doc_id, i FROM s JOIN (SELECT h FROM s GROUP BY h HAVING count(*) > 1) USING (h)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
n AS (SELECT doc_id, count(*) AS n, list(i) AS gone FROM gone GROUP BY doc_id),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""


@query("op3_substring_dedup", REPEAT_SQL)
def substring_dedup(spark, sf):
    from shelfwise.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf, "documents"))


VECTOR_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS d, vec_id AS r FROM embeddings
  UNION SELECT d, y FROM reach JOIN links ON r = x),
least AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON d = vec_id LEFT JOIN n ON x = vec_id
"""


@query("op1_embedding_dedup", VECTOR_SQL)
def embedding_dedup(spark, sf):
    from shelfwise.llm.embedding_dedup import similar_vectors

    return similar_vectors(table(spark, sf, "embeddings"))


TOKENIZERS = "/opt/tokenizers"  # holds the public rank files
RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op6_byte_bpe")
def byte_bpe(spark, sf):
    from shelfwise.llm.bpe import encode_texts

    return encode_texts(table(spark, sf, "documents"), f"{TOKENIZERS}/{RANKS}")


@query("op2_language_id")
def language_id(spark, sf):
    from shelfwise.llm.language_id import identify

    return identify(table(spark, sf, "documents"))


@query("op5_toxicity")
def toxicity(spark, sf):
    from shelfwise.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


LICENSE_TEXTS = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))
LICENSE_SQL = rf"""
WITH t(k, license, text) AS (VALUES {LICENSE_TEXTS}),
tw AS (SELECT k, license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM t),
ts AS (SELECT DISTINCT k, license, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM tw),
tn AS (SELECT k, count(*) AS n, (2 ** ceil(log2(count(*))))::BIGINT AS c FROM ts GROUP BY k),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-/:-@\[-`{{-\x7F]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(0, len(w) - 4)) AS p, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d),
m AS (SELECT doc_id, k, license, p, s.s AS s, n, c FROM s JOIN ts ON s.s = ts.s JOIN tn USING (k)),
win AS (SELECT *, unnest(CASE WHEN p // c > 0 THEN [p // c - 1, p // c] ELSE [p // c] END) AS win FROM m),
hit AS (SELECT doc_id, k, license, win, count(DISTINCT s) / any_value(n)::DOUBLE AS containment, min(p) AS first_word FROM win
  GROUP BY doc_id, k, license, win HAVING 100 * count(DISTINCT s) >= 75 * any_value(n))
SELECT doc_id, license, containment, first_word FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY containment DESC, first_word) AS nth FROM hit) WHERE nth = 1
"""


@query("op8_license_scan", LICENSE_SQL)
def license_scan(spark, sf):
    from shelfwise.llm.license_scan import scan

    return scan(table(spark, sf, "documents"))


LEAK_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-/:-@\[-`{-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-/:-@\[-`{-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda i: array_to_string(w[i:i + 9], ' '))) AS s
  FROM b WHERE len(w) > 0),
g AS (SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n),
o AS (SELECT doc_id, item_id, i, g.n AS n FROM g JOIN p ON g.s = p.s AND g.n = p.n),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM o GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op11_decontamination", LEAK_SQL)
def decontamination(spark, sf):
    from shelfwise.llm.decontamination import find_passages

    told = find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return told.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: crc32 of a decimal number as text, for engines without the function.
CRC_SQL = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(({})::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384)))"""
TRIE_SQL = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor({CRC_SQL.format("conv_id")}, 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.i, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.i <= h
  UNION ALL SELECT c.conv_id, t.i + 10, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > h),
s AS (SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY i) AS l, list(length(text) ORDER BY i) AS z FROM r GROUP BY conv_id),
a AS (SELECT conv_id, coalesce(l, []) AS l, coalesce(z, []) AS z FROM c LEFT JOIN s USING (conv_id)),
p AS (SELECT conv_id, unnest(range(0, len(l) + 1)) AS depth, l, z FROM a),
k AS (SELECT conv_id, depth, array_to_string(l[1:depth], ',') AS key, array_to_string(l[1:depth - 1], ',') AS up, l[1:depth] AS l,
  CASE WHEN depth > 0 THEN z[depth] ELSE 0 END AS size, depth = len(l) AS ends FROM p),
n AS (SELECT key, depth, any_value(up) AS up, any_value(l) AS l, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
  string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends FROM k GROUP BY key, depth),
kids AS (SELECT up AS key, depth - 1 AS depth, count(*) AS kids FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN kids USING (key, depth)),
e AS (SELECT l, depth, kids, n, size, unnest(range(0, depth + 1)) AS d FROM m),
u AS (SELECT array_to_string(l[1:d], ',') AS key, d AS depth, count(*) FILTER (kids = 0) AS leaves, sum((n - 1) * size) AS saved FROM e GROUP BY 1, 2)
SELECT m.conv_id, m.depth::BIGINT AS depth, CASE WHEN m.depth > 0 THEN o.conv_id END AS parent_conv_id, m.n::BIGINT AS n_convs, m.kids::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN u ON u.key = m.key AND u.depth = m.depth LEFT JOIN n o ON o.key = m.up AND o.depth = m.depth - 1
"""


@query("op12_prefix_trie", TRIE_SQL)
def prefix_trie(spark, sf):
    from shelfwise.llm.prefix_trie import conversation_trie, end_digests, spliced, turn_sequences

    trie = conversation_trie(spliced(turn_sequences(table(spark, sf, "conversations"))))
    told = trie.nodes.join(end_digests(trie.ends), ["path", "depth"], "left")
    longs = ["depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return told.select("conv_id", *[F.col(c).cast("long").alias(c) for c in longs], F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


REPAIR_SQL = rf"""
WITH RECURSIVE z AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor({CRC_SQL.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295) % 20 AS fate FROM conversations),
g AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(0, CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM z),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i, role[1] AS ini,
  rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended FROM g),
q AS (SELECT *, ended = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, ended[-1] NOT IN ('.', '!', '?') AS cut,
  lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM p),
f AS (SELECT *, NOT blank AND again AS dup, NOT blank AND NOT again AND cut AS trunc FROM q),
t AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
    count(*) FILTER (trunc) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY conv_id),
r AS (
  SELECT conv_id, n AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 6, 'a': 'II'}} AS s1, {{'c': 3, 'a': 'I'}} AS u, {{'c': 0, 'a': ''}} AS a FROM t
  UNION ALL
  SELECT conv_id, i, least(b0, {{'c': 3 + nu.c, 'a': 'I' || nu.a}}), least(b1, {{'c': 3 + nu.c, 'a': 'I' || nu.a}}), nu, least(ba, {{'c': 3 + bu.c, 'a': 'I' || bu.a}})
  FROM (
    SELECT *, least(bu, {{'c': 3 + ba.c, 'a': 'I' || ba.a}}) AS nu FROM (
      SELECT r.conv_id, r.i - 1 AS i,
        least({{'c': 4 + s0.c, 'a': 'D' || s0.a}}, {{'c': x + CASE ini WHEN 's' THEN s1.c WHEN 'u' THEN u.c ELSE 99999999 END, 'a': 'K' || CASE ini WHEN 's' THEN s1.a ELSE u.a END}},
          {{'c': 3 + x + u.c, 'a': 'R' || u.a}}) AS b0,
        least({{'c': 4 + s1.c, 'a': 'D' || s1.a}}, {{'c': x + CASE ini WHEN 'u' THEN u.c ELSE 99999999 END, 'a': 'K' || u.a}}, {{'c': 3 + x + u.c, 'a': 'R' || u.a}}) AS b1,
        least({{'c': 4 + u.c, 'a': 'D' || u.a}}, {{'c': x + CASE ini WHEN 'a' THEN a.c ELSE 99999999 END, 'a': 'K' || a.a}}, {{'c': 3 + x + a.c, 'a': 'R' || a.a}}) AS bu,
        least({{'c': 4 + a.c, 'a': 'D' || a.a}}, {{'c': x + CASE ini WHEN 'u' THEN u.c ELSE 99999999 END, 'a': 'K' || u.a}}, {{'c': 3 + x + u.c, 'a': 'R' || u.a}}) AS ba
      FROM r JOIN (SELECT *, CASE WHEN blank OR dup THEN 99999999 WHEN trunc THEN 3 ELSE 0 END AS x FROM f) f
        ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i WHERE r.i > 0))),
o AS (SELECT conv_id, s0.c::BIGINT AS cost, s0.a AS audit FROM r WHERE i = 0),
l AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(1, length(audit) + 1)) AS j FROM o WHERE audit <> ''),
m AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS nth FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
k AS (SELECT m.*, f.role, f.text, max(CASE WHEN nth = 1 AND e = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS sys
  FROM m LEFT JOIN f ON e <> 'I' AND f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = m.i WHERE e <> 'D'),
y AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (nth - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END,
  chr(10) ORDER BY j) AS lines FROM k GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op13_structure_repair", REPAIR_SQL)
def structure_repair(spark, sf):
    from shelfwise.llm.structure_repair import damaged, repair_structure, repaired_digests

    turns = table(spark, sf, "conversations")
    repair = repair_structure(damaged(turns))
    told, lines = repair.conversations.withColumnRenamed("conv_id", "id"), repaired_digests(repair.rows).withColumnRenamed("id", "line_id")
    ids = turns.select("conv_id").distinct()
    joined = ids.join(told, F.col("conv_id").eqNullSafe(F.col("id")), "left").join(lines, F.col("conv_id").eqNullSafe(F.col("line_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))

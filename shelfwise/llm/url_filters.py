"""URL filters: rules over host suffixes and path prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_BYTES = 4  # of a digest; what the join compares first


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", prefix_bytes: int = PREFIX_BYTES
) -> DataFrame:
    """``pages`` with host, path, rule and verdict added (columns of these names are replaced).

    ``rules`` has host, path, verdict. A rule fits its host and all subdomains
    when the path starts with the rule's path. The longest rule (host + path)
    wins, then the longer host, then ``block`` before ``allow``. Without a rule:
    rule null and verdict ``default``.

    The outcome depends only on the last labels of the host and the first
    characters of the path, as many as the longest rule has. So URLs are reduced
    to these, and only distinct reduced URLs are expanded into expressions
    (host suffixes times path prefixes of the lengths that rules have). Those
    equi-join the rules, listed by short hash prefix, on that prefix alone; each
    row then confirms its full digest among the listed ones (one rule, but for
    chance). Outcomes are written, and pages take that of their reduced URL. One host with a third of all pages is
    one reduced URL per path head, counted out before any shuffle. Nothing is
    broadcast unless the planner finds it below its threshold.

    Null url: host and path empty, no rule. An empty host fits no rule. Repeated
    rows and null ids stay as they are. An empty rule table gives ``default``.
    The one thing collected is the distinct lengths of rule hosts (labels) and
    paths (characters), at most as many as the longest rule is long.
    """
    ruled = rules.select(
        F.translate("host", UPPER, LOWER).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"),
        F.col("verdict").alias("r_verdict"),
    ).where("r_host is not null and r_host <> ''")
    shape = ruled.select(
        F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"), F.collect_set(F.length("r_path")).alias("chars")
    ).first()
    labels, chars = sorted(shape["labels"]), sorted(shape["chars"])

    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    page = F.struct(*own).alias("_page")  # no column of a page can clash with those below
    named = pages.select(page, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if not labels:
        return named.select("_page.*", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    tail, head = F.substring_index("host", ".", -labels[-1]), F.substring("path", 1, chars[-1])
    named = named.withColumns({"_tail": tail, "_head": head})

    reduced = named.select("_tail", "_head").where("_tail <> ''").distinct()
    suffixes = F.array_distinct(F.array(*[F.substring_index("_tail", ".", -n) for n in labels]))
    prefixes = F.array_distinct(F.array(*[F.substring("_head", 1, n) for n in chars]))
    expressions = (
        reduced.withColumn("_host", F.explode(suffixes))
        .withColumn("_path", F.explode(prefixes))
        .withColumn("_digest", _digest(F.col("_host"), F.col("_path")))
        .withColumn("_short", F.substring("_digest", 1, prefix_bytes))
    )
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("length"),
        F.length("r_host").alias("host_length"),
        (F.col("r_verdict") == "block").alias("blocks"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("r_verdict").alias("verdict"),
    )
    single = ruled.groupBy(_digest(F.col("r_host"), F.col("r_path")).alias("digest")).agg(F.max(rank).alias("rank"))
    listed = single.groupBy(F.substring("digest", 1, prefix_bytes).alias("_short")).agg(
        F.collect_list(F.struct("digest", "rank")).alias("_listed")
    )
    confirmed = F.filter("_listed", lambda r: r["digest"] == F.col("_digest"))
    best = (
        expressions.join(listed, "_short")
        .withColumn("_rank", F.get(confirmed, F.lit(0))["rank"])
        .where("_rank is not null")
        .groupBy("_tail", "_head")
        .agg(F.max("_rank").alias("_best"))
    )
    best = materialize(best, "url-rules")  # both sides of the last join are plain then: broadcast by size, or split where skewed
    return named.join(best, ["_tail", "_head"], "left").select(
        "_page.*", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )

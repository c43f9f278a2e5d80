"""Quality rules: text statistics and a learned, ordered list of threshold rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.support import WORD, Scratch

SAMPLE = 20000  # labelled rows that rules are learned from at most
CUTS = 48  # thresholds tried per measure
PRECISION = 0.9  # of a rule on the rows kept for pruning, at least
FEW = 16  # repeated windows of a text that are looked up in a list
SUPPORT = 5  # rows a rule must cover there

Condition = tuple[str, str, float]

#: Measures that rules may test, as ratios, so that text length alone says little.
MEASURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "capitals_per_char": "n_capitals / greatest(word_chars, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}


def text_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and counts of the whole text; every count 0 for a null or empty text.

    n_words, word_chars (code points in words), n_symbols (``#*$%&|<>``), n_marks
    (``!?``), n_capitals (A-Z), n_lines (lines with a word), n_dup_lines (those
    equal to an earlier line), n_repeat_words (words in 3-word windows found twice
    or more, the first included). Built-in functions on one row at a time: no
    shuffle, memory as large as the longest text. Repeated windows are found by
    sorting hashes of three words; where they are few, each position is looked up
    in their list, else (hash, position) pairs are sorted. Both give the same, in
    n log n steps for n words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    counted = docs.select(
        *keep,
        words.alias("_words"),
        lines.alias("_lines"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(body, F.lit(r"[!?]")).alias("n_marks"),
        F.regexp_count(body, F.lit(r"[A-Z]")).alias("n_capitals"),
    )
    w = F.col("_words")
    triples = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    hashed = counted.withColumn("_h", F.when(F.size(w) >= 3, triples))
    hashed = hashed.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array("_h")))
    h, s = F.col("_h"), F.col("_s")
    found = hashed.withColumn("_d", F.array_distinct(F.filter(s, lambda x, k: F.coalesce(x == F.get(s, k + 1), F.lit(False)))))
    places = F.sequence(F.lit(0), F.size(h) - 1)
    few = F.filter(places, lambda i: F.array_contains("_d", F.get(h, i)))
    pairs = F.array_sort(F.transform(places, lambda i: F.struct(F.get(h, i).alias("h"), i.alias("i"))))
    found = found.withColumn("_p", F.when(F.size("_d") > FEW, pairs))
    p = F.col("_p")

    def same(x: Column, k: Column) -> Column:
        return F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))

    many = F.array_sort(F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    found = found.withColumn("_at", F.when(F.size("_d") > FEW, many).when(F.size("_d") > 0, few))
    at = F.col("_at")
    later, earlier = F.slice(at, 2, F.size(at) - 1), F.slice(at, 1, F.size(at) - 1)
    gaps = F.zip_with(later, earlier, lambda b, a: F.least(b - a, F.lit(3)))
    covered = F.when(F.size(at) > 0, F.aggregate(gaps, F.lit(3), lambda total, gap: total + gap))
    return found.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("n_marks").cast("long").alias("n_marks"),
        F.col("n_capitals").cast("long").alias("n_capitals"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Too short, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _covers(rule: Sequence[Condition], row: dict) -> bool:
    return all(row[m] > v if op == ">" else row[m] <= v for m, op, v in rule)


def _grow(rows: list[dict], cuts: dict[str, list[float]]) -> list[Condition]:
    """Add the condition with the highest information gain until no clean row is covered."""
    from math import log2

    rule: list[Condition] = []
    while True:
        bad = sum(r["low"] for r in rows)
        if bad in (0, len(rows)):
            return rule
        start, best, choice = log2(bad / len(rows)), 1e-9, None
        for m, values in cuts.items():
            ranked = sorted((r[m], r["low"]) for r in rows)
            upto, low, i = 0, 0, 0
            for v in values:
                while i < len(ranked) and ranked[i][0] <= v:
                    upto, low, i = upto + 1, low + ranked[i][1], i + 1
                for op, p, n in (("<=", low, upto), (">", bad - low, len(ranked) - upto)):
                    if p and n < len(ranked) and (gain := p * (log2(p / n) - start)) > best:
                        best, choice = gain, (m, op, v)
        if choice is None:
            return rule
        rule.append(choice)
        rows = [r for r in rows if _covers([choice], r)]


def _worth(rule: Sequence[Condition], rows: list[dict]) -> tuple[float, int]:
    """Precision and number of rows covered."""
    hit = [r["low"] for r in rows if _covers(rule, r)]
    return (sum(hit) / len(hit) if hit else 0.0), len(hit)


def cover(rows: list[dict], precision: float = PRECISION, support: int = SUPPORT, cuts: int = CUTS) -> list[list[Condition]]:
    """Sequential covering: grow a conjunction, prune it, take its rows away, go on.

    Rows hold measures, ``low`` (0 or 1) and ``fold``; two folds of three grow
    rules, the third prunes them: trailing conditions go while that does not lower
    the rule's precision there. A rule below ``precision`` or ``support`` ends the
    list, so clean documents stay unless rules are sure.
    """
    values = {}
    for m in MEASURES:
        seen = sorted({r[m] for r in rows})
        step = max(1, len(seen) // cuts)
        values[m] = seen[step - 1 :: step]
    grow, prune = [r for r in rows if r["fold"]], [r for r in rows if not r["fold"]]
    rules: list[list[Condition]] = []
    while any(r["low"] for r in grow):
        rule = _grow(grow, values)
        while len(rule) > 1 and _worth(rule[:-1], prune)[0] >= _worth(rule, prune)[0]:
            rule = rule[:-1]
        sure, covered = _worth(rule, prune)
        if not rule or sure < precision or covered < support:
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not _covers(rule, r)] for part in (grow, prune))
    return rules


def rule_expression(rules: Sequence[Sequence[Condition]]) -> Column:
    """Number (from 1) of the first rule that fits, null if none: one ordered conditional expression."""
    out: Column | None = None
    for k, rule in enumerate(rules, 1):
        fits = F.lit(True)
        for m, op, v in rule:
            value = F.expr(MEASURES[m])
            fits = fits & (value > v if op == ">" else value <= v)
        out = F.when(fits, k) if out is None else out.when(fits, k)
    return F.lit(None).cast("int") if out is None else out


def learn_rules(statistics: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> list[list[Condition]]:
    """Rules for low quality from labelled statistics.

    At most ``sample`` labelled rows, the first in the order of a hash of the id,
    come to the driver: six ratios and a label each. A cut by hash to about twice as
    many comes first, so what is ordered stays small. Rows that fail the base rule
    are left out, null labels too. No labelled rows: no rules.
    """
    hashed = F.xxhash64(F.col(id_col).cast("string"))
    order = F.pmod(hashed, F.lit(1 << 30))
    known = labels.where("quality is not null")
    few = order.cast("double") * known.count() <= F.lit(2.0 * sample * (1 << 30))
    marked = known.where(few).select(F.col(id_col), F.col("quality")).dropDuplicates([id_col])
    rows = (
        statistics.where(~base_failed())
        .join(marked, id_col)
        .select(
            F.col(id_col),
            *[F.expr(e).alias(m) for m, e in MEASURES.items()],
            (1 - F.col("quality")).cast("int").alias("low"),
            order.alias("_order"),
            hashed.alias("_hash"),
        )
        .orderBy("_order", id_col)
        .limit(sample)
        .collect()
    )
    return cover([{**r.asDict(), "fold": r["_hash"] % 3 != 0} for r in rows])


def judge_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """One row per document: id, statistics, base_failed, rule (number or null), kept.

    The statistics of all documents are computed once and written (numbers only);
    rules are learned from them and ``labels`` (id, quality 0/1) and applied as one
    conditional expression. A document is kept unless it fails the base rule or a
    learned rule fits.

    Null or empty text: all counts 0, base failed. Null or repeated ids: such rows
    are judged like any other; repeated labels count once. No rows: no rows.
    Columns beside id and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    statistics = scratch.keep(text_statistics(docs, text, (id_col,)), "statistics")
    rules = learn_rules(statistics, labels, id_col, sample)
    judged = statistics.withColumn("base_failed", base_failed()).withColumn("rule", rule_expression(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())

"""Benchmark passages in documents, by a prefix-filtered join of windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.support import Scratch

#: Words are runs of ASCII letters and digits and of anything beyond ASCII.
LETTERS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WINDOW = 10  # words of an item that count as a passage; a shorter item is one passage
SHINGLE = 5  # words of a token of the join, or the whole of a shorter passage
FILTER_BITS = 22  # the filter of shingles has 2**22 bits, whatever the number of items


def lower_words(text: Column) -> Column:
    """Words of a text, A-Z in lower case, all else unchanged."""
    plain = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LETTERS), F.lit(0))
    # lower() would also change letters beyond ASCII
    return F.transform(
        plain, lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER))
    )


def _shingles(words: Column, width: Column) -> Column:
    """Hashes of each ``width`` consecutive words; an empty array for fewer words."""
    places = F.sequence(F.lit(1), F.size(words) - width + 1)
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, width)))
    return F.when(F.size(words) >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def _least(size: Column, containment: float) -> Column:
    """Of ``size`` shingles, how many a passage must share."""
    return F.ceil(size * F.lit(float(containment)) - F.lit(1e-9)).cast("int")


def _bit_words(hashes: DataFrame) -> DataFrame:
    """(slot, bits): a bit for each hash ``h``, in at most 2**(FILTER_BITS - 6) rows."""
    slot, bit = _slot(F.col("h")), F.col("h").bitwiseAND(F.lit(63)).cast("int")
    return (
        hashes.select(slot.alias("slot"), bit.alias("_bit"))
        .groupBy("slot")
        .agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("bits"))
    )


def _slot(h: Column) -> Column:
    return F.shiftrightunsigned(h.bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), 6)


def _passages(items: DataFrame, item_id: str, text: str, window: int, scratch: Scratch) -> DataFrame:
    """Distinct (passage, item): each ``window`` consecutive words of an item, or all of a shorter one."""
    parted = items.select(F.col(item_id).cast("string").alias("item"), lower_words(F.col(text)).alias("words"))
    parted = scratch.keep(parted.where(F.size("words") > 0), "items")
    places = F.sequence(F.lit(1), F.greatest(F.size("words") - window, F.lit(0)) + 1)
    passages = F.transform(places, lambda i: F.array_join(F.slice("words", i, window), " "))
    return scratch.keep(parted.select(F.explode(passages).alias("passage"), "item").distinct(), "passages")


def _tokens(passages: DataFrame, shingle: int, scratch: Scratch) -> DataFrame:
    """(passage, length, width, h, at, n): distinct shingles of each distinct passage, the first
    word at which each stands, and their number."""
    parted = passages.select("passage").distinct().withColumn("words", F.split("passage", " "))
    sized = parted.withColumn("length", F.size("words")).withColumn("width", F.least(F.lit(shingle), "length"))
    laid = sized.select("passage", "length", "width", F.posexplode(_shingles(F.col("words"), F.col("width"))).alias("at", "h"))
    own = laid.groupBy("passage", "length", "width", "h").agg(F.min("at").alias("at"))
    return scratch.keep(own.withColumn("n", F.count("*").over(W.partitionBy("passage")).cast("int")), "tokens")


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    containment: float = 1.0,
    carry: tuple = (),
) -> DataFrame:
    """One row per document: id, ``carry``, n_words, n_hit, spans, items, contaminated.

    A passage is ``window`` consecutive words of an item (all words of an item that
    has fewer). It occurs in a document where as many consecutive words hold at
    least ``containment`` of its distinct shingles; at 1 the words must be the
    passage, word for word. ``n_hit`` counts the document's words inside any
    occurrence, ``spans`` lists them as (first, last) word numbers from 0 on,
    ``items`` the ids of items with an occurring passage, sorted as strings.

    1. A filter of fixed size (2**22 bits, broadcast as at most 65,536 rows) keeps the
       document shingles that some item may have. More items make it let more
       through, never fewer.
    2. What is left is counted over all documents. Each passage orders its shingles
       by that count. A place that shares ``k`` of ``n`` shingles shares one of the
       rarest ``n - k + 1``: only these join the documents. At containment 1 that is
       the single rarest one, so boilerplate joins nothing unless all of a passage is.
    3. The passage must lie inside the document (its length and the shingle's
       position in it say where). Candidates of one document are put beside its
       words, and containment is decided on the words themselves. A second filter of
       the same size keeps documents without candidates where they are.

    Only built-in functions. Words of the documents are written once; those of
    documents with candidates move once. A frequent shingle is split by the
    runtime's skewed joins, both sides of which are written tables. Only the
    distinct lengths of shingles (at most ``shingle``) come to the driver.

    Null or empty texts have no words and no hits. An item without words has no
    passage. Items without an id mark words but are neither counted nor listed;
    rows with one item id are one item. Repeated document rows each get their own
    row. Columns beside those named are not read, so theirs cannot clash. Empty
    tables give no rows, or rows without hits.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    passages = _passages(items, item_id, item_text, window, scratch)
    tokens = _tokens(passages, shingle, scratch)
    widths = sorted(r.width for r in tokens.select("width").distinct().collect())

    named = F.struct(F.col(id_col), *[F.col(c) for c in carry]).alias("_doc")
    rows = docs.select(named, F.monotonically_increasing_id().alias("_row"), lower_words(F.col(text)).alias("words"))
    rows = scratch.keep(rows.withColumn("n_words", F.size("words").cast("long")), "rows")
    if widths:
        told = _occurrences(rows, passages, tokens, widths, containment, scratch)
    else:
        kinds = "_row long, n_hit long, spans array<struct<first:int,last:int>>, items array<string>"
        told = docs.sparkSession.createDataFrame([], kinds)
    no_spans, no_items = F.array().cast("array<struct<first:int,last:int>>"), F.array().cast("array<string>")
    scratch.drop_all_but("rows", "hits", "told")
    return (
        rows.select("_doc", "_row", "n_words")
        .join(told, "_row", "left")
        .select(
            "_doc.*",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("spans", no_spans).alias("spans"),
            F.coalesce("items", no_items).alias("items"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def _occurrences(
    rows: DataFrame, passages: DataFrame, tokens: DataFrame, widths: list[int], containment: float, scratch: Scratch
) -> DataFrame:
    """(_row, n_hit, spans, items) of the rows with a passage."""
    # at most 2**(FILTER_BITS - 6) rows of two longs, whatever the items
    filter_ = F.broadcast(scratch.keep(_bit_words(tokens), "filter"))
    laid = [rows.select("_row", "n_words", F.posexplode(_shingles(F.col("words"), F.lit(w))).alias("place", "h")) for w in widths]
    every = reduce(DataFrame.union, laid).withColumn("slot", _slot(F.col("h")))
    may_be = F.expr("getbit(bits, cast(h & 63 as int)) = 1")
    found = scratch.keep(every.join(filter_, "slot").where(may_be).select("_row", "n_words", "place", "h"), "found")

    counts = scratch.keep(found.groupBy("h").agg(F.count("*").alias("times")), "counts")
    rarity = W.partitionBy("passage").orderBy(F.coalesce("times", F.lit(0)), "h")
    ranked = tokens.join(counts, "h", "left").withColumn("rank", F.row_number().over(rarity))
    needed = ranked.where(F.col("rank") <= F.col("n") - _least(F.col("n"), containment) + 1).where("times is not null")
    needed = scratch.keep(needed.select("h", "passage", "length", "width", "at"), "needed")

    exact, length, place = containment >= 1, F.col("length"), F.col("place")
    met = found.join(needed, "h")
    if exact:
        met = met.withColumn("start", place - F.col("at"))
    else:  # the shingle may stand anywhere in the passage
        low, high = F.greatest(F.lit(0), place - (length - F.col("width"))), F.least(place, (F.col("n_words") - length).cast("int"))
        met = met.where(low <= high).withColumn("start", F.explode(F.sequence(low, high)))
    inside = met.where((F.col("start") >= 0) & (F.col("start") + length <= F.col("n_words")))
    at = F.struct("start", "length", "width", "passage")
    candidates = scratch.keep(inside.groupBy("_row").agg(F.collect_set(at).alias("candidates")), "candidates")
    # only rows that this second filter lets through are moved to their candidates
    wanted = F.broadcast(scratch.keep(_bit_words(candidates.select(F.xxhash64("_row").alias("h"))), "wanted"))
    marked = rows.select("_row", "words", F.xxhash64("_row").alias("h")).withColumn("slot", _slot(F.col("h")))
    texts = marked.join(wanted, "slot").where(may_be).select("_row", "words")

    def holds(c: Column) -> Column:
        here = F.slice("words", c["start"] + 1, c["length"])
        if exact:
            return F.array_join(here, " ") == c["passage"]
        theirs, ours = (F.array_distinct(_texts(x, c["length"], c["width"])) for x in (F.split(c["passage"], " "), here))
        return F.size(F.array_intersect(theirs, ours)) >= _least(F.size(theirs), containment)

    sure = candidates.join(texts, "_row").select("_row", F.filter("candidates", holds).alias("sure"))
    places = F.flatten(F.transform("sure", lambda c: F.sequence(c["start"], c["start"] + c["length"] - 1)))
    hits = sure.where(F.size("sure") > 0).select(
        "_row",
        F.array_sort(F.array_distinct(places)).alias("hit"),
        F.array_distinct(F.transform("sure", lambda c: c["passage"])).alias("passages"),
    )
    hits = scratch.keep(hits, "hits")

    pairs = hits.select("_row", F.explode("passages").alias("passage")).join(passages, "passage")
    listed = pairs.groupBy("_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    firsts = F.filter("hit", lambda x, i: (i == 0) | (F.get("hit", i - 1) != x - 1))
    lasts = F.filter("hit", lambda x, i: F.coalesce(F.get("hit", i + 1) != x + 1, F.lit(True)))
    spans = F.arrays_zip(firsts.alias("first"), lasts.alias("last")).cast("array<struct<first:int,last:int>>")
    told = hits.select("_row", F.size("hit").cast("long").alias("n_hit"), spans.alias("spans")).join(listed, "_row", "left")
    return scratch.keep(told, "told")


def _texts(words: Column, length: Column, width: Column) -> Column:
    """Shingles of a passage's words as texts."""
    return F.transform(F.sequence(F.lit(1), length - width + 1), lambda i: F.array_join(F.slice(words, i, width), " "))

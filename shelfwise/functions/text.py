"""Column expressions for review text and delimited lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.scalars import _col, strip

# Fixed values. Letters, digits and blanks are spelled as Unicode classes because
# the regex engine's own \w and \s cover ASCII only.
BLANK = r"\s\x0b\p{Z}\x1c-\x1f\x85"
KEPT = r"\p{L}\p{N}_.,;:\-!?'"
WORD = r"[\p{L}\p{N}_]{2,}"


def clean_review(c: Column | str) -> Column:
    """Drop symbols other than letters, digits and basic punctuation, collapse
    blanks (line breaks and tabs too) to one space and trim; null gives empty text."""
    plain = F.regexp_replace(F.coalesce(_col(c), F.lit("")), f"[^{KEPT}{BLANK}]+", "")
    return F.trim(F.regexp_replace(plain, f"[{BLANK}]+", " "))


def split_trim(c: Column | str, separator: str, drop_empty: bool = False) -> Column:
    """Delimited text → trimmed items; null counts as empty text."""
    items = F.transform(F.split(F.coalesce(_col(c), F.lit("")), separator), strip)
    return F.filter(items, lambda x: x != "") if drop_empty else items


def join_items(c: Column | str, separator: str) -> Column:
    """Items → delimited text."""
    return F.array_join(_col(c), separator)


def words(c: Column | str) -> Column:
    """Lower-case words of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(WORD), F.lit(0))


def pair_value(labels: Column | str, values: Column | str, wanted: str) -> Column:
    """Value standing at the position of the last label that contains ``wanted``."""
    pairs = F.arrays_zip(_col(labels).alias("k"), _col(values).alias("v"))
    hits = F.filter(pairs, lambda p: F.lower(strip(p["k"])).contains(wanted))
    return F.coalesce(strip(F.get(hits, F.size(hits) - 1)["v"]), F.lit(""))

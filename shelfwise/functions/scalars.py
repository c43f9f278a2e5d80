"""Column expressions for prices, dates, owner ranges and other scalars.

Every function takes a column name or Column and returns a Column made of
built-in expressions, so all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number shape, characters stripped around numbers, and
# the date patterns tried in turn. The guard keeps the two engines' casts equal
# ("5d", "1_0", "1,299.00" and "inf" are all null).
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER = r"^[+-]?\d+$"
BLANKS = " \t\n\r\f\u000b\u00a0"
DATE_PATTERNS = ("d MMM, yyyy", "MMM d, yyyy", "d MMMM, yyyy", "MMMM d, yyyy", "yyyy-MM-dd")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing blanks of every kind, not only spaces."""
    return F.btrim(_col(c), F.lit(BLANKS))


def safe_double(c: Column | str) -> Column:
    """Number from text; anything else is null."""
    text = strip(_col(c).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def safe_long(c: Column | str) -> Column:
    """Whole number from text; anything else is null."""
    text = strip(_col(c).cast("string"))
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def thousands_long(c: Column | str) -> Column:
    """Whole number with thousands commas."""
    return safe_long(F.replace(_col(c), F.lit(","), F.lit("")))


def parse_price(c: Column | str) -> Column:
    """``$14.99 USD`` → 14.99; text that is no plain amount is null."""
    bare = F.replace(F.replace(_col(c), F.lit("$"), F.lit("")), F.lit("USD"), F.lit(""))
    return safe_double(bare)


def format_price(c: Column | str) -> Column:
    """14.5 → ``$14.50``; null stays null."""
    return F.when(_col(c).isNotNull(), F.format_string("$%.2f", _col(c)))


def discount_fraction(current: Column | str, discounted: Column | str) -> Column:
    """``1 - discounted/current``; null (not an error) when current is zero."""
    return F.lit(1.0) - F.try_divide(_col(discounted), _col(current))


def parse_release_date(c: Column | str) -> Column:
    """First date pattern that fits; null for texts such as ``Coming soon``. All patterns
    have digits: a text without any is not tried with each of them, which is slow."""
    text = strip(c)
    return F.when(text.rlike(r"\p{Nd}"), F.coalesce(*[F.try_to_date(text, p) for p in DATE_PATTERNS]))


def date_text(c: Column | str) -> Column:
    """Date as ``YYYY-MM-DD`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def iso_text(c: Column | str) -> Column:
    """Timestamp as ISO text in UTC, ``2025-01-01T00:00:00Z``."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ssXXX")


def release_year(c: Column | str) -> Column:
    """Year of the parsed date, else the first four-digit 19xx/20xx in the text."""
    found = F.regexp_extract(_col(c), r"((?:19|20)\d{2})", 1)
    return F.coalesce(F.year(parse_release_date(c)), found.try_cast("int"))


def days_since(c: Column | str, as_of: str) -> Column:
    """Whole 24-hour days from a date to ``as_of``, truncated toward zero."""
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(
        _col(c).cast("timestamp")
    )
    return (seconds / F.lit(86400)).cast("int")


def log_mean(low: Column, high: Column) -> Column:
    """Geometric mean of a range; a zero bound gives 0, not null."""
    return F.when((low == 0) | (high == 0), F.lit(0.0)).when(
        (low > 0) & (high > 0), F.exp((F.ln(low) + F.ln(high)) / 2)
    )


def parse_owners(c: Column | str) -> Column:
    """``"20,000 .. 50,000"`` → struct(owner_min, owner_max, owners_log_mean).

    Text that is not exactly two whole numbers gives three nulls.
    """
    ends = F.split(F.replace(_col(c), F.lit(","), F.lit("")), r"\.\.")

    def fields(numbers: Column) -> Column:
        low, high = F.get(numbers, F.lit(0)), F.get(numbers, F.lit(1))
        good = (F.size(numbers) == 2) & low.isNotNull() & high.isNotNull()
        return F.struct(
            F.when(good, low.cast("double")).alias("owner_min"),
            F.when(good, high.cast("double")).alias("owner_max"),
            F.when(good, log_mean(low, high)).alias("owners_log_mean"),
        )

    # The numbers are parsed once and bound to a name: each field mentions them many times.
    return F.get(F.transform(F.array(F.transform(ends, safe_long)), fields), F.lit(0))


def mentions(c: Column | str, word: str) -> Column:
    """Case-insensitive substring test; null text does not mention anything."""
    return F.coalesce(F.lower(_col(c)).contains(word.lower()), F.lit(False))


def finite_or_zero(c: Column | str) -> Column:
    """Null, NaN and both infinities become 0."""
    value = _col(c).cast("double")
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.coalesce(F.when(~bad, value), F.lit(0.0))


def bucket_of(c: Column | str, width: int = 5) -> Column:
    """Number of the half-open bucket ``[width*b, width*(b+1))`` holding the day."""
    return F.floor(_col(c) / F.lit(width)).cast("bigint")


def append_text(c: Column | str, suffix: str) -> Column:
    """Text with a suffix; null counts as empty text."""
    return F.concat(F.coalesce(_col(c), F.lit("")), F.lit(suffix))


def scale_by_day(c: Column | str, day: Column | str, rate: float = 0.1) -> Column:
    """``x * (1 + rate * day)``."""
    return _col(c) * (F.lit(1.0) + F.lit(rate) * _col(day))


def floor_at(c: Column | str, cut: Column | int, bound: int) -> Column:
    """``max(x - cut, bound)``; null stays null."""
    cut = F.lit(cut) if isinstance(cut, int) else cut
    return F.when(_col(c).isNotNull(), F.greatest(_col(c) - cut, F.lit(bound)))


def hash_int(*parts: Column | str) -> Column:
    """Repeatable 32-bit whole number from the given values (md5 based)."""
    text = F.concat_ws("-", *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def flag_list(c: Column | str, flags: dict[str, str]) -> Column:
    """Sorted, comma-joined labels of the substrings that occur in the text."""
    labels = [F.when(_col(c).contains(part), F.lit(label)) for part, label in flags.items()]
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ", ")


def first_present(*cols: Column) -> Column:
    """First value that is neither null nor empty text."""
    return reduce(lambda a, b: F.coalesce(a, b), [F.nullif(c, F.lit("")) for c in cols])


def json_field(c: Column | str, name: str, default: str | None = None) -> Column:
    """Text of a top-level JSON key, or the default when it is absent."""
    value = F.get_json_object(_col(c), f"$.{name}")
    return value if default is None else F.coalesce(value, F.lit(default))

"""Scalar and text expressions on literal and odd values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import metrics, scalars, text


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "value, wanted",
    [
        ("$20.00", 20.0), ("USD 15", 15.0), ("  $100 ", 100.0), ("  $ 30.5 ", 30.5), ("$14.99 USD", 14.99), ("\t$5\n", 5.0),
        ("Free", None), (None, None), ("invalid", None), ("$7.99 USD / month", None), ("5d", None), ("1_0", None),
        ("1,299.00", None), ("inf", None), ("", None),
    ],
)
def test_parse_price(spark, value, wanted):
    assert one(spark, scalars.parse_price("x"), value) == [wanted]


@pytest.mark.parametrize(
    "value, wanted",
    [
        ("0 .. 20,000", (0.0, 20000.0, 0.0)),
        ("50000..100000", (50000.0, 100000.0, 70710.678119)),
        ("100,000,000 .. 200,000,000", (1e8, 2e8, 141421356.23731)),
        ("", (None,) * 3), ("abc", (None,) * 3), ("1 .. 2 .. 3", (None,) * 3), (None, (None,) * 3), ("5 ..", (None,) * 3),
    ],
)
def test_parse_owners(spark, value, wanted):
    got = one(spark, scalars.parse_owners("x"), value)[0]
    assert tuple(None if g is None else round(g, 6) for g in got) == wanted


def test_dates(spark):
    values = ("21 Aug, 2012", "Aug 21, 2012", "2012-08-21", "Coming soon", "Q3 2025", None)
    day = dt.date(2012, 8, 21)
    assert one(spark, scalars.parse_release_date("x"), *values) == [day, day, day, None, None, None]
    assert one(spark, scalars.release_year("x"), *values) == [2012, 2012, 2012, None, 2025, None]


def test_days_truncate_toward_zero(spark):
    days = scalars.days_since(F.to_date("x"), "2025-06-16 12:00:00")
    assert one(spark, days, "2012-08-21", "2025-06-19", "2025-06-16", None) == [4682, -2, 0, None]


def test_zero_price_gives_no_error(spark):
    df = spark.createDataFrame([(0.0, 5.0), (0.0, 0.0), (20.0, 10.0)], "c double, d double")
    assert [r[0] for r in df.select(scalars.discount_fraction("c", "d")).collect()] == [None, None, 0.5]


def test_clean_review(spark):
    values = ("Да было!\n\n 无法玩了，😀 ok_1", " a\x0bb\t\tc ", "x@y#z", None, "😀")
    assert one(spark, text.clean_review("x"), *values) == ["Да было! 无法玩了 ok_1", "a b c", "xyz", "", ""]


def test_cleaning_parts_equals_cleaning_the_whole(spark):
    texts = ["a  b\n", "😀", "\tc@d ", "é!", ""]
    whole = one(spark, text.clean_review("x"), " ".join(texts))
    parts = [p for p in one(spark, text.clean_review("x"), *texts) if p]
    assert whole == [" ".join(parts)]


def test_lists(spark):
    assert one(spark, text.split_trim("x", ";"), "Action;", " A ; B", None) == [["Action", ""], ["A", "B"], [""]]
    assert one(spark, text.split_trim("x", ";", True), "Action;", None) == [["Action"], []]
    assert one(spark, text.words("x"), "It's a Träum_1, é!", None) == [["it", "träum_1"], []]


def test_flags_and_buckets(spark):
    flags = scalars.flag_list("x", {"win": "Windows", "mac": "Mac", "linux": "Linux"})
    assert one(spark, flags, "linux win win", "none", "mac") == ["Linux, Windows", "", "Mac"]
    assert one(spark, scalars.bucket_of(F.col("x").cast("int")), "-2", "0", "4", "5") == [-1, 0, 0, 1]
    assert one(spark, scalars.floor_at(F.col("x").cast("int"), 3, 40), "90", "41", None) == [87, 40, None]
    assert one(spark, scalars.append_text("x", ";New"), "A", None) == ["A;New", ";New"]
    assert one(spark, scalars.format_price(F.col("x").cast("double")), "14.5", None) == ["$14.50", None]


def test_finite_or_zero(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (None,), (2.5,)], "x double")
    assert [r[0] for r in df.select(scalars.finite_or_zero("x")).collect()] == [0.0, 0.0, 0.0, 0.0, 2.5]


def test_mape(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 310.0)], "y double, p double")
    assert round(df.agg(metrics.mape("y", "p")).first()[0], 2) == 6.11
    zero = spark.createDataFrame([(0.0, 5.0), (100.0, 110.0)], "y double, p double")
    assert zero.agg(metrics.mape("y", "p")).first()[0] == pytest.approx(10.0)
    assert zero.where("y = 0").agg(metrics.mape("y", "p")).first()[0] is None


def test_pair_value(spark):
    df = spark.createDataFrame([(["Developer:", "Publisher:"], ["A ", "B"]), (["x"], ["y"])], "k array<string>, v array<string>")
    assert [r[0] for r in df.select(text.pair_value("k", "v", "publisher")).collect()] == ["B", ""]

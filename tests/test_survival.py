"""Survival functions against closed forms and full enumeration."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import survival
from shelfwise.operators import drift


def value(spark, rows, schema, expression):
    df = spark.createDataFrame(rows, schema)
    return [r.v for r in df.select(expression(*[F.col(c) for c in df.columns]).alias("v")).collect()]


def test_normal_tails(spark):
    points = [0.0, 1e-9, 0.1, 0.5, 1.0, 1.4, 1.5, 1.959963984540054, 2.0, 3.0, 5.0, 8.0, 37.0, -1.0, 600.0]
    got = value(spark, [(z,) for z in points] + [(None,)], "z double", survival.normal_tails)
    assert got[-1] is None
    for z, p in zip(points, got):
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-12)


def test_chi_square_tails(spark):
    def closed(x, k):
        h = x / 2
        if k % 2 == 0:
            return math.exp(-h) * sum(h**i / math.factorial(i) for i in range(k // 2))
        return math.erfc(math.sqrt(h)) + math.exp(-h) * sum(h ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, (k + 1) // 2))

    rows = [(x, k) for x in (0.0, 0.01, 0.7, 1.0, 3.841459, 9.0, 30.0, 55.5, 120.0) for k in (1, 2, 3, 4, 5, 10, 31, 60, 100)]
    for (x, k), p in zip(rows, value(spark, rows, "x double, k int", survival.chi_square_tail)):
        assert p == pytest.approx(closed(x, k), abs=1e-11)
    # fixed values of printed tables: 5 % points
    table = [(3.841458820694124, 1), (18.307038053275146, 10), (124.34211340400407, 100), (1074.6794495, 1000), (10233.7489, 10000)]
    for p in value(spark, table, "x double, k int", survival.chi_square_tail):
        assert p == pytest.approx(0.05, abs=1e-6)


def test_log_gamma(spark):
    points = [0.5, 1.0, 1.5, 2.0, 7.25, 100.0, 12345.5]
    assert value(spark, [(x,) for x in points], "x double", survival.log_gamma) == pytest.approx([math.lgamma(x) for x in points], abs=1e-9)


def distances(n, m):
    """The distance of every order of n and m pooled values."""
    for order in itertools.combinations(range(n + m), n):
        i, j, most = 0, 0, 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in order else (i, j + 1)
            most = max(most, abs(i * m - j * n))
        yield most


def test_exact_distance_tails_count_all_orders(spark):
    for n, m in ((1, 1), (1, 5), (4, 4), (6, 3), (5, 7)):
        all_ = list(distances(n, m))
        rows = [(d / (n * m), n, m) for d in sorted(set(all_))] + [(0.0, n, m)]
        got = value(spark, rows, "d double, n long, m long", survival.distance_exact_tail)
        for (d, *_), p in zip(rows, got):
            assert p == pytest.approx(sum(x >= round(d * n * m) for x in all_) / len(all_), abs=1e-12)


def test_limit_of_the_distance(spark):
    got = value(spark, [(x,) for x in (0.0, 0.3, 0.828, 0.99, 1.0, 1.3580986, 1.6276236, 5.0)] + [(None,)], "x double", survival.distance_limit_tail)
    direct = lambda x: 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 400))
    assert got[:-1] == pytest.approx([1.0, direct(0.3), direct(0.828), direct(0.99), direct(1.0), 0.05, 0.01, direct(5.0)], abs=1e-7)
    assert got[-1] is None
    close, limit = value(spark, [(0.05, 900, 1000)], "d double, n long, m long", survival.distance_tail), value(
        spark, [(0.05, 900, 1000)], "d double, n long, m long", lambda d, n, m: survival.distance_tail(d, n, m, cells=10)
    )
    assert close == pytest.approx(limit, abs=0.03) and close != limit


def test_p_values_of_drift_rows(spark):
    ref = spark.createDataFrame([(float(i), i % 2, i % 4) for i in range(200)], "a double, b int, c int")
    cur = spark.createDataFrame([(float(i) + 60, int(i % 10 == 0), i % 5, 0) for i in range(150)], "a double, b int, c int, bucket int")
    told = {r.column_name: r for r in drift.with_p_values(drift.numeric_drift(ref, cur, ["a", "b", "c"], "bucket")).collect()}
    assert (told["a"].test, told["b"].test, told["c"].test) == ("ks", "z", "chi_square")
    assert told["c"].p_value == 0.0 and told["c"].new_values > 0
    assert all(r.drifted_by_p and r.drift_score == r.p_value < 0.05 for r in told.values())
    same = {r.column_name: r for r in drift.with_p_values(drift.numeric_drift(ref, ref.withColumn("bucket", F.lit(0)), ["a", "b", "c"], "bucket")).collect()}
    assert all(r.p_value == pytest.approx(1.0) and not r.drifted_by_p for r in same.values())

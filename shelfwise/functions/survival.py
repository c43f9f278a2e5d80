"""Survival functions of test statistics as column expressions: how likely a larger value is by chance.

All are folds over sequences of built-in arithmetic, so they run where the
statistics are. A null in gives a null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_CELLS = 1_000_000  # product of the sizes up to which the two-sample distance is counted exactly
_SHIFT = 8
# Coefficients of Stirling's series, by odd powers of 1 / z.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
_SERIES_TERMS = 20  # of the limit distribution; the first left out is below 1e-100


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of a positive number, to some 1e-13."""
    z = x + F.lit(float(_SHIFT))
    tail = sum(F.lit(k) / F.pow(z, F.lit(2.0 * i + 1)) for i, k in enumerate(_STIRLING))
    down = sum(F.log(x + F.lit(float(i))) for i in range(_SHIFT))
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + tail - down


def gamma_upper(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function: a series below a + 1, a continued fraction above."""
    terms = F.sequence(F.lit(1), (F.lit(200.0) + F.sqrt(a) * 12).cast("int"))
    front = F.exp(a * F.log(x) - x - log_gamma(a))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] * x / (a + i)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    first = F.lit(1.0) / a
    lower = F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), add, lambda s: s["total"])

    def deepen(state: Column, i: Column) -> Column:
        over = i * (a - i)
        b = x + 1 - a + i * 2
        d = F.lit(1.0) / (over * state["d"] + b)
        c = b + over / state["c"]
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    top = F.lit(1.0) / (x + 1 - a)
    start = F.struct(F.lit(1e300).alias("c"), top.alias("d"), top.alias("h"))
    upper = F.aggregate(terms, start, deepen, lambda s: s["h"])
    below = F.greatest(F.lit(0.0), 1 - front * lower)
    return F.when(x <= 0, F.lit(1.0)).when(x > 1e5 + a * 4, F.lit(0.0)).when(x < a + 1, below).when(x.isNotNull() & a.isNotNull(), front * upper)


def chi_square_tail(statistic: Column, freedom: Column) -> Column:
    """Chance of a larger chi-square statistic."""
    return gamma_upper(freedom.cast("double") / 2, statistic.cast("double") / 2)


def normal_tails(z: Column) -> Column:
    """Chance of a standard normal value further from 0, on either side."""
    return gamma_upper(F.lit(0.5), z * z / 2)


def distance_limit_tail(scaled: Column) -> Column:
    """Chance that the scaled distance of two large samples is larger (Kolmogorov's distribution)."""
    signs = [(2.0 if k % 2 else -2.0, k) for k in range(1, _SERIES_TERMS + 1)]
    far = sum(F.lit(s) * F.exp(scaled * scaled * F.lit(-2.0 * k * k)) for s, k in signs)
    odd = sum(F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8) / (scaled * scaled)) for k in range(1, _SERIES_TERMS + 1))
    near = 1 - F.lit(math.sqrt(2 * math.pi)) / scaled * odd
    return F.when(scaled <= 0, F.lit(1.0)).when(scaled < 1.0, near).when(scaled.isNotNull(), far)


def distance_exact_tail(distance: Column, n: Column, m: Column) -> Column:
    """Chance that two samples of sizes ``n`` and ``m`` of one continuous distribution are at least ``distance`` apart.

    Of the orders of the pooled values all are equally likely; an order is a path from (0, 0) to
    (n, m), and the distance is reached if it leaves the band ``|i / n - j / m| < distance``.
    The share of paths to (i, j) that stay inside follows from the two places before it;
    all places of one sum i + j are one array, so the fold takes n + m steps.
    """
    few, many = F.least(n, m).cast("long"), F.greatest(n, m).cast("long")
    reach = F.round(distance * few * many).cast("long")
    places = F.sequence(F.lit(0).cast("long"), few)

    def step(inside: Column, s: Column) -> Column:
        def share(i: Column) -> Column:
            j = s - i
            went = F.coalesce(F.get(inside, (i - 1).cast("int")), F.lit(0.0)) * i + F.get(inside, i.cast("int")) * j
            within = (j >= 0) & (j <= many) & (F.abs(i * many - j * few) < reach)
            return F.when(within, went / s).otherwise(0.0)

        return F.transform(places, share)

    start = F.transform(places, lambda i: F.when(i == 0, 1.0).otherwise(0.0))
    stay = F.aggregate(F.sequence(F.lit(1).cast("long"), few + many), start, step, lambda a: F.element_at(a, -1))
    return F.when(reach <= 0, F.lit(1.0)).when(reach.isNotNull(), F.greatest(F.lit(0.0), 1 - stay))


def distance_tail(distance: Column, n: Column, m: Column, cells: int = EXACT_CELLS) -> Column:
    """Exact up to ``cells`` for the product of the sizes, the limit distribution beyond."""
    scaled = distance * F.sqrt(F.try_divide(n.cast("double") * m, n + m))
    small = n.cast("double") * m <= cells
    known = distance.isNotNull() & (n > 0) & (m > 0)
    return F.when(known & small, distance_exact_tail(distance, n, m)).when(known, distance_limit_tail(scaled))

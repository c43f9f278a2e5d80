"""Aggregate expressions for prediction quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.scalars import _col


def mae(y: Column | str, p: Column | str) -> Column:
    """Mean absolute error."""
    return F.avg(F.abs(_col(y) - _col(p)))


def rmse(y: Column | str, p: Column | str) -> Column:
    """Root of the mean squared error."""
    return F.sqrt(F.avg(F.pow(_col(y) - _col(p), F.lit(2.0))))


def mape(y: Column | str, p: Column | str) -> Column:
    """Mean absolute error in percent of y over rows with ``y != 0``."""
    y, p = _col(y), _col(p)
    return F.avg(F.when(y != 0, F.abs(F.try_divide(y - p, y)))) * 100


def population_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation; null (not an error) when a side is constant."""
    x, y = _col(x), _col(y)
    spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
    return F.covar_pop(x, y) / spread

"""Queries of this subpackage and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def reachable(spark: SparkSession) -> SparkSession:
    """The session, whose Python workers also look for this library where the driver has it.

    That is enough where executors see the driver's folders; elsewhere the library is
    installed on them or sent with ``--py-files``, as any package.
    """
    root, environment = os.path.abspath(os.path.join(os.path.dirname(__file__), "..", "..")), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf: fn(configure(reachable(spark)), sf)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add

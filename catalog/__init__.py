"""Registered queries and, next to each, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame``."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(use_utc(spark), sf_dir)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


from tidepoint.session import use_utc  # noqa: E402

from catalog import (  # noqa: E402,F401
    checks,
    discovery,
    encoding,
    mapping,
    progress,
    scans,
    slicing,
    transfers,
)

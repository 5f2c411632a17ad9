"""Registration of the corpus queries and what they share with the executors."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepoint.session import use_utc

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver found it."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
    return spark


def llm_query(name: str, sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` and the SQL for the same rows."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(importable(use_utc(spark)), sf_dir)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        LLM_QUERIES[name] = run
        if sql is not None:
            LLM_ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

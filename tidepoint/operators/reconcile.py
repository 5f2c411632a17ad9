"""Compare what a source holds with what its target holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: rows shown when a comparison is sampled.
SAMPLE_SIZE = 100


def reconcile(
    source: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Status per key: ``same``, ``changed``, ``missing`` (in the target) or ``extra``.

    Both sides are counted per (key, values) and those counts rolled up per key. This
    compares whole multisets exactly, yet never pairs the copies of a key with each other as
    an outer join would, and copies of a hot key are merged before each shuffle.
    """
    columns = [*keys, *values]
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    left = source.select(*columns, one.alias("_s"), zero.alias("_t"))
    right = target.select(*columns, zero.alias("_s"), one.alias("_t"))
    per_row = (
        left.unionByName(right)
        .groupBy(*columns)
        .agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    )
    status = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "extra")
        .when(
            (F.col("source_rows") == F.col("_both")) & (F.col("target_rows") == F.col("_both")),
            "same",
        )
        .otherwise("changed")
    )
    return (
        per_row.groupBy(*keys)
        .agg(
            F.sum("_s").alias("source_rows"),
            F.sum("_t").alias("target_rows"),
            F.sum(F.least("_s", "_t")).alias("_both"),
        )
        .withColumn("status", status)
        .drop("_both")
    )


def differences(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows one side holds more often than the other, with the surplus per side."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    counted = (
        source.select(*columns, one.alias("_s"), zero.alias("_t"))
        .unionByName(target.select(*columns, zero.alias("_s"), one.alias("_t")))
        .groupBy(*columns)
        .agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
        .where(F.col("_s") != F.col("_t"))
    )
    return counted.select(
        *columns,
        F.greatest(F.col("_s") - F.col("_t"), zero).alias("only_source"),
        F.greatest(F.col("_t") - F.col("_s"), zero).alias("only_target"),
    )


def status_totals(compared: DataFrame) -> DataFrame:
    return compared.groupBy("status").agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("source_rows").alias("source_rows"),
        F.sum("target_rows").alias("target_rows"),
    )


def sample_differences(
    compared: DataFrame, keys: Sequence[str], n: int = SAMPLE_SIZE
) -> DataFrame:
    """The first ``n`` differing keys in key order, the same ones on every run."""
    return compared.where(F.col("status") != "same").orderBy(*keys).limit(n)

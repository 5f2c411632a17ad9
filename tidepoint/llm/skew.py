"""Joins with a table of groups, some of which may hold a large part of all rows.

A group is heavy if it holds at least one in ``HEAVY`` of the counted rows, so there are at
most ``HEAVY`` heavy groups whatever the input's size, and those are broadcast. The rows of
all other groups are shuffled, and none of these groups can fill more than that share of a
task. A row that met a heavy group goes on under a random key, so it gathers nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY = 10_000


def _random_key(column: str) -> Column:
    """A key of no group, other for other values; null, which joins nothing, for null."""
    return F.encode(F.concat(F.lit("-"), F.col(column).cast("string")), "UTF-8")


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    size: str,
    spread_by: str,
    heavy: int = HEAVY,
    inner: bool = True,
) -> DataFrame:
    """``rows`` with the columns of their group in ``groups``; ``key`` is binary.

    ``groups`` has a row per key and should be fixed in storage. ``size`` is its column of row
    counts, ``spread_by`` a column of ``rows`` with many values. Rows of no group are left out,
    or have nulls if not ``inner``.
    """
    total = groups.agg(F.sum(size).alias("n")).first().n or 0
    large = F.col(size) * F.lit(heavy) >= F.lit(total)
    own = [c for c in groups.columns if c != key]
    light = groups.where(~large).select(F.col(key).alias("_key"), F.struct(*own).alias("_light"))
    top = groups.where(large).select(key, F.struct(*own).alias("_heavy"))
    met = rows.join(F.broadcast(top), key, "left")
    dealt = F.when(
        F.col("_heavy").isNull(), F.col(key)
    ).otherwise(_random_key(spread_by))
    found = met.withColumn("_key", dealt).join(light, "_key", "left")
    merged = found.withColumn("_group", F.coalesce("_heavy", "_light"))
    kept = [F.col(c) for c in rows.columns]
    return (merged.where("_group is not null") if inner else merged).select(
        *kept, *[F.col("_group")[c].alias(c) for c in own]
    )

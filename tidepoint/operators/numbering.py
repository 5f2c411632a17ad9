"""Consecutive numbers in a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepoint.functions.columns import named, spare_name
from tidepoint.points import check_batch_size, check_series_per_query
from tidepoint.session import pin, small_or_pinned


def number_rows(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], out: str = "row_no"
) -> DataFrame:
    """Number the rows of each group 1, 2, 3 … in ``order_by``.

    ``row_number()`` over a group sorts the whole group in one task. Here the rows are range
    partitioned by (group, order), so a group of any size spreads over many tasks; each
    partition then counts its own rows of a group and adds what the partitions before it
    hold. ``order_by`` must be total up to fully equal rows, which are spread by a random
    last key. The placement is pinned to reliable storage because counts and rows must
    agree on it even when a lost task is run again. The counts have a row per partition and
    group; few of them are joined as a local relation, which leaves the pinned rows in place.
    """
    salt, part, pos, first, n, shift = (
        spare_name(df.columns, c) for c in ("_salt", "_part", "_pos", "_first", "_n", "_shift")
    )
    keys = [*group_by, *order_by, salt]
    placed = (
        df.withColumn(salt, F.rand(11))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(salt)
        .withColumn(part, F.spark_partition_id())
        .withColumn(pos, F.monotonically_increasing_id())
    )
    placed = pin(placed)
    counts = placed.groupBy(part, *group_by).agg(
        F.min(pos).alias(first), F.count(F.lit(1)).alias(n)
    )
    before = Window.partitionBy(*group_by).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = small_or_pinned(
        counts.select(
            part,
            *group_by,
            (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(first) + 1).alias(shift),
        )
    )
    left, right = placed.alias("l"), offsets.alias("r")
    on = reduce(
        lambda a, b: a & b,
        [F.col(f"l.{part}") == F.col(f"r.{part}")]
        + [named(g, "l").eqNullSafe(named(g, "r")) for g in group_by],
    )
    number = (F.col(f"l.{pos}") + F.col(f"r.{shift}")).cast("bigint")
    return left.join(right, on).select(*[named(c, "l") for c in df.columns], number.alias(out))


def _batch_of(row_no: str, size: int):
    n = F.lit(size).cast("bigint")
    return F.call_function("div", F.col(row_no) - 1, n)


def series_batches(
    series: DataFrame,
    size: int = 0,
    group_by: Sequence[str] = ("measurement",),
    key: str = "series_key",
) -> DataFrame:
    """Consecutive groups of ``size`` series in key order, numbered from 0 within each group."""
    size = check_series_per_query(max(size, 0))
    number = spare_name(series.columns, "_no")
    numbered = number_rows(series, group_by, [key], number)
    return numbered.withColumn("batch_id", _batch_of(number, size)).drop(number)


def chunk_batches(
    points: DataFrame, size: int, group_by: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Chunks of ``size`` points in time order; adds ``row_no`` and ``batch_id`` (from 0)."""
    size = check_batch_size(size)
    numbered = number_rows(points, group_by, order_by, "row_no")
    return numbered.withColumn("batch_id", _batch_of("row_no", size))

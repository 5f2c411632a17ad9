"""What time is covered, and what is still open: union and difference of half-open intervals.

Both are sweeps over the sorted ends of intervals, per key, as window functions; interval
tables are metadata, a row per window of a run, and no interval is compared with another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _edges(intervals: DataFrame, keys: Sequence[str], start: str, end: str, **counts) -> DataFrame:
    """Each interval as a step up at its start and a step down at its end."""
    steps = F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("step")),
        F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")),
    )
    rows = intervals.where(F.col(start) < F.col(end)).select(
        *keys, F.explode(steps).alias("edge")
    )
    return rows.select(
        *keys,
        "edge.at",
        *[(F.col("edge.step") * F.lit(weight)).alias(name) for name, weight in counts.items()],
    )


def _segments(edges: DataFrame, keys: Sequence[str], *depths: str) -> DataFrame:
    """Stretches between neighbouring ends, with how many intervals of each kind hold them."""
    order = Window.partitionBy(*keys).orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    merged = edges.groupBy(*keys, "at").agg(*[F.sum(d).alias(d) for d in depths])
    return merged.select(
        *keys,
        F.col("at").alias("start_ns"),
        F.lead("at").over(order).alias("end_ns"),
        *[F.sum(d).over(so_far).alias(d) for d in depths],
    ).where(F.col("end_ns").isNotNull())


def _islands(segments: DataFrame, keys: Sequence[str], new: Column) -> DataFrame:
    """Neighbouring segments joined up; ``new`` is true where one may not be joined on."""
    order = Window.partitionBy(*keys).orderBy("start_ns")
    first = F.lag("end_ns").over(order).isNull() | (
        F.lag("end_ns").over(order) < F.col("start_ns")
    )
    return (
        segments.withColumn("_new", (first | new).cast("int"))
        .withColumn(
            "_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(*keys, "_island")
        .agg(F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns"))
        .drop("_island")
    )


def covered_ranges(
    intervals: DataFrame, keys: Sequence[str], start: str = "start_ns", end: str = "end_ns"
) -> DataFrame:
    """The union of intervals per key, as the fewest ranges: ``keys, start_ns, end_ns``.

    Intervals that touch are joined. Empty intervals count for nothing.
    """
    held = _segments(_edges(intervals, keys, start, end, n=1), keys, "n").where("n > 0")
    return _islands(held, keys, F.lit(False))


def uncovered_ranges(
    wanted: DataFrame,
    done: DataFrame,
    keys: Sequence[str],
    start: str = "start_ns",
    end: str = "end_ns",
) -> DataFrame:
    """The parts of ``wanted`` that no interval of ``done`` with the same keys covers.

    Widths need not agree. Parts end where an interval of ``wanted`` begins or ends, so each
    lies in the intervals it comes from: ``keys, start_ns, end_ns``.
    """
    edges = _edges(wanted, keys, start, end, w=1, d=0, cut=1).unionByName(
        _edges(done, keys, start, end, w=0, d=1, cut=0)
    )
    cuts = edges.where("cut <> 0").select(*keys, F.col("at").alias("start_ns")).distinct()
    open_ = _segments(edges, keys, "w", "d").where("w > 0 and d = 0")
    marked = open_.join(cuts.withColumn("_cut", F.lit(True)), [*keys, "start_ns"], "left")
    return _islands(marked, keys, F.coalesce("_cut", F.lit(False)))

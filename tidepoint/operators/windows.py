"""Time slicing: window split, window of a point, shard overlap and clip."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from functools import reduce
from itertools import pairwise
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepoint.functions.columns import spare_name
from tidepoint.functions.timefn import ns_floor_div
from tidepoint.operators.sweep import located
from tidepoint.session import small_or_pinned

QUANTILE_ACCURACY = 100_000
GATHERED_ROWS = 100_000


def _long(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("bigint")


def window_start_of(time_ns: Column, width_ns: int, origin_ns: int | Column = 0) -> Column:
    """Start of the grid window of a time. Integer arithmetic: exact at the borders, no join."""
    return time_ns - F.pmod(time_ns - _long(origin_ns), _long(width_ns))


def split_windows(ranges: DataFrame, start: str, end: str, width_ns: int) -> DataFrame:
    """One row per half-open window of ``[start, end)``, the last one clipped.

    A width of zero or less gives one window over the whole range; an empty range gives none.
    Adds ``window_no, window_start, window_end``.
    """
    low, high = F.col(start), F.col(end)
    ranges = ranges.where(low < high)
    if width_ns <= 0:
        return ranges.withColumns(
            {"window_no": F.lit(0).cast("bigint"), "window_start": low, "window_end": high}
        )
    width = _long(width_ns)
    last = ns_floor_div(high - low - 1, width_ns)
    numbered = ranges.withColumn("window_no", F.explode(F.sequence(_long(0), last)))
    begin = low + F.col("window_no") * width
    return numbered.withColumns(
        {"window_start": begin, "window_end": F.least(begin + width, high)}
    )


def overlapping(
    groups: DataFrame, query_start: int | Column, query_end: int | Column
) -> DataFrame:
    """Shard groups that share time with the half-open query range; touching is not sharing."""
    return groups.where(
        (F.col("start_ns") < _long(query_end)) & (F.col("end_ns") > _long(query_start))
    )


def clipped(groups: DataFrame, query_start: int | Column, query_end: int | Column) -> DataFrame:
    """Adds ``eff_start, eff_end``: the part of each shard group inside the query range."""
    return groups.withColumns(
        {
            "eff_start": F.greatest(F.col("start_ns"), _long(query_start)),
            "eff_end": F.least(F.col("end_ns"), _long(query_end)),
        }
    )


def assign_intervals(
    points: DataFrame,
    intervals: DataFrame,
    cell_ns: int,
    time: str = "time_ns",
    start: str = "start_ns",
    end: str = "end_ns",
) -> DataFrame:
    """Join points to the irregular half-open intervals that hold them.

    Each interval is listed under every grid cell it touches and each point under its own
    cell, which turns the range join into an equi-join on the cell. ``cell_ns`` is best near
    the usual interval length. The intervals are evaluated first: few of them reach the plan
    as a local relation, whose true size lets Spark broadcast it, so the points stay in place.
    """
    first = ns_floor_div(F.col(start), cell_ns)
    last = ns_floor_div(F.col(end) - 1, cell_ns)
    cell = spare_name([*points.columns, *intervals.columns], "_cell")
    listed = small_or_pinned(
        intervals.where(F.col(start) < F.col(end)).withColumn(
            cell, F.explode(F.sequence(first, last))
        )
    )
    keyed = points.withColumn(cell, ns_floor_div(F.col(time), cell_ns))
    inside = (F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))
    return keyed.join(listed, cell).where(inside).drop(cell)


def window_summary(points: DataFrame, keys: Sequence[str], time: str = "time_ns") -> DataFrame:
    """Processed rows and progress mark (latest time) per work unit."""
    return points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"), F.max(time).alias("last_time_ns")
    )


def _more_bounds(
    times: DataFrame, brackets: dict[tuple[int, int], list[float]], accuracy: int
) -> list[int]:
    """Bounds around the times at the given shares of the rows of each bracket, by sketches."""
    t, proposed = F.col("t"), []
    for (low, end), shares in brackets.items():
        # The sketch works on doubles: offsets where they hold them, else whole cells of 1,024 ns.
        value = t - _long(low) if end - low <= 2**53 else F.shiftright(t, 10)
        inside = F.when((t >= _long(low)) & (t < _long(end)), value)
        spread = sorted({min(max(s + d / accuracy, 0.0), 1.0) for s in shares for d in (-2, 0, 2)})
        proposed.append(
            F.percentile_approx(inside, F.array(*map(F.lit, spread)), F.lit(accuracy))
        )
    bounds = set()
    for (low, end), cuts in zip(brackets, times.agg(*proposed).first(), strict=True):
        narrow = end - low <= 2**53
        for cut in set(cuts):
            cell = (low + cut, low + cut + 1) if narrow else (cut << 10, (cut + 1) << 10)
            bounds.update(b for b in cell if low < b < end)
    return sorted(bounds)


def times_at_ranks(
    times: DataFrame, parts: int, accuracy: int = QUANTILE_ACCURACY, gathered: int = GATHERED_ROWS
) -> list[int]:
    """The least time, the first times by which ``i / parts`` of all rows are seen, one after the last.

    ``times``: one column ``t`` without nulls, read several times. Sketches only propose bounds;
    rows below a bound are counted, and a bracket between two bounds is narrowed until it is a
    single time or few rows are left, whose times are counted one by one. So the result is exact
    whatever the sketch, and the driver gets a number per bound and at most ``gathered`` times.
    """
    ends = times.agg(F.min("t"), F.max("t"), F.count("t")).first()
    if ends[0] is None:
        return []
    below = {ends[0]: 0, ends[1] + 1: ends[2]}
    ranks = np.array([-(-i * ends[2] // parts) for i in range(1, parts)], np.int64)
    while True:
        bounds = np.array(sorted(below), np.int64)
        rows = np.array([below[b] for b in bounds.tolist()], np.int64)
        at = np.searchsorted(rows, ranks, "left")
        wanted = {}
        for j, rank in zip(at.tolist(), ranks.tolist(), strict=True):
            low, end = int(bounds[j - 1]), int(bounds[j])
            if end - low > 1:
                share = (rank - below[low]) / (below[end] - below[low])
                wanted.setdefault((low, end), []).append(share)
        if not wanted:
            return sorted({ends[0], *bounds[at - 1].tolist(), ends[1] + 1})
        if sum(below[end] - below[low] for low, end in wanted) <= gathered:
            t = F.col("t")
            inside = [(t >= _long(low)) & (t < _long(end)) for low, end in wanted]
            counted = times.where(reduce(or_, inside)).groupBy("t").count().collect()
            upto = {low: below[low] for low, _ in wanted}
            starts = sorted(upto)
            for time, count in sorted(counted):
                low = starts[bisect_right(starts, time) - 1]
                below[time] = upto[low]
                upto[low] += count
                below[time + 1] = upto[low]
            continue
        finer = np.array(sorted({*bounds.tolist(), *_more_bounds(times, wanted, accuracy)}), np.int64)
        counts = np.zeros(len(finer), np.int64)
        for r, count in times.groupBy(located(finer)("t").alias("r")).count().collect():
            counts[r] = count
        below = dict(zip(finer.tolist(), [0, *np.cumsum(counts)[:-1].tolist()], strict=True))


def balanced_windows(
    points: DataFrame, parts: int, time: str = "time_ns", accuracy: int = QUANTILE_ACCURACY
) -> DataFrame:
    """At most ``parts`` half-open windows that hold like numbers of points.

    ``window_no, window_start, window_end``. Bounds are the exact quantiles of the times: a
    window begins at the first time by which its share of all points is seen. They are found by
    a few aggregates over the points, which are read several times and must be the same each
    time; ``accuracy`` is that of the sketches and changes no result. Times that very many
    points share make fewer windows. Points without a time are in none.
    """
    t = F.col(time).cast("bigint").alias("t")
    bounds = times_at_ranks(points.select(t).where("t is not null"), parts, accuracy)
    windows = [(i, *ends) for i, ends in enumerate(pairwise(bounds))]
    return points.sparkSession.createDataFrame(
        windows, "window_no int, window_start bigint, window_end bigint"
    )

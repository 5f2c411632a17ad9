"""Row predicates: time range, tag filters, series sets and resume positions."""

from __future__ import annotations

from collections.abc import Mapping as MappingType
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepoint.functions.columns import named
from tidepoint.functions.keys import tag_is_set
from tidepoint.functions.timefn import parse_instant, time_literal
from tidepoint.points import PointsSchema, all_of, any_of


def time_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Keep ``start <= column < end``; either bound may be open.

    The raw column is compared with a literal of its own type, so the range reaches the
    file reader and prunes row groups.
    """
    for condition in time_conditions(df, column, start, end):
        df = df.where(condition)
    return df


def time_conditions(df: DataFrame, column: str, start=None, end=None) -> list[Column]:
    kind = df.schema[column].dataType
    low = None if start is None else parse_instant(start)
    high = None if end is None else parse_instant(end)
    if low is not None and high is not None and high <= low:
        raise ValueError(f"time range ends before it starts: {start} .. {end}")
    conditions = []
    if low is not None:
        conditions.append(named(column) >= time_literal(kind, low))
    if high is not None:
        conditions.append(named(column) < time_literal(kind, high))
    return conditions


def tag_predicate(filters: MappingType[str, Sequence[str]]) -> Column:
    """Every listed tag must equal one of its values; an empty list allows all values."""
    return all_of(
        [named(tag).isin(list(values)) for tag, values in filters.items() if values]
    )


def tag_filter(df: DataFrame, filters: MappingType[str, Sequence[str]]) -> DataFrame:
    return df.where(tag_predicate(filters))


def source_tag_filter(rows: DataFrame, filters: MappingType[str, Sequence[str]]) -> DataFrame:
    """The same filter on source rows, before they become points.

    There a text tag is still the raw column, so the filter reaches the file reader.
    """
    for condition in source_tag_conditions(filters):
        rows = rows.where(condition)
    return rows


def source_tag_conditions(filters: MappingType[str, Sequence[str]]) -> list[Column]:
    return [
        named(tag).cast("string").isin([v for v in values if v != ""])
        for tag, values in filters.items()
        if values
    ]


def series_predicate(series: Sequence[MappingType[str, str]]) -> Column:
    """An OR of ANDs for a short list of series given as tag maps.

    A series without tags matches everything when no series has tags. Long lists belong in a
    DataFrame, see :func:`in_series`.
    """
    wanted = [s for s in series if s]
    if not wanted:
        return F.lit(True)
    return any_of(
        [all_of([named(tag) == value for tag, value in s.items()]) for s in wanted]
    )


def in_series(points: DataFrame, series: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Points whose ``columns`` equal those of some row of ``series``; null equals null.

    A left semi join without a hint: Spark broadcasts ``series`` only while its measured size
    is below the broadcast threshold and otherwise shuffles, where adaptive execution splits
    a hot series. Null-safe equality keeps its hash keys in both cases. Without columns there
    is nothing to tell series apart, and every point belongs.
    """
    if not columns:
        return points
    left, right = points.alias("p"), series.select(*map(named, columns)).alias("s")
    on = reduce(
        lambda a, b: a & b, [named(c, "p").eqNullSafe(named(c, "s")) for c in columns]
    )
    return left.join(right, on, "left_semi")


def after_position(
    df: DataFrame,
    time_column: str | None = None,
    last_time=None,
    id_column: str | None = None,
    last_id: int | None = None,
) -> DataFrame:
    """Rows after a resume position: later time, or the same time and a higher id.

    The time bound is stated a second time on its own, as ``time >= last``; it changes no
    result but is a predicate the file reader can use, which the OR is not.
    """
    has_time = time_column is not None and last_time is not None
    has_id = id_column is not None and last_id is not None
    if has_time:
        mark = time_literal(df.schema[time_column].dataType, parse_instant(last_time))
        time = named(time_column)
        if has_id:
            tie = (time == mark) & (named(id_column) > F.lit(last_id))
            return df.where(time >= mark).where((time > mark) | tie)
        return df.where(time > mark)
    if has_id:
        return df.where(named(id_column) > F.lit(last_id))
    return df


def drop_absent(points: DataFrame, schema: PointsSchema) -> DataFrame:
    """Empty tags become absent. Absent fields are null already; every point stays."""
    tags = {t: F.when(tag_is_set(named(t)), named(t)) for t in schema.tags}
    return points.withColumns(tags) if tags else points


def first_rows(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order: a per-partition top-n, merged."""
    return df.orderBy(*order_by).limit(n)

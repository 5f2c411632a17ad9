"""Scans. All are lazy, filter on raw columns and leave paging to Spark's file splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepoint.functions.columns import named, spare_name
from tidepoint.operators.filters import after_position, in_series, time_range
from tidepoint.points import PointsSchema, to_points


def read_table(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table by path and format, or by catalog name when ``fmt`` is ``"table"``.

    For ``fmt="jdbc"`` pass ``url``, ``dbtable``, ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` as options, so that the read is split.
    """
    if fmt == "table":
        return spark.table(source)
    reader = spark.read.format(fmt).options(**options)
    return reader.load() if fmt == "jdbc" else reader.load(source)


def scan_points(
    df: DataFrame,
    schema: PointsSchema,
    time_column: str,
    measurement: str,
    start=None,
    end=None,
) -> DataFrame:
    """Points of ``[start, end)``; the range is tested before the projection."""
    return to_points(time_range(df, time_column, start, end), schema, time_column, measurement)


def scan_series(
    df: DataFrame,
    schema: PointsSchema,
    time_column: str,
    measurement: str,
    series: DataFrame,
    start=None,
    end=None,
) -> DataFrame:
    """Points of ``[start, end)`` that belong to one of ``series`` (rows of tag values)."""
    points = scan_points(df, schema, time_column, measurement, start, end)
    return in_series(points, series, [t for t in schema.tags if t in series.columns])


def scan_after(
    df: DataFrame,
    time_column: str | None,
    id_column: str | None,
    last_time=None,
    last_id: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Relational rows after a position, as the next ``limit`` rows by (time, id)."""
    rows = after_position(df, time_column, last_time, id_column, last_id)
    if limit is None:
        return rows
    order = [c for c in (time_column, id_column) if c]
    return rows.orderBy(*order).limit(limit)


def rows_to_points(
    df: DataFrame, measurement: str, time_column: str | None, id_column: str
) -> tuple[DataFrame, PointsSchema]:
    """Relational rows as points: every column but the time is a field, the id one is kept."""
    fields = tuple(c for c in df.columns if c != time_column)
    schema = PointsSchema((), fields, id_col=id_column)
    return to_points(df, schema, time_column, measurement), schema


def scan_super_table(
    df: DataFrame,
    time_column: str,
    table_column: str,
    columns: Sequence[str],
    start=None,
    end=None,
    sort: bool = False,
) -> DataFrame:
    """Rows of all child tables as ``tbname, ts, col_1 … col_n``, columns named by position.

    ``sort`` orders rows by child table and time within range partitions, so a hot child is
    spread over several tasks and still reads in order.
    """
    rows = time_range(df, time_column, start, end)
    by_position = [named(c).alias(f"col_{i}") for i, c in enumerate(columns, 1)]
    rows = rows.select(
        named(table_column).alias("tbname"), named(time_column).alias("ts"), *by_position
    )
    if not sort:
        return rows
    # The random last key lets rows of one table and time spread over partitions too.
    salt = spare_name(rows.columns, "_salt")
    keys = ["tbname", "ts", salt]
    salted = rows.withColumn(salt, F.rand(11))
    return salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(salt)

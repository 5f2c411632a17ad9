"""Discovery: tables, columns, series, tag keys and shard groups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.columns import named
from tidepoint.functions.keys import series_key, tag_is_set
from tidepoint.operators.filters import time_range
from tidepoint.operators.windows import window_start_of
from tidepoint.points import PointsSchema
from tidepoint.sinks.tables import UpsertTable

# Names that mark a time column when no column has a time type.
TIME_NAME_PATTERN = "timestamp|time|date"


def measurements(points: DataFrame, column: str = "measurement") -> DataFrame:
    return points.select(column).distinct()


def catalog_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def child_tables(rows: DataFrame, column: str = "tbname") -> DataFrame:
    return rows.select(column).distinct()


def time_column_of(schema: T.StructType) -> str | None:
    """The last column of a time type, else the first whose name speaks of time."""
    typed = [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    if typed:
        return typed[-1]
    speaking = [f.name for f in schema.fields if re.search(TIME_NAME_PATTERN, f.name.lower())]
    return speaking[0] if speaking else None


def id_column_of(schema: T.StructType, primary_key: str | None = None) -> str | None:
    return primary_key or (schema.fieldNames()[0] if schema.fields else None)


def column_profile(df: DataFrame, with_distinct: bool = True) -> DataFrame:
    """One row per column: type, rows, nulls, least and greatest value, role.

    All columns are profiled by one aggregate in one pass; the single result row is then
    turned into one row per column.
    """
    state = df.agg(*profile_aggregates(df.schema, with_distinct, sketch=False))
    return profile_lines(state, df.schema, with_distinct, sketch=False)


def profile_aggregates(schema: T.StructType, with_distinct: bool, sketch: bool) -> list[Column]:
    """What a profile needs to know of some rows; with ``sketch``, in a form that merges."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(schema.fields):
        column = named(field.name)
        aggregates.append(F.count(column).alias(f"n_{i}"))
        if not isinstance(field.dataType, _NESTED):
            low, high = F.min(column), F.max(column)
            if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                # The two zeros are equal, so either may be found; both are shown as 0.0.
                zero = F.lit(0.0).cast(field.dataType)
                low, high = low + zero, high + zero
            aggregates += [low.alias(f"lo_{i}"), high.alias(f"hi_{i}")]
            if with_distinct:
                aggregates.append(
                    F.hll_sketch_agg(column.cast("string")).alias(f"d_{i}")
                    if sketch
                    else F.approx_count_distinct(column).alias(f"d_{i}")
                )
    return aggregates


def profile_lines(
    state: DataFrame, schema: T.StructType, with_distinct: bool, sketch: bool
) -> DataFrame:
    """One row per column from the one row of a profile's state."""
    time_column, id_column = time_column_of(schema), id_column_of(schema)
    lines = []
    for i, field in enumerate(schema.fields):
        flat = not isinstance(field.dataType, _NESTED)
        role = {id_column: "id", time_column: "time"}.get(field.name, "value")
        cells = [
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n_{i}")).alias("nulls"),
            F.col(f"lo_{i}" if flat else "_none").cast("string").alias("min"),
            F.col(f"hi_{i}" if flat else "_none").cast("string").alias("max"),
            F.lit(role).alias("role"),
        ]
        if with_distinct:
            distinct = F.lit(None).cast("bigint")
            if flat:
                distinct = F.hll_sketch_estimate(f"d_{i}") if sketch else F.col(f"d_{i}")
            cells.append(distinct.alias("approx_distinct"))
        lines.append(F.struct(*cells))
    named_state = state.withColumn("_none", F.lit(None).cast("string"))
    return named_state.select(F.explode(F.array(*lines)).alias("c")).select("c.*")


class StoredProfile:
    """Profiles kept per window, so that a table that grows is never read again.

    Each window has one row: counts, least and greatest values and a distinct-count sketch of
    every column. The profile of the table merges those rows; a window that is profiled again
    replaces its row. Columns and types stay as they are.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.schema = schema
        self._states = UpsertTable(spark, path, ["window_start"], ["_seq"])

    def update(self, rows: DataFrame, window: Column) -> None:
        """Profile all windows that ``rows`` holds; a window must come as a whole."""
        seq = F.lit(self._states.version() + 1).cast("bigint")
        states = rows.groupBy(window.alias("window_start")).agg(
            *profile_aggregates(self.schema, with_distinct=True, sketch=True)
        )
        self._states.upsert(states.withColumn("_seq", seq))

    def profile(self) -> DataFrame | None:
        """As :func:`column_profile` of all windows together."""
        states = self._states.current()
        if states is None:
            return None
        merged = [F.sum("rows").alias("rows")]
        for i, field in enumerate(self.schema.fields):
            merged.append(F.sum(f"n_{i}").alias(f"n_{i}"))
            if not isinstance(field.dataType, _NESTED):
                merged += [F.min(f"lo_{i}").alias(f"lo_{i}"), F.max(f"hi_{i}").alias(f"hi_{i}")]
                merged.append(F.hll_union_agg(f"d_{i}").alias(f"d_{i}"))
        return profile_lines(states.agg(*merged), self.schema, with_distinct=True, sketch=True)


_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def repeated_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of an id candidate that occur more than once; empty when it is unique.

    Copies are counted before the shuffle, so a value that fills the table costs no more.
    """
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    )


def series(points: DataFrame, schema: PointsSchema) -> DataFrame:
    """Distinct series with their key; points without tags form one series by table name."""
    columns = schema.series_columns
    distinct = points.select(*[named(c) for c in columns]).distinct()
    return distinct.withColumn(
        "series_key", series_key(F.col(schema.measurement_col), schema.tags)
    )


def series_in_range(
    df: DataFrame, schema: PointsSchema, time_column: str, start=None, end=None
) -> DataFrame:
    """Series with data in ``[start, end)``, the range tested on the raw column."""
    return series(time_range(df, time_column, start, end), schema)


def series_per_window(
    points: DataFrame, schema: PointsSchema, width_ns: int, origin_ns: int | Column = 0
) -> DataFrame:
    """Series with data in each grid window, all windows in one pass."""
    start = window_start_of(F.col(schema.time_col), width_ns, origin_ns)
    return (
        points.select(start.alias("window_start"), *schema.series_columns)
        .distinct()
        .withColumn("series_key", series_key(F.col(schema.measurement_col), schema.tags))
    )


def tag_keys(points: DataFrame, schema: PointsSchema) -> DataFrame:
    """Tags in use per measurement, ``measurement, tag_key``."""
    if not schema.tags:
        none = F.lit(None).cast("string").alias("tag_key")
        return points.select(F.col(schema.measurement_col), none).limit(0)
    used = points.groupBy(schema.measurement_col).agg(
        *[
            F.max(F.coalesce(tag_is_set(named(t)), F.lit(False))).alias(f"t_{i}")
            for i, t in enumerate(schema.tags)
        ]
    )
    names = F.array(
        *[F.when(F.col(f"t_{i}"), F.lit(t)) for i, t in enumerate(schema.tags)]
    )
    return used.select(
        F.col(schema.measurement_col),
        F.explode(F.filter(names, lambda n: n.isNotNull())).alias("tag_key"),
    )


def shard_groups(shards: DataFrame) -> DataFrame:
    """Shard groups of a shard list, with their time range, by start."""
    return (
        shards.groupBy("shard_group_id")
        .agg(F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns"))
        .orderBy("start_ns", "shard_group_id")
    )


def shard_groups_of_points(
    points: DataFrame, width_ns: int, origin_ns: int = 0, time: str = "time_ns"
) -> DataFrame:
    """Shard groups that the points of a fixed-width grid fall into, numbered from 1."""
    start = window_start_of(F.col(time), width_ns, origin_ns)
    width = F.lit(width_ns).cast("bigint")
    number = F.call_function("div", F.col("start_ns") - F.lit(origin_ns).cast("bigint"), width)
    return (
        points.where(F.col(time).isNotNull())
        .groupBy(start.alias("start_ns"))
        .agg(F.count(F.lit(1)).alias("points"))
        .select(
            (number + 1).alias("shard_group_id"),
            "start_ns",
            (F.col("start_ns") + width).alias("end_ns"),
            "points",
        )
    )

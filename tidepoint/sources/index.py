"""A stored index of series, so that finding series needs no scan of points.

Two upsert tables: ``series`` (a series, its tags, first and last time) and ``postings`` (tag,
value and the series that have it). Each wave of points updates both; a wave costs one
aggregate over its own points and a join with the series it meets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepoint.functions.columns import named
from tidepoint.functions.keys import series_key, tag_is_set
from tidepoint.operators.numbering import number_rows
from tidepoint.points import PointsSchema
from tidepoint.session import pin
from tidepoint.sinks.tables import UpsertTable


class SeriesIndex:
    """Series of one schema below ``path``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: PointsSchema):
        self.spark, self.schema = spark, schema
        self._series = UpsertTable(spark, f"{path}/series", ["series_key"], ["_seq"])
        self._postings = UpsertTable(
            spark, f"{path}/postings", ["tag_key", "tag_value", "series_key"], ["_seq"]
        )

    def update(self, points: DataFrame) -> None:
        """Add the series of some points, or widen their times. Repeating it changes nothing."""
        columns, time = self.schema.series_columns, F.col(self.schema.time_col)
        found = (
            points.groupBy(*[named(c) for c in columns])
            .agg(F.min(time).alias("first_ns"), F.max(time).alias("last_ns"))
            .withColumn("series_key", series_key(F.col(columns[0]), self.schema.tags))
        )
        found = pin(found)
        known = self._series.current()
        if known is not None:
            before = known.select(
                "series_key", F.col("first_ns").alias("_first"), F.col("last_ns").alias("_last")
            )
            found = pin(
                found.join(before, "series_key", "left")
                .withColumn("first_ns", F.least("first_ns", "_first"))
                .withColumn("last_ns", F.greatest("last_ns", "_last"))
                .drop("_first", "_last")
            )
        seq = F.lit(self._series.version() + 1).cast("bigint")
        tags = F.array(
            *[
                F.struct(F.lit(t).alias("tag_key"), named(t).alias("tag_value"))
                for t in self.schema.tags
            ]
        )
        if self.schema.tags:
            listed = found.select(
                F.explode(tags).alias("tag"), "series_key", "first_ns", "last_ns"
            ).select("tag.*", "series_key", "first_ns", "last_ns")
            set_ = listed.where(tag_is_set(F.col("tag_value")))
            self._postings.upsert(set_.withColumn("_seq", seq))
        # Last, as it is what a repeated update starts from.
        self._series.upsert(found.withColumn("_seq", seq))

    def series(self, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
        """Series whose first to last time shares time with ``[start, end)``."""
        return self._active(self._series, start_ns, end_ns)

    def tag_values(self, tag: str) -> DataFrame:
        """``tag_value, series``: how many series have each value of a tag."""
        rows = self._rows(self._postings).where(F.col("tag_key") == tag)
        return rows.groupBy("tag_value").agg(F.count(F.lit(1)).alias("series"))

    def find(
        self,
        filters: Mapping[str, Sequence[str]],
        start_ns: int | None = None,
        end_ns: int | None = None,
    ) -> DataFrame:
        """Series that have, for every tag of ``filters``, one of its values; an empty list
        allows all values. The postings of the tags are intersected by count."""
        asked = {tag: list(values) for tag, values in filters.items() if values}
        series = self.series(start_ns, end_ns)
        if not asked:
            return series
        wanted = F.lit(False)
        for tag, values in asked.items():
            wanted |= (F.col("tag_key") == tag) & F.col("tag_value").isin(values)
        met = (
            self._rows(self._postings)
            .where(wanted)
            .groupBy("series_key")
            .agg(F.count(F.lit(1)).alias("_tags"))
            .where(F.col("_tags") == len(asked))
        )
        return series.join(met.select("series_key"), "series_key", "left_semi")

    def _rows(self, table: UpsertTable) -> DataFrame:
        rows = table.current()
        if rows is None:
            raise ValueError("the index is empty: update it with points first")
        return rows.drop("_seq")

    def _active(self, table: UpsertTable, start_ns: int | None, end_ns: int | None) -> DataFrame:
        rows = self._rows(table)
        if start_ns is not None:
            rows = rows.where(F.col("last_ns") >= start_ns)
        return rows if end_ns is None else rows.where(F.col("first_ns") < end_ns)


class BatchDictionary:
    """Numbers of series that never change: a new series comes after all known ones.

    Batches of ``size`` series keep their members as series are added, so marks that name a
    batch stay right. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, group_by: Sequence[str] = ("measurement",)):
        self.group_by = list(group_by)
        self._table = UpsertTable(spark, path, [*self.group_by, "series_key"], ["series_no"])

    def assign(self, series: DataFrame, size: int) -> DataFrame:
        """``series`` with ``series_no`` (from 0, in key order among those added together) and
        ``batch_id``."""
        keys = [*self.group_by, "series_key"]
        known = self._table.current()
        fresh = series.select(*keys).distinct()
        if known is not None:
            fresh = fresh.join(known, keys, "left_anti")
        numbered = number_rows(fresh, self.group_by, ["series_key"], "_no")
        if known is not None:
            offset = known.groupBy(*self.group_by).agg(F.max("series_no").alias("_top"))
            numbered = numbered.join(offset, self.group_by, "left")
        else:
            numbered = numbered.withColumn("_top", F.lit(None).cast("bigint"))
        number = (F.coalesce(F.col("_top") + 1, F.lit(0)) + F.col("_no") - 1).cast("bigint")
        self._table.upsert(numbered.select(*keys, number.alias("series_no")))
        every = self._table.current()
        if every is None:
            every = numbered.select(*keys, number.alias("series_no"))
        batch = F.call_function("div", F.col("series_no"), F.lit(size).cast("bigint"))
        return series.join(every, keys).withColumn("batch_id", batch)

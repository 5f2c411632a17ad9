"""Routing of points to one child table per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepoint.functions.keys import series_key
from tidepoint.points import PointsSchema
from tidepoint.sinks.tables import UpsertTable

BUCKETS = 64


def child_table(table: Column, schema: PointsSchema) -> Column:
    """``table_<md5 of the series key>``; a point without tags stays in the table itself."""
    key = series_key(F.col(schema.measurement_col), schema.tags)
    return F.when(key == F.col(schema.measurement_col), table).otherwise(
        F.concat(table, F.lit("_"), F.md5(key))
    )


def route_to_children(points: DataFrame, schema: PointsSchema, table: Column) -> DataFrame:
    if "child_table" in points.columns:
        raise ValueError("points already have a column child_table")
    return points.withColumn("child_table", child_table(table, schema))


class ChildTables(UpsertTable):
    """Child tables in a fixed number of hash buckets, whatever the number of series.

    A load is an upsert on child, tags and time, so repeating it adds nothing. Within a file
    rows are ordered by child, so a read of one child skips the row groups of others.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: PointsSchema,
        sequence: Sequence[str],
        buckets: int = BUCKETS,
    ):
        keys = ["child_table", *schema.tags, schema.time_col]
        super().__init__(spark, path, keys, sequence)
        self.buckets = buckets
        self.slice_ns = -buckets  # kept in the manifest, so another number is refused

    def _slice(self) -> Column:
        return F.pmod(F.xxhash64("child_table"), F.lit(self.buckets)).cast("string")

    def _placed(self, rows: DataFrame, folder: str) -> DataFrame:
        return rows.hint("rebalance", folder).sortWithinPartitions(folder, "child_table")

    def child(self, name: str) -> DataFrame | None:
        """Rows of one child; only its bucket is read."""
        manifest = self._manifest()
        bucket = self.spark.range(1).select(
            F.pmod(F.xxhash64(F.lit(name)), F.lit(self.buckets)).cast("string")
        ).first()[0]
        if manifest is None or bucket not in manifest["slices"]:
            return None
        return self._read(manifest, [bucket]).where(F.col("child_table") == name)


def write_children(routed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One directory per child, for few children and readers that look for one by path.

    Rebalancing splits a hot child and merges small ones.
    """
    (
        routed.hint("rebalance", "child_table")
        .write.mode(mode)
        .partitionBy("child_table")
        .parquet(path)
    )

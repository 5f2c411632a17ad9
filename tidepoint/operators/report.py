"""Progress reports over the task ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.operators.ledger import COMPLETED, FAILED, IN_PROGRESS, PENDING


def status_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("status").agg(F.count(F.lit(1)).alias("tasks"))


def report_totals(tasks: DataFrame, by: str = "task_id") -> DataFrame:
    """Rows in all, transferred and failed, and the overall state, per migration.

    The worst state of any entry is the state of the whole: failed, then in progress, then
    pending, then completed.
    """
    rows = F.col("processed_rows")
    status = F.col("status")
    started, ended = F.min("created_at"), F.max("updated_at")

    def seen(value: str):
        return F.coalesce(F.bool_or(status == value), F.lit(False))

    return tasks.groupBy(by).agg(
        F.count(F.lit(1)).alias("entries"),
        F.countDistinct("target_meas").alias("measurements"),
        F.sum(rows).alias("total_rows"),
        F.sum(F.when(status == COMPLETED, rows).otherwise(0)).alias("transferred_rows"),
        F.sum(F.when(status == FAILED, rows).otherwise(0)).alias("failed_rows"),
        F.when(seen(FAILED), FAILED)
        .when(seen(IN_PROGRESS), IN_PROGRESS)
        .when(seen(PENDING), PENDING)
        .otherwise(COMPLETED)
        .alias("status"),
        started.alias("started_at"),
        ended.alias("completed_at"),
        (F.unix_seconds(ended) - F.unix_seconds(started)).alias("duration_secs"),
    )


def report_entries(tasks: DataFrame) -> DataFrame:
    """One detail row per source table."""
    return tasks.select(
        "task_id",
        F.col("source_table").alias("table"),
        F.col("source_table").alias("measurement"),
        "target_meas",
        "last_id",
        F.col("last_time_ns").alias("last_timestamp"),
        "processed_rows",
        "status",
        F.col("updated_at").alias("saved_at"),
    )


def write_report(tasks: DataFrame, path: str, by: str = "task_id") -> None:
    """Totals and entries as JSON lines in two folders; entries stay rows, never one list."""
    report_totals(tasks, by).write.mode("overwrite").json(f"{path}/totals")
    report_entries(tasks).write.mode("overwrite").json(f"{path}/entries")

"""Check a finished run: what its windows moved against what the target holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.operators.fingerprint import differing_windows, window_fingerprints
from tidepoint.operators.ledger import COMPLETED, Ledger
from tidepoint.operators.windows import assign_intervals


def verify_windows(
    ledger: Ledger,
    task_id: str,
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    time: str,
    cell_ns: int,
) -> DataFrame:
    """A row per completed window of a task: ``shard_group_id, window_start, window_end,
    recorded_rows, source_rows, target_rows, status``, which is ``same`` or ``differs``.

    Rows are compared by fingerprints per window, so none is shuffled. ``source`` and
    ``target`` hold the columns under the same names and types; ``cell_ns`` is best near the
    width of the windows.
    """
    windows = ledger.windows().where(
        (F.col("task_id") == task_id) & (F.col("status") == COMPLETED)
    ).select(
        "shard_group_id", "window_start", "window_end",
        F.coalesce("total_processed_rows", F.lit(0)).alias("recorded_rows"),
    )
    listed = windows.select(
        F.struct("shard_group_id", "window_start", "window_end").alias("_window"),
        F.col("window_start").alias("_from"),
        F.col("window_end").alias("_until"),
    )

    def prints(rows: DataFrame) -> DataFrame:
        columns = list(dict.fromkeys([*keys, *values, time]))
        placed = assign_intervals(
            rows.select(*columns), listed, cell_ns, time, start="_from", end="_until"
        )
        return window_fingerprints(placed, keys, values, F.col("_window"))

    left, right = prints(source), prints(target)
    apart = differing_windows(left, right).select("window_start").distinct()

    def counts(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("window_start").agg(F.sum("rows").alias(name))

    found = (
        windows.withColumn("_w", F.struct("shard_group_id", "window_start", "window_end"))
        .join(counts(left, "source_rows").withColumnRenamed("window_start", "_w"), "_w", "left")
        .join(counts(right, "target_rows").withColumnRenamed("window_start", "_w"), "_w", "left")
        .join(
            apart.select(F.col("window_start").alias("_w"), F.lit("differs").alias("status")),
            "_w",
            "left",
        )
    )
    return found.drop("_w").fillna({"source_rows": 0, "target_rows": 0, "status": "same"})

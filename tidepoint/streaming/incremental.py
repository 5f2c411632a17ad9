"""Incremental sync: each run takes what has arrived since the last one and then stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.operators.ledger import Ledger
from tidepoint.operators.observe import Observed
from tidepoint.sinks.tables import UpsertTable


def sync_new_files(
    spark: SparkSession,
    source_path: str,
    source_schema: T.StructType,
    to_rows: Callable[[DataFrame], DataFrame],
    table: UpsertTable,
    checkpoint_path: str,
    max_files: int | None = None,
    ledger: Ledger | None = None,
    task_id: str = "",
    time_column: str | None = None,
) -> int:
    """Upsert the rows of files not seen before; returns the table version afterwards.

    ``checkpoint_path`` belongs to ``table``: it remembers the files taken. A batch that is
    repeated after a failure carries the same ``batch_seq`` and rows, and the upsert by key
    gives the same table, so delivery at least once has the effect of exactly once.
    ``max_files`` cuts a large backlog into several batches.

    With a ``ledger`` each epoch leaves a row: its task, rows and latest time, counted while the
    rows are written. An epoch that is replayed replaces its row.
    """
    reader = spark.readStream.schema(source_schema).format("parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        rows = to_rows(batch).withColumn("batch_seq", F.lit(epoch_id).cast("bigint"))
        if ledger is None:
            table.upsert(rows)
            return
        time = F.lit(None).cast("bigint") if time_column is None else F.col(time_column)
        observed = Observed.progress(rows, time)
        table.upsert(observed.rows)
        found = observed.get()
        last = found["last"]["t"] if found["last"] else None
        ledger.save_batch(task_id, epoch_id, found["n"], last)

    query = (
        reader.load(source_path)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.version()

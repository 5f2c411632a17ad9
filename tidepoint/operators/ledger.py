"""The progress ledger: what each task and each window has done, and what is left."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidepoint.functions.columns import named
from tidepoint.operators.upsert import last_wins
from tidepoint.sinks.log import LogTable

# The states of a task or window.
PENDING, IN_PROGRESS, COMPLETED, FAILED = "pending", "in_progress", "completed", "failed"

# The columns of a ledger are its interface.
TASK_KEYS = ["task_id", "source_table"]
WINDOW_KEYS = ["task_id", "shard_group_id", "window_start"]
TASK_SCHEMA = (
    "task_id string, source_table string, task_name string, target_meas string,"
    " last_id bigint, last_time_ns bigint, processed_rows bigint, status string,"
    " created_at timestamp, updated_at timestamp, error_message string,"
    " mapping_config string, deleted boolean, seq bigint"
)
WINDOW_SCHEMA = (
    "task_id string, shard_group_id string, window_start bigint, window_end bigint,"
    " last_completed_batch int, last_time_ns bigint, total_processed_rows bigint,"
    " status string, created_at timestamp, updated_at timestamp, deleted boolean, seq bigint"
)
BATCH_KEYS = ["task_id", "epoch_id"]
BATCH_SCHEMA = (
    "task_id string, epoch_id bigint, processed_rows bigint, last_time_ns bigint,"
    " status string, updated_at timestamp, deleted boolean, seq bigint"
)


# Queries over a ledger, in log form (many versions of a row) or current form.


def latest_tasks(log: DataFrame) -> DataFrame:
    return last_wins(log, TASK_KEYS, ["seq"])


def latest_windows(log: DataFrame) -> DataFrame:
    return last_wins(log, WINDOW_KEYS, ["seq"])


def latest_window_per_shard(windows: DataFrame) -> DataFrame:
    """The window that starts last, per task and shard group."""
    return last_wins(windows, ["task_id", "shard_group_id"], ["window_start"])


def ordered_windows(windows: DataFrame) -> DataFrame:
    return windows.orderBy("task_id", "shard_group_id", "window_start")


def with_status(rows: DataFrame, *statuses: str) -> DataFrame:
    return rows.where(F.col("status").isin(*statuses))


def resumable(tasks: DataFrame) -> DataFrame:
    """Failed and interrupted tasks; their last committed position is kept."""
    return with_status(tasks, FAILED, IN_PROGRESS)


def without_completed(work: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work whose ledger row is not completed, or that has none."""
    done = with_status(ledger, COMPLETED).select(*keys)
    left, right = work.alias("w"), done.alias("d")
    on = reduce(
        lambda a, b: a & b, [named(k, "w").eqNullSafe(named(k, "d")) for k in keys]
    )
    return left.join(right, on, "left_anti")


def without_covered(windows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Windows not yet completed up to their end.

    A run over a shorter range clips its last window; completed there, it is still open for
    a run that reaches further.
    """
    done = with_status(ledger, COMPLETED).select(*WINDOW_KEYS, "window_end")
    left, right = windows.alias("w"), done.alias("d")
    on = reduce(
        lambda a, b: a & b, [named(k, "w") == named(k, "d") for k in WINDOW_KEYS]
    )
    return left.join(right, on & (F.col("d.window_end") >= F.col("w.window_end")), "left_anti")


def without_done_batches(items: DataFrame, windows: DataFrame) -> DataFrame:
    """Work items left: not in a completed window, and past the last completed batch."""
    done = windows.select(
        *WINDOW_KEYS,
        F.when(F.col("status") == COMPLETED, F.lit(2**31 - 1))
        .otherwise(F.coalesce("last_completed_batch", F.lit(-1)))
        .alias("_done"),
    )
    return (
        items.join(done, WINDOW_KEYS, "left")
        .where(F.col("batch_id") > F.coalesce("_done", F.lit(-1)))
        .drop("_done")
    )


def _live(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce("deleted", F.lit(False)))


class Ledger:
    """Progress of tasks, windows and stream batches in append-only logs below ``path``.

    Callers write data first and the ledger after it, so a crash repeats work and never
    skips it; targets are idempotent, so repeating is harmless.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._begun: dict[tuple[str, str], dict | None] = {}
        path = path.rstrip("/")
        self._tasks = LogTable(spark, f"{path}/ledger_tasks", TASK_SCHEMA, TASK_KEYS)
        self._windows = LogTable(spark, f"{path}/ledger_windows", WINDOW_SCHEMA, WINDOW_KEYS)
        self._batches = LogTable(spark, f"{path}/ledger_batches", BATCH_SCHEMA, BATCH_KEYS)

    def tasks(self) -> DataFrame:
        return _live(self._tasks.current())

    def windows(self) -> DataFrame:
        return _live(self._windows.current())

    def batches(self) -> DataFrame:
        """A row per task and epoch of a stream; a replayed epoch replaces its row."""
        return _live(self._batches.current())

    @staticmethod
    def _save(table: LogTable, rows: DataFrame) -> None:
        table.append(rows.withColumn("updated_at", F.lit(datetime.now(timezone.utc))))

    # Tasks

    def load(self, task_id: str, source_table: str) -> Row | None:
        own = (F.col("task_id") == task_id) & (F.col("source_table") == source_table)
        return _live(self._tasks.current(own)).first()

    def create(
        self,
        task_id: str,
        source_table: str,
        task_name: str = "",
        target_meas: str = "",
        mapping_config: str = "",
    ) -> Row:
        """Add a pending row unless the task is known; known progress is never reset."""
        known = self.load(task_id, source_table)
        if known is None:
            self.save(
                task_id,
                source_table,
                task_name=task_name,
                target_meas=target_meas,
                mapping_config=mapping_config,
                status=PENDING,
                processed_rows=0,
            )
            known = self.load(task_id, source_table)
        return known

    def begin(
        self,
        task_id: str,
        source_table: str,
        task_name: str = "",
        target_meas: str = "",
        mapping_config: str = "",
    ) -> Row | None:
        """Mark a task in progress, adding it if unknown; returns what was known before."""
        known = self.load(task_id, source_table)
        self._begun[task_id, source_table] = None
        changes = {"status": IN_PROGRESS, "error_message": None}
        if known is None:
            changes.update(
                task_name=task_name,
                target_meas=target_meas,
                mapping_config=mapping_config,
                processed_rows=0,
            )
        self._begun[task_id, source_table] = self._write_task(
            task_id, source_table, known.asDict() if known else None, changes
        )
        return known

    def save(self, task_id: str, source_table: str, **changes) -> None:
        """Insert a task row or change the named columns of the present one."""
        known = self.load(task_id, source_table)
        self._write_task(task_id, source_table, known.asDict() if known else None, changes)

    def finish(self, task_id: str, source_table: str, **changes) -> None:
        """Change the row that ``begin`` wrote, without reading it again."""
        known = self._begun.pop((task_id, source_table), None)
        if known is None:
            self.save(task_id, source_table, **changes)
        else:
            self._write_task(task_id, source_table, known, changes)

    def _write_task(
        self, task_id: str, source_table: str, known: dict | None, changes: dict
    ) -> dict:
        values = dict(known) if known else {"created_at": datetime.now(timezone.utc)}
        values.update(task_id=task_id, source_table=source_table, deleted=False, **changes)
        self._tasks.append_values([values | {"updated_at": datetime.now(timezone.utc)}])
        return values

    def save_tasks(self, rows: DataFrame) -> None:
        """Save many task rows in one step."""
        self._save(self._tasks, rows)

    def mark(self, task_id: str, source_table: str, status: str, error: str | None = None):
        self.save(task_id, source_table, status=status, error_message=error)

    def by_status(self, *statuses: str) -> DataFrame:
        return with_status(self.tasks(), *statuses)

    def delete(self, task_id: str, source_table: str | None = None) -> None:
        gone = self.tasks().where(F.col("task_id") == task_id)
        if source_table is not None:
            gone = gone.where(F.col("source_table") == source_table)
        self._drop(self._tasks, gone)

    def reset(self) -> None:
        """Forget all tasks, windows and batches."""
        for table in (self._tasks, self._windows, self._batches):
            self._drop(table, _live(table.current()))

    def _drop(self, table: LogTable, gone: DataFrame) -> None:
        self._save(table, gone.withColumn("deleted", F.lit(True)))

    def mark_interrupted(self) -> None:
        """In-progress tasks of a dead run become failed and keep their position."""
        stuck = self.by_status(IN_PROGRESS)
        self._save(
            self._tasks,
            stuck.withColumns(
                {"status": F.lit(FAILED), "error_message": F.lit("interrupted")}
            ),
        )

    # Stream batches

    def save_batch(
        self, task_id: str, epoch_id: int, processed_rows: int, last_time_ns: int | None
    ) -> None:
        row = {
            "task_id": task_id, "epoch_id": epoch_id, "processed_rows": processed_rows,
            "last_time_ns": last_time_ns, "status": COMPLETED, "deleted": False,
            "updated_at": datetime.now(timezone.utc),
        }
        self._batches.append_values([row])

    # Windows

    def save_windows(self, rows: DataFrame) -> None:
        """Save progress of many windows in one step.

        A completed window stays completed, unless a wider range has moved its end.
        """
        fresh = without_covered(rows, self.windows())
        fresh = fresh.withColumn("deleted", F.lit(False))
        if "created_at" not in fresh.columns:
            fresh = fresh.withColumn("created_at", F.lit(datetime.now(timezone.utc)))
        self._save(self._windows, fresh)

    def save_window_values(self, rows: Sequence[dict]) -> None:
        """Rows of windows that a run has in hand and that no other run completes."""
        now = datetime.now(timezone.utc)
        self._windows.append_values(
            [{"created_at": now, "updated_at": now, "deleted": False, **row} for row in rows]
        )

    def latest_window(self, task_id: str, shard_group_id: str) -> Row | None:
        own = self.windows().where(
            (F.col("task_id") == task_id) & (F.col("shard_group_id") == shard_group_id)
        )
        return latest_window_per_shard(own).first()

    def complete_shard(self, task_id: str, shard_group_id: str) -> None:
        own = self.windows().where(
            (F.col("task_id") == task_id) & (F.col("shard_group_id") == shard_group_id)
        )
        self.save_windows(own.withColumn("status", F.lit(COMPLETED)))

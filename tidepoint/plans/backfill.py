"""Backfill over shard groups: shard → window → series batch.

The windows of all shard groups are rows of one table. Those that the ledger does not know as
completed are taken in waves. A wave reads only its own time range, moves its points and then
records its windows, so a run that dies repeats one wave at most.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.functions.keys import series_key
from tidepoint.operators.coverage import uncovered_ranges
from tidepoint.operators.filters import tag_filter, time_range
from tidepoint.operators.ledger import (
    COMPLETED,
    FAILED,
    IN_PROGRESS,
    Ledger,
    with_status,
    without_done_batches,
)
from tidepoint.operators.numbering import series_batches
from tidepoint.operators.windows import assign_intervals, clipped, overlapping, split_windows
from tidepoint.points import PointsSchema, check_window
from tidepoint.session import pin, scratch_path
from tidepoint.sinks.files import SharedFiles
from tidepoint.sources.scan import scan_points

UNIT = ["task_id", "shard_group_id", "window_start", "window_end"]
WAVE_WINDOWS = 16
Reader = Callable[[int, int], DataFrame]


def window_plan(
    shards: DataFrame, task_id: str, start_ns: int, end_ns: int, width_ns: int
) -> DataFrame:
    """Windows of every shard group that shares time with the range, clipped to both."""
    inside = clipped(overlapping(shards, start_ns, end_ns), start_ns, end_ns)
    windows = split_windows(inside, "eff_start", "eff_end", check_window(width_ns))
    return windows.select(
        F.lit(task_id).alias("task_id"),
        F.col("shard_group_id").cast("string").alias("shard_group_id"),
        "window_start",
        "window_end",
    )


def open_windows(windows: DataFrame, known: DataFrame, start_ns: int, end_ns: int) -> DataFrame:
    """What is left of planned windows: the time that no completed window covers.

    Windows are compared by the time they cover, so a run with another width moves nothing
    again. A known window inside the range that stopped between batches stays as it is, as its
    marks hold for that window alone; the rest is cut from ``windows``. A window that a shorter
    run had clipped, and that nothing else covers, opens again as a whole: its ledger row is
    replaced, so the points that are moved again are counted once.
    """
    keys = ["task_id", "shard_group_id"]
    units = windows.select(*keys).distinct()
    known = known.join(units, keys, "left_semi")
    begun = known.where(
        (F.col("status") != COMPLETED)
        & (F.col("last_completed_batch") >= 0)
        & (F.col("window_start") >= start_ns)
        & (F.col("window_end") <= end_ns)
    ).select(*UNIT)
    done = with_status(known, COMPLETED).select(*UNIT)
    ends = {"start": "window_start", "end": "window_end"}
    left = uncovered_ranges(windows, done.unionByName(begun), keys, **ends)
    clipped_ = done.join(windows.withColumnRenamed("window_end", "end_ns"), [*keys, "window_start"])
    clipped_ = clipped_.where("window_end < end_ns").select(
        *keys, "window_start", F.col("window_end").alias("start_ns"), "end_ns"
    )
    rest = left.join(clipped_, [*keys, "start_ns", "end_ns"], "left").select(
        *keys,
        F.coalesce("window_start", "start_ns").alias("window_start"),
        F.col("end_ns").alias("window_end"),
    )
    return rest.unionByName(begun)


def points_in_windows(points: DataFrame, windows: DataFrame, width_ns: int) -> DataFrame:
    """Points with the window that holds them; points outside all windows are left out."""
    return assign_intervals(
        points, windows, check_window(width_ns), start="window_start", end="window_end"
    )


def work_items(
    points: DataFrame,
    schema: PointsSchema,
    windows: DataFrame,
    width_ns: int,
    series_per_query: int = 0,
) -> DataFrame:
    """``task_id, shard_group_id, window_start, window_end, batch_id, series_key`` and tags."""
    columns = schema.series_columns
    found = (
        points_in_windows(points.select(*columns, schema.time_col), windows, width_ns)
        .select(*UNIT, *columns)
        .distinct()
        .withColumn("series_key", series_key(F.col(schema.measurement_col), schema.tags))
    )
    return series_batches(found, series_per_query, UNIT)


def remaining_items(items: DataFrame, ledger_windows: DataFrame) -> DataFrame:
    return without_done_batches(items, ledger_windows)


def source_reader(
    rows: DataFrame, schema: PointsSchema, time_column: str, measurement: str
) -> Reader:
    """Points of a time range from source rows; the range is tested on the raw column."""
    return lambda low, high: scan_points(rows, schema, time_column, measurement, low, high)


def run_backfill(
    points: DataFrame | Reader,
    schema: PointsSchema,
    shards: DataFrame,
    task_id: str,
    start_ns: int,
    end_ns: int,
    width_ns: int,
    sink: Callable[[DataFrame, PointsSchema], None],
    ledger: Ledger,
    series_per_query: int = 0,
    tag_filters: Mapping[str, Sequence[str]] | None = None,
    wave_windows: int = WAVE_WINDOWS,
) -> DataFrame:
    """Move all points of unfinished windows in waves, each followed by its ledger rows.

    Time that completed windows cover, of whatever width, is not moved again. ``points`` is a
    frame of points or a function that gives those of a time range, such as
    :func:`source_reader`. A wave has ``wave_windows`` windows in the order of time. Its
    points are evaluated once, into reliable storage, from which they are counted and moved,
    so the ledger says just what the sink got. A window without points is recorded too.

    With ``series_per_query`` the series of a wave's windows are moved in batches, and the
    ledger gets the number of the last finished batch after each; a run that stops inside a
    window goes on with the next batch. Batch numbers hold for the window they were given
    in, as long as its series stay the same. A wave that fails is recorded as failed.
    """
    windows = window_plan(shards, task_id, start_ns, end_ns, width_ns)
    # Only the list of open windows reaches the driver, a row per window.
    listed = open_windows(windows, ledger.windows(), start_ns, end_ns).toArrow().sort_by(
        [(c, "ascending") for c in ("window_start", "window_end", "shard_group_id")]
    )
    spark = shards.sparkSession
    for first in range(0, listed.num_rows, max(1, wave_windows)):
        part = listed.slice(first, max(1, wave_windows))
        # A local relation, so that the join with it needs no shuffle of the points.
        wave = spark.createDataFrame(part)
        low = min(part.column("window_start").to_pylist())
        high = max(part.column("window_end").to_pylist())
        try:
            found = points(low, high) if callable(points) else time_range(
                points, schema.time_col, low, high
            )
            found = tag_filter(found, tag_filters or {})
            assigned = _assigned(found, wave, width_ns)
            if series_per_query:
                _move_batches(assigned, schema, wave, series_per_query, sink, ledger)
            else:
                _move(assigned, schema, wave, sink, ledger)
        except Exception:
            _record_failure(wave, ledger)
            raise
    return ledger.windows().where(F.col("task_id") == task_id)


def _assigned(points: DataFrame, wave: DataFrame, width_ns: int) -> DataFrame:
    """The points of a wave with their windows, fixed."""
    clash = {*UNIT, "series_key", "batch_id"} & set(points.columns)
    if clash:
        raise ValueError(f"names of the backfill are used by columns: {sorted(clash)}")
    return pin(points_in_windows(points, wave, width_ns))


def _summary(assigned: DataFrame, schema: PointsSchema, wave: DataFrame) -> DataFrame:
    """A row per window of the wave: points moved and their latest time."""
    moved = assigned.groupBy(*UNIT).agg(
        F.count(F.lit(1)).alias("moved"), F.max(schema.time_col).alias("last_time_ns")
    )
    return wave.join(moved, UNIT, "left").withColumn("moved", F.coalesce("moved", F.lit(0)))


def _move(
    assigned: DataFrame, schema: PointsSchema, wave: DataFrame, sink, ledger: Ledger
) -> None:
    rows = _summary(assigned, schema, wave).select(
        *UNIT,
        F.lit(None).cast("int").alias("last_completed_batch"),
        "last_time_ns",
        F.col("moved").alias("total_processed_rows"),
        F.lit(COMPLETED).alias("status"),
    )
    rows = pin(rows)
    sink(assigned.drop(*UNIT), schema)
    ledger.save_windows(rows)


def _move_batches(
    assigned: DataFrame,
    schema: PointsSchema,
    wave: DataFrame,
    series_per_query: int,
    sink,
    ledger: Ledger,
) -> None:
    """Batch by batch over all windows of the wave, a ledger row per window after each."""
    columns = schema.series_columns
    series = assigned.select(*UNIT, *columns).distinct().withColumn(
        "series_key", series_key(F.col(schema.measurement_col), schema.tags)
    )
    items = pin(series_batches(series, series_per_query, UNIT))
    # A mark holds only for the window it was set in, so its end must agree.
    marks = pin(
        ledger.windows().where(F.col("last_completed_batch") >= 0).join(wave, UNIT, "left_semi")
    )
    state = {
        tuple(r[c] for c in UNIT): r
        for r in wave.join(items.groupBy(*UNIT).agg(F.max("batch_id").alias("last")), UNIT, "left")
        .join(
            marks.select(
                *UNIT,
                F.col("last_completed_batch").alias("mark"),
                F.col("total_processed_rows").alias("before"),
                F.col("last_time_ns").alias("time_before"),
            ),
            UNIT,
            "left",
        )
        .collect()
    }
    reached = marks.select(*UNIT, F.col("last_completed_batch").alias("_mark"))
    numbered = (
        _with_batch(assigned, items, columns)
        .join(reached, UNIT, "left")
        .where(F.col("batch_id") > F.coalesce("_mark", F.lit(-1)))
        .drop("_mark")
    )
    # Laid out by batch, so that each batch reads its own rows; counted once, by batch.
    folder = scratch_path(wave.sparkSession, "batches")
    numbered.write.partitionBy("batch_id").parquet(folder)
    reader = wave.sparkSession.read.schema(numbered.drop("batch_id").schema)
    stored = wave.sparkSession.read.schema(numbered.schema).parquet(folder)
    moved: dict[int, dict[tuple, tuple[int, int | None]]] = {}
    for r in (
        stored.groupBy(*UNIT, "batch_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max(schema.time_col).alias("t"))
        .collect()
    ):
        moved.setdefault(r["batch_id"], {})[tuple(r[c] for c in UNIT)] = (r["n"], r["t"])
    try:
        _batches(reader, folder, state, moved, schema, sink, ledger)
    finally:
        SharedFiles(wave.sparkSession).remove(folder)


def _batches(reader, folder: str, state, moved, schema: PointsSchema, sink, ledger) -> None:
    """Sink and ledger batch by batch; sums so far are kept here, a row per window."""
    sums = {u: [r["before"] or 0, r["time_before"]] for u, r in state.items()}

    def row(unit: tuple, batch: int, done: bool) -> dict:
        n, last = sums[unit]
        return dict(zip(UNIT, unit)) | {
            "last_completed_batch": batch, "last_time_ns": last, "total_processed_rows": n,
            "status": COMPLETED if done else IN_PROGRESS,
        }

    def ends(unit: tuple) -> tuple[int, int]:
        """Last batch and mark of a window, -1 for none."""
        r = state[unit]
        return tuple(-1 if r[c] is None else int(r[c]) for c in ("last", "mark"))

    idle = [row(u, ends(u)[1], True) for u in state if ends(u)[0] <= ends(u)[1]]
    if idle:
        ledger.save_window_values(idle)
    for batch in sorted(moved):
        for unit, (n, last) in moved[batch].items():
            sums[unit][0] += n
            times = [t for t in (sums[unit][1], last) if t is not None]
            sums[unit][1] = max(times, default=None)
        sink(reader.parquet(f"{folder}/batch_id={batch}").drop(*UNIT), schema)
        here = [u for u in state if ends(u)[1] < batch <= ends(u)[0]]
        ledger.save_window_values([row(u, batch, ends(u)[0] <= batch) for u in here])


def _with_batch(assigned: DataFrame, items: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Points with the batch of their series; a null tag equals a null tag."""
    left = assigned.withColumn("series_key", series_key(F.col(columns[0]), columns[1:]))
    return left.join(items.select(*UNIT, "series_key", "batch_id"), [*UNIT, "series_key"]).drop(
        "series_key"
    )


def _record_failure(wave: DataFrame, ledger: Ledger) -> None:
    """Windows of a wave that stopped: failed, with the marks they have reached."""
    known = ledger.windows().join(wave, UNIT, "left_semi")
    begun = known.where(F.col("status") != COMPLETED).withColumn("status", F.lit(FAILED))
    fresh = wave.join(known.select(*UNIT), UNIT, "left_anti").withColumn("status", F.lit(FAILED))
    ledger.save_windows(begun.unionByName(fresh, allowMissingColumns=True))


def run_windows(
    points: DataFrame | Reader,
    schema: PointsSchema,
    task_id: str,
    start_ns: int,
    end_ns: int,
    width_ns: int,
    sink: Callable[[DataFrame, PointsSchema], None],
    ledger: Ledger,
    **options,
) -> DataFrame:
    """Backfill by time windows alone, for sources without shard groups."""
    whole = ledger.spark.createDataFrame(
        [("range", start_ns, end_ns)], "shard_group_id string, start_ns bigint, end_ns bigint"
    )
    return run_backfill(
        points, schema, whole, task_id, start_ns, end_ns, width_ns, sink, ledger, **options
    )

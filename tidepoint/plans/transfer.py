"""Mappings from source rows to a sink, with their ledger rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping as MappingType, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.columns import named, spare_name
from tidepoint.functions.keys import series_key
from tidepoint.functions.timefn import time_literal, to_time_ns
from tidepoint.operators.filters import (
    source_tag_conditions,
    source_tag_filter,
    time_conditions,
    time_range,
)
from tidepoint.operators.ledger import COMPLETED, FAILED, Ledger, resumable
from tidepoint.operators.mapping import (
    apply_mapping,
    default_target,
    fill_template,
    mapping_from_json,
    mapping_to_json,
)
from tidepoint.operators.observe import Observed
from tidepoint.points import Mapping, PointsSchema, all_of, tag_text, to_points
from tidepoint.session import scratch_path
from tidepoint.sinks.files import SharedFiles

Sink = Callable[[DataFrame, PointsSchema], None]
Source = tuple[DataFrame, PointsSchema, str]

PARALLEL_TABLES = 4

COMPARABLE = (T.LongType, T.TimestampType, T.TimestampNTZType, T.DateType)


def comparable_time(rows: DataFrame, column: str) -> tuple[DataFrame, str]:
    """Rows with a time column that ranges and positions can be tested on.

    Times and whole ns stay as they are, so that tests on them reach the reader. Text and
    other numbers are parsed once, into a helper column.
    """
    if isinstance(rows.schema[column].dataType, COMPARABLE):
        return rows, column
    parsed = spare_name(rows.columns, "_time_ns")
    return rows.withColumn(parsed, to_time_ns(rows, column)), parsed


def has_several_series(rows: DataFrame, schema: PointsSchema) -> bool:
    tags = [tag_text(rows, t).alias(t) for t in schema.tags]
    return bool(tags) and rows.select(*tags).distinct().limit(2).count() > 1


def with_target_name(
    points: DataFrame, schema: PointsSchema, mapping: Mapping, table: str, several: bool
) -> DataFrame:
    """Points of ``table`` under the name the mapping gives them, by expression.

    The name pattern tells series apart and applies only to a table that has several; next
    comes the mapping's target, and last the default name of table and series.
    """
    series = series_key(F.lit(table), schema.tags)
    if mapping.subtable_pattern and several:
        name = fill_template(F.lit(mapping.subtable_pattern), F.lit(table), series)
    elif mapping.target_measurement:
        name = F.lit(mapping.target_measurement)
    else:
        name = default_target(F.lit(table), series)
    return points.withColumn(schema.measurement_col, name)


def mapped_points(
    rows: DataFrame,
    schema: PointsSchema,
    mapping: Mapping,
    time_column: str,
    table: str | None = None,
    several: bool | None = None,
) -> tuple[DataFrame, PointsSchema]:
    """Time range → tag filters → points without absent tags → mapping, one lazy plan.

    ``table`` is the table that is read, needed for a wildcard mapping. ``several`` tells
    whether it has more than one series, where a name pattern depends on it.
    """
    table = table or mapping.source_table
    if table == "*":
        raise ValueError("a wildcard mapping needs the name of the table it is run on")
    rows, column = comparable_time(rows, mapping.timestamp_column or time_column)
    ranged = time_range(rows, column, mapping.start, mapping.end)
    kept = source_tag_filter(ranged, mapping.tag_filters)
    if several is None:
        several = bool(mapping.subtable_pattern) and has_several_series(rows, schema)
    points = to_points(kept, schema, column, table)
    points = with_target_name(points, schema, mapping, table, several)
    return apply_mapping(points, schema, replace(mapping, target_measurement=""))


def run_mapping(
    rows: DataFrame,
    schema: PointsSchema,
    mapping: Mapping,
    time_column: str,
    sink: Sink,
    ledger: Ledger,
    task_id: str,
    task_name: str = "",
    table: str | None = None,
) -> int:
    """Transfer what lies after the committed mark; returns the number of points delivered.

    The mark is a time and, if the schema has an id column, the greatest id at that time. Count
    and mark are observed while the sink writes, so the source is read through once and the mark
    covers just what was written, also when the source grows meanwhile. An increment without
    rows does not reach the sink. Marks are kept in ns
    but tested on the source's own time column.

    Rows that come later with the time of the mark are told by their id. Without an id column
    all rows of that time are delivered again, as are rows without an id at that time and rows
    without a usable time, which have no position: targets are idempotent. ``processed_rows``
    counts deliveries.
    """
    table = table or mapping.source_table
    known = ledger.begin(
        task_id, table, task_name, mapping.target_measurement, mapping_to_json(mapping)
    )
    try:
        mark, last_id = (known["last_time_ns"], known["last_id"]) if known else (None, None)
        rows, column = comparable_time(rows, mapping.timestamp_column or time_column)
        timed = replace(mapping, timestamp_column=column)
        several = bool(mapping.subtable_pattern) and has_several_series(rows, schema)
        if mark is not None:
            for condition in _increment(rows, column, mark, schema.id_col, last_id):
                rows = rows.where(condition)
        points, target = mapped_points(rows, schema, timed, column, table, several)
        if points.isEmpty():  # stops at the first row
            ledger.finish(task_id, table, status=COMPLETED)
            return 0
        observed = Observed.progress(points, F.col(schema.time_col), _id_of(points, schema))
        sink(observed.rows, target)
        found = observed.get()
    except Exception as error:
        ledger.finish(task_id, table, status=FAILED, error_message=str(error))
        raise
    done = (known["processed_rows"] or 0) if known else 0
    last = found["last"] or {"t": mark, "i": last_id}
    if mark is not None and last["t"] is not None and last["t"] < mark:
        last = {"t": mark, "i": last_id}
    elif last["t"] == mark and last_id is not None:
        last = {"t": mark, "i": max(last_id, last_id if last["i"] is None else last["i"])}
    ledger.finish(
        task_id,
        table,
        status=COMPLETED,
        error_message=None,
        last_time_ns=last["t"],
        last_id=last["i"],
        processed_rows=done + found["n"],
    )
    return found["n"]


def _id_of(points: DataFrame, schema: PointsSchema) -> Column:
    if schema.id_col and schema.id_col in points.columns:
        return named(schema.id_col).cast("bigint")
    return F.lit(None).cast("bigint")


def _increment(
    rows: DataFrame, column: str, mark: int, id_column: str | None, last_id: int | None
) -> list[Column]:
    """Conditions for rows not covered by the mark. What has no position is always part of it:
    a null time, and a null id at the time of the mark."""
    literal = time_literal(rows.schema[column].dataType, mark)
    open_ = named(column).isNull()
    if id_column and last_id is not None:
        number = named(id_column)
        tie = (named(column) == literal) & (number.isNull() | (number > F.lit(last_id)))
        later = (named(column) > literal) | tie
    else:
        later = named(column) >= literal
    # The first condition follows from the second; it is what the file reader can use.
    return [open_ | (named(column) >= literal), open_ | later]


def run_mappings(
    sources: MappingType[str, Source],
    mappings: Sequence[Mapping],
    sink: Sink,
    ledger: Ledger,
    task_id: str,
    parallel: int = PARALLEL_TABLES,
) -> dict[tuple[int, str], int]:
    """Run a list of mappings; a wildcard stands for every table of ``sources``.

    Each pair of mapping and table is one task with its own ledger row and one plan, whatever
    the number of series; series get their names by an expression. Tasks that a former call
    completed go on from their marks. A table that several mappings read is scanned once, see
    :func:`fan_out`. Up to ``parallel`` tables are worked on at a time, each in a scheduler pool
    of its name; the mappings of a table go one after another. ``sink`` is called from their
    threads. Returns the points delivered per (mapping, table).
    """
    by_table: dict[str, list[int]] = {}
    for number, mapping in enumerate(mappings):
        mapping.validate()
        for table in _tables(mapping, number, sources):
            by_table.setdefault(table, []).append(number)

    def run_table(table: str) -> dict[tuple[int, str], int]:
        rows, schema, time_column = sources[table]
        numbers = by_table[table]
        tasks = {n: f"{task_id}/{n}" for n in numbers}
        context = ledger.spark.sparkContext
        context.setLocalProperty("spark.scheduler.pool", table)
        folder = None
        try:
            parts = {n: rows for n in numbers}
            if len(numbers) > 1:
                folder = scratch_path(ledger.spark, "fan-out")
                wanted = {n: (mappings[n], ledger.load(tasks[n], table)) for n in numbers}
                parts = fan_out(rows, schema, time_column, wanted, folder)
            return {
                (n, table): run_mapping(
                    parts[n], schema, mappings[n], time_column, sink, ledger, tasks[n],
                    table=table,
                )
                for n in numbers
            }
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            if folder is not None:
                SharedFiles(ledger.spark).remove(folder)

    moved: dict[tuple[int, str], int] = {}
    inherits = inheritable_thread_target(ledger.spark)
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        runs = [pool.submit(inherits(run_table), t) for t in by_table]
        errors = [e for e in (r.exception() for r in runs) if e is not None]
    if errors:
        raise errors[0]
    for run in runs:
        moved.update(run.result())
    return moved


def fan_out(
    rows: DataFrame,
    schema: PointsSchema,
    time_column: str,
    wanted: MappingType[int, tuple[Mapping, Row | None]],
    folder: str,
) -> dict[int, DataFrame]:
    """The rows each mapping takes, by one scan of ``rows``, written below ``folder``.

    A row is kept once for each mapping whose time range, tag filters and mark it meets, under
    the mapping's number. Only columns that points are made of are read.
    """
    needed = {*schema.tags, *schema.fields, time_column}
    needed |= {m.timestamp_column or time_column for m, _ in wanted.values()}
    needed |= {schema.id_col} if schema.id_col else set()
    rows = rows.select(*[named(c) for c in rows.columns if c in needed])
    number = spare_name(rows.columns, "_mapping")
    met, timed = [], rows
    for n, (mapping, known) in wanted.items():
        timed, column = comparable_time(timed, mapping.timestamp_column or time_column)
        conditions = time_conditions(timed, column, mapping.start, mapping.end)
        conditions += source_tag_conditions(mapping.tag_filters)
        if known is not None and known["last_time_ns"] is not None:
            conditions += _increment(
                timed, column, known["last_time_ns"], schema.id_col, known["last_id"]
            )
        met.append(F.when(all_of(conditions), F.lit(n)))
    numbers = F.filter(F.array(*met), lambda n: n.isNotNull())
    tagged = timed.withColumn(number, F.explode(numbers)).select(
        *[named(c) for c in rows.columns], number
    )
    tagged.write.partitionBy(number).parquet(folder)
    reader = rows.sparkSession.read.schema(rows.schema)
    found = set(SharedFiles(rows.sparkSession).names(folder))
    return {
        n: reader.parquet(f"{folder}/{number}={n}")
        if f"{number}={n}" in found
        else rows.sparkSession.createDataFrame([], rows.schema)
        for n in wanted
    }


def _tables(mapping: Mapping, number: int, sources: MappingType[str, Source]) -> list[str]:
    """Tables of a mapping. A wildcard leaves out those without a tag that it filters by."""
    if mapping.is_wildcard:
        wanted = {tag for tag, values in mapping.tag_filters.items() if values}
        return [t for t in sorted(sources) if wanted <= set(sources[t][1].tags)]
    if mapping.source_table not in sources:
        raise ValueError(f"mapping {number} names an unknown table: {mapping.source_table}")
    return [mapping.source_table]


def resume(
    ledger: Ledger,
    open_source: Callable[[str], Source],
    sink: Sink,
) -> int:
    """Rerun failed and interrupted tasks from their committed marks.

    ``open_source`` gives rows, roles and time column of a table. The list walked here is the
    list of unfinished tasks, one entry per mapping.
    """
    ledger.mark_interrupted()
    total = 0
    for task in resumable(ledger.tasks()).orderBy("task_id", "source_table").collect():
        rows, schema, time_column = open_source(task["source_table"])
        mapping = mapping_from_json(task["mapping_config"])
        total += run_mapping(
            rows, schema, mapping, time_column, sink, ledger, task["task_id"],
            task["task_name"], table=task["source_table"],
        )
    return total

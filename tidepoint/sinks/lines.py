"""Line-protocol text: ``measurement,tag=v field=v time``, tags and fields in name order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepoint.functions.columns import named
from tidepoint.functions.keys import tag_is_set
from tidepoint.functions.textfn import (
    escape_key_text,
    escape_measurement,
    escape_tag,
    field_text,
)
from tidepoint.functions.timefn import time_is_set
from tidepoint.operators.numbering import chunk_batches
from tidepoint.points import PointsSchema, any_of


MAX_PAYLOAD_BYTES = 64 << 20


def _single_line(c: Column, name: str) -> Column:
    """Names and tags cannot hold a line break in this format, so one fails the job."""
    return F.when(c.contains("\n"), F.raise_error(F.lit(f"line break in {name}"))).otherwise(c)


def line_column(points: DataFrame, schema: PointsSchema, always_time: bool = False) -> Column:
    """The line of a point, null when the point has no field."""
    if not schema.fields:
        raise ValueError("a line needs at least one field")
    tags = [
        F.when(
            tag_is_set(named(t)),
            F.concat(
                F.lit(f"{escape_key_text(t)}="),
                escape_tag(_single_line(named(t), f"tag {t}")),
            ),
        )
        for t in schema.tags
    ]
    fields = [
        F.concat(
            F.lit(f"{escape_key_text(f)}="),
            field_text(named(f), points.schema[f].dataType),
        )
        for f in schema.fields
    ]
    measurement = _single_line(F.col(schema.measurement_col), "measurement")
    head = F.concat_ws(",", escape_measurement(measurement), *tags)
    body = F.concat_ws(",", *fields)
    time = F.col(schema.time_col)
    if always_time:
        tail = F.coalesce(time, F.lit(0).cast("bigint")).cast("string")
    else:
        tail = F.when(time_is_set(time), time.cast("string"))
    return F.when(has_field(schema), F.concat_ws(" ", head, body, tail))


def has_field(schema: PointsSchema) -> Column:
    return any_of([named(f).isNotNull() for f in schema.fields])


def to_lines(
    points: DataFrame,
    schema: PointsSchema,
    always_time: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Points with at least one field as ``line``; a projection, so no shuffle."""
    # Tested on the fields: a test of the line itself would build every line twice.
    line = line_column(points, schema, always_time).alias("line")
    return points.where(has_field(schema)).select(*keep, line)


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines.select("line").write.mode(mode).text(path)


def payloads(
    points: DataFrame,
    schema: PointsSchema,
    size: int,
    group_by: Sequence[str],
    order_by: Sequence[str],
    always_time: bool = False,
    max_bytes: int = MAX_PAYLOAD_BYTES,
) -> DataFrame:
    """One text per chunk of at most ``size`` lines, in order, joined by line breaks.

    A chunk of more than ``max_bytes`` is closed early and goes on as the next ``part_no``, so
    a text is bounded by that and one line, however long the lines are. The sum that cuts the
    parts needs the lines of a chunk in one partition, where the texts are then built without
    a further shuffle.
    """
    kept = list(dict.fromkeys([*group_by, *order_by]))
    lines = to_lines(points, schema, always_time, kept)
    chunks = chunk_batches(lines, size, group_by, order_by)
    before = Window.partitionBy(*group_by, "batch_id").orderBy("row_no")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum(F.octet_length("line") + 1).over(before), F.lit(0))
    part = F.call_function("div", filled, F.lit(max_bytes).cast("bigint")).cast("int")
    chunks = chunks.withColumn("part_no", part)
    ordered = F.array_sort(F.collect_list(F.struct("row_no", "line")))
    return chunks.groupBy(*group_by, "batch_id", "part_no").agg(
        F.count(F.lit(1)).alias("lines"),
        F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("payload"),
    )

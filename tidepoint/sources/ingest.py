"""Saved query responses (JSON) and long rows, turned into wide points."""

from __future__ import annotations

from collections.abc import Mapping as MappingType
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.casts import cast_value
from tidepoint.functions.columns import named
from tidepoint.functions.timefn import parse_time_column, parse_time_ns
from tidepoint.points import PointsSchema, widest_kind

_SERIES = (
    "struct<name: string, tags: map<string, string>, columns: array<string>,"
    " values: array<array<variant>>>"
)
RESPONSE_TYPE = (
    f"results array<struct<name: string, tags: map<string, string>, columns: array<string>,"
    f" values: array<array<variant>>, series: array<{_SERIES}>>>"
)


def read_responses(spark: SparkSession, path: str, one_per_line: bool = True) -> DataFrame:
    """Response texts as ``response``, one per line, so that Spark can split a file.

    With ``one_per_line`` off each file is one response: one page of a query, which is read
    as one row.
    """
    return spark.read.text(path, wholetext=not one_per_line).withColumnRenamed(
        "value", "response"
    )


def response_rows(responses: DataFrame) -> DataFrame:
    """``measurement, series_tags, columns, row``: one row per value list of a response.

    Series may sit directly in ``results`` or below ``results[].series``.
    """
    parsed = responses.select(
        F.explode(F.from_json("response", RESPONSE_TYPE)["results"]).alias("r")
    )
    own = F.struct("r.name", "r.tags", "r.columns", "r.values")
    series = F.when(F.col("r.series").isNotNull(), F.col("r.series")).otherwise(F.array(own))
    return (
        parsed.select(F.explode(series).alias("s"))
        .select(
            F.col("s.name").alias("measurement"),
            F.col("s.tags").alias("series_tags"),
            F.col("s.columns").alias("columns"),
            F.explode("s.values").alias("row"),
        )
    )


def response_columns(responses: DataFrame) -> DataFrame:
    """``name, kind`` of every non-null value column, for inferring roles.

    ``kind`` is ``float``, ``int``, ``bool`` or ``string``. An aggregate: its size is the
    number of distinct columns and kinds.
    """
    cells = response_rows(responses).select(
        F.explode(F.arrays_zip("columns", "row")).alias("c")
    )
    shape = F.schema_of_variant(F.col("c.row"))
    kind = (
        F.when(shape == "VOID", F.lit(None))
        .when(shape == "BIGINT", "int")
        .when(shape == "BOOLEAN", "bool")
        .when(shape == "STRING", "string")
        .when(shape.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "float")
    )
    return (
        cells.select(F.col("c.columns").alias("name"), kind.alias("kind"))
        .where(F.col("kind").isNotNull() & (F.col("name") != "time"))
        .distinct()
    )


def infer_response_schema(
    responses: DataFrame, tag_keys: Sequence[str] | None = None
) -> tuple[PointsSchema, dict[str, str]]:
    """Roles and field types of saved responses.

    With ``tag_keys`` those are the tags and every other value, text included, is a field.
    Without, text columns are tags and numbers and booleans are fields.
    """
    kinds: dict[str, list[str]] = {}
    for row in response_columns(responses).collect():
        kinds.setdefault(row["name"], []).append(row["kind"])
    merged = {name: widest_kind(found) for name, found in kinds.items()}
    if tag_keys is None:
        tags = {n for n, k in merged.items() if k == "string"}
    else:
        tags = set(tag_keys)
    spark_types = {"float": "double", "int": "bigint", "bool": "boolean", "string": "string"}
    fields = {n: spark_types[k] for n, k in merged.items() if n not in tags}
    return PointsSchema(tuple(tags), tuple(fields)), fields


def parse_responses(
    responses: DataFrame, schema: PointsSchema, field_types: MappingType[str, str]
) -> DataFrame:
    """Responses as wide points. A null or missing value is absent; bad times are absent."""
    rows = response_rows(responses)

    def value(name: str, type_name: str) -> Column:
        # By place, the first of a repeated name; a short row has nothing at its end.
        place = F.array_position("columns", name).cast("int") - 1
        return F.try_variant_get(F.get("row", place), "$", type_name)

    columns = [F.col("measurement").alias(schema.measurement_col)]
    for tag in schema.tags:
        of_series = F.element_at(F.col("series_tags"), F.lit(tag))
        columns.append(
            F.nullif(F.coalesce(value(tag, "string"), of_series), F.lit("")).alias(tag)
        )
    columns += [value(f, field_types[f]).alias(f) for f in schema.fields]
    columns.append(parse_time_ns(value("time", "string")).alias(schema.time_col))
    return rows.select(*columns)


def read_long_rows(
    spark: SparkSession,
    path: str,
    tags: Sequence[str],
    fields: Sequence[str] = (),
    one_per_line: bool = False,
) -> DataFrame:
    """Saved long rows, each file an array of objects unless ``one_per_line``.

    Values are read as text and typed by :func:`widen`.
    """
    names = ["_time", "_measurement", "_field", "_value", *tags, *fields]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).json(path, multiLine=not one_per_line)


def long_points(
    rows: DataFrame,
    tags: Sequence[str],
    time: str = "_time",
    field: str = "_field",
    value: str = "_value",
    fields: Sequence[str] = (),
) -> DataFrame:
    """Long rows as one-field points; ``_measurement`` is kept as a tag.

    Columns that are neither system nor tag columns are named in ``fields`` and stay fields.
    """
    return rows.select(
        F.col("_measurement").alias("measurement"),
        F.col("_measurement"),
        *[F.nullif(named(t), F.lit("")).alias(t) for t in tags],
        F.col(field).alias("field_name"),
        F.col(value).alias("field_value"),
        *[named(f) for f in fields],
        parse_time_column(F.col(time)).alias("time_ns"),
    )


# The value cast that gives each column type.
_CASTS = {"double": "float", "bigint": "int", "boolean": "bool", "string": "string"}


def widen(
    points: DataFrame,
    tags: Sequence[str],
    field_types: MappingType[str, str],
    sequence: Sequence[str] = (),
) -> DataFrame:
    """One-field points of a series and time as one wide point, fields given by name.

    Naming the fields spares a pass that would look for them, and the aggregate combines
    before its shuffle. Of repeated values the last by ``sequence`` wins, as in an upsert;
    rows equal in it are settled by their text. Values are cast as a mapping casts them.
    """
    text = F.col("field_value")
    order = F.struct(*[named(s) for s in sequence], text)
    fields = []
    for name, type_name in sorted(field_types.items()):
        last = F.max_by(text, F.when((F.col("field_name") == name) & text.isNotNull(), order))
        fields.append(last.alias(name))
    wide = points.groupBy("measurement", *tags, "time_ns").agg(*fields)
    kind = T.StringType()
    return wide.withColumns(
        {
            name: cast_value(named(name), kind, _CASTS.get(type_name, "")).cast(type_name)
            for name, type_name in field_types.items()
        }
    )


def to_long(points: DataFrame, schema: PointsSchema) -> DataFrame:
    """Wide points as long rows, one per present field; the inverse of :func:`widen`."""
    time = F.col(schema.time_col)
    return points.select(
        F.col(schema.measurement_col).alias("_measurement"),
        *[named(t) for t in schema.tags],
        time.alias("time_ns"),
        F.explode(
            F.filter(
                F.array(
                    *[
                        F.struct(
                            F.lit(f).alias("_field"),
                            named(f).cast("string").alias("_value"),
                        )
                        for f in schema.fields
                    ]
                ),
                lambda x: x["_value"].isNotNull(),
            )
        ).alias("f"),
    ).select("_measurement", *schema.tags, "time_ns", "f._field", "f._value")

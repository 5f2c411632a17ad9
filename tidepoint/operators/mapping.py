"""Field and tag mapping, and the expansion of mappings over tables and series."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepoint.functions.casts import cast_value
from tidepoint.functions.columns import named
from tidepoint.functions.keys import series_tags, tag_is_set
from tidepoint.points import FieldMap, Mapping, PointsSchema, TagMap

MAPPING_TYPE = T.StructType(
    [
        T.StructField("mapping_id", T.IntegerType(), False),
        T.StructField("match_table", T.StringType(), False),
        T.StructField("mapping_target", T.StringType(), False),
        T.StructField("subtable_pattern", T.StringType(), False),
        T.StructField(
            "tag_filters", T.MapType(T.StringType(), T.ArrayType(T.StringType())), False
        ),
    ]
)


def apply_mapping(
    points: DataFrame, schema: PointsSchema, mapping: Mapping
) -> tuple[DataFrame, PointsSchema]:
    """Keep, rename and cast the listed fields and tags in one projection.

    A mapping that lists neither passes the points on. A listed tag is read from the tag of
    that name and, where that is absent, from a text field of that name. Listed names the
    points do not have are left out.
    """
    mapping.validate()
    if not mapping.fields and not mapping.tags:
        return _renamed(points, schema, mapping), schema

    fields = {
        f.name: cast_value(
            named(f.source), points.schema[f.source].dataType, f.data_type.lower()
        )
        for f in mapping.fields
        if f.source and f.source in schema.fields
    }
    tags = {}
    for tag in mapping.tags:
        column = _tag_or_text_field(points, schema, tag.source) if tag.source else None
        if column is not None:
            tags[tag.name] = column
    reserved = {schema.measurement_col, schema.time_col} & {*tags, *fields}
    if reserved:
        raise ValueError(f"mapping targets use reserved names: {sorted(reserved)}")
    result = PointsSchema(
        tuple(tags), tuple(fields), schema.measurement_col, schema.time_col, schema.id_col
    )
    columns = [_target(schema, mapping).alias(schema.measurement_col)]
    columns += [tags[t].alias(t) for t in result.tags]
    columns += [fields[f].alias(f) for f in result.fields]
    columns.append(F.col(schema.time_col))
    if schema.id_col and schema.id_col not in fields:
        columns.append(named(schema.id_col))
    return points.select(*columns), result


def _target(schema: PointsSchema, mapping: Mapping) -> Column:
    if mapping.target_measurement:
        return F.lit(mapping.target_measurement)
    return F.col(schema.measurement_col)


def _renamed(points: DataFrame, schema: PointsSchema, mapping: Mapping) -> DataFrame:
    if not mapping.target_measurement:
        return points
    return points.withColumn(schema.measurement_col, F.lit(mapping.target_measurement))


def _tag_or_text_field(points: DataFrame, schema: PointsSchema, name: str) -> Column | None:
    sources = []
    if name in schema.tags:
        sources.append(named(name))
    elif name in schema.fields and isinstance(points.schema[name].dataType, T.StringType):
        sources.append(named(name))
    if not sources:
        return None
    return F.when(tag_is_set(sources[0]), sources[0])


def tag_with_fallback(tag: Column | None, text_field: Column | None) -> Column:
    """The tag where it is set, else the text field; for sources that keep both by one name."""
    choices = [F.when(tag_is_set(c), c) for c in (tag, text_field) if c is not None]
    return F.coalesce(*choices)


def name_collisions(schema: PointsSchema) -> list[str]:
    """Names used both as tag and field, known from the schema of wide points."""
    return sorted(set(schema.tags) & set(schema.fields))


def collision_counts(points: DataFrame, tags: str = "tags", fields: str = "fields") -> DataFrame:
    """Points per measurement and clashing name, for points that carry tag and field maps."""
    clashing = F.array_intersect(F.map_keys(F.col(tags)), F.map_keys(F.col(fields)))
    return (
        points.select("measurement", F.explode(clashing).alias("name"))
        .groupBy("measurement", "name")
        .agg(F.count(F.lit(1)).alias("points"))
    )


def default_target(table: Column, series: Column) -> Column:
    return F.when(series == table, table).otherwise(F.concat_ws("_", table, series))


def fill_template(pattern: Column, table: Column, series: Column) -> Column:
    """Replace ``{{tagN}}``, ``{{valueN}}``, ``{{table}}`` and ``{{series}}`` in ``pattern``.

    N counts the comma parts of the series key from 1, so the first tag is 2. A part that is
    not exactly ``name=value`` fills nothing and its placeholders stay.
    """
    parts = F.transform(
        F.split(series, ","),
        lambda p, i: F.struct((i + 1).cast("string").alias("n"), F.split(p, "=").alias("kv")),
    )
    tagged = F.filter(parts, lambda p: F.size(p["kv"]) == 2)
    filled = F.aggregate(
        tagged,
        pattern,
        lambda text, p: F.replace(
            F.replace(text, F.concat(F.lit("{{tag"), p["n"], F.lit("}}")), p["kv"][0]),
            F.concat(F.lit("{{value"), p["n"], F.lit("}}")),
            p["kv"][1],
        ),
    )
    return F.replace(F.replace(filled, F.lit("{{table}}"), table), F.lit("{{series}}"), series)


def mappings_frame(spark: SparkSession, mappings: Sequence[Mapping]) -> DataFrame:
    rows = [
        (
            i,
            "*" if m.is_wildcard else m.source_table,
            m.target_measurement,
            m.subtable_pattern,
            {tag: list(values) for tag, values in m.tag_filters.items()},
        )
        for i, m in enumerate(mappings)
    ]
    # By way of Arrow, so that the plan knows how small the list is.
    names = MAPPING_TYPE.names
    listed = pa.Table.from_pylist(
        [dict(zip(names, row)) for row in rows], to_arrow_schema(MAPPING_TYPE)
    )
    return spark.createDataFrame(listed, MAPPING_TYPE)


def expand_mappings(series: DataFrame, mappings: DataFrame) -> DataFrame:
    """One row per (mapping, table, series) that the mapping takes.

    ``series`` has ``source_table, series_key``, each series once. The wildcard becomes an
    equality: each series row is looked up once under its table's name and once under ``*``,
    so this is a plain hash join and not an inequality join.
    """
    several = series.groupBy("source_table").agg(
        (F.count(F.lit(1)) > 1).alias("has_several")
    )
    keyed = series.join(several, "source_table").withColumn(
        "match_table", F.explode(F.array_distinct(F.array("source_table", F.lit("*"))))
    )
    tags = series_tags(F.col("series_key"))
    accepted = F.forall(
        F.map_entries("tag_filters"),
        lambda f: (F.size(f["value"]) == 0)
        | F.coalesce(F.array_contains(f["value"], F.element_at(tags, f["key"])), F.lit(False)),
    )
    chosen = (
        F.when(
            (F.col("subtable_pattern") != "") & F.col("has_several"),
            fill_template(F.col("subtable_pattern"), F.col("source_table"), F.col("series_key")),
        )
        .when(F.col("mapping_target") != "", F.col("mapping_target"))
        .otherwise(default_target(F.col("source_table"), F.col("series_key")))
    )
    return (
        keyed.join(mappings, "match_table")
        .where(accepted)
        .select("mapping_id", "source_table", "series_key", chosen.alias("target_measurement"))
    )


def named_and_discovered(discovered: DataFrame, wanted: DataFrame) -> DataFrame:
    """Tables found in the source together with those a mapping names, each once."""
    return discovered.unionByName(wanted).distinct()


def mapping_to_json(mapping: Mapping) -> str:
    """The stored form of a mapping, kept with a task so that a resume can rebuild it."""
    return json.dumps(
        {
            "source_table": mapping.source_table,
            "target_measurement": mapping.target_measurement,
            "tags": [[t.source, t.target] for t in mapping.tags],
            "fields": [[f.source, f.target, f.data_type] for f in mapping.fields],
            "tag_filters": {k: list(v) for k, v in mapping.tag_filters.items()},
            "start": mapping.start,
            "end": mapping.end,
            "window_ns": mapping.window_ns,
            "subtable_pattern": mapping.subtable_pattern,
            "timestamp_column": mapping.timestamp_column,
        },
        sort_keys=True,
    )


def mapping_from_json(text: str) -> Mapping:
    stored = json.loads(text)
    stored["tags"] = tuple(TagMap(*t) for t in stored["tags"])
    stored["fields"] = tuple(FieldMap(*f) for f in stored["fields"])
    return Mapping(**stored)


def union_points(frames: Sequence[DataFrame]) -> DataFrame:
    """Points of several origins under the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

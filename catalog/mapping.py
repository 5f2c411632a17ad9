"""Field and tag mapping, casts, names and mapping expansion."""

from pyspark.sql import functions as F

from catalog import query
from catalog.views import (
    E_SCHEMA,
    E_SQL,
    L_SQL,
    all_points,
    event_points,
    event_rows,
    number_sql,
    table,
)
from tidepoint.functions.casts import cast_value
from tidepoint.functions.keys import series_key, series_pairs
from tidepoint.operators.mapping import (
    apply_mapping,
    collision_counts,
    default_target,
    expand_mappings,
    fill_template,
    mappings_frame,
    tag_with_fallback,
)
from tidepoint.points import FieldMap, Mapping, PointsSchema, TagMap, to_points
from tidepoint.sources.discover import series

FLOAT_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
INT_RE = "[+-]?[0-9]+"


@query(
    "map_fields",
    f"""WITH {E_SQL}
    SELECT 'activity' AS measurement, event_type AS kind, user_id,
           value AS amount, CAST(k AS DOUBLE) AS level, time_ns
    FROM e""",
)
def map_fields(spark, sf_dir):
    mapping = Mapping(
        source_table="events",
        target_measurement="activity",
        tags=(TagMap("event_type", "kind"), TagMap("user_id"), TagMap("absent", "gone")),
        fields=(FieldMap("value", "amount", "float"), FieldMap("k", "level", "float")),
    )
    return apply_mapping(event_points(spark, sf_dir), E_SCHEMA, mapping)[0]


@query(
    "map_tag_fallback",
    """SELECT 'orders' AS measurement, o_orderstatus AS status, o_orderpriority AS priority,
           CAST(trunc(o_totalprice) AS BIGINT) AS total, epoch_us(o_orderdate) * 1000 AS time_ns
    FROM orders""",
)
def map_tag_fallback(spark, sf_dir):
    """``status`` is a tag of the source, ``priority`` only a text field of it."""
    schema = PointsSchema(("o_orderstatus",), ("o_orderpriority", "o_totalprice"))
    points = to_points(table(spark, sf_dir, "orders"), schema, "o_orderdate", "orders")
    mapping = Mapping(
        source_table="orders",
        tags=(TagMap("o_orderstatus", "status"), TagMap("o_orderpriority", "priority")),
        fields=(FieldMap("o_totalprice", "total", "int"),),
    )
    return apply_mapping(points, schema, mapping)[0]


@query(
    "tag_fallback_rows",
    """SELECT doc_id, CASE WHEN lang <> 'en' THEN lang ELSE source END AS origin FROM documents""",
)
def tag_fallback_rows(spark, sf_dir):
    """The tag is empty on English documents, where the text field takes its place."""
    tag = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", tag_with_fallback(tag, F.col("source")).alias("origin")
    )


@query(
    "cast_matrix",
    f"""WITH {E_SQL}, c AS (
        SELECT event_id, event_type, user_id, value, k, k > 50 AS flag,
               CASE WHEN value < 10 THEN k || '.5' WHEN value < 20 THEN ' ' || k
                    WHEN value < 30 THEN k || 'd' WHEN value < 40 THEN '-' || k || 'e2'
                    WHEN value < 50 THEN 'Yes' WHEN value < 60 THEN 'on'
                    WHEN value < 70 THEN '1'
                    WHEN value < 80 THEN '99999999999999999999' ELSE user_id END AS t
        FROM e)
    SELECT event_id,
           CAST(trunc(value) AS BIGINT) AS float_int, {number_sql('value')} AS float_text,
           value <> 0 AS float_bool,
           CAST(k AS DOUBLE) AS int_float, CAST(k AS VARCHAR) AS int_text, k <> 0 AS int_bool,
           CASE WHEN regexp_full_match(t, '{FLOAT_RE}') THEN TRY_CAST(t AS DOUBLE) ELSE 0 END
               AS text_float,
           CASE WHEN regexp_full_match(t, '{INT_RE}') THEN coalesce(TRY_CAST(t AS BIGINT), 0)
                ELSE 0 END AS text_int,
           lower(t) IN ('true', 'yes', 'on', '1') AS text_bool,
           CAST(0 AS DOUBLE) AS bool_float, CAST(0 AS BIGINT) AS bool_int,
           CASE WHEN flag THEN 'true' ELSE 'false' END AS bool_text,
           t AS other
    FROM c""",
)
def cast_matrix(spark, sf_dir):
    """Every kind cast to every type, on values and on number-like and odd texts."""
    value, k = F.col("value"), F.col("k").cast("string")
    text = (
        F.when(value < 10, F.concat(k, F.lit(".5")))
        .when(value < 20, F.concat(F.lit(" "), k))
        .when(value < 30, F.concat(k, F.lit("d")))
        .when(value < 40, F.concat(F.lit("-"), k, F.lit("e2")))
        .when(value < 50, "Yes")
        .when(value < 60, "on")
        .when(value < 70, "1")
        .when(value < 80, "99999999999999999999")
        .otherwise(F.col("user_id").cast("string"))
    )
    rows = event_rows(spark, sf_dir).select(
        "event_id", "value", "k", (F.col("k") > 50).alias("flag"), text.alias("t")
    )
    sources = {"float": "value", "int": "k", "text": "t", "bool": "flag"}
    targets = {"float": "float", "int": "integer", "text": "string", "bool": "boolean"}
    casts = [
        cast_value(F.col(column), rows.schema[column].dataType, targets[to]).alias(
            f"{kind}_{to}"
        )
        for kind, column in sources.items()
        for to in targets
        if kind != to
    ]
    unchanged = cast_value(F.col("t"), rows.schema["t"].dataType, "blob").alias("other")
    return rows.select("event_id", *casts, unchanged)


@query(
    "cast_documents",
    f"""SELECT doc_id,
           CASE WHEN regexp_full_match(text, '{FLOAT_RE}') THEN TRY_CAST(text AS DOUBLE)
                ELSE 0 END AS text_float,
           CASE WHEN regexp_full_match(text, '{INT_RE}')
                THEN coalesce(TRY_CAST(text AS BIGINT), 0) ELSE 0 END AS text_int,
           lower(text) IN ('true', 'yes', 'on', '1') AS text_bool,
           CAST(n_chars AS VARCHAR) AS chars_text
    FROM documents""",
)
def cast_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    kind, count = rows.schema["text"].dataType, rows.schema["n_chars"].dataType
    return rows.select(
        "doc_id",
        cast_value(F.col("text"), kind, "float").alias("text_float"),
        cast_value(F.col("text"), kind, "int").alias("text_int"),
        cast_value(F.col("text"), kind, "bool").alias("text_bool"),
        cast_value(F.col("n_chars"), count, "string").alias("chars_text"),
    )


@query(
    "collision_count",
    f"""WITH {E_SQL}, names AS (
        SELECT event_type AS measurement, 'host' AS name, value > 50 AS is_tag, k > 30 AS is_field
        FROM e
        UNION ALL SELECT event_type, 'region', k > 60, value > 20 FROM e)
    SELECT measurement, name, count(*) AS points FROM names WHERE is_tag AND is_field
    GROUP BY ALL""",
)
def collision_count(spark, sf_dir):
    """Points that carry tag and field maps, some with ``host`` or ``region`` in both."""

    def present(name, condition, value):
        return F.when(condition, F.struct(F.lit(name).alias("key"), value.alias("value")))

    def as_map(*entries):
        return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))

    text = F.col("user_id").cast("string")
    points = event_rows(spark, sf_dir).select(
        F.col("event_type").alias("measurement"),
        as_map(
            present("host", F.col("value") > 50, text), present("region", F.col("k") > 60, text)
        ).alias("tags"),
        as_map(
            present("host", F.col("k") > 30, F.col("value")),
            present("region", F.col("value") > 20, F.col("value")),
        ).alias("fields"),
    )
    return collision_counts(points)


@query(
    "target_name",
    f"""WITH {E_SQL}, {L_SQL}, s AS (
        SELECT DISTINCT measurement, series_key FROM e
        UNION ALL SELECT DISTINCT measurement, series_key FROM l
        UNION ALL SELECT DISTINCT 'plain' || n_nationkey, 'plain' || n_nationkey FROM nation)
    SELECT series_key,
           CASE WHEN series_key = measurement THEN measurement
                ELSE measurement || '_' || series_key END AS default_target,
           CASE WHEN series_key LIKE '%=%' THEN
               replace(replace(replace(
                   '{{{{table}}}}_{{{{tag2}}}}_{{{{value3}}}}_{{{{tag9}}}}',
                   '{{{{table}}}}', measurement),
                   '{{{{tag2}}}}', split_part(split_part(series_key, ',', 2), '=', 1)),
                   '{{{{value3}}}}', split_part(split_part(series_key, ',', 3), '=', 2))
               ELSE measurement || '_{{{{tag2}}}}_{{{{value3}}}}_{{{{tag9}}}}' END
               AS templated
    FROM s""",
)
def target_name(spark, sf_dir):
    points, schema = all_points(spark, sf_dir)
    found = series(points, schema).select("measurement", "series_key")
    plain = F.concat(F.lit("plain"), F.col("n_nationkey").cast("string"))
    bare = table(spark, sf_dir, "nation").select(
        plain.alias("measurement"), plain.alias("series_key")
    )
    name, key = F.col("measurement"), F.col("series_key")
    pattern = F.lit("{{table}}_{{tag2}}_{{value3}}_{{tag9}}")
    return (
        found.unionByName(bare.distinct())
        .select(
            "series_key",
            default_target(name, key).alias("default_target"),
            fill_template(pattern, name, key).alias("templated"),
        )
    )


@query(
    "parse_series_key",
    """WITH k AS (SELECT DISTINCT source, lang FROM documents)
    SELECT 'docs,lang=' || lang || ',src=' || source || ',x,lang=z=' || lang AS series_key,
           u.name, u.value
    FROM k, LATERAL (SELECT unnest(['src', 'lang']) AS name,
                            unnest([source, 'z=' || lang]) AS value) u""",
)
def parse_series_key(spark, sf_dir):
    """Keys with a part that is no tag, a repeated tag and an equals sign in a value."""
    key = F.concat(
        F.lit("docs,lang="),
        "lang",
        F.lit(",src="),
        "source",
        F.lit(",x,lang=z="),
        "lang",
    )
    return (
        table(spark, sf_dir, "documents")
        .select(key.alias("series_key"))
        .distinct()
        .select("series_key", F.explode(series_pairs(F.col("series_key"))).alias("p"))
        .select("series_key", "p.name", "p.value")
    )


@query(
    "build_series_key",
    """SELECT page_id, 'pages' || CASE WHEN lang <> '' THEN ',lang=' || lang ELSE '' END
           || ',url=' || url AS series_key
    FROM (SELECT page_id, url, regexp_extract(html, '<html lang="([a-z]*)"', 1) AS lang
          FROM pages)""",
)
def build_series_key(spark, sf_dir):
    lang = F.regexp_extract("html", '<html lang="([a-z]*)"', 1)
    rows = table(spark, sf_dir, "pages").select("page_id", "url", lang.alias("lang"))
    return rows.select("page_id", series_key(F.lit("pages"), ["url", "lang"]).alias("series_key"))


MAPPINGS = [
    Mapping(source_table="*"),
    Mapping(
        source_table="events",
        target_measurement="clicks",
        tag_filters={"event_type": ["click", "view"], "user_id": []},
    ),
    Mapping(source_table="lineitem", subtable_pattern="{{table}}_{{value2}}_{{value3}}"),
    Mapping(source_table="", target_measurement="all", tag_filters={"l_linestatus": ["F"]}),
    Mapping(source_table="unknown", target_measurement="nothing"),
]


@query(
    "expand_mappings",
    f"""WITH {E_SQL}, {L_SQL}, s AS (
        SELECT DISTINCT measurement AS source_table, series_key, event_type, NULL AS status,
               NULL AS flag FROM e
        UNION ALL SELECT DISTINCT measurement, series_key, NULL, l_linestatus, l_returnflag
        FROM l),
    m(mapping_id, source, target) AS (VALUES
        (0, '*', ''), (1, 'events', 'clicks'), (2, 'lineitem', ''), (3, '', 'all'),
        (4, 'unknown', 'nothing'))
    SELECT m.mapping_id, s.source_table, s.series_key,
           CASE WHEN mapping_id = 2 THEN source_table || '_' || status || '_' || flag
                WHEN target <> '' THEN target
                ELSE source_table || '_' || series_key END AS target_measurement
    FROM s JOIN m ON m.source IN ('', '*') OR m.source = s.source_table
    WHERE (mapping_id <> 1 OR event_type IN ('click', 'view'))
      AND (mapping_id <> 3 OR status = 'F')""",
)
def expand_mappings_query(spark, sf_dir):
    found = series(*all_points(spark, sf_dir)).select(
        F.col("measurement").alias("source_table"), "series_key"
    )
    return expand_mappings(found, mappings_frame(spark, MAPPINGS))

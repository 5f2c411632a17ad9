"""Discovery of tables, columns, series, tag keys and shard groups."""

from pyspark.sql import functions as F

from catalog import query
from catalog.views import (
    DAY,
    E_SCHEMA,
    E_SQL,
    L_SQL,
    ORIGIN,
    WEEK,
    all_points,
    event_points,
    event_rows,
    line_points,
    table,
)
from tidepoint.operators.mapping import named_and_discovered
from tidepoint.sources import discover


@query(
    "discover_tables",
    "SELECT DISTINCT event_type AS measurement FROM events"
    " UNION SELECT DISTINCT source FROM documents",
)
def discover_tables(spark, sf_dir):
    found = discover.measurements(table(spark, sf_dir, "events"), "event_type")
    named = table(spark, sf_dir, "documents").select(F.col("source").alias("measurement"))
    return named_and_discovered(found.withColumnRenamed("event_type", "measurement"), named)


@query(
    "discover_children",
    "SELECT DISTINCT event_type || '_' || user_id AS tbname FROM events",
)
def discover_children(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select(
        F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("tbname")
    )
    return discover.child_tables(rows)


def _profile_sql(table_name, columns, types, id_column, time_column):
    parts = []
    for name, kind in zip(columns, types):
        role = {id_column: "id", time_column: "time"}.get(name, "value")
        zero = " + CAST(0 AS DOUBLE)" if kind == "double" else ""
        text = tuple(f"CAST({f}({name}){zero} AS VARCHAR)" for f in ("min", "max"))
        if kind == "timestamp_ntz" and table_name == "orders":
            text = tuple(f"strftime({f}({name}), '%Y-%m-%d %H:%M:%S')" for f in ("min", "max"))
        parts.append(
            f"SELECT '{table_name}' AS table_name, '{name}' AS name, '{kind}' AS type,"
            f" count(*) AS rows, count(*) - count({name}) AS nulls,"
            f" {text[0]} AS min, {text[1]} AS max, '{role}' AS role FROM {table_name}"
        )
    return " UNION ALL ".join(parts)


@query(
    "column_profile",
    _profile_sql(
        "events",
        ["event_id", "ts", "user_id", "event_type", "value", "props"],
        ["bigint", "timestamp_ntz", "bigint", "string", "double", "string"],
        "event_id",
        "ts",
    )
    + " UNION ALL "
    + _profile_sql(
        "orders",
        [
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            "o_orderpriority",
        ],
        ["bigint", "bigint", "string", "double", "timestamp_ntz", "string"],
        "o_orderkey",
        "o_orderdate",
    ),
)
def column_profile(spark, sf_dir):
    profiles = [
        discover.column_profile(table(spark, sf_dir, name), with_distinct=False).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name in ("events", "orders")
    ]
    return profiles[0].unionByName(profiles[1])


@query(
    "repeated_ids",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem"
    " GROUP BY ALL HAVING count(*) > 1",
)
def repeated_ids(spark, sf_dir):
    return discover.repeated_ids(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "discover_series",
    f"""WITH {E_SQL}, {L_SQL}
    SELECT DISTINCT measurement, event_type, user_id, NULL AS l_returnflag,
           NULL AS l_linestatus, series_key FROM e
    UNION ALL
    SELECT DISTINCT measurement, NULL, NULL, l_returnflag, l_linestatus, series_key FROM l""",
)
def discover_series(spark, sf_dir):
    return discover.series(*all_points(spark, sf_dir))


@query(
    "series_in_window",
    f"""WITH {E_SQL}
    SELECT DISTINCT {ORIGIN} + (time_ns - {ORIGIN}) // {WEEK} * {WEEK} AS window_start,
           measurement, event_type, user_id, series_key
    FROM e""",
)
def series_in_window(spark, sf_dir):
    return discover.series_per_window(event_points(spark, sf_dir), E_SCHEMA, WEEK, ORIGIN)


@query(
    "series_in_range",
    f"""WITH {E_SQL}
    SELECT DISTINCT measurement, event_type, user_id, series_key FROM e
    WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'""",
)
def series_in_range(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select(
        "ts",
        F.lit("events").alias("measurement"),
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
    )
    return discover.series_in_range(
        rows, E_SCHEMA, "ts", "2024-01-10T00:00:00Z", "2024-01-17T00:00:00Z"
    )


@query(
    "discover_tag_keys",
    f"""WITH {E_SQL}, {L_SQL}
    SELECT measurement, 'event_type' AS tag_key FROM e GROUP BY 1
        HAVING bool_or(event_type <> '')
    UNION ALL SELECT measurement, 'user_id' FROM e GROUP BY 1 HAVING bool_or(user_id <> '')
    UNION ALL SELECT measurement, 'l_returnflag' FROM l GROUP BY 1
        HAVING bool_or(l_returnflag <> '')
    UNION ALL SELECT measurement, 'l_linestatus' FROM l GROUP BY 1
        HAVING bool_or(l_linestatus <> '')""",
)
def discover_tag_keys(spark, sf_dir):
    return discover.tag_keys(*all_points(spark, sf_dir))


@query(
    "discover_shards",
    f"""WITH {L_SQL}
    SELECT b + 1 AS shard_group_id, b * {30 * DAY} AS start_ns, (b + 1) * {30 * DAY} AS end_ns,
           count(*) AS points
    FROM (SELECT time_ns // {30 * DAY} AS b FROM l) GROUP BY b""",
)
def discover_shards(spark, sf_dir):
    return discover.shard_groups_of_points(line_points(spark, sf_dir), 30 * DAY)


@query(
    "shard_listing",
    f"""WITH {L_SQL}, s AS (
        SELECT time_ns // {30 * DAY} // 4 AS shard_group_id, time_ns // {DAY} * {DAY} AS start_ns,
               time_ns // {DAY} * {DAY} + {DAY} AS end_ns FROM l)
    SELECT shard_group_id, min(start_ns) AS start_ns, max(end_ns) AS end_ns FROM s
    GROUP BY 1""",
)
def shard_listing(spark, sf_dir):
    """Day shards of the line items, gathered to the groups they belong to."""
    time = F.col("time_ns")
    day = F.lit(DAY).cast("bigint")
    shards = line_points(spark, sf_dir).select(
        F.call_function("div", time, F.lit(120 * DAY).cast("bigint")).alias("shard_group_id"),
        (time - F.pmod(time, day)).alias("start_ns"),
        (time - F.pmod(time, day) + day).alias("end_ns"),
    )
    return discover.shard_groups(shards)

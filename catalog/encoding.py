"""Line text, payloads, time text, child tables and typed targets."""

from pyspark.sql import functions as F

from catalog import query
from catalog.views import E_ID_SCHEMA, E_SCHEMA, E_SQL, L_SCHEMA, L_SQL
from catalog.views import event_points, event_rows, finished, line_points, number_sql, table
from tidepoint.functions.timefn import (
    epoch_number_to_ns,
    ns_to_ms_text,
    ns_to_timestamp,
    parse_time_ns,
    time_is_set,
    timestamp_to_ns,
)
from tidepoint.operators.upsert import last_wins
from tidepoint.points import FieldMap, Mapping, PointsSchema, to_points
from tidepoint.sinks.children import route_to_children
from tidepoint.sinks.lines import payloads, to_lines
from tidepoint.session import scratch_path
from tidepoint.sinks.tables import save_typed_table, typed_rows, upsert_rows

E_LINE = (
    "measurement || ',event_type=' || event_type || ',user_id=' || user_id"
    f" || ' k=' || k || 'i,value=' || {number_sql('value')} || ' ' || time_ns"
)


@query("line_protocol_v1", f"WITH {E_SQL} SELECT event_id, {E_LINE} AS line FROM e")
def line_protocol_v1(spark, sf_dir):
    points = event_points(spark, sf_dir, with_id=True)
    return to_lines(points, E_SCHEMA, keep=["event_id"])


@query(
    "line_protocol_v2",
    f"""WITH {L_SQL}
    SELECT 'lineitem,l_linestatus=' || l_linestatus || ',l_returnflag=' || l_returnflag
        || ' l_discount=' || {number_sql('l_discount')}
        || ',l_extendedprice=' || {number_sql('l_extendedprice')}
        || ',l_quantity=' || {number_sql('l_quantity')} || ',l_tax=' || {number_sql('l_tax')}
        || ' ' || time_ns AS line
    FROM l""",
)
def line_protocol_v2(spark, sf_dir):
    return to_lines(line_points(spark, sf_dir), L_SCHEMA, always_time=True)


@query(
    "line_escapes",
    r"""SELECT doc_id,
           'text\ docs,lang=' || lang || ',source\ name=' ||
               regexp_replace(lang || ', ' || source || '=x', '([,= ])', '\\\1', 'g')
               || ' n\=chars=' || n_chars || 'i,text="'
               || replace(replace(text, '\', '\\'), '"', '\"') || '",valid='
               || CASE WHEN n_chars > 200 THEN 'true' ELSE 'false' END AS line
    FROM documents""",
)
def line_escapes(spark, sf_dir):
    """Whole documents as string fields, odd characters in names and tags, no time."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.concat("lang", F.lit(", "), "source", F.lit("=x")).alias("source name"),
        "text",
        F.col("n_chars").alias("n=chars"),
        (F.col("n_chars") > 200).alias("valid"),
    )
    schema = PointsSchema(
        ("lang", "source name"), ("text", "n=chars", "valid"), id_col="doc_id"
    )
    points = to_points(rows, schema, None, "text docs")
    return to_lines(points, schema, keep=["doc_id"])


@query(
    "line_absent",
    f"""WITH {E_SQL}
    SELECT event_id, 'events' || CASE WHEN event_type <> 'view' THEN ',event_type=' || event_type
               ELSE '' END || ',user_id=' || user_id
           || ' ' || concat_ws(',', CASE WHEN k > 20 THEN 'k=' || k || 'i' END,
                               CASE WHEN value > 10 THEN 'value=' || {number_sql('value')} END)
           || ' ' || CASE WHEN k > 90 THEN 0 ELSE time_ns END AS line
    FROM e WHERE k > 20 OR value > 10""",
)
def line_absent(spark, sf_dir):
    """Absent tags and fields are left out, points without fields dropped, no time is 0."""
    points = event_points(spark, sf_dir, with_id=True).withColumns(
        {
            "event_type": F.when(F.col("event_type") != "view", F.col("event_type")),
            "k": F.when(F.col("k") > 20, F.col("k")),
            "value": F.when(F.col("value") > 10, F.col("value")),
            "time_ns": F.when(F.coalesce(F.col("k"), F.lit(0)) <= 90, F.col("time_ns")),
        }
    )
    return to_lines(points, E_SCHEMA, always_time=True, keep=["event_id"])


@query(
    "payload",
    f"""WITH {E_SQL}, n AS (
        SELECT event_type, {E_LINE} AS line,
               row_number() OVER (PARTITION BY event_type ORDER BY time_ns, event_id) AS row_no
        FROM e)
    SELECT event_type, (row_no - 1) // 500 AS batch_id, CAST(0 AS INTEGER) AS part_no,
           count(*) AS lines,
           string_agg(line, chr(10) ORDER BY row_no) AS payload
    FROM n GROUP BY ALL""",
)
def payload(spark, sf_dir):
    return payloads(
        event_points(spark, sf_dir, with_id=True),
        E_SCHEMA,
        500,
        ["event_type"],
        ["time_ns", "event_id"],
    )


@query(
    "time_text",
    f"""WITH {E_SQL}, t AS (
        SELECT event_id, ts, k, time_ns, time_ns + k * 10 AS ns FROM e)
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ms_text,
           ns AS rfc_ns, CASE WHEN k > 50 THEN time_ns // 1000000000 * 1000000000 END AS plain_ns,
           ns - 7200000000000 AS offset_ns,
           CAST(NULL AS BIGINT) AS bad_ns,
           time_ns // 1000000000 * 1000000000 AS epoch_ns, time_ns AS given_ns,
           time_ns // 1000 * 1000 AS back_ns, k > 0 AS has_time
    FROM t""",
)
def time_text(spark, sf_dir):
    """Times as text with nine digits, without fraction, with offset, broken, and as numbers."""
    ns = timestamp_to_ns(F.col("ts"))
    nine = F.concat(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.lpad((F.col("k") * 10).cast("string"), 3, "0"),
    )
    plain = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    seconds = F.call_function("div", ns, F.lit(1_000_000_000).cast("bigint"))
    return event_rows(spark, sf_dir).select(
        "event_id",
        ns_to_ms_text(ns).alias("ms_text"),
        parse_time_ns(F.concat(nine, F.lit("Z"))).alias("rfc_ns"),
        F.when(F.col("k") > 50, parse_time_ns(plain)).alias("plain_ns"),
        parse_time_ns(F.concat(nine, F.lit("+02:00"))).alias("offset_ns"),
        parse_time_ns(F.concat(plain, F.lit("x"))).alias("bad_ns"),
        epoch_number_to_ns(seconds).alias("epoch_ns"),
        epoch_number_to_ns(ns).alias("given_ns"),
        timestamp_to_ns(ns_to_timestamp(ns)).alias("back_ns"),
        time_is_set(F.when(F.col("k") > 0, ns).otherwise(0)).alias("has_time"),
    )


@query(
    "upsert_last_wins",
    f"""WITH {E_SQL}, h AS (
        SELECT time_ns // 3600000000000 * 3600000000000 AS key_time_ns, event_type, user_id, k,
               value, event_id,
               row_number() OVER (PARTITION BY time_ns // 3600000000000, event_type, user_id
                                  ORDER BY event_id DESC) AS r
        FROM e)
    SELECT key_time_ns, event_type, user_id, k, value, event_id FROM h WHERE r = 1""",
)
def upsert_last_wins(spark, sf_dir):
    points = event_points(spark, sf_dir, with_id=True)
    hourly = points.withColumn("time_ns", F.col("time_ns") - F.pmod("time_ns", F.lit(3600 * 10**9)))
    rows = upsert_rows(hourly, E_ID_SCHEMA, ["event_id"])
    return last_wins(rows, ["key_time_ns", "event_type", "user_id"], ["event_id"])


@query(
    "child_routing",
    f"""WITH {E_SQL}
    SELECT event_id, 'metrics_' || md5(series_key) AS child_table, event_type, user_id, time_ns
    FROM e""",
)
def child_routing(spark, sf_dir):
    points = event_points(spark, sf_dir, with_id=True)
    routed = route_to_children(points, E_SCHEMA, F.lit("metrics"))
    return routed.select("event_id", "child_table", "event_type", "user_id", "time_ns")


@query(
    "typed_target",
    f"""WITH {E_SQL}
    SELECT event_type, user_id, CAST(k AS VARCHAR) AS k, value,
           epoch_us(ts) // 1000 AS time_ms
    FROM e""",
)
def typed_target(spark, sf_dir):
    mapping = Mapping(
        fields=(FieldMap("value", data_type="float64"), FieldMap("k", data_type="varchar"))
    )
    rows = typed_rows(event_points(spark, sf_dir), E_SCHEMA, mapping)
    millis = F.unix_millis("_migration_time").alias("time_ms")
    return rows.select("event_type", "user_id", "k", "value", millis)


@query(
    "typed_super_table",
    f"""WITH {E_SQL}
    SELECT event_type, user_id, CAST(k AS INTEGER) AS k, CAST(CAST(value AS FLOAT) AS DOUBLE)
           AS value, epoch_us(ts) // 1000 AS time_ms
    FROM e""",
)
def typed_super_table(spark, sf_dir):
    mapping = Mapping(
        fields=(FieldMap("value", data_type="float64"), FieldMap("k", data_type="int"))
    )
    rows = typed_rows(event_points(spark, sf_dir), E_SCHEMA, mapping, super_table=True)
    millis = F.unix_millis("_migration_time").alias("time_ms")
    value = F.col("value").cast("double").alias("value")
    return rows.select("event_type", "user_id", "k", value, millis)


@query(
    "typed_table_saved",
    """SELECT o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice,
           CASE WHEN o_totalprice <= 250000 THEN o_orderkey END AS o_orderkey,
           epoch_us(o_orderdate) // 1000 AS time_ms
    FROM orders""",
)
def typed_table_saved(spark, sf_dir):
    """Orders in a catalog table that the first part creates; the second has a column more."""
    schema = PointsSchema(("o_orderpriority",), ("o_custkey", "o_orderkey", "o_totalprice"))
    mapping = Mapping(
        fields=(
            FieldMap("o_custkey", data_type="text"),
            FieldMap("o_orderkey", data_type="int64"),
            FieldMap("o_totalprice", "", "double"),
        )
    )
    points = to_points(table(spark, sf_dir, "orders"), schema, "o_orderdate", "orders")
    rows = typed_rows(points, schema, mapping)
    path = scratch_path(spark, "typed")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    dear = F.col("o_totalprice") > 250_000
    for part in (rows.where(dear).drop("o_orderkey"), rows.where(~dear)):
        save_typed_table(part, name, path)
    millis = F.unix_millis("_migration_time").alias("time_ms")
    saved = finished(
        spark.table(name).select(
            "o_orderpriority", "o_custkey", "o_totalprice", "o_orderkey", millis
        ),
        path,
    )
    spark.sql(f"DROP TABLE {name}")
    return saved

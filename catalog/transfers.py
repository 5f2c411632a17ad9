"""Ingest of saved responses, and whole runs that write targets and ledgers."""

from pyspark.sql import functions as F

from catalog import query
from catalog.views import (
    E_ID_SCHEMA,
    E_SCHEMA,
    DAY,
    E_SQL,
    L_SCHEMA,
    L_SQL,
    ORIGIN,
    WEEK,
    event_points,
    event_rows,
    finished,
    line_points,
    table,
)
from tidepoint.functions.timefn import parse_instant
from tidepoint.operators.ledger import Ledger
from tidepoint.operators.numbering import chunk_batches
from tidepoint.points import FieldMap, Mapping, PointsSchema, TagMap, to_points
from tidepoint.plans.backfill import run_backfill, run_windows, source_reader
from tidepoint.plans.transfer import mapped_points, resume, run_mapping, run_mappings
from tidepoint.session import pin, scratch_path
from tidepoint.sinks.lines import to_lines, write_lines
from tidepoint.sinks.children import ChildTables, route_to_children
from tidepoint.sinks.tables import UpsertTable, flat_rows, upsert_rows
from tidepoint.sources.discover import shard_groups_of_points
from tidepoint.sources.ingest import (
    infer_response_schema,
    long_points,
    parse_responses,
    to_long,
    widen,
)
from tidepoint.sources.pages import read_pages, save_pages, stream_pages
from tidepoint.streaming.incremental import sync_new_files

POINTS_SQL = (
    f"WITH {E_SQL} SELECT measurement, event_type, user_id, k, value, time_ns FROM e"
)
TABLE_SQL = f"""WITH {E_SQL}
    SELECT epoch_us(ts) // 1000 * 1000000 AS key_time_ns, event_type, user_id, k, value, event_id
    FROM e"""
KEYS = ["key_time_ns", "event_type", "user_id"]
PAGES_START = parse_instant("2024-01-08T00:00:00Z")
PAGES_END = parse_instant("2024-01-22T12:30:00Z")


def _rfc_time():
    time = F.timestamp_micros(F.expr("time_ns div 1000"))
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def responses_of(points):
    """Points as saved query responses of 500 value lists each."""
    columns = ("event_type", "user_id", "value", "k")
    cells = F.array(*[c.cast("variant") for c in (_rfc_time(), *map(F.col, columns))])
    chunks = chunk_batches(
        points.select("event_type", "event_id", "time_ns", cells.alias("cells")),
        500,
        ["event_type"],
        ["time_ns", "event_id"],
    )
    series = F.struct(
        F.lit("events").alias("name"),
        F.array(*[F.lit(c) for c in ("time", *columns)]).alias("columns"),
        F.collect_list("cells").alias("values"),
    )
    return chunks.groupBy("event_type", "batch_id").agg(
        F.to_json(F.struct(F.array(series).alias("results"))).alias("response"),
        F.min("time_ns").alias("first_ns"),
        F.max("time_ns").alias("last_ns"),
    )


@query("json_ingest", POINTS_SQL)
def json_ingest(spark, sf_dir):
    """Events as saved JSON responses and back, roles and types inferred from the text."""
    path = scratch_path(spark, "responses")
    responses_of(event_points(spark, sf_dir, with_id=True)).select("response").write.text(path)
    saved = spark.read.text(path).withColumnRenamed("value", "response")
    schema, types = infer_response_schema(saved)
    return finished(parse_responses(saved, schema, types), path)


@query("json_ingest_tag_keys", POINTS_SQL)
def json_ingest_tag_keys(spark, sf_dir):
    """The same with the tag keys given, by which text values may also be fields."""
    path = scratch_path(spark, "responses")
    responses_of(event_points(spark, sf_dir, with_id=True)).select("response").write.text(path)
    saved = spark.read.text(path).withColumnRenamed("value", "response")
    schema, types = infer_response_schema(saved, tag_keys=["user_id"])
    return finished(parse_responses(saved, schema, types), path)


E_TYPES = {"value": "double", "k": "bigint"}


@query(
    "pages_in_range",
    POINTS_SQL
    + f" WHERE time_ns >= {PAGES_START} AND time_ns < {PAGES_END}",
)
def pages_in_range(spark, sf_dir):
    """A time range of saved pages, of which only those that share time with it are read."""
    path = scratch_path(spark, "pages")
    save_pages(responses_of(event_points(spark, sf_dir, with_id=True)), path)
    pages = read_pages(spark, path, PAGES_START, PAGES_END)
    points = parse_responses(pages.select("response"), E_SCHEMA, E_TYPES)
    return finished(points.where(F.col("time_ns").between(PAGES_START, PAGES_END - 1)), path)


@query("streamed_pages", POINTS_SQL)
def streamed_pages(spark, sf_dir):
    """Pages saved in two goes and read as a stream after each: every page arrives once."""
    path, out, marks = (scratch_path(spark, f"pages-{n}") for n in ("in", "out", "marks"))
    pages = responses_of(event_points(spark, sf_dir, with_id=True))
    early = F.col("first_ns") < F.lit(PAGES_START).cast("bigint")
    for some in (pages.where(early), pages.where(~early)):
        save_pages(some, path)
        points = parse_responses(stream_pages(spark, path).select("response"), E_SCHEMA, E_TYPES)
        run = (
            points.writeStream.format("parquet")
            .option("checkpointLocation", marks)
            .trigger(availableNow=True)
            .start(out)
        )
        run.awaitTermination()
    return finished(spark.read.parquet(out), path, out, marks)


@query(
    "long_rows",
    f"""WITH {E_SQL}
    SELECT measurement, measurement AS _measurement, event_type, user_id, 'k' AS field_name,
           CAST(k AS VARCHAR) AS field_value, time_ns FROM e
    UNION ALL SELECT measurement, measurement, event_type, user_id, 'value',
           CAST(value AS VARCHAR), time_ns FROM e""",
)
def long_rows(spark, sf_dir):
    return long_points(_long_form(spark, sf_dir), ["event_type", "user_id"])


@query("widen_rows", POINTS_SQL)
def widen_rows(spark, sf_dir):
    """Long rows widened, each value preceded by a greater one that it replaces."""
    rows = _long_form(spark, sf_dir).withColumn("seq", F.lit(2))
    former = rows.withColumns({"seq": F.lit(1), "_value": F.lit("999999")})
    points = long_points(rows.unionByName(former), ["event_type", "user_id"], fields=["seq"])
    return widen(
        points, ["event_type", "user_id"], {"value": "double", "k": "bigint"}, ["seq"]
    )


def _long_form(spark, sf_dir):
    rows = to_long(event_points(spark, sf_dir), E_SCHEMA)
    return rows.withColumn("_time", _rfc_time())


def _rows(frame):
    return upsert_rows(to_points(frame, E_ID_SCHEMA, "ts", "events"), E_ID_SCHEMA, ["event_id"])


@query("incremental_union", TABLE_SQL)
def incremental_union(spark, sf_dir):
    """Two increments arrive as files; each run takes only what is new."""
    base = scratch_path(spark, "incremental")
    rows = event_rows(spark, sf_dir)
    middle = F.lit("2024-01-15T00:00:00").cast("timestamp_ntz")
    target = UpsertTable(spark, f"{base}/table", KEYS, ["batch_seq", "event_id"], "key_time_ns")
    # The later half comes with a replay of part of the earlier one.
    for increment in (F.col("ts") < middle, (F.col("ts") >= middle) | (F.col("value") > 90)):
        rows.where(increment).write.mode("append").parquet(f"{base}/in")
        sync_new_files(spark, f"{base}/in", rows.schema, _rows, target, f"{base}/progress")
    return finished(target.current().drop("batch_seq"), base)


@query("backfill_run", TABLE_SQL)
def backfill_run(spark, sf_dir):
    """A backfill of all weeks in one wave, after one of the first two weeks."""
    base = scratch_path(spark, "backfill")
    points = source_reader(event_rows(spark, sf_dir), E_ID_SCHEMA, "ts", "events")
    shards = shard_groups_of_points(event_points(spark, sf_dir, with_id=True), WEEK, ORIGIN)
    target = UpsertTable(spark, f"{base}/table", KEYS, ["event_id"], "key_time_ns")
    ledger = Ledger(spark, f"{base}/ledger")

    def sink(moved, schema):
        target.upsert(upsert_rows(moved, schema, ["event_id"]))

    for end in (ORIGIN + 2 * WEEK, ORIGIN + 60 * WEEK):
        run_backfill(
            points, E_ID_SCHEMA, shards, "backfill", ORIGIN, end, WEEK, sink, ledger
        )
    return finished(target.current(), base)


@query(
    "transfer_run",
    f"""WITH {E_SQL}
    SELECT epoch_us(ts) // 1000 * 1000000 AS key_time_ns, event_type AS kind, user_id,
           value AS amount, event_id
    FROM e WHERE event_type IN ('click', 'purchase')""",
)
def transfer_run(spark, sf_dir):
    """One mapping run twice on a source that grew in between."""
    base = scratch_path(spark, "transfer")
    rows = event_rows(spark, sf_dir)
    target = UpsertTable(
        spark, f"{base}/table", ["key_time_ns", "kind", "user_id"], ["event_id"], "key_time_ns"
    )
    ledger = Ledger(spark, f"{base}/ledger")
    mapping = Mapping(
        source_table="events",
        target_measurement="activity",
        tags=(TagMap("event_type", "kind"), TagMap("user_id")),
        fields=(FieldMap("value", "amount", "float"),),
        tag_filters={"event_type": ["click", "purchase"]},
    )

    def sink(points, schema):
        target.upsert(upsert_rows(points, schema, ["event_id"]))

    early = rows.where(F.col("ts") < F.lit("2024-01-20T00:00:00").cast("timestamp_ntz"))
    for source in (early, rows):
        run_mapping(source, E_ID_SCHEMA, mapping, "ts", sink, ledger, "transfer")
    return finished(target.current(), base)


@query(
    "resume_same_time",
    f"""WITH {E_SQL}, d AS (
        SELECT time_ns // {DAY} * {DAY} AS key_time_ns, event_id, event_type, value FROM e)
    SELECT key_time_ns, event_id, event_type, value, last_id, processed_rows
    FROM d, (SELECT count(*) AS processed_rows FROM d),
         (SELECT max(event_id) AS last_id FROM d
          WHERE key_time_ns = (SELECT max(key_time_ns) FROM d))""",
)
def resume_same_time(spark, sf_dir):
    """Times cut to the day, so most rows share one; odd ids come in a later run."""
    base = scratch_path(spark, "same-time")
    rows = event_rows(spark, sf_dir).withColumn(
        "ts", F.date_trunc("day", "ts").cast("timestamp_ntz")
    )
    last = rows.agg(F.max("ts")).first()[0]
    schema = PointsSchema(("event_type",), ("value",), id_col="event_id")
    target = UpsertTable(
        spark, f"{base}/table", ["key_time_ns", "event_id"], ["value"], "key_time_ns", 30 * DAY
    )
    ledger = Ledger(spark, f"{base}/ledger")
    mapping = Mapping(source_table="events", target_measurement="activity")

    def sink(points, schema):
        target.upsert(upsert_rows(points, schema, ["event_id"]))

    # What comes later lies after the mark: the last day's rows with the higher ids.
    middle = rows.where(F.col("ts") == last).agg(F.expr("median(event_id)")).first()[0]
    early = rows.where((F.col("ts") < last) | (F.col("event_id") <= middle))
    for source in (early, rows):
        run_mapping(source, schema, mapping, "ts", sink, ledger, "same-time")
    task = ledger.load("same-time", "events")
    result = target.current().select("key_time_ns", "event_id", "event_type", "value")
    marks = {n: F.lit(task[n]).cast("bigint") for n in ("last_id", "processed_rows")}
    return finished(result.withColumns(marks), base)


@query(
    "run_mappings",
    f"""WITH {E_SQL}, o AS (
        SELECT o_orderstatus, o_orderpriority, epoch_us(o_orderdate) * 1000 AS time_ns FROM orders)
    SELECT 'all' AS measurement, 'events' AS source, count(*) AS points, max(time_ns) AS last_time_ns
    FROM e
    UNION ALL SELECT 'all', 'orders', count(*), max(time_ns) FROM o
    UNION ALL SELECT 'events_' || event_type, 'events', count(*), max(time_ns) FROM e GROUP BY 1
    UNION ALL SELECT 'open', 'orders', count(*), max(time_ns) FROM o WHERE o_orderstatus = 'O'""",
)
def run_mappings_query(spark, sf_dir):
    """A wildcard, a name pattern per series and a filter, over two tables."""
    base = scratch_path(spark, "mappings")
    sources = {
        "events": (event_rows(spark, sf_dir), PointsSchema(("event_type",), ("value",)), "ts"),
        "orders": (
            table(spark, sf_dir, "orders"),
            PointsSchema(("o_orderstatus", "o_orderpriority"), ("o_totalprice",)),
            "o_orderdate",
        ),
    }
    mappings = [
        Mapping(target_measurement="all"),
        Mapping(source_table="events", subtable_pattern="{{table}}_{{value2}}"),
        Mapping(target_measurement="open", tag_filters={"o_orderstatus": ["O"]}),
    ]

    def sink(points, schema):
        source = "events" if "value" in schema.fields else "orders"
        (
            points.groupBy("measurement")
            .agg(F.count(F.lit(1)).alias("points"), F.max("time_ns").alias("last_time_ns"))
            .withColumn("source", F.lit(source))
            .write.mode("append")
            .parquet(f"{base}/moved")
        )

    run_mappings(sources, mappings, sink, Ledger(spark, f"{base}/ledger"), "list")
    return finished(spark.read.parquet(f"{base}/moved"), base)


def whole_windows(spark, sf_dir, width):
    """The end of the last window that holds an event."""
    last = event_points(spark, sf_dir).agg(F.max("time_ns")).first()[0]
    return ORIGIN + (last - ORIGIN) // width * width + width


@query(
    "resume_in_window",
    f"""WITH {E_SQL}, w AS (
        SELECT {ORIGIN} + (time_ns - {ORIGIN}) // {2 * WEEK} * {2 * WEEK} AS window_start, *
        FROM e),
    n AS (SELECT window_start, count(DISTINCT event_type) AS kinds, count(*) AS n,
                 max(time_ns) AS last_time_ns FROM w GROUP BY 1),
    b AS (SELECT window_start, event_type,
                 dense_rank() OVER (PARTITION BY window_start ORDER BY event_type) - 1 AS no FROM w)
    SELECT n.window_start, 'failed' AS status, CAST(0 AS INTEGER) AS last_completed_batch,
           (SELECT count(*) FROM b WHERE b.window_start = n.window_start AND no < 2)
               AS total_processed_rows
    FROM n
    UNION ALL SELECT window_start, 'completed', CAST((kinds - 1) // 2 AS INTEGER), n FROM n""",
)
def resume_in_window(spark, sf_dir):
    """The window ledger after a sink that stops in the second batch, and after the resume."""
    base = scratch_path(spark, "in-window")
    schema = PointsSchema(("event_type",), ("value",))
    points = source_reader(event_rows(spark, sf_dir), schema, "ts", "events")
    ledger = Ledger(spark, f"{base}/ledger")
    end = whole_windows(spark, sf_dir, 2 * WEEK)
    calls = []

    def sink(moved, schema):
        calls.append(moved.count())
        if len(calls) == 2:
            raise RuntimeError("the target is down")

    def run():
        return run_windows(
            points, schema, "in-window", ORIGIN, end, 2 * WEEK, sink, ledger, series_per_query=2
        ).select("window_start", "status", "last_completed_batch", "total_processed_rows")

    try:
        run()
    except RuntimeError:
        stopped = pin(
            ledger.windows().select(
                "window_start", "status", "last_completed_batch", "total_processed_rows"
            )
        )
    return finished(stopped.union(run()), base)


@query(
    "upsert_widened",
    """SELECT epoch_us(o_orderdate) * 1000 AS time_ns, o_orderkey, any_value(slice) AS slice,
              any_value(amount) AS amount
    FROM (SELECT o_orderdate, o_orderkey, o_orderpriority AS slice,
                 CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderkey % 7 = 0
                      THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS amount
          FROM orders) GROUP BY 1, 2""",
)
def upsert_widened(spark, sf_dir):
    """A whole-number column takes fractions later; a column is named like a storage slice."""
    path = scratch_path(spark, "widened")
    orders = table(spark, sf_dir, "orders").select(
        (F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000).alias("time_ns"),
        "o_orderkey", F.col("o_orderpriority").alias("slice"), "o_custkey", "o_totalprice",
        "o_orderdate",
    )
    target = UpsertTable(
        spark, path, ["time_ns", "o_orderkey"], ["seq"], "time_ns", 366 * DAY
    )
    keys = ["time_ns", "o_orderkey", "slice"]
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    whole = orders.select(*keys, F.col("o_custkey").alias("amount"), F.lit(1).alias("seq"))
    target.upsert(whole)
    dear = orders.where(late | (F.col("o_orderkey") % 7 == 0))
    target.upsert(dear.select(*keys, F.col("o_totalprice").alias("amount"), F.lit(2).alias("seq")))
    return finished(target.current().drop("seq"), path)


FLAGSHIP = Mapping(
    source_table="events",
    target_measurement="activity",
    tags=(TagMap("event_type", "kind"), TagMap("user_id", "user")),
    fields=(FieldMap("value", "amount", "float"), FieldMap("k", "level", "float")),
    tag_filters={"event_type": ["click", "purchase"]},
    start="2024-01-08T00:00:00Z",
    end="2024-01-15T00:00:00Z",
)


@query(
    "migrate_lines",
    f"""WITH {E_SQL}
    SELECT 'activity,kind=' || event_type || ',user=' || user_id || ' amount='
           || regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') || ',level=' || k || ' '
           || time_ns AS line
    FROM e
    WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'
      AND event_type IN ('click', 'purchase')""",
)
def migrate_lines(spark, sf_dir):
    """Clicks and purchases of one week, renamed and cast, as line text."""
    points, schema = mapped_points(event_rows(spark, sf_dir), E_SCHEMA, FLAGSHIP, "ts")
    return to_lines(points, schema)


@query(
    "lines_written",
    """SELECT 'lines' AS kind, count(*) AS n, CAST(sum(length(
        'orders,o_orderpriority=' || replace(o_orderpriority, ' ', '\\ ')
        || ' o_custkey=' || o_custkey || 'i,o_orderkey=' || o_orderkey || 'i '
        || epoch_us(o_orderdate) * 1000)) AS BIGINT) AS chars
    FROM orders""",
)
def lines_written(spark, sf_dir):
    """Orders written as line text and read back."""
    schema = PointsSchema(("o_orderpriority",), ("o_custkey", "o_orderkey"))
    path = scratch_path(spark, "lines")
    points = to_points(table(spark, sf_dir, "orders"), schema, "o_orderdate", "orders")
    write_lines(to_lines(points, schema), path)
    return finished(
        spark.read.text(path).agg(
            F.lit("lines").alias("kind"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.length("value")).alias("chars"),
        ),
        path,
    )


@query(
    "flat_append",
    """SELECT time_ns, o_orderkey, o_custkey, o_totalprice FROM (
        SELECT epoch_us(o_orderdate) * 1000 AS time_ns, o_orderkey, o_custkey, o_totalprice,
               row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey DESC) AS r
        FROM orders) WHERE r = 1""",
)
def flat_append(spark, sf_dir):
    """Orders in a flat table keyed on time, all loaded and then the dear ones again."""
    schema = PointsSchema((), ("o_orderkey", "o_custkey", "o_totalprice"))
    points = to_points(table(spark, sf_dir, "orders"), schema, "o_orderdate", "orders")
    rows = flat_rows(points, schema, ["o_orderkey"])
    path = scratch_path(spark, "flat")
    target = UpsertTable(spark, path, ["time_ns"], ["o_orderkey"], "time_ns", 366 * DAY)
    target.upsert(rows)
    target.upsert(rows.where(F.col("o_totalprice") > 300_000))
    return finished(target.current(), path)


@query(
    "windowed_run",
    f"""WITH {E_SQL}, w AS (
        SELECT {ORIGIN} + (time_ns - {ORIGIN}) // {3 * DAY} * {3 * DAY} AS window_start,
               count(*) AS total_processed_rows, max(time_ns) AS last_time_ns
        FROM e GROUP BY 1)
    SELECT 'windowed' AS task_id, window_start,
           least(window_start + {3 * DAY}, (SELECT max(last_time_ns) + 1 FROM w)) AS window_end,
           last_time_ns, total_processed_rows, 'completed' AS status
    FROM w""",
)
def windowed_run(spark, sf_dir):
    """The window ledger after a backfill in three-day windows; the last one is clipped."""
    base = scratch_path(spark, "windowed")
    last = event_points(spark, sf_dir).agg(F.max("time_ns")).first()[0]
    known = run_windows(
        source_reader(event_rows(spark, sf_dir), E_SCHEMA, "ts", "events"),
        E_SCHEMA,
        "windowed",
        ORIGIN,
        last + 1,
        3 * DAY,
        lambda moved, schema: write_lines(to_lines(moved, schema), f"{base}/lines", "append"),
        Ledger(spark, f"{base}/ledger"),
    )
    columns = ("window_start", "window_end", "last_time_ns", "total_processed_rows", "status")
    return finished(known.select("task_id", *columns), base)


@query(
    "resume_run",
    f"""WITH {E_SQL}
    SELECT epoch_us(ts) // 1000 * 1000000 AS key_time_ns, event_type AS kind, value AS amount,
           event_id
    FROM e WHERE event_type <> 'view'""",
)
def resume_run(spark, sf_dir):
    """A run that was killed after its first increment, taken up by a resume."""
    base = scratch_path(spark, "resume")
    rows = event_rows(spark, sf_dir)
    keys = ["key_time_ns", "kind", "event_id"]
    target = UpsertTable(spark, f"{base}/table", keys, ["event_id"], "key_time_ns", 30 * DAY)
    ledger = Ledger(spark, f"{base}/ledger")
    mapping = Mapping(
        source_table="events",
        tags=(TagMap("event_type", "kind"),),
        fields=(FieldMap("value", "amount", "float"),),
        tag_filters={"event_type": ["click", "error", "purchase", "signup"]},
    )

    def sink(points, schema):
        target.upsert(upsert_rows(points, schema, ["event_id"]))

    early = rows.where(F.col("ts") < F.lit("2024-01-12T00:00:00").cast("timestamp_ntz"))
    run_mapping(early, E_ID_SCHEMA, mapping, "ts", sink, ledger, "resumed")
    ledger.mark("resumed", "events", "in_progress")
    resume(ledger, lambda name: (table_rows(spark, sf_dir, name), E_ID_SCHEMA, "ts"), sink)
    return finished(target.current(), base)


def table_rows(spark, sf_dir, name):
    return event_rows(spark, sf_dir) if name == "events" else table(spark, sf_dir, name)


@query(
    "children_written",
    f"""WITH {L_SQL}
    SELECT 'bulk_' || md5(series_key) AS child_table, l_returnflag, l_linestatus,
           count(DISTINCT time_ns) AS points, max(time_ns) AS last_time_ns
    FROM l GROUP BY child_table, l_returnflag, l_linestatus""",
)
def children_written(spark, sf_dir):
    """Line items in child tables, one point per series and time, loaded twice, read back."""
    path = scratch_path(spark, "children")
    routed = route_to_children(line_points(spark, sf_dir), L_SCHEMA, F.lit("bulk"))
    target = ChildTables(spark, path, L_SCHEMA, ["l_extendedprice"])
    for _ in range(2):
        target.upsert(routed)
    return finished(
        target.current()
        .groupBy("child_table", "l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("points"), F.max("time_ns").alias("last_time_ns")),
        path,
    )

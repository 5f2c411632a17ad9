"""Covered time, fingerprints, stored indexes and profiles, over whole tables."""

from pyspark.sql import functions as F

from catalog import query
from catalog.discovery import _profile_sql
from catalog.progress import KEYS, TARGET_SQL, VALUES, source_and_target
from catalog.views import (
    DAY,
    E_ID_SCHEMA,
    E_SCHEMA,
    E_SQL,
    ORIGIN,
    event_points,
    event_rows,
    finished,
    table,
)
from tidepoint.functions.timefn import time_faults
from tidepoint.operators.coverage import covered_ranges, uncovered_ranges
from tidepoint.operators.fingerprint import reconcile_windows
from tidepoint.operators.ledger import Ledger
from tidepoint.operators.windows import assign_intervals, balanced_windows, window_start_of
from tidepoint.plans.backfill import run_windows, source_reader
from tidepoint.plans.verify import verify_windows
from tidepoint.points import to_points
from tidepoint.session import scratch_path
from tidepoint.sinks.tables import UpsertTable, upsert_rows
from tidepoint.sources.discover import StoredProfile, series
from tidepoint.sources.index import BatchDictionary, SeriesIndex
from tidepoint.streaming.incremental import sync_new_files

HOUR = DAY // 24
MIDDLE = ORIGIN + 14 * DAY

FAR_SQL = f"""{E_SQL}, far AS (
    SELECT event_type, event_id % 50 < 2 AS is_far,
           CASE WHEN event_id % 50 < 2 THEN NULL ELSE time_ns END AS time_ns FROM e)"""


@query(
    "far_times",
    f"""WITH {FAR_SQL}
    SELECT event_type, count(*) AS points, count(time_ns) AS timed, max(time_ns) AS last_time_ns,
           (SELECT count(*) FROM far WHERE is_far) AS out_of_range
    FROM far GROUP BY event_type""",
)
def far_times(spark, sf_dir):
    """Events of which some carry the sentinels 9999-12-31 and 0001-01-01 as their time."""
    far = {0: "9999-12-31T00:00:00", 1: "0001-01-01T00:00:00"}
    time = F.col("ts")
    for rest, text in far.items():
        sentinel = F.lit(text).cast("timestamp_ntz")
        time = F.when(F.col("event_id") % 50 == rest, sentinel).otherwise(time)
    rows = event_rows(spark, sf_dir).withColumn("ts", time)
    faults = time_faults(rows, "ts").select("out_of_range")
    points = to_points(rows, E_SCHEMA, "ts", "events")
    counted = points.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("points"),
        F.count("time_ns").alias("timed"),
        F.max("time_ns").alias("last_time_ns"),
    )
    return counted.withColumn("out_of_range", F.lit(faults.first()[0]).cast("bigint"))


# A window of some hours after every event of odd number is done; the range of its type is wanted.
COVER_SQL = f"""{E_SQL}, wanted AS (
    SELECT event_type, min(time_ns) AS low, max(time_ns) + 1 AS high FROM e GROUP BY 1),
done AS (
    SELECT event_type, time_ns AS s, time_ns + (1 + k % 5) * {HOUR // 4} AS t FROM e
    WHERE event_id % 2 = 1),
mark AS (
    SELECT *, CASE WHEN s <= max(t) OVER (PARTITION BY event_type ORDER BY s, t
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                   THEN 0 ELSE 1 END AS is_new FROM done),
island AS (
    SELECT *, sum(is_new) OVER (PARTITION BY event_type ORDER BY s, t) AS no FROM mark),
held AS (
    SELECT event_type, min(s) AS start_ns, max(t) AS end_ns FROM island GROUP BY event_type, no),
gaps AS (
    SELECT event_type, coalesce(lag(end_ns) OVER w, low) AS start_ns, start_ns AS end_ns
    FROM held JOIN wanted USING (event_type)
    WINDOW w AS (PARTITION BY event_type ORDER BY held.start_ns)
    UNION ALL
    SELECT event_type, max(end_ns), any_value(high)
    FROM held JOIN wanted USING (event_type) GROUP BY event_type)"""


def _wanted_and_done(spark, sf_dir):
    points = event_points(spark, sf_dir, with_id=True)
    wanted = points.groupBy("event_type").agg(
        F.min("time_ns").alias("start_ns"), (F.max("time_ns") + 1).alias("end_ns")
    )
    width = (1 + F.col("k") % 5) * F.lit(HOUR // 4).cast("bigint")
    done = points.where(F.col("event_id") % 2 == 1).select(
        "event_type", F.col("time_ns").alias("start_ns"), (F.col("time_ns") + width).alias("end_ns")
    )
    return wanted, done


@query("covered_ranges", f"WITH {COVER_SQL} SELECT event_type, start_ns, end_ns FROM held")
def covered(spark, sf_dir):
    return covered_ranges(_wanted_and_done(spark, sf_dir)[1], ["event_type"])


@query(
    "uncovered_ranges",
    f"""WITH {COVER_SQL}
    SELECT event_type, start_ns, end_ns FROM gaps WHERE start_ns < end_ns""",
)
def uncovered(spark, sf_dir):
    return uncovered_ranges(*_wanted_and_done(spark, sf_dir), ["event_type"])


@query(
    "coverage_run",
    f"""WITH {E_SQL} SELECT count(*) AS moved, max(time_ns) AS last_time_ns, count(*) AS recorded
    FROM e""",
)
def coverage_run(spark, sf_dir):
    """Four-day windows, then windows of another width over more time; each event moves once."""
    base = scratch_path(spark, "coverage")
    points = source_reader(event_rows(spark, sf_dir), E_ID_SCHEMA, "ts", "events")
    ledger = Ledger(spark, f"{base}/ledger")

    def sink(moved, schema):
        moved.select("time_ns").write.mode("append").parquet(f"{base}/moved")

    for end, width in ((20 * DAY, 4 * DAY), (20 * DAY, 2 * DAY), (60 * DAY, 3 * DAY)):
        known = run_windows(
            points, E_ID_SCHEMA, "coverage", ORIGIN, ORIGIN + end, width, sink, ledger
        )
    recorded = known.agg(F.sum("total_processed_rows")).first()[0]
    return finished(
        spark.read.parquet(f"{base}/moved").agg(
            F.count(F.lit(1)).alias("moved"),
            F.max("time_ns").alias("last_time_ns"),
            F.lit(recorded).cast("bigint").alias("recorded"),
        ),
        base,
    )


@query(
    "reconcile_windows",
    f"""WITH {TARGET_SQL}
    SELECT {ORIGIN} + (time_ns - {ORIGIN}) // {DAY} * {DAY} AS window_start, event_type, user_id,
           time_ns, source_rows, target_rows, status
    FROM compared WHERE status <> 'same'""",
)
def reconcile_by_window(spark, sf_dir):
    """Differing keys, found by comparing fingerprints of days first."""
    source, target = source_and_target(spark, sf_dir)
    return reconcile_windows(source, target, KEYS, VALUES, "time_ns", DAY, ORIGIN)


@query(
    "verify_run",
    f"""WITH {E_SQL}, w AS (
        SELECT {ORIGIN} + (time_ns - {ORIGIN}) // {5 * DAY} * {5 * DAY} AS window_start,
               event_id % 997 = 0 AS lost FROM e)
    SELECT window_start, count(*) AS recorded_rows, count(*) AS source_rows,
           count(*) FILTER (NOT lost) AS target_rows,
           CASE WHEN bool_or(lost) THEN 'differs' ELSE 'same' END AS status
    FROM w GROUP BY 1""",
)
def verify_run(spark, sf_dir):
    """A run whose target lost some events afterwards, checked window by window."""
    base = scratch_path(spark, "verify")
    rows = event_rows(spark, sf_dir)
    ledger = Ledger(spark, f"{base}/ledger")
    keys = ["key_time_ns", "event_id"]
    target = UpsertTable(spark, f"{base}/table", keys, ["value"], "key_time_ns", 30 * DAY)
    run_windows(
        source_reader(rows, E_ID_SCHEMA, "ts", "events"), E_ID_SCHEMA, "verify", ORIGIN,
        ORIGIN + 60 * DAY, 5 * DAY,
        lambda moved, schema: target.upsert(upsert_rows(moved, schema, ["event_id"])), ledger,
    )
    held = target.current().where(F.col("event_id") % 997 != 0)
    source = upsert_rows(event_points(spark, sf_dir, with_id=True), E_ID_SCHEMA, ["event_id"])
    checked = verify_windows(
        ledger, "verify", source, held, keys, ["value", "k"], "key_time_ns", 5 * DAY
    )
    columns = ("window_start", "recorded_rows", "source_rows", "target_rows", "status")
    return finished(checked.where("recorded_rows > 0").select(*columns), base)


@query(
    "stream_ledger",
    f"""WITH {E_SQL}, n AS (SELECT count(*) AS n, max(time_ns) AS t FROM e WHERE time_ns < {MIDDLE}),
    later AS (SELECT count(*) AS n, max(time_ns) AS t FROM e WHERE time_ns >= {MIDDLE} OR value > 90)
    SELECT 0::BIGINT AS epoch_id, n AS processed_rows, t // 1000000 * 1000000 AS last_time_ns,
           'completed' AS status FROM n
    UNION ALL SELECT 1, n, t // 1000000 * 1000000, 'completed' FROM later""",
)
def stream_ledger(spark, sf_dir):
    """The ledger of a stream of files: two increments, and the second one's row once more."""
    base = scratch_path(spark, "stream-ledger")
    rows = event_rows(spark, sf_dir)
    keys = ["key_time_ns", "event_id"]
    target = UpsertTable(spark, f"{base}/table", keys, ["batch_seq"], "key_time_ns", 30 * DAY)
    ledger = Ledger(spark, f"{base}/ledger")
    middle = F.timestamp_micros(F.lit(MIDDLE // 1000)).cast("timestamp_ntz")

    def to_rows(batch):
        return upsert_rows(to_points(batch, E_ID_SCHEMA, "ts", "events"), E_ID_SCHEMA, ["event_id"])

    for increment in (F.col("ts") < middle, (F.col("ts") >= middle) | (F.col("value") > 90)):
        rows.where(increment).write.mode("append").parquet(f"{base}/in")
        sync_new_files(
            spark, f"{base}/in", rows.schema, to_rows, target, f"{base}/progress",
            ledger=ledger, task_id="stream", time_column="key_time_ns",
        )
    last = ledger.batches().orderBy(F.desc("epoch_id")).first()
    ledger.save_batch("stream", last["epoch_id"], last["processed_rows"], last["last_time_ns"])
    columns = ("epoch_id", "processed_rows", "last_time_ns", "status")
    return finished(ledger.batches().select(*columns), base)


@query(
    "indexed_series",
    f"""WITH {E_SQL}
    SELECT event_type, user_id, series_key, min(time_ns) AS first_ns, max(time_ns) AS last_ns
    FROM e WHERE event_type IN ('click', 'error') GROUP BY ALL
    HAVING max(time_ns) >= {MIDDLE} AND min(time_ns) < {MIDDLE + 7 * DAY}""",
)
def indexed_series(spark, sf_dir):
    """Series by tag and time from an index that two waves of events have filled."""
    base = scratch_path(spark, "series-index")
    points, index = event_points(spark, sf_dir), SeriesIndex(spark, base, E_SCHEMA)
    for wave in (F.col("time_ns") < MIDDLE, F.col("time_ns") >= MIDDLE):
        index.update(points.where(wave))
    found = index.find({"event_type": ["click", "error"]}, MIDDLE, MIDDLE + 7 * DAY)
    columns = ("event_type", "user_id", "series_key", "first_ns", "last_ns")
    return finished(found.select(*columns), base)


@query(
    "batches_after_growth",
    f"""WITH {E_SQL}, s AS (SELECT series_key, min(time_ns) >= {ORIGIN + DAY} AS is_new FROM e GROUP BY 1)
    SELECT series_key, row_number() OVER (ORDER BY is_new, series_key) - 1 AS series_no,
           (row_number() OVER (ORDER BY is_new, series_key) - 1) // 10 AS batch_id
    FROM s""",
)
def batches_after_growth(spark, sf_dir):
    """Batches of ten series, given after the first day and again with all events."""
    base = scratch_path(spark, "dictionary")
    points, numbers = event_points(spark, sf_dir), BatchDictionary(spark, base)
    numbers.assign(series(points.where(F.col("time_ns") < ORIGIN + DAY), E_SCHEMA), 10)
    every = numbers.assign(series(points, E_SCHEMA), 10)
    return finished(every.select("series_key", "series_no", "batch_id"), base)


@query(
    "balanced_windows",
    f"""WITH {E_SQL}, r AS (
        SELECT time_ns, row_number() OVER (ORDER BY time_ns) AS rank, count(*) OVER () AS n FROM e),
    cuts AS (
        SELECT (SELECT min(time_ns) FROM r WHERE rank >= i * n / 12.0) AS cut
        FROM (SELECT max(n) AS n FROM r), range(1, 12) AS parts(i)
        UNION SELECT min(time_ns) FROM r UNION SELECT max(time_ns) + 1 FROM r),
    w AS (SELECT cut AS window_start, lead(cut) OVER (ORDER BY cut) AS window_end FROM cuts)
    SELECT window_start, window_end, count(*) AS points
    FROM w JOIN r ON time_ns >= window_start AND time_ns < window_end GROUP BY ALL""",
)
def balanced(spark, sf_dir):
    """Twelve windows of like numbers of events, and how many each holds."""
    points = event_points(spark, sf_dir)
    windows = balanced_windows(points, 12)
    placed = assign_intervals(
        points.select("time_ns"), windows, 3 * DAY, start="window_start", end="window_end"
    )
    return placed.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("points"))


@query(
    "profile_merged",
    _profile_sql(
        "events",
        ["event_id", "ts", "user_id", "event_type", "value", "props"],
        ["bigint", "timestamp_ntz", "bigint", "string", "double", "string"],
        "event_id",
        "ts",
    ),
)
def profile_merged(spark, sf_dir):
    """The profile of events, merged from windows that came in two waves, one of them twice."""
    base = scratch_path(spark, "profile")
    rows = table(spark, sf_dir, "events")
    time = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    window = window_start_of(time, DAY, ORIGIN)
    stored = StoredProfile(spark, base, rows.schema)
    for wave in (time < MIDDLE, time >= MIDDLE - 2 * DAY):
        stored.update(rows.where(wave), window)
    found = stored.profile().drop("approx_distinct")
    return finished(found.select(F.lit("events").alias("table_name"), "*"), base)

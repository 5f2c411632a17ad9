"""Ledger, pending work, reports and reconciliation, over rows derived from the tables."""

from pyspark.sql import functions as F

from catalog import query
from catalog.views import (
    DAY,
    E_SCHEMA,
    E_SQL,
    ORIGIN,
    WEEK,
    event_points,
    finished,
)
from tidepoint.functions.keys import series_key
from tidepoint.functions.timefn import parse_instant
from tidepoint.operators import ledger
from tidepoint.operators.numbering import series_batches
from tidepoint.operators.reconcile import (
    differences,
    reconcile,
    sample_differences,
    status_totals,
)
from tidepoint.operators.report import (
    report_entries,
    report_totals,
    status_counts,
    write_report,
)
from tidepoint.operators.windows import window_start_of, window_summary
from tidepoint.session import scratch_path
from tidepoint.sources import discover

_STATUS_SQL = """CASE WHEN value > 80 THEN 'failed' WHEN value > 40 THEN 'in_progress'
    WHEN value > 10 THEN 'pending' ELSE 'completed' END"""
LOG_SQL = f"""{E_SQL}, log AS (
    SELECT event_type AS task_id, 'u' || user_id AS source_table, 'm' || (k // 10) AS target_meas,
           event_id AS last_id, time_ns AS last_time_ns, k AS processed_rows,
           {_STATUS_SQL} AS status, ts AS created_at, ts AS updated_at, event_id AS seq
    FROM e),
task AS (SELECT * EXCLUDE r FROM (
    SELECT *, row_number() OVER (PARTITION BY task_id, source_table ORDER BY seq DESC) AS r
    FROM log) WHERE r = 1)"""


def _status():
    value = F.col("value")
    return (
        F.when(value > 80, ledger.FAILED)
        .when(value > 40, ledger.IN_PROGRESS)
        .when(value > 10, ledger.PENDING)
        .otherwise(ledger.COMPLETED)
    )


def task_log(spark, sf_dir):
    """Every event as one version of the ledger row of its (type, user)."""
    time = F.timestamp_micros(F.call_function("div", F.col("time_ns"), F.lit(1000).cast("bigint")))
    return event_points(spark, sf_dir, with_id=True).select(
        F.col("event_type").alias("task_id"),
        F.concat(F.lit("u"), "user_id").alias("source_table"),
        F.concat(F.lit("m"), F.expr("k div 10").cast("string")).alias("target_meas"),
        F.col("event_id").alias("last_id"),
        F.col("time_ns").alias("last_time_ns"),
        F.col("k").alias("processed_rows"),
        _status().alias("status"),
        time.alias("created_at"),
        time.alias("updated_at"),
        F.col("event_id").alias("seq"),
    )


@query(
    "ledger_latest",
    f"""WITH {LOG_SQL}
    SELECT task_id, source_table, target_meas, last_id, last_time_ns, processed_rows, status, seq
    FROM task""",
)
def ledger_latest(spark, sf_dir):
    return ledger.latest_tasks(task_log(spark, sf_dir).drop("created_at", "updated_at"))


WINDOW_LOG_SQL = f"""{E_SQL}, wlog AS (
    SELECT event_type AS task_id, CAST((time_ns - {ORIGIN}) // {WEEK} AS VARCHAR)
               AS shard_group_id,
           time_ns // {DAY} * {DAY} AS window_start, time_ns AS last_time_ns,
           {_STATUS_SQL} AS status, event_id AS seq
    FROM e),
win AS (SELECT * EXCLUDE r FROM (
    SELECT *, row_number() OVER (PARTITION BY task_id, shard_group_id, window_start
                                 ORDER BY seq DESC) AS r FROM wlog) WHERE r = 1)"""


def window_log(spark, sf_dir):
    week = F.lit(WEEK).cast("bigint")
    shard = F.call_function("div", F.col("time_ns") - F.lit(ORIGIN).cast("bigint"), week)
    return event_points(spark, sf_dir, with_id=True).select(
        F.col("event_type").alias("task_id"),
        shard.cast("string").alias("shard_group_id"),
        window_start_of(F.col("time_ns"), DAY).alias("window_start"),
        F.col("time_ns").alias("last_time_ns"),
        _status().alias("status"),
        F.col("event_id").alias("seq"),
    )


@query("ledger_windows", f"WITH {WINDOW_LOG_SQL} SELECT * FROM win")
def ledger_windows(spark, sf_dir):
    return ledger.ordered_windows(ledger.latest_windows(window_log(spark, sf_dir)))


@query(
    "latest_window",
    f"""WITH {WINDOW_LOG_SQL}
    SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (
        PARTITION BY task_id, shard_group_id ORDER BY window_start DESC) AS r FROM win)
    WHERE r = 1""",
)
def latest_window(spark, sf_dir):
    return ledger.latest_window_per_shard(ledger.latest_windows(window_log(spark, sf_dir)))


@query(
    "ledger_by_status",
    f"""WITH {LOG_SQL}
    SELECT task_id, source_table, last_time_ns, status FROM task
    WHERE status IN ('failed', 'in_progress')""",
)
def ledger_by_status(spark, sf_dir):
    tasks = ledger.latest_tasks(task_log(spark, sf_dir))
    return ledger.resumable(tasks).select("task_id", "source_table", "last_time_ns", "status")


def _filled_ledger(spark, sf_dir):
    """A ledger on disk with the current tasks, and its folder."""
    path = scratch_path(spark, "ledger")
    kept = ledger.Ledger(spark, path)
    names = [part.split()[0] for part in ledger.TASK_SCHEMA.split(", ")]
    tasks = ledger.latest_tasks(task_log(spark, sf_dir))
    tasks = tasks.withColumn("deleted", F.lit(False))
    kept.save_tasks(tasks.select(*[c for c in tasks.columns if c in names]))
    return kept, path


@query(
    "ledger_delete",
    f"""WITH {LOG_SQL}
    SELECT task_id, source_table, status, processed_rows FROM task
    WHERE NOT (task_id = 'view' OR (task_id = 'click' AND source_table = 'u1'))""",
)
def ledger_delete(spark, sf_dir):
    """The ledger after all tasks of one id and one table of another are deleted."""
    kept, path = _filled_ledger(spark, sf_dir)
    kept.delete("view")
    kept.delete("click", "u1")
    rows = kept.tasks().select("task_id", "source_table", "status", "processed_rows")
    return finished(rows, path)


@query(
    "ledger_reset",
    f"""WITH {LOG_SQL}
    SELECT 'before' AS moment, count(*) AS tasks FROM task
    UNION ALL SELECT 'after', 0""",
)
def ledger_reset(spark, sf_dir):
    """Tasks in the ledger before and after a reset."""
    kept, path = _filled_ledger(spark, sf_dir)

    def counted(moment):
        return finished(
            kept.tasks().agg(F.lit(moment).alias("moment"), F.count(F.lit(1)).alias("tasks"))
        )

    before = counted("before")
    kept.reset()
    return finished(before.union(counted("after")), path)


@query(
    "pending_tasks",
    f"""WITH {LOG_SQL}
    SELECT DISTINCT event_type AS task_id, 'u' || user_id AS source_table FROM e
    WHERE (event_type, 'u' || user_id) NOT IN
        (SELECT task_id, source_table FROM task WHERE status = 'completed')""",
)
def pending_tasks(spark, sf_dir):
    log = task_log(spark, sf_dir)
    work = log.select("task_id", "source_table").distinct()
    return ledger.without_completed(work, ledger.latest_tasks(log), ledger.TASK_KEYS)


# The ledger behind pending_work: windows completed, then windows begun, then unknown ones.
DONE, BEGUN = "2024-01-11T00:00:00", "2024-01-20T00:00:00"


@query(
    "pending_work",
    f"""WITH {E_SQL}, s AS (
        SELECT DISTINCT event_type AS task_id, CAST((time_ns - {ORIGIN}) // {WEEK} AS VARCHAR)
                   AS shard_group_id,
               time_ns // {DAY} * {DAY} AS window_start, series_key FROM e),
    b AS (SELECT *, (row_number() OVER (PARTITION BY task_id, shard_group_id, window_start
                                        ORDER BY series_key) - 1) // 10 AS batch_id FROM s),
    w AS (SELECT event_type AS task_id, CAST((time_ns - {ORIGIN}) // {WEEK} AS VARCHAR)
                     AS shard_group_id,
                 time_ns // {DAY} * {DAY} AS window_start, max(ts) < TIMESTAMP '{DONE}' AS done,
                 CASE WHEN event_type > 'd' THEN 2 END AS last_batch
          FROM e GROUP BY ALL HAVING max(ts) < TIMESTAMP '{BEGUN}')
    SELECT b.* FROM b LEFT JOIN w USING (task_id, shard_group_id, window_start)
    WHERE NOT coalesce(done, false) AND batch_id > coalesce(last_batch, -1)""",
)
def pending_work(spark, sf_dir):
    """Series batches of day windows, less what a ledger of those windows calls done."""
    week = F.lit(WEEK).cast("bigint")
    shard = F.call_function("div", F.col("time_ns") - F.lit(ORIGIN).cast("bigint"), week)
    points = event_points(spark, sf_dir).withColumns(
        {
            "task_id": F.col("event_type"),
            "shard_group_id": shard.cast("string"),
            "window_start": window_start_of(F.col("time_ns"), DAY),
            "series_key": series_key(F.col("measurement"), E_SCHEMA.tags),
        }
    )
    keys = ledger.WINDOW_KEYS
    items = series_batches(points.select(*keys, "series_key").distinct(), 10, keys)
    known = (
        points.groupBy(*keys)
        .agg(
            F.when(F.max("time_ns") < parse_instant(DONE), ledger.COMPLETED)
            .otherwise(ledger.IN_PROGRESS)
            .alias("status"),
            F.when(F.col("task_id") > "d", 2).alias("last_completed_batch"),
            F.max("time_ns").alias("_last"),
        )
        .where(F.col("_last") < parse_instant(BEGUN))
    )
    return ledger.without_done_batches(items, known)


@query(
    "status_counts",
    f"WITH {LOG_SQL} SELECT status, count(*) AS tasks FROM task GROUP BY status",
)
def status_counts_query(spark, sf_dir):
    return status_counts(ledger.latest_tasks(task_log(spark, sf_dir)))


@query(
    "report_totals",
    f"""WITH {LOG_SQL}
    SELECT task_id, count(*) AS entries, count(DISTINCT target_meas) AS measurements,
           CAST(sum(processed_rows) AS BIGINT) AS total_rows,
           CAST(sum(CASE WHEN status = 'completed' THEN processed_rows ELSE 0 END) AS BIGINT)
               AS transferred_rows,
           CAST(sum(CASE WHEN status = 'failed' THEN processed_rows ELSE 0 END) AS BIGINT)
               AS failed_rows,
           CASE WHEN bool_or(status = 'failed') THEN 'failed'
                WHEN bool_or(status = 'in_progress') THEN 'in_progress'
                WHEN bool_or(status = 'pending') THEN 'pending' ELSE 'completed' END AS status,
           epoch_us(min(created_at)) AS started_us, epoch_us(max(updated_at)) AS completed_us,
           epoch_us(max(updated_at)) // 1000000 - epoch_us(min(created_at)) // 1000000
               AS duration_secs
    FROM task GROUP BY task_id""",
)
def report_totals_query(spark, sf_dir):
    totals = report_totals(ledger.latest_tasks(task_log(spark, sf_dir)))
    return totals.select(
        *[c for c in totals.columns if not c.endswith("_at")],
        F.unix_micros("started_at").alias("started_us"),
        F.unix_micros("completed_at").alias("completed_us"),
    )


@query(
    "report_json",
    f"""WITH {LOG_SQL}
    SELECT task_id, "table", processed_rows, status FROM (
        SELECT task_id, source_table AS "table", processed_rows, status FROM task
        UNION ALL SELECT task_id, 'total', CAST(sum(processed_rows) AS BIGINT),
            CASE WHEN bool_or(status = 'failed') THEN 'failed'
                 WHEN bool_or(status = 'in_progress') THEN 'in_progress'
                 WHEN bool_or(status = 'pending') THEN 'pending' ELSE 'completed' END
        FROM task GROUP BY task_id)""",
)
def report_json(spark, sf_dir):
    """The report written as JSON and read back."""
    path = scratch_path(spark, "report")
    write_report(ledger.latest_tasks(task_log(spark, sf_dir)), path)
    entries = spark.read.json(f"{path}/entries").select(
        "task_id", "table", "processed_rows", "status"
    )
    totals = spark.read.json(f"{path}/totals").select(
        "task_id", F.lit("total").alias("table"), "total_rows", "status"
    )
    return finished(entries.union(totals), path)


@query(
    "report_entries",
    f"""WITH {LOG_SQL}
    SELECT task_id, source_table AS "table", source_table AS measurement, target_meas, last_id,
           last_time_ns AS last_timestamp, processed_rows, status, epoch_us(updated_at) AS saved_us
    FROM task""",
)
def report_entries_query(spark, sf_dir):
    entries = report_entries(ledger.latest_tasks(task_log(spark, sf_dir)))
    return entries.withColumn("saved_us", F.unix_micros("saved_at")).drop("saved_at")


@query(
    "progress_mark",
    f"""WITH {E_SQL}
    SELECT event_type, user_id, count(*) AS points, max(time_ns) AS last_time_ns FROM e
    GROUP BY ALL""",
)
def progress_mark(spark, sf_dir):
    return window_summary(event_points(spark, sf_dir), ["event_type", "user_id"])


# Reconciliation: a target that lost points of low value, cut the decimals of high ones,
# holds the error points twice and moved points of mid value by a second.

TARGET_SQL = f"""{E_SQL}, src AS (
    SELECT event_type, user_id, time_ns, value, k FROM e),
tgt AS (
    SELECT event_type, user_id,
           CASE WHEN value > 50 AND value <= 52 THEN time_ns + 1000000000 ELSE time_ns END
               AS time_ns,
           CASE WHEN value > 90 THEN floor(value) ELSE value END AS value, k
    FROM src WHERE value >= 2
    UNION ALL SELECT event_type, user_id, time_ns, value, k FROM src
    WHERE event_type = 'error' AND value BETWEEN 10 AND 12),
cmp AS (
    SELECT event_type, user_id, time_ns, sum(s) AS source_rows, sum(t) AS target_rows,
           sum(least(s, t)) AS common
    FROM (SELECT event_type, user_id, time_ns, value, k, sum(s) AS s, sum(t) AS t
          FROM (SELECT *, 1 AS s, 0 AS t FROM src UNION ALL SELECT *, 0, 1 FROM tgt)
          GROUP BY ALL)
    GROUP BY ALL),
compared AS (
    SELECT event_type, user_id, time_ns, CAST(source_rows AS BIGINT) AS source_rows,
           CAST(target_rows AS BIGINT) AS target_rows,
           CASE WHEN target_rows = 0 THEN 'missing' WHEN source_rows = 0 THEN 'extra'
                WHEN source_rows = common AND target_rows = common THEN 'same'
                ELSE 'changed' END AS status
    FROM cmp)"""
KEYS, VALUES = ["event_type", "user_id", "time_ns"], ["value", "k"]


def source_and_target(spark, sf_dir):
    source = event_points(spark, sf_dir).drop("measurement")
    value, second = F.col("value"), F.lit(10**9).cast("bigint")
    moved = F.when((value > 50) & (value <= 52), F.col("time_ns") + second)
    cut = F.when(value > 90, F.floor(value).cast("double")).otherwise(value)
    kept = source.where(value >= 2).select(
        "event_type",
        "user_id",
        F.coalesce(moved, F.col("time_ns")).alias("time_ns"),
        cut.alias("value"),
        "k",
    )
    twice = source.where((F.col("event_type") == "error") & value.between(10, 12))
    return source, kept.unionByName(twice)


@query("reconcile", f"WITH {TARGET_SQL} SELECT * FROM compared")
def reconcile_query(spark, sf_dir):
    return reconcile(*source_and_target(spark, sf_dir), KEYS, VALUES)


@query(
    "reconcile_totals",
    f"""WITH {TARGET_SQL}
    SELECT status, count(*) AS keys, CAST(sum(source_rows) AS BIGINT) AS source_rows,
           CAST(sum(target_rows) AS BIGINT) AS target_rows FROM compared GROUP BY status""",
)
def reconcile_totals(spark, sf_dir):
    return status_totals(reconcile(*source_and_target(spark, sf_dir), KEYS, VALUES))


@query(
    "reconcile_sample",
    f"""WITH {TARGET_SQL}
    SELECT * FROM compared WHERE status <> 'same'
    ORDER BY event_type, user_id, time_ns LIMIT 100""",
)
def reconcile_sample(spark, sf_dir):
    compared = reconcile(*source_and_target(spark, sf_dir), KEYS, VALUES)
    return sample_differences(compared, KEYS)


@query(
    "reconcile_rows",
    f"""WITH {TARGET_SQL}, one AS (
        SELECT event_type, user_id, time_ns, value, k, sum(s) AS s, sum(t) AS t
        FROM (SELECT *, 1 AS s, 0 AS t FROM src UNION ALL SELECT *, 0, 1 FROM tgt)
        GROUP BY ALL)
    SELECT event_type, user_id, time_ns, value, k,
           CAST(greatest(s - t, 0) AS BIGINT) AS only_source,
           CAST(greatest(t - s, 0) AS BIGINT) AS only_target
    FROM one WHERE s <> t""",
)
def reconcile_rows(spark, sf_dir):
    return differences(*source_and_target(spark, sf_dir), [*KEYS, *VALUES])

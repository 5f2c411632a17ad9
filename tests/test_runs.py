"""Ledger, single runs, resume, backfill, streaming increments, ingest and discovery."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepoint.functions.timefn import parse_instant
from tidepoint.operators.ledger import COMPLETED, FAILED, IN_PROGRESS, PENDING, Ledger
from tidepoint.operators.report import report_totals, status_counts, write_report
from tidepoint.plans.backfill import (
    remaining_items,
    run_backfill,
    source_reader,
    window_plan,
    work_items,
)
from tidepoint.plans.transfer import resume, run_mapping, run_mappings
from tidepoint.points import FieldMap, Mapping, PointsSchema, TagMap, to_points
from tidepoint.session import scratch_path
from tidepoint.sinks.tables import UpsertTable, upsert_rows
from tidepoint.sources import discover
from tidepoint.sources.ingest import (
    infer_response_schema,
    long_points,
    parse_responses,
    read_long_rows,
    read_responses,
    widen,
)
from tidepoint.sources.scan import read_table
from tidepoint.streaming.incremental import sync_new_files

DAY = 86_400 * 10**9
WEEK = 7 * DAY
START = parse_instant("2024-01-01T00:00:00Z")
SCHEMA = PointsSchema(("host",), ("cpu",))
POINTS = "measurement string, host string, cpu double, time_ns bigint"


@pytest.fixture
def ledger(spark):
    return Ledger(spark, scratch_path(spark, "ledger"))


def test_task_rows(ledger):
    assert ledger.load("t", "a") is None
    ledger.create("t", "a", "name", "meas", "{}")
    assert ledger.load("t", "a")["status"] == PENDING
    ledger.save("t", "a", last_id=7, last_time_ns=9, processed_rows=500, status=IN_PROGRESS)
    ledger.create("t", "a")
    row = ledger.load("t", "a")
    assert (row["task_name"], row["last_id"], row["last_time_ns"]) == ("name", 7, 9)
    assert (row["processed_rows"], row["status"]) == (500, IN_PROGRESS)
    ledger.mark("t", "a", FAILED, "boom")
    assert ledger.load("t", "a")["error_message"] == "boom"
    ledger.save("t", "b", processed_rows=1, status=COMPLETED)
    assert Counter(r["status"] for r in ledger.by_status(FAILED, COMPLETED).collect()) == {
        FAILED: 1, COMPLETED: 1,
    }
    assert {r["status"]: r["tasks"] for r in status_counts(ledger.tasks()).collect()} == {
        FAILED: 1, COMPLETED: 1,
    }
    ledger.delete("t", "a")
    assert [r["source_table"] for r in ledger.tasks().collect()] == ["b"]
    ledger.reset()
    assert ledger.tasks().isEmpty()


def test_window_rows_stay_completed(spark, ledger):
    columns = (
        "task_id string, shard_group_id string, window_start bigint, window_end bigint,"
        " status string, total_processed_rows bigint"
    )
    save = lambda *rows: ledger.save_windows(spark.createDataFrame(list(rows), columns))
    save(("t", "1", 0, 5, COMPLETED, 10), ("t", "1", 5, 9, IN_PROGRESS, 4))
    save(("t", "1", 0, 5, IN_PROGRESS, 0))
    found = {r["window_start"]: r for r in ledger.windows().collect()}
    assert (found[0]["status"], found[0]["total_processed_rows"]) == (COMPLETED, 10)
    assert ledger.latest_window("t", "1")["window_start"] == 5
    ledger.complete_shard("t", "1")
    assert {r["status"] for r in ledger.windows().collect()} == {COMPLETED}


def test_report(spark, ledger):
    # 500 rows completed, 200 failed.
    ledger.save("t", "a", target_meas="m", processed_rows=500, status=COMPLETED)
    ledger.save("t", "b", target_meas="m", processed_rows=200, status=FAILED)
    row = report_totals(ledger.tasks()).first()
    assert (row["total_rows"], row["transferred_rows"], row["failed_rows"]) == (700, 500, 200)
    assert (row["status"], row["entries"], row["measurements"]) == (FAILED, 2, 1)
    path = scratch_path(spark, "report")
    write_report(ledger.tasks(), path)
    assert spark.read.json(f"{path}/totals").first()["total_rows"] == 700
    assert spark.read.json(f"{path}/entries").count() == 2


# Single runs

SOURCE = "host string, cpu double, ts timestamp_ntz"
MAPPING = Mapping(
    source_table="cpu", tags=(TagMap("host"),), fields=(FieldMap("cpu", "load", "float"),)
)


def _source(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("h"), F.col("id") % 3).alias("host"),
        F.col("id").cast("double").alias("cpu"),
        F.timestamp_micros(F.lit(START // 1000) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("row_id"),
    )


ID_SCHEMA = PointsSchema(("host",), ("cpu",), id_col="row_id")


def _moved_rows(rows, schema, ledger, task="t", mapping=MAPPING):
    got = []
    run_mapping(rows, schema, mapping, "ts", lambda p, s: got.extend(p.collect()), ledger, task)
    return sorted(r["load"] for r in got)


def test_rows_without_a_time_are_moved_and_counted(spark, ledger):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', 1D, timestamp_ntz'2024-01-01', 1L), ('a', 2D, NULL, 2L),"
        " ('b', 3D, timestamp_ntz'2024-01-02', 3L) AS t(host, cpu, ts, row_id)"
    )
    assert _moved_rows(rows, ID_SCHEMA, ledger) == [1.0, 2.0, 3.0]
    assert ledger.load("t", "cpu")["processed_rows"] == 3
    later = rows.unionByName(spark.sql("SELECT 'c' AS host, 4D AS cpu, NULL AS ts, 9L AS row_id"))
    assert _moved_rows(later, ID_SCHEMA, ledger) == [2.0, 4.0]


def test_later_rows_with_the_time_of_the_mark(spark, ledger):
    rows = spark.range(3).selectExpr(
        "'a' AS host", "double(id) AS cpu", "timestamp_ntz'2024-01-01' AS ts", "id AS row_id"
    )
    assert _moved_rows(rows.where("row_id < 2"), ID_SCHEMA, ledger) == [0.0, 1.0]
    assert _moved_rows(rows, ID_SCHEMA, ledger) == [2.0]
    assert _moved_rows(rows.where("row_id < 2"), SCHEMA, ledger, "u") == [0.0, 1.0]
    assert _moved_rows(rows, SCHEMA, ledger, "u") == [0.0, 1.0, 2.0]


def test_text_times_have_positions(spark, ledger):
    rows = spark.range(4).selectExpr(
        "'a' AS host", "double(id) AS cpu", "concat('2024-01-0', id + 1, 'T00:00:00Z') AS ts",
        "id AS row_id",
    )
    assert _moved_rows(rows.where("row_id < 2"), ID_SCHEMA, ledger) == [0.0, 1.0]
    assert _moved_rows(rows, ID_SCHEMA, ledger) == [2.0, 3.0]


def test_failing_source_is_recorded_whole(spark, ledger):
    text = "x" * 5000
    rows = _source(spark, 3).withColumn("cpu", F.raise_error(F.lit(text)).cast("double"))
    with pytest.raises(Exception):
        run_mapping(rows, SCHEMA, MAPPING, "ts", lambda p, s: p.collect(), ledger, "t")
    row = ledger.load("t", "cpu")
    assert row["status"] == FAILED and text in row["error_message"]


def test_names_of_a_run(spark, ledger):
    rows = _source(spark, 6)
    sources = {"cpu": (rows, SCHEMA, "ts"), "solo": (rows.drop("host"), PointsSchema((), ("cpu",)), "ts")}
    mappings = [
        Mapping(source_table="*"),
        Mapping(source_table="cpu", subtable_pattern="{{table}}_{{value2}}", target_measurement="x"),
        Mapping(source_table="*", tag_filters={"host": ["h1"]}, target_measurement="one"),
    ]
    names = Counter()
    sink = lambda points, schema: names.update(r["measurement"] for r in points.collect())
    moved = run_mappings(sources, mappings, sink, ledger, "list")
    assert moved == {(0, "cpu"): 6, (0, "solo"): 6, (1, "cpu"): 6, (2, "cpu"): 2}
    assert names == {
        "cpu_cpu,host=h0": 2, "cpu_cpu,host=h1": 2, "cpu_cpu,host=h2": 2, "solo": 6,
        "cpu_h0": 2, "cpu_h1": 2, "cpu_h2": 2, "one": 2,
    }
    assert {r["status"] for r in ledger.tasks().collect()} == {COMPLETED}
    with pytest.raises(ValueError, match="unknown table"):
        run_mappings(sources, [Mapping(source_table="gpu")], sink, ledger, "list")


def test_second_run_moves_only_what_is_new(spark, ledger):
    moved = []
    sink = lambda points, schema: moved.append(points.count())
    for n in (10, 10, 25):
        run_mapping(_source(spark, n), ID_SCHEMA, MAPPING, "ts", sink, ledger, "t")
    assert moved == [10, 15]
    row = ledger.load("t", "cpu")
    assert (row["processed_rows"], row["status"], row["last_id"]) == (25, COMPLETED, 24)
    assert row["last_time_ns"] == START + 24_000


def test_resume_goes_on_at_the_mark(spark, ledger):
    seen = []

    def sink(points, schema):
        if not points.where("load >= 40").isEmpty():
            raise RuntimeError("target is down")
        seen.append(points.count())

    run_mapping(_source(spark, 30), ID_SCHEMA, MAPPING, "ts", sink, ledger, "t")
    with pytest.raises(RuntimeError):
        run_mapping(_source(spark, 50), ID_SCHEMA, MAPPING, "ts", sink, ledger, "t")
    assert ledger.load("t", "cpu")["status"] == FAILED
    ledger.mark("t", "cpu", IN_PROGRESS)  # as after a killed run
    healthy = lambda points, schema: seen.append(points.count())
    assert resume(ledger, lambda table: (_source(spark, 50), ID_SCHEMA, "ts"), healthy) == 20
    assert seen == [30, 20]
    row = ledger.load("t", "cpu")
    assert (row["status"], row["processed_rows"], row["error_message"]) == (COMPLETED, 50, None)


# Backfill


def _points(spark, hosts=5, days=14):
    rows = [
        ("cpu", f"h{h}", float(d), START + d * DAY + h) for d in range(days) for h in range(hosts)
    ]
    return spark.createDataFrame(rows, POINTS)


def _shards(spark, count=2):
    rows = [(str(i + 1), START + i * WEEK, START + (i + 1) * WEEK) for i in range(count)]
    return spark.createDataFrame(rows, "shard_group_id string, start_ns bigint, end_ns bigint")


def test_work_items_and_resume_inside_a_window(spark, ledger):
    """2 shards of 5 series in batches of 2, batch 0 of the first shard done: 5 batches left.

    Fixed values: these numbers and the batches that are left.
    """
    windows = window_plan(_shards(spark), "t", START, START + 2 * WEEK, WEEK)
    items = work_items(_points(spark), SCHEMA, windows, WEEK, 2)
    ledger.save_windows(
        windows.where("shard_group_id = '1'").select(
            "*", F.lit(0).alias("last_completed_batch"), F.lit(IN_PROGRESS).alias("status")
        )
    )
    left = remaining_items(items, ledger.windows()).groupBy("shard_group_id", "batch_id").agg(
        F.sort_array(F.collect_list("host")).alias("hosts")
    )
    got = {(r["shard_group_id"], r["batch_id"]): r["hosts"] for r in left.collect()}
    assert got == {
        ("1", 1): ["h2", "h3"],
        ("1", 2): ["h4"],
        ("2", 0): ["h0", "h1"],
        ("2", 1): ["h2", "h3"],
        ("2", 2): ["h4"],
    }
    moved = []
    run_backfill(
        _points(spark), SCHEMA, _shards(spark), "t", START, START + 2 * WEEK, WEEK,
        lambda p, s: moved.extend((r["host"], r["time_ns"] < START + WEEK) for r in p.collect()),
        ledger, series_per_query=2,
    )
    count = Counter(moved)
    assert all(count[f"h{h}", True] == (7 if h >= 2 else 0) for h in range(5))
    assert all(count[f"h{h}", False] == 7 for h in range(5))


def test_crash_between_windows_repeats_nothing(spark, ledger):
    """The first of two windows is done; only the second runs."""
    shard = spark.createDataFrame(
        [("1", START, START + 2 * WEEK)], "shard_group_id string, start_ns bigint, end_ns bigint"
    )
    plan = window_plan(shard, "t", START, START + 2 * WEEK, WEEK)
    ledger.save_windows(
        plan.where(F.col("window_start") == START).withColumn("status", F.lit(COMPLETED))
    )
    moved = []
    known = run_backfill(
        _points(spark), SCHEMA, shard, "t", START, START + 2 * WEEK, WEEK,
        lambda p, s: moved.extend(r["time_ns"] for r in p.collect()), ledger,
    )
    assert len(moved) == 35 and min(moved) >= START + WEEK
    assert {r["status"] for r in known.collect()} == {COMPLETED} and known.count() == 2


@pytest.mark.parametrize("cut", [3, 9])
def test_backfill_cut_anywhere_equals_one_run(spark, ledger, cut):
    points, shards = _points(spark), _shards(spark, 3)
    path = scratch_path(spark, "backfill")
    table = UpsertTable(spark, path, ["key_time_ns", "host"], ["cpu"], "key_time_ns")

    def sink(p, s):
        table.upsert(upsert_rows(p, s, ["cpu"]))

    def failing(p, s):
        sink(p, s)
        raise RuntimeError("killed after the write, before the ledger")

    with pytest.raises(RuntimeError):
        run_backfill(points, SCHEMA, shards, "t", START, START + cut * DAY, WEEK, failing, ledger)
    assert {r["status"] for r in ledger.windows().collect()} == {FAILED}
    known = run_backfill(points, SCHEMA, shards, "t", START, START + 3 * WEEK, WEEK, sink, ledger)
    assert {r["status"] for r in known.collect()} == {COMPLETED}
    assert table.current().count() == 70
    assert {r["shard_group_id"]: r["total_processed_rows"] for r in known.collect()} == {
        "1": 35, "2": 35, "3": 0,
    }


def test_wider_range_reopens_a_clipped_window(spark, ledger):
    """A window completed up to the end of a shorter run is moved again by a longer one."""
    moved = []
    for days in (3, 3, 14):
        known = run_backfill(
            _points(spark), SCHEMA, _shards(spark), "t", START, START + days * DAY, WEEK,
            lambda p, s: moved.append(p.count()), ledger,
        )
    assert moved == [15, 70]  # nothing is open in the second run
    assert [r["total_processed_rows"] for r in known.orderBy("window_start").collect()] == [35, 35]


def test_waves_are_committed_one_by_one(spark, ledger):
    """A run that dies in wave 2 of 3 goes on with wave 2."""
    points, shards, seen = _points(spark, days=21), _shards(spark, 3), []

    def failing(p, s):
        if seen:
            raise RuntimeError("killed")
        seen.append(p.count())

    with pytest.raises(RuntimeError):
        run_backfill(
            points, SCHEMA, shards, "t", START, START + 3 * WEEK, WEEK, failing, ledger,
            wave_windows=1,
        )
    states = {r["window_start"]: r["status"] for r in ledger.windows().collect()}
    assert states == {START: COMPLETED, START + WEEK: FAILED}
    known = run_backfill(
        points, SCHEMA, shards, "t", START, START + 3 * WEEK, 0,
        lambda p, s: seen.append(p.count()), ledger, wave_windows=1,
    )
    assert seen == [35, 35, 35] and {r["status"] for r in known.collect()} == {COMPLETED}


def test_a_wave_reads_its_own_range(spark, tmp_path):
    path = str(tmp_path / "rows")
    _source(spark, 10).write.parquet(path)
    reader = source_reader(spark.read.parquet(path), SCHEMA, "ts", "cpu")
    plan = reader(START, START + DAY)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_batches_leave_marks(spark, ledger):
    """5 series in batches of 2; the sink dies in the second batch and the run goes on there."""
    seen = []

    def failing(p, s):
        if seen:
            raise RuntimeError("killed")
        seen.append(sorted({r["host"] for r in p.collect()}))

    run = lambda sink: run_backfill(
        _points(spark), SCHEMA, _shards(spark), "t", START, START + 2 * WEEK, WEEK, sink, ledger,
        series_per_query=2,
    )
    with pytest.raises(RuntimeError):
        run(failing)
    rows = ledger.windows().collect()
    assert {(r["status"], r["last_completed_batch"]) for r in rows} == {(FAILED, 0)}
    known = run(lambda p, s: seen.append(sorted({r["host"] for r in p.collect()})))
    assert seen == [["h0", "h1"], ["h2", "h3"], ["h4"]]
    assert {
        (r["status"], r["last_completed_batch"], r["total_processed_rows"]) for r in known.collect()
    } == {(COMPLETED, 2, 35)}


def test_small_tables_leave_points_in_place(spark):
    """With a tiny threshold for estimates, neither joins nor numbering shuffle the points."""
    from tidepoint.operators.numbering import number_rows
    from tidepoint.operators.windows import assign_intervals

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50k")
    try:
        points = _points(spark, 50, 50)
        spans = points.groupBy((F.col("time_ns") / WEEK).cast("int").alias("w")).agg(
            F.min("time_ns").alias("start_ns"), F.max("time_ns").alias("end_ns")
        )
        for frame in (assign_intervals(points, spans, WEEK), number_rows(points, ["host"], ["time_ns"])):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Streaming


def test_each_file_is_taken_once(spark):
    base = scratch_path(spark, "stream")
    columns = "t bigint, k string, v double"
    table = UpsertTable(spark, f"{base}/table", ["t", "k"], ["batch_seq", "v"])
    seen = []

    def to_rows(batch):
        seen.append(batch.count())
        return batch

    for rows in ([(1, "a", 1.0), (2, "a", 1.0)], [(2, "a", 0.5), (3, "b", 1.0)], []):
        frame = spark.createDataFrame(rows, columns)
        if rows:
            frame.coalesce(1).write.mode("append").parquet(f"{base}/in")
        sync_new_files(spark, f"{base}/in", frame.schema, to_rows, table, f"{base}/ck")
    assert seen == [2, 2]
    assert sorted((r["t"], r["k"], r["v"]) for r in table.current().collect()) == [
        (1, "a", 1.0), (2, "a", 0.5), (3, "b", 1.0),
    ]


# Saved responses


def _response(values, columns, **extra):
    series = {"name": "cpu", "columns": columns, "values": values, **extra}
    return {"results": [{"series": [series]}]}


def test_responses_with_inferred_roles(spark, tmp_path):
    columns = ["time", "host", "value", "up", "note"]
    documents = [
        _response(
            [
                ["2024-01-01T00:00:00.000000001Z", "a", 1, True, None],
                ["2024-01-01T00:00:01Z", "", 2.5, False, None],
                ["broken", "b", None, None, None],
                ["2024-01-01T00:00:02Z", "c"],
            ],
            columns,
        ),
        {"results": [{"name": "mem", "tags": {"host": "t"}, "columns": ["time", "value"],
                      "values": [["2024-01-01T00:00:03Z", 7]]}]},
    ]
    for i, document in enumerate(documents):
        (tmp_path / f"r{i}.json").write_text(json.dumps(document, indent=1))
    saved = read_responses(spark, str(tmp_path), one_per_line=False)
    schema, types = infer_response_schema(saved)
    assert (schema.tags, types) == (("host",), {"value": "double", "up": "boolean"})
    got = {tuple(r) for r in parse_responses(saved, schema, types).collect()}
    assert got == {
        ("cpu", "a", True, 1.0, START + 1),
        ("cpu", None, False, 2.5, START + 10**9),
        ("cpu", "b", None, None, None),
        ("cpu", "c", None, None, START + 2 * 10**9),
        ("mem", "t", None, 7.0, START + 3 * 10**9),
    }


def test_tag_keys_keep_text_fields(spark, tmp_path):
    document = _response([["2024-01-01T00:00:00Z", "a", "fine", 3]], ["time", "host", "state", "n"])
    (tmp_path / "r.jsonl").write_text(json.dumps(document) + "\n" + json.dumps(document))
    saved = read_responses(spark, str(tmp_path))
    schema, types = infer_response_schema(saved, tag_keys=["host"])
    assert (schema.tags, types) == (("host",), {"state": "string", "n": "bigint"})
    assert [tuple(r) for r in parse_responses(saved, schema, types).collect()] == [
        ("cpu", "a", 3, "fine", START)
    ] * 2


def test_long_rows_are_widened(spark, tmp_path):
    rows = [
        {"_time": "2024-01-01T00:00:00Z", "_measurement": "cpu", "_field": f, "_value": v,
         "host": "a", "quality": 3}
        for f, v in (("load", 1.5), ("state", "ok"), ("up", True))
    ]
    (tmp_path / "long.json").write_text(json.dumps(rows))
    saved = read_long_rows(spark, str(tmp_path), ["host"], ["quality"])
    points = long_points(saved, ["host"], fields=["quality"])
    assert {(r["_measurement"], r["quality"]) for r in points.collect()} == {("cpu", "3")}
    wide = widen(points, ["host"], {"load": "double", "state": "string", "up": "boolean"})
    assert [tuple(r) for r in wide.collect()] == [("cpu", "a", START, 1.5, "ok", True)]


def test_zoneless_times_need_a_utc_session(spark):
    frame = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS ts, 1.0D AS cpu, 'a' AS host")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="use_utc"):
            to_points(frame, SCHEMA, "ts", "cpu")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_file_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    _points(spark, 2, 3).write.format(fmt).save(path)
    assert read_table(spark, path, fmt).count() == 6


# Discovery


@pytest.mark.parametrize(
    "columns, wanted",
    [
        ("id bigint, ts timestamp, v double", ("ts", "id")),
        ("id bigint, a timestamp, b timestamp_ntz", ("b", "id")),
        ("id bigint, created_datetime string, v double", ("created_datetime", "id")),
        ("event_id bigint, event_type string, payload string", (None, "event_id")),
    ],
)
def test_roles_of_relational_columns(spark, columns, wanted):
    schema = spark.createDataFrame([], columns).schema
    assert (discover.time_column_of(schema), discover.id_column_of(schema)) == wanted


def test_profile_and_sources(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    spark.createDataFrame([(1, "a"), (2, None)], "id int, s string").write.option(
        "header", True
    ).csv(path)
    frame = read_table(spark, path, "csv", header="true", inferSchema="true")
    profile = {r["name"]: r for r in discover.column_profile(frame).collect()}
    assert (profile["s"]["nulls"], profile["id"]["max"], profile["id"]["role"]) == (1, "2", "id")
    assert profile["id"]["approx_distinct"] == 2
    assert discover.repeated_ids(frame, ["id"]).isEmpty()


def test_series_without_tags_is_named_after_its_table(spark):
    frame = spark.createDataFrame([("cpu", 1), ("cpu", 2)], "measurement string, v int")
    got = discover.series(frame, PointsSchema((), ("v",)))
    assert [tuple(r) for r in got.collect()] == [("cpu", "cpu")]


def test_hot_series_is_counted_whole(spark):
    rng = random.Random(2)
    rows = [("m", "hot" if rng.random() < 0.5 else f"h{i}", 1.0, i) for i in range(4000)]
    frame = spark.createDataFrame(rows, POINTS)
    got = discover.series_per_window(frame, SCHEMA, 1000)
    wanted = {(t // 1000 * 1000, h) for _, h, _, t in rows}
    assert {(r["window_start"], r["host"]) for r in got.collect()} == wanted

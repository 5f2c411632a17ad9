"""Covered time, far times, observed runs, one scan for many mappings, the batch ledger."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidepoint.functions.timefn import time_faults, to_time_ns
from tidepoint.operators.coverage import covered_ranges, uncovered_ranges
from tidepoint.operators.ledger import COMPLETED, Ledger
from tidepoint.operators.observe import Observed
from tidepoint.plans.backfill import run_windows
from tidepoint.plans.transfer import run_mapping, run_mappings
from tidepoint.points import Mapping, PointsSchema, to_points
from tidepoint.session import scratch_path
from tidepoint.sinks.log import LogTable
from tidepoint.sinks.tables import UpsertTable
from tidepoint.streaming.incremental import sync_new_files

DAY = 86_400_000_000_000
SCHEMA = PointsSchema(("host",), ("cpu",))
ID_SCHEMA = PointsSchema(("host",), ("cpu",), id_col="id")


@pytest.fixture
def ledger(spark):
    return Ledger(spark, scratch_path(spark, "coverage-ledger"))


def _ranges(frame):
    return sorted((r.k, r.start_ns, r.end_ns) for r in frame.collect())


def test_ranges_as_sets_of_numbers(spark):
    rng = random.Random(3)
    for _ in range(6):
        sides = [
            [(rng.choice("ab"), s := rng.randrange(30), s + rng.randrange(-1, 9)) for _ in range(9)]
            for _ in range(2)
        ]
        wanted, done = (
            spark.createDataFrame(s, "k string, start_ns bigint, end_ns bigint") for s in sides
        )
        held = [{(k, i) for k, a, b in s for i in range(a, b)} for s in sides]
        union = _ranges(covered_ranges(wanted, ["k"]))
        assert {(k, i) for k, a, b in union for i in range(a, b)} == held[0]
        assert all(not (k, b) in held[0] for k, _, b in union)
        left = _ranges(uncovered_ranges(wanted, done, ["k"]))
        cells = [(k, i) for k, a, b in left for i in range(a, b)]
        assert len(cells) == len(set(cells)) and set(cells) == held[0] - held[1]
        for k, a, b in left:  # each part lies within the intervals it comes from
            assert all(not (k == x and a < e < b) for x, s, t in sides[0] if s < t for e in (s, t))


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k string, start_ns bigint, end_ns bigint")
    one = spark.createDataFrame([("a", 1, 5)], none.schema)
    assert _ranges(uncovered_ranges(one, none, ["k"])) == [("a", 1, 5)]
    assert _ranges(uncovered_ranges(none, one, ["k"])) == []
    assert _ranges(covered_ranges(none, ["k"])) == []


def _points(spark, days, per_day=1):
    rows = [("m", "a", 1.0, d * DAY + i) for d in range(days) for i in range(per_day)]
    return spark.createDataFrame(rows, "measurement string, host string, cpu double, time_ns bigint")


@pytest.mark.parametrize("width", [2, 4, 5, 16])
def test_another_width_moves_nothing_again(spark, ledger, width):
    moved = []
    sink = lambda p, s: moved.extend(r.time_ns for r in p.collect())
    for days, step in ((16, 4), (16, width), (20, width)):
        known = run_windows(_points(spark, 20), SCHEMA, "t", 0, days * DAY, step * DAY, sink, ledger)
    total = sum(r.total_processed_rows for r in known.collect())
    assert total == 20 and set(moved) == {d * DAY for d in range(20)}
    assert len(moved) == 20


def test_window_that_stopped_between_batches_keeps_its_marks(spark, ledger):
    rows = [("m", f"h{i:02}", 1.0, d * DAY) for d in range(8) for i in range(6)]
    points = spark.createDataFrame(
        rows, "measurement string, host string, cpu double, time_ns bigint"
    )
    moved = []

    def sink(p, s):
        if len(moved) == 2:
            moved.append(None)
            raise RuntimeError("killed")
        moved.append(sorted((r.host, r.time_ns) for r in p.collect()))

    with pytest.raises(RuntimeError):
        run_windows(points, SCHEMA, "t", 0, 8 * DAY, 4 * DAY, sink, ledger, series_per_query=2)
    known = run_windows(points, SCHEMA, "t", 0, 8 * DAY, 2 * DAY, sink, ledger, series_per_query=2)
    flat = [x for m in moved if m for x in m]
    assert sorted(flat) == sorted((h, t) for _, h, _, t in rows)
    assert {(r.window_end - r.window_start) // DAY for r in known.collect()} == {4}
    assert sum(r.total_processed_rows for r in known.collect()) == 48


def test_many_batches_read_their_own_rows(spark, ledger):
    rows = [("m", f"h{i:03}", 1.0, i % 3) for i in range(120)]
    points = spark.createDataFrame(
        rows, "measurement string, host string, cpu double, time_ns bigint"
    )
    read = []

    def sink(p, s):
        read.append((len(p.inputFiles()), p.count()))

    known = run_windows(points, SCHEMA, "t", 0, DAY, DAY, sink, ledger, series_per_query=10)
    assert [n for _, n in read] == [10] * 12
    assert known.first().last_completed_batch == 11 and known.first().total_processed_rows == 120


def test_far_times_are_null_and_counted(spark):
    texts = ["9999-12-31 00:00:00", "1600-01-01 00:00:00", "2024-01-01 00:00:00", None,
             "1677-09-22 00:00:00", "2262-04-11 00:00:00"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.col("t"), F.col("t").cast("timestamp_ntz").alias("ts")
    )
    for name in ("t", "ts"):
        ns = [r[0] for r in frame.select(to_time_ns(frame, name)).collect()]
        assert [n is None for n in ns] == [True, True, False, True, False, False]
        assert tuple(time_faults(frame, name).first()) == (6, 1, 2)
    points = to_points(frame.withColumn("cpu", F.lit(1.0)), PointsSchema((), ("cpu",)), "ts", "m")
    assert points.where("time_ns is null").count() == 3


def _source(spark, rows):
    return spark.createDataFrame(rows, "id bigint, host string, cpu double, ts timestamp_ntz")


def _row(id_, minute, host="a"):
    import datetime

    return (id_, host, float(minute), datetime.datetime(2024, 1, 1, 0, minute))


MAPPING = Mapping(source_table="src", target_measurement="m")


def test_null_ids_at_the_mark_are_delivered(spark, ledger):
    got = []
    sink = lambda p, s: got.append(sorted(str(r.id) for r in p.collect()))
    first = [_row(1, 1), _row(2, 2)]
    for rows in (first, [*first, _row(None, 2)], [*first, _row(3, 2)]):
        run_mapping(_source(spark, rows), ID_SCHEMA, MAPPING, "ts", sink, ledger, "t")
    assert got == [["1", "2"], ["None"], ["3"]]
    assert ledger.load("t", "src").last_id == 3 and ledger.load("t", "src").processed_rows == 4


def test_a_run_with_a_far_time_goes_on(spark, ledger):
    got = []
    sink = lambda p, s: got.append(p.count())
    rows = _source(spark, [_row(1, 1)]).unionByName(
        spark.sql("select 9L id, 'a' host, 1d cpu, timestamp_ntz'9999-12-31 00:00:00' ts")
    )
    for _ in range(2):
        run_mapping(rows, ID_SCHEMA, MAPPING, "ts", sink, ledger, "t")
    assert got == [2, 1]  # what has no position comes again
    task = ledger.load("t", "src")
    assert task.last_id == 1 and task.status == COMPLETED


def _counted(spark, frame):
    """``frame`` with an accumulator of the rows that were read from it."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return frame.repartition(4).mapInArrow(run, frame.schema), seen


def test_rows_are_read_through_once(spark, ledger):
    rows, seen = _counted(spark, _source(spark, [_row(i, i % 60) for i in range(400)]))
    path = scratch_path(spark, "once")

    def sink(points, schema):
        points.write.parquet(path)

    assert run_mapping(rows, ID_SCHEMA, MAPPING, "ts", sink, ledger, "t") == 400
    # The test for a first row reads a part, the write all of them.
    assert 400 <= seen.value <= 400 + 200


def test_observed_tells_of_a_sink_that_reads_nothing(spark, monkeypatch):
    monkeypatch.setattr("tidepoint.operators.observe.WAIT_SECONDS", 1)
    observed = Observed(spark.range(3), F.count(F.lit(1)).alias("n"))
    with pytest.raises(RuntimeError, match="read none"):
        observed.get()


def test_many_mappings_of_a_table_scan_it_once(spark, ledger):
    data = [_row(i, i % 60, "abcde"[i % 5]) for i in range(300)]
    rows, seen = _counted(spark, _source(spark, data))
    mappings = [
        replace(MAPPING, target_measurement=h, tag_filters={"host": [h]}) for h in "abcd"
    ] + [replace(MAPPING, target_measurement="late", start="2024-01-01T00:30:00Z")]
    got = {}

    def sink(points, schema):
        got.update({r.measurement: r["count"] for r in points.groupBy("measurement").count().collect()})

    moved = run_mappings({"src": (rows, ID_SCHEMA, "ts")}, mappings, sink, ledger, "list")
    assert got == {"a": 60, "b": 60, "c": 60, "d": 60, "late": 150} and sum(moved.values()) == 390
    assert seen.value == 300
    more, _ = _counted(spark, _source(spark, [*data, _row(300, 59, "a")]))
    assert sum(run_mappings({"src": (more, ID_SCHEMA, "ts")}, mappings, sink, ledger, "list").values()) == 2


def test_tables_side_by_side_fail_apart(spark, ledger):
    good = _source(spark, [_row(1, 1)])
    bad = good.withColumn("cpu", F.raise_error(F.lit("no")).cast("double"))
    sources = {"bad": (bad, ID_SCHEMA, "ts"), "good": (good, ID_SCHEMA, "ts")}
    with pytest.raises(Exception, match="no"):
        run_mappings(sources, [Mapping()], lambda p, s: p.collect(), ledger, "w")
    states = {r.source_table: r.status for r in ledger.tasks().collect()}
    assert states == {"bad": "failed", "good": "completed"}


def test_stream_epochs_leave_rows(spark, ledger):
    base = scratch_path(spark, "epochs")
    target = UpsertTable(spark, f"{base}/table", ["t"], ["batch_seq"])
    for low in (0, 5):
        spark.range(low, low + 5).coalesce(1).select(F.col("id").alias("t")).write.mode(
            "append"
        ).parquet(f"{base}/in")
        schema = spark.range(1).select(F.col("id").alias("t")).schema
        sync_new_files(
            spark, f"{base}/in", schema, lambda b: b, target, f"{base}/progress",
            ledger=ledger, task_id="s", time_column="t",
        )
    rows = sorted((r.epoch_id, r.processed_rows, r.last_time_ns) for r in ledger.batches().collect())
    assert rows == [(0, 5, 4), (1, 5, 9)]
    ledger.save_batch("s", 1, 5, 9)  # a replay
    assert ledger.batches().count() == 2


def test_log_keeps_last_versions_through_compaction(spark, monkeypatch):
    monkeypatch.setattr("tidepoint.sinks.log.COMPACT_FILES", 3)
    path = scratch_path(spark, "log")
    table = LogTable(spark, path, "k string, v int, seq bigint", ["k"])
    assert table.current().count() == 0
    for i in range(8):
        table.append_values([{"k": "ab"[i % 2], "v": i}])
    assert sorted((r.k, r.v) for r in table.current().collect()) == [("a", 6), ("b", 7)]
    assert len(table._files.names(f"{path}/generation")) == 2
    assert [(r.k, r.v) for r in LogTable(spark, path, "k string, v int, seq bigint", ["k"]).current(
        F.col("k") == "a").collect()] == [("a", 6)]


def test_first_upsert_writes_each_row_once(spark):
    table = UpsertTable(spark, scratch_path(spark, "single"), ["t"], ["seq"], "t")
    rows, seen = _counted(spark, spark.range(100).select(
        (F.col("id") * DAY / 10).cast("bigint").alias("t"), F.lit(1).alias("seq")))
    table.upsert(rows)
    assert seen.value == 100 and table.current().count() == 100
    assert table._files.names(table.path) == ["data", "manifest"]
    table.upsert(rows.where("t >= 0").withColumn("seq", F.lit(2)))
    assert {r.seq for r in table.current().collect()} == {2}


def test_tables_forget_old_versions(spark):
    table = UpsertTable(spark, scratch_path(spark, "short"), ["t"], ["seq"], keep_versions=2)
    for i in range(4):
        table.upsert(spark.createDataFrame([(i, i)], "t bigint, seq int"))
    assert table._versions() == [3, 4] and table.current().count() == 4

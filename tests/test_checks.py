"""Fingerprints, verification, the series index, stable batches, balance, merged profiles."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog.views import E_SCHEMA, event_points
from tidepoint.operators.fingerprint import (
    differing_windows,
    reconcile_windows,
    window_fingerprints,
)
from tidepoint.operators.ledger import Ledger
from tidepoint.operators.reconcile import reconcile
from tidepoint.operators.windows import balanced_windows, times_at_ranks
from tidepoint.plans.backfill import run_windows
from tidepoint.plans.verify import verify_windows
from tidepoint.points import PointsSchema
from tidepoint.session import scratch_path
from tidepoint.sources.discover import StoredProfile, column_profile, series
from tidepoint.sources.index import BatchDictionary, SeriesIndex

SF_DIR = "/root/testdata/sf0.001"
HOUR = 3_600_000_000_000
COLUMNS = "k string, time_ns bigint, a double, b double, n int"


def _rows(seed=1, n=400):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 0.0, -0.0, 1.5, float("nan")])
    return [(rng.choice("abcde"), rng.randrange(40) * HOUR // 4, value(), value(), 1) for _ in range(n)]


def test_windows_differ_where_full_reconciliation_does(spark):
    source = _rows()
    target = [r for r in source if not (r[0] == "a" and 3 * HOUR <= r[1] < 4 * HOUR)]
    target += [source[5], source[5], ("z", None, 1.0, 2.0, 1), ("z", 99 * HOUR, 1.0, 2.0, 1)]
    left, right = spark.createDataFrame(source, COLUMNS), spark.createDataFrame(target, COLUMNS)
    right = right.withColumn("n", F.col("n").cast("bigint"))
    keys, values = ["k", "time_ns"], ["a", "b", "n"]
    got = reconcile_windows(left, right, keys, values, "time_ns", HOUR)
    wanted = reconcile(left, right, keys, values).where("status <> 'same'")
    columns = [*keys, "source_rows", "target_rows", "status"]
    found = Counter(map(tuple, got.select(columns).collect()))
    assert found == Counter(map(tuple, wanted.select(columns).collect())) and found


def test_fingerprints_tell_nulls_zeros_and_copies(spark):
    def prints(rows):
        frame = spark.createDataFrame(rows, COLUMNS)
        return window_fingerprints(frame, ["k", "time_ns"], ["a", "b", "n"], F.lit(0), 4)

    def same(one, two):
        return differing_windows(prints(one), prints(two)).isEmpty()

    rows = _rows(2)
    assert same(rows, rows[::-1])
    assert same([("a", 1, 0.0, None, 1)], [("a", 1, -0.0, None, 1)])
    assert not same([("a", 1, None, 1.0, 1)], [("a", 1, 1.0, None, 1)])
    assert not same(rows, rows[:-1])
    assert not same([("a", 1, 1.0, 1.0, 1)] * 2, [("a", 1, 1.0, 1.0, 1), ("a", 1, 2.0, 1.0, 1)])
    assert not same([("a", 1, 1.0, 1.0, 1)] * 2, [("a", 1, 2.0, 1.0, 1)] * 2)


def test_only_differing_windows_are_compared_by_rows(spark, monkeypatch):
    from tidepoint.operators import fingerprint

    source = spark.createDataFrame(_rows(), COLUMNS)
    target = source.where("time_ns <> 0")
    read = []

    def counting(left, right, *args):
        read.append((left.select("window_start").distinct().count(), left.count()))
        return reconcile(left, right, *args)

    monkeypatch.setattr(fingerprint, "reconcile", counting)
    fingerprint.reconcile_windows(
        source, target, ["k", "time_ns"], ["a", "b", "n"], "time_ns", HOUR
    ).collect()
    assert read[0][0] == 1 and read[0][1] < 100


def test_a_run_is_verified_window_by_window(spark):
    rows = [("m", "h", float(i), i * HOUR) for i in range(96)]
    points = spark.createDataFrame(
        rows, "measurement string, host string, cpu double, time_ns bigint"
    )
    ledger, schema = Ledger(spark, scratch_path(spark, "verify")), PointsSchema(("host",), ("cpu",))
    run_windows(points, schema, "t", 0, 120 * HOUR, 24 * HOUR, lambda p, s: p.collect(), ledger)
    target = points.where(F.col("time_ns") != 30 * HOUR).withColumn(
        "cpu", F.when(F.col("time_ns") == 50 * HOUR, 0.5).otherwise(F.col("cpu"))
    )
    checked = verify_windows(
        ledger, "t", points, target, ["host", "time_ns"], ["cpu"], "time_ns", 24 * HOUR
    )
    got = {
        r.window_start // (24 * HOUR): (r.recorded_rows, r.source_rows, r.target_rows, r.status)
        for r in checked.collect()
    }
    assert got == {
        0: (24, 24, 24, "same"), 1: (24, 24, 23, "differs"), 2: (24, 24, 24, "differs"),
        3: (24, 24, 24, "same"), 4: (0, 0, 0, "same"),
    }


@pytest.fixture(scope="module")
def events(spark):
    return event_points(spark, SF_DIR)


def test_index_equals_a_scan(spark, events):
    index = SeriesIndex(spark, scratch_path(spark, "index"), E_SCHEMA)
    with pytest.raises(ValueError):
        index.series()
    middle = events.agg(F.expr("percentile_approx(time_ns, 0.5)")).first()[0]
    for _ in range(2):  # a repeated wave changes nothing
        index.update(events.where(F.col("time_ns") < middle))
        index.update(events.where(F.col("time_ns") >= middle))
    scanned = events.groupBy("event_type", "user_id").agg(
        F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns")
    )
    columns = ["event_type", "user_id", "first_ns", "last_ns"]
    whole = Counter(map(tuple, scanned.collect()))
    assert Counter(map(tuple, index.series().select(columns).collect())) == whole
    some = scanned.where("event_type in ('click', 'view') and user_id in ('1', '2', '3')")
    found = index.find({"event_type": ["click", "view"], "user_id": ["1", "2", "3"]})
    assert Counter(map(tuple, found.select(columns).collect())) == Counter(map(tuple, some.collect()))
    late = index.find({"event_type": []}, middle, None)
    assert late.count() == scanned.where(F.col("last_ns") >= middle).count()
    values = {r.tag_value: r.series for r in index.tag_values("event_type").collect()}
    assert values == {r.event_type: r["count"] for r in scanned.groupBy("event_type").count().collect()}
    # Found without the points: the plan reads the index alone.
    assert "events.parquet" not in found._jdf.queryExecution().toString()


def test_series_without_tags_are_indexed(spark):
    points = spark.createDataFrame([("m", 1.0, 5), ("m", 1.0, 9)], "measurement string, v double, time_ns bigint")
    index = SeriesIndex(spark, scratch_path(spark, "bare"), PointsSchema((), ("v",)))
    index.update(points)
    assert [tuple(r) for r in index.series().select("measurement", "first_ns", "last_ns").collect()] == [("m", 5, 9)]


def test_old_series_keep_their_batch(spark, events):
    numbers = BatchDictionary(spark, scratch_path(spark, "numbers"))
    every = series(events, E_SCHEMA)
    old = every.where("event_type <> 'click'")
    before = {r.series_key: r.batch_id for r in numbers.assign(old, 7).collect()}
    again = {r.series_key: r.batch_id for r in numbers.assign(old, 7).collect()}
    after = {r.series_key: r for r in numbers.assign(every, 7).collect()}
    assert before == again and {k: after[k].batch_id for k in before} == before
    assert sorted(r.series_no for r in after.values()) == list(range(len(after)))
    assert max(Counter(r.batch_id for r in after.values()).values()) == 7


def test_windows_are_balanced(spark, events):
    times = sorted(r.time_ns for r in events.select("time_ns").collect())
    for parts in (1, 2, 7):
        rows = sorted(tuple(r) for r in balanced_windows(events, parts).collect())
        assert [r[0] for r in rows] == list(range(parts))
        assert rows[0][1] == times[0] and rows[-1][2] == times[-1] + 1
        counts = [sum(a <= t < b for t in times) for _, a, b in rows]
        assert sum(counts) == len(times) and max(counts) - min(counts) <= 2
    same = events.withColumn("time_ns", F.lit(5).cast("bigint"))
    assert [tuple(r) for r in balanced_windows(same, 4).collect()] == [(0, 5, 6)]
    assert balanced_windows(events.limit(0), 4).count() == 0


@pytest.mark.parametrize("spread", [50, 10**4, 9 * 10**18])
def test_bounds_are_exact_whatever_the_sketch(spark, spread):
    """Times a few ns apart, far apart, and shared by very many points."""
    rng = random.Random(spread)
    times = [rng.randrange(-spread, spread) for _ in range(3000)] + [7] * 900 + [spread // 2] * 400
    frame = spark.createDataFrame([(t,) for t in times], "t bigint").repartition(4)
    times.sort()
    for parts in (1, 3, 12):
        cuts = {times[-(-i * len(times) // parts) - 1] for i in range(1, parts)}
        wanted = sorted({times[0], *cuts, times[-1] + 1})
        for accuracy, gathered in ((100_000, 100_000), (5, 0), (5, 500)):
            assert times_at_ranks(frame, parts, accuracy, gathered) == wanted
        windows = balanced_windows(frame, parts, "t", 5).orderBy("window_no").collect()
        assert [r.window_start for r in windows] + [windows[-1].window_end] == wanted


def test_profiles_merge_without_a_reread(spark):
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("list", F.array("event_id"))
    stored = StoredProfile(spark, scratch_path(spark, "profile"), rows.schema)
    assert stored.profile() is None
    day = F.unix_date(F.col("ts").cast("date")).cast("bigint")
    for wave in (rows.where(day % 2 == 0), rows.where(day % 2 == 1), rows.where(day % 4 == 0)):
        stored.update(wave, day)
    exact = {r.name: r for r in column_profile(rows).collect()}
    for r in stored.profile().collect():
        want = exact[r.name]
        assert (r.type, r.rows, r.nulls, r.min, r.max, r.role) == (
            want.type, want.rows, want.nulls, want.min, want.max, want.role,
        )
        if want.approx_distinct is not None:
            assert r.approx_distinct == pytest.approx(want.approx_distinct, rel=0.15)

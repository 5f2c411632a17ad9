"""Filters, mapping, windows, numbering, upsert and reconciliation, also under skew."""

import random
from collections import Counter
from functools import wraps
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepoint.functions.timefn import parse_instant
from tidepoint.operators import sweep
from tidepoint.operators.filters import (
    after_position,
    drop_absent,
    in_series,
    series_predicate,
    tag_filter,
    time_range,
)
from tidepoint.operators.mapping import (
    apply_mapping,
    expand_mappings,
    fill_template,
    mapping_from_json,
    mapping_to_json,
    mappings_frame,
    name_collisions,
)
from tidepoint.operators.numbering import chunk_batches, number_rows, series_batches
from tidepoint.operators.reconcile import differences, reconcile
from tidepoint.operators.upsert import last_wins
from tidepoint.operators.sweep import range_bounds, sweep_intervals
from tidepoint.operators.windows import (
    assign_intervals,
    clipped,
    overlapping,
    split_windows,
    window_start_of,
)
from tidepoint.points import (
    FieldMap,
    Mapping,
    PointsSchema,
    TagMap,
    check_batch_size,
    check_series_per_query,
    check_window,
    infer_roles,
    to_points,
)

H = 3600 * 10**9
DAY = 24 * H


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_null_filter(spark):
    schema = PointsSchema(("tag1", "tag2", "tag3"), ("field1", "field2", "field3", "field4"))
    frame = spark.createDataFrame(
        [("m", "v1", "", "v3", "value1", None, 0, 42, 5)],
        "measurement string, tag1 string, tag2 string, tag3 string, field1 string,"
        " field2 string, field3 int, field4 int, time_ns bigint",
    )
    got = drop_absent(frame, schema).first().asDict()
    assert got["tag2"] is None and got["field2"] is None
    assert (got["tag1"], got["field3"]) == ("v1", 0)


def test_mapping_reads_tag_from_text_field(spark):
    schema = PointsSchema(
        ("region",), ("host_id", "cpu_usage", "memory_usage", "disk_usage", "extra")
    )
    frame = spark.createDataFrame(
        [("m", "us", "server1", "85.5", 70, 1.5, 9, 1)],
        "measurement string, region string, host_id string, cpu_usage string,"
        " memory_usage int, disk_usage double, extra int, time_ns bigint",
    )
    mapping = Mapping(
        tags=(TagMap("host_id", "host"), TagMap("region"), TagMap("extra", "e"), TagMap("")),
        fields=(
            FieldMap("cpu_usage", "cpu", "float"),
            FieldMap("memory_usage", "memory", "float"),
            FieldMap("disk_usage", "", "float"),
            FieldMap("", "nothing"),
            FieldMap("unknown", "u"),
        ),
    )
    out, result = apply_mapping(frame, schema, mapping)
    assert (result.tags, result.fields) == (("host", "region"), ("cpu", "disk_usage", "memory"))
    got = out.first().asDict()
    assert got == {
        "measurement": "m",
        "host": "server1",
        "region": "us",
        "cpu": 85.5,
        "disk_usage": 1.5,
        "memory": 70.0,
        "time_ns": 1,
    }


def test_empty_mapping_passes_points_on(spark):
    schema = PointsSchema(("t",), ("f",))
    frame = spark.createDataFrame(
        [("m", "a", 1.0, 1)], "measurement string, t string, f double, time_ns bigint"
    )
    assert rows(apply_mapping(frame, schema, Mapping())[0]) == rows(frame)


@pytest.mark.parametrize(
    "mapping",
    [
        Mapping(fields=(FieldMap("a", "x"), FieldMap("b", "x"))),
        Mapping(tags=(TagMap("a"), TagMap("b", "a"))),
        Mapping(tags=(TagMap("a", "x"),), fields=(FieldMap("x"),)),
        Mapping(tags=(TagMap("a"),), fields=(FieldMap("f"), FieldMap("g", "f"))),
        Mapping(window_ns=H - 1),
        Mapping(window_ns=721 * H),
    ],
)
def test_bad_mappings(mapping):
    with pytest.raises(ValueError):
        mapping.validate()


def test_odd_and_reserved_names(spark):
    schema = PointsSchema(("a.b", "c`d"), ("e f",))
    columns = "`a.b` string, `c``d` string, `e f` double, t bigint"
    frame = spark.createDataFrame([("x", "y", 1.0, 5)], columns)
    points = to_points(frame, schema, "t", "m")
    mapping = Mapping(tags=(TagMap("c`d", "tag"), TagMap("a.b")), fields=(FieldMap("e f"),))
    assert apply_mapping(points, schema, mapping)[0].first().asDict() == {
        "measurement": "m", "a.b": "x", "tag": "y", "e f": 1.0, "time_ns": 5,
    }
    with pytest.raises(ValueError, match="reserved"):
        apply_mapping(points, schema, Mapping(tags=(TagMap("a.b", "time_ns"),)))


def test_limits():
    assert check_batch_size(0) == 10_000 and check_batch_size(1_000_000) == 1_000_000
    assert check_series_per_query(0) == 100 and check_window(0) == 168 * H
    for check, value in (
        (check_batch_size, 1_000_001),
        (check_batch_size, -1),
        (check_series_per_query, 1001),
        (check_window, 721 * H),
    ):
        with pytest.raises(ValueError):
            check(value)


def test_mapping_survives_storage():
    mapping = Mapping(
        source_table="t",
        tags=(TagMap("a", "b"),),
        fields=(FieldMap("f", "g", "int"),),
        tag_filters={"a": ["x"]},
        start="2024-01-01T00:00:00Z",
    )
    assert mapping_from_json(mapping_to_json(mapping)) == mapping


def test_roles_inferred_from_types(spark):
    frame = spark.createDataFrame(
        [("a", 1.0, True, 1)], "host string, cpu double, ok boolean, time bigint"
    )
    schema = infer_roles(frame, "time")
    assert (schema.tags, schema.fields) == (("host",), ("cpu", "ok"))
    points = to_points(frame, schema, "time", "m")
    assert points.columns == ["measurement", "host", "cpu", "ok", "time_ns"]
    assert name_collisions(PointsSchema(("a", "b"), ("b", "c"))) == ["b"]


def test_time_range_reaches_the_reader(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kept = time_range(frame, "ts", "2024-01-08T00:00:00Z", "2024-01-09T00:00:00Z")
    plan = kept.select("value")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
    with pytest.raises(ValueError):
        time_range(frame, "ts", "2024-01-09T00:00:00Z", "2024-01-09T00:00:00Z")


def test_tag_filter_is_exact(spark):
    frame = spark.createDataFrame(
        [("server1", "us"), ("server10", "us"), ("server2", "eu")], "host string, region string"
    )
    kept = tag_filter(frame, {"host": ["server1", "server2"], "region": []})
    assert {r["host"] for r in kept.collect()} == {"server1", "server2"}


def test_series_predicate_and_join_agree(spark):
    frame = spark.createDataFrame(
        [(f"h{i % 5}", f"r{i % 3}", i) for i in range(60)], "host string, region string, i int"
    )
    wanted = [{"host": "h1", "region": "r1"}, {"host": "h2", "region": "r0"}]
    listed = frame.where(series_predicate(wanted))
    joined = in_series(
        frame, spark.createDataFrame([("h1", "r1"), ("h2", "r0")], "host string, region string"),
        ["host", "region"],
    )
    assert sorted(rows(listed)) == sorted(rows(joined)) and listed.count() == 8
    assert frame.where(series_predicate([{}])).count() == 60


def test_null_tags_match_as_equal(spark):
    frame = spark.createDataFrame([("a", None), ("a", "x"), (None, None)], "p string, q string")
    kept = in_series(frame, frame.where("q is null"), ["p", "q"])
    assert sorted(rows(kept), key=str) == [("a", None), (None, None)]


def test_after_position_forms(spark):
    frame = spark.createDataFrame([(t, i) for t in range(4) for i in range(3)], "t bigint, id int")
    assert after_position(frame, "t", 1, "id", 1).count() == 7
    assert after_position(frame, "t", 1).count() == 6
    assert after_position(frame, None, None, "id", 1).count() == 4
    assert after_position(frame).count() == 12


@pytest.mark.parametrize(
    "start, end, width, wanted",
    [
        (0, 24 * H, 0, [(0, 24 * H)]),
        (0, 48 * H, 24 * H, [(0, 24 * H), (24 * H, 48 * H)]),
        (0, 24 * H, 48 * H, [(0, 24 * H)]),
        (0, 72 * H, 24 * H, [(0, 24 * H), (24 * H, 48 * H), (48 * H, 72 * H)]),
        (5, 5, 24 * H, []),
        (-H, H, 90 * 60 * 10**9, [(-H, H // 2), (H // 2, H)]),
    ],
)
def test_split_windows(spark, start, end, width, wanted):
    frame = spark.createDataFrame([(start, end)], "s bigint, e bigint")
    got = split_windows(frame, "s", "e", width).orderBy("window_no")
    assert rows(got.select("window_start", "window_end")) == wanted


def test_every_time_falls_in_one_window(spark):
    times = [random.Random(3).randrange(-10 * DAY, 10 * DAY) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in times], "t bigint")
    got = frame.withColumn("w", window_start_of(F.col("t"), 7 * H, 5))
    for t, w in rows(got):
        assert w <= t < w + 7 * H and (w - 5) % (7 * H) == 0


@pytest.mark.parametrize(
    "start, end, wanted",
    [
        ("2024-01-05", "2024-01-15", ("2024-01-05", "2024-01-10")),
        ("2023-12-25", "2024-01-05", ("2024-01-01", "2024-01-05")),
        ("2023-12-01", "2024-02-01", ("2024-01-01", "2024-01-10")),
        ("2024-01-11", "2024-01-15", None),
        ("2023-12-01", "2023-12-31", None),
        ("2024-01-10", "2024-01-15", None),
    ],
)
def test_shard_overlap_and_clip(spark, start, end, wanted):
    day = lambda text: parse_instant(f"{text}T00:00:00Z")
    shards = spark.createDataFrame(
        [(1, day("2024-01-01"), day("2024-01-10"))], "id int, start_ns bigint, end_ns bigint"
    )
    got = clipped(overlapping(shards, day(start), day(end)), day(start), day(end))
    expected = [] if wanted is None else [(day(wanted[0]), day(wanted[1]))]
    assert rows(got.select("eff_start", "eff_end")) == expected


def test_intervals_against_brute_force(spark):
    rng = random.Random(5)
    points = [(i, rng.randrange(-500, 3000)) for i in range(1500)]
    points += [(i, 700) for i in range(1500, 2300)]  # a third at one time
    spans = [(j, s := rng.randrange(-400, 2800), s + rng.randrange(0, 400)) for j in range(40)]
    got = assign_intervals(
        spark.createDataFrame(points, "i int, time_ns bigint"),
        spark.createDataFrame(spans, "j int, start_ns bigint, end_ns bigint"),
        100,
    ).select("i", "j")
    wanted = [(i, j) for i, t in points for j, s, e in spans if s <= t < e]
    assert sorted(rows(got)) == sorted(wanted)


@pytest.mark.parametrize("range_rows", [30, 200_000])
def test_sweep_against_brute_force(spark, range_rows):
    """Long and short intervals, a third of the points at one time, gaps, copies and nulls."""
    rng = random.Random(5)
    points = [(i, rng.randrange(-500, 1500)) for i in range(700)]
    points += [(i, 700) for i in range(700, 1100)] + [(3, 700)] * 2 + [(9, None)]
    spans = [(j, s := rng.randrange(-600, 3000), s + rng.randrange(0, 60)) for j in range(300)]
    spans += [(j, rng.randrange(-600, 0), rng.randrange(1000, 9000)) for j in range(40)]
    spans += [(50, 700, 701)] * 3 + [(51, 700, 700), (52, 9, 3), (53, None, 5), (54, 5, None)]
    got = sweep_intervals(
        spark.createDataFrame(points, "r int, time_ns bigint"),
        spark.createDataFrame(spans, "p int, start_ns bigint, end_ns bigint"),
        range_rows=range_rows,
    )
    assert got.columns == ["r", "time_ns", "p", "start_ns", "end_ns"]
    wanted = Counter(
        (i, t, j, s, e)
        for i, t in points
        for j, s, e in spans
        if None not in (t, s, e) and s <= t < e
    )
    assert Counter(rows(got)) == wanted


def test_sweep_copies_an_interval_per_range_it_covers(spark):
    """No explode per grid cell, and no copies for ranges without points."""
    points = spark.range(2000).select("id", (F.col("id") * 10**12).alias("time_ns"))
    spans = spark.createDataFrame([(1, 0, 2 * 10**15)], "j int, start_ns bigint, end_ns bigint")
    got = sweep_intervals(points, spans, range_rows=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
    assert got.count() == 2000
    empty = spans.limit(0)
    assert sweep_intervals(points, empty).isEmpty()
    assert sweep_intervals(points.limit(0), spans).isEmpty()
    assert sweep_intervals(points.limit(0), empty).columns == [*points.columns, *spans.columns]
    with pytest.raises(ValueError, match="share"):
        sweep_intervals(points, spans.withColumnRenamed("j", "ID"))


def test_pairs_are_joined_in_tasks_of_like_numbers(spark, monkeypatch):
    """No pair passes through Python, and ranges with many pairs are dealt over several tasks."""
    monkeypatch.setattr(sweep, "TASK_PAIRS", 5_000)
    rng = random.Random(8)
    points = [(i, rng.randrange(10**6)) for i in range(600)] + [(i, 700) for i in range(600, 900)]
    spans = [(j, s := rng.randrange(10**6), s + rng.randrange(3 * 10**5)) for j in range(500)]
    spans += [(j, 600 + j % 90, 800) for j in range(500, 700)]
    # As many intervals as one fine range can hold, at a single time and around it.
    spans += [(j, 700, 701) for j in range(700, 900)]
    got = sweep_intervals(
        spark.createDataFrame(points, "r int, time_ns bigint"),
        spark.createDataFrame(spans, "p int, start_ns bigint, end_ns bigint"),
    )
    assert "InArrow" not in got._jdf.queryExecution().optimizedPlan().toString()
    wanted = Counter((i, t, j, s, e) for i, t in points for j, s, e in spans if s <= t < e)
    assert Counter(rows(got)) == wanted and wanted.total() > 100_000
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < 30_000


def _shuffled(plan):
    """Rows written by each shuffle below ``plan``."""
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    found = []
    if plan.nodeName() == "Exchange":
        found.append(plan.metrics().apply("shuffleRecordsWritten").value())
    if "QueryStage" in plan.nodeName():
        found += _shuffled(plan.plan())
    children = plan.children()
    return found + [n for i in range(children.size()) for n in _shuffled(children.apply(i))]


def test_shuffles_and_files_of_overlapping_intervals_are_small(spark, tmp_path, monkeypatch):
    """Few intervals are sent more than once, and pairs are written in an order that packs."""
    monkeypatch.setattr(sweep, "TASK_PAIRS", 100_000)
    rng = random.Random(9)
    times = rng.sample(range(10**9), 4_000)
    points = spark.createDataFrame(list(enumerate(times)), "r int, time_ns bigint")
    starts = enumerate(rng.sample(times, 4_000))
    spans = [(j, s, s + 3 * 10**7 + rng.randrange(10**7)) for j, s in starts]
    got = sweep_intervals(
        points, spark.createDataFrame(spans, "p int, start_ns bigint, end_ns bigint"), range_rows=50
    )
    made = rows(got)
    held = np.sort(times)
    ends = [np.searchsorted(held, [s, e]) for _, s, e in spans]
    assert len(made) == len(set(made)) == sum(int(b - a) for a, b in ends) > 500_000
    assert all(s <= t < e for _, t, _, s, e in made)
    shuffled = _shuffled(got._jdf.queryExecution().executedPlan())
    assert len(shuffled) == 2 and sum(shuffled) < 4_000 + 1.5 * 4_000
    got.write.parquet(str(tmp_path / "pairs"))
    size = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    assert size < 1.2 * len(made)


def test_a_time_that_many_points_share_is_not_swept(spark, monkeypatch):
    """Coarse ranges: the points of a single time are never gathered in one task."""
    sweep_of = sweep._sweep

    def watched(*names):
        run = sweep_of(*names)

        @wraps(run)
        def checked(batches):
            batches = list(batches)
            assert sum(b.num_rows for b in batches) < 5_000
            return run(iter(batches))

        return checked

    monkeypatch.setattr(sweep, "_sweep", watched)
    time = F.when(F.col("id") < 9_000, 4_000).otherwise(F.col("id"))
    points = spark.range(12_000).select("id", time.alias("time_ns"))
    spans = [(1, 3_000, 9_500), (2, 4_000, 4_001)]
    spans = spark.createDataFrame(spans, "j int, start_ns bigint, end_ns bigint")
    assert sweep_intervals(points, spans, range_rows=1_200).count() == 9_500 + 9_000


def test_ranges_isolate_a_time_that_many_rows_share(spark):
    """Times a few ns apart near the end of 64 bits, half of them equal."""
    base = 9 * 10**18
    times = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, base + 777).otherwise(base + F.col("id")).alias("t")
    )
    bounds = range_bounds(times, 100)
    held = Counter(int(np.searchsorted(bounds, t, "right")) for (t,) in rows(times))
    wide = {r: n for r, n in held.items() if bounds[r] - bounds[r - 1] > 1}
    assert max(wide.values()) <= 200 and len(bounds) < 80


@pytest.mark.parametrize("parts", [1, 7])
def test_numbering_against_brute_force(spark, parts):
    """One group holds most rows, one is null, a third of the rows are copies."""
    rng = random.Random(7)
    data = [("hot", rng.randrange(10**6)) for _ in range(3000)]
    data += [(None, rng.randrange(50)) for _ in range(40)]
    data += [(f"g{i}", i) for i in range(200)] + [("hot", 77)] * 1500
    frame = spark.createDataFrame(data, "g string, t bigint").repartition(parts)
    got = rows(number_rows(frame, ["g"], ["t"]))
    assert Counter((g, t) for g, t, _ in got) == Counter(data)
    for _, group in groupby(sorted(got, key=lambda r: (str(r[0]), r[2])), key=lambda r: r[0]):
        group = list(group)
        assert [n for _, _, n in group] == list(range(1, len(group) + 1))
        assert [t for _, t, _ in group] == sorted(t for _, t, _ in group)


def test_numbering_spreads_one_group_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(20_000).select(F.lit("one").alias("g"), "id")
        got = number_rows(frame, ["g"], ["id"]).withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in got.groupBy("p").count().collect()]
        assert max(sizes) < 10_000
        assert got.where(F.col("row_no") != F.col("id") + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize(
    "count, size, wanted", [(5, 2, [2, 2, 1]), (4, 4, [4]), (3, 100, [3]), (150, 0, [100, 50])]
)
def test_series_batches(spark, count, size, wanted):
    frame = spark.createDataFrame(
        [("m", f"m,t={i:04d}") for i in range(count)], "measurement string, series_key string"
    )
    got = Counter(r["batch_id"] for r in series_batches(frame, size).collect())
    assert [got[i] for i in sorted(got)] == wanted


def test_chunks_are_full_but_the_last(spark):
    frame = spark.range(1001).select(F.lit("m").alias("m"), "id")
    sizes = Counter(r["batch_id"] for r in chunk_batches(frame, 100, ["m"], ["id"]).collect())
    assert [sizes[i] for i in range(11)] == [100] * 10 + [1]


def test_last_wins_under_a_hot_key(spark):
    rng = random.Random(9)
    data = [(rng.choice(["hot", "hot", None, "b", "c"]), i, rng.random()) for i in range(5000)]
    rng.shuffle(data)
    frame = spark.createDataFrame(data, "k string, seq int, v double")
    got = {r["k"]: (r["seq"], r["v"]) for r in last_wins(frame, ["k"], ["seq"]).collect()}
    wanted = {}
    for k, seq, v in sorted(data, key=lambda r: r[1]):
        wanted[k] = (seq, v)
    assert got == wanted
    again = last_wins(frame.unionByName(frame), ["k"], ["seq"])
    assert sorted(rows(again), key=str) == sorted(rows(last_wins(frame, ["k"], ["seq"])), key=str)


def test_reconcile_against_brute_force(spark):
    rng = random.Random(13)
    source = [(f"k{rng.randrange(40)}", rng.randrange(3)) for _ in range(400)]
    target = [(k, v if rng.random() > 0.05 else 9) for k, v in source if rng.random() > 0.02]
    source += [("hot", 1)] * 300
    target += [("hot", 1)] * 299 + [("new", 1)]
    left = spark.createDataFrame(source, "k string, v int")
    right = spark.createDataFrame(target, "k string, v int")
    got = {r["k"]: r["status"] for r in reconcile(left, right, ["k"], ["v"]).collect()}
    for key in {k for k, _ in source + target}:
        a = Counter(v for k, v in source if k == key)
        b = Counter(v for k, v in target if k == key)
        wanted = "missing" if not b else "extra" if not a else "same" if a == b else "changed"
        assert got[key] == wanted
    assert differences(left, left, ["k", "v"]).count() == 0
    only = differences(left, right, ["k", "v"])
    assert sum(r["only_source"] for r in only.collect()) == sum(
        (Counter(source) - Counter(target)).values()
    )


def test_template(spark):
    frame = spark.createDataFrame([("t", "t,a=1,b=x=y,c=3")], "table string, key string")
    pattern = F.lit("{{table}}/{{tag2}}-{{value2}}/{{value3}}/{{tag4}}/{{series}}")
    got = frame.select(fill_template(pattern, F.col("table"), F.col("key"))).first()[0]
    assert got == "t/a-1/{{value3}}/c/t,a=1,b=x=y,c=3"


def test_pattern_needs_several_series(spark):
    series = spark.createDataFrame(
        [("one", "one,a=1"), ("two", "two,a=1"), ("two", "two,a=2"), ("bare", "bare")],
        "source_table string, series_key string",
    )
    mappings = [
        Mapping(source_table="*", subtable_pattern="{{table}}_{{value2}}"),
        Mapping(source_table="two", target_measurement="fixed", tag_filters={"a": ["2"]}),
    ]
    got = expand_mappings(series, mappings_frame(spark, mappings))
    assert sorted(rows(got)) == [
        (0, "bare", "bare", "bare"),
        (0, "one", "one,a=1", "one_one,a=1"),
        (0, "two", "two,a=1", "two_1"),
        (0, "two", "two,a=2", "two_2"),
        (1, "two", "two,a=2", "fixed"),
    ]


def test_no_tags_is_no_crash(spark):
    from tidepoint.sources.discover import tag_keys
    from tidepoint.sources.scan import scan_series

    frame = spark.createDataFrame([(1, 2.0)], "time_ns bigint, v double")
    schema = PointsSchema((), ("v",))
    series = spark.createDataFrame([("x",)], "host string")
    assert scan_series(frame, schema, "time_ns", "m", series).count() == 1
    points = frame.selectExpr("'m' AS measurement", "v", "time_ns")
    assert tag_keys(points, schema).count() == 0


def test_last_of_repeated_long_values_wins(spark):
    from tidepoint.sources.ingest import widen

    columns = "measurement string, host string, field_name string, field_value string, time_ns bigint, seq int"
    rows = [("m", "a", "v", "9", 1, 1), ("m", "a", "v", "2", 1, 2), ("m", "a", "up", "bad", 1, 1)]
    wide = widen(
        spark.createDataFrame(rows, columns), ["host"], {"v": "double", "up": "boolean"}, ["seq"]
    )
    assert [(r["v"], r["up"]) for r in wide.collect()] == [(2.0, False)]


def test_time_parser_stays_small(spark):
    """Reading its argument once keeps the generated methods below the compiler's limit."""
    import re

    from tidepoint.functions.timefn import parse_time_ns

    text = F.concat(F.col("id").cast("string"), F.lit("x"))
    for _ in range(4):
        text = F.regexp_replace(text, "x", "y")
    frame = spark.range(3).select(parse_time_ns(text).alias("t"))
    report = frame._jdf.queryExecution().debug().codegenToSeq()
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", str(report)) or ["0"]
    assert max(map(int, sizes)) < 8000

"""Line text, payloads, typed tables, children and the upsert table."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidepoint.points import FieldMap, Mapping, PointsSchema
from tidepoint.session import scratch_path
from tidepoint.sinks.children import ChildTables, route_to_children, write_children
from tidepoint.sinks.lines import payloads, to_lines, write_lines
from tidepoint.sinks.tables import (
    UpsertTable,
    flat_rows,
    save_typed_table,
    table_type,
    typed_rows,
    upsert_rows,
)
from tidepoint.sources.discover import catalog_tables

SCHEMA = PointsSchema(("host",), ("cpu", "memory"))
COLUMNS = "measurement string, host string, cpu double, memory double, time_ns bigint"
DAY = 86_400 * 10**9


def lines(spark, row, columns=COLUMNS, schema=SCHEMA, **options):
    frame = spark.createDataFrame([row], columns)
    return [r["line"] for r in to_lines(frame, schema, **options).collect()]


@pytest.mark.parametrize(
    "row, wanted",
    [
        (
            ("metrics", "server1", 85.5, 70.2, 1709853600 * 10**9),
            ["metrics,host=server1 cpu=85.5,memory=70.2 1709853600000000000"],
        ),
        (("metrics", None, 85.5, None, 17 * 10**17), ["metrics cpu=85.5 1700000000000000000"]),
        (("metrics", "", 85.5, None, 1), ["metrics cpu=85.5 1"]),
        (("metrics", "server1", None, None, 1), []),
        (("metrics", "server1", 1e7, None, None), ["metrics,host=server1 cpu=10000000"]),
        (("metrics", "server1", 1.0, None, 0), ["metrics,host=server1 cpu=1"]),
        (("my data,x", "a b=c,d", 1.0, None, 1), [r"my\ data\,x,host=a\ b\=c\,d cpu=1 1"]),
    ],
)
def test_line(spark, row, wanted):
    assert lines(spark, row) == wanted


def test_line_always_with_time(spark):
    assert lines(spark, ("m", "h", 1.0, None, None), always_time=True) == ["m,host=h cpu=1 0"]


def test_line_field_types_and_escapes(spark):
    schema = PointsSchema((), ("a,b", "i", "s", "yes"))
    got = lines(
        spark,
        ("m", 1.5, 3, 'say "hi" \\ there\nnext', True, 9),
        "measurement string, `a,b` double, i int, s string, yes boolean, time_ns bigint",
        schema,
    )
    assert got == ['m a\\,b=1.5,i=3i,s="say \\"hi\\" \\\\ there\nnext",yes=true 9']


def test_line_break_in_tag_fails(spark):
    with pytest.raises(Exception, match="line break in tag host"):
        lines(spark, ("m", "a\nb", 1.0, None, 1))


def test_lines_are_written_as_text(spark):
    path = scratch_path(spark, "lines")
    rows = [("m", f"h{i}", float(i), None, i + 1) for i in range(50)]
    frame = spark.createDataFrame(rows, COLUMNS)
    write_lines(to_lines(frame, SCHEMA), path)
    assert {r["value"] for r in spark.read.text(path).collect()} == {
        f"m,host=h{i} cpu={i} {i + 1}" for i in range(50)
    }


def test_payloads_hold_every_line_in_order(spark):
    data = [("m", f"h{i % 3}", float(i), None, 1000 - i) for i in range(257)]
    frame = spark.createDataFrame(data, COLUMNS)
    got = payloads(frame, SCHEMA, 100, ["measurement"], ["time_ns", "host"]).orderBy("batch_id")
    found = [r["payload"].split("\n") for r in got.collect()]
    assert [len(p) for p in found] == [100, 100, 57]
    assert [int(x.split()[-1]) for p in found for x in p] == sorted(r[4] for r in data)


@pytest.mark.parametrize(
    "name, plain, super_table",
    [
        ("float", "double", "float"),
        ("float32", "float", "float"),
        ("int", "bigint", "int"),
        ("int64", "bigint", "bigint"),
        ("varchar", "string", "string"),
        ("BOOLEAN", "boolean", "boolean"),
        ("datetime", "timestamp", "timestamp"),
        ("blob", "string", "string"),
    ],
)
def test_table_types(name, plain, super_table):
    assert (table_type(name), table_type(name, True)) == (plain, super_table)


def test_typed_table_is_created_then_appended(spark):
    fields = (FieldMap("cpu", data_type="float"), FieldMap("memory", data_type="int"))
    mapping = Mapping(fields=fields)
    frame = spark.createDataFrame([("m", "a", 1.5, 2.0, 1_500_000)], COLUMNS)
    for _ in range(2):
        save_typed_table(typed_rows(frame, SCHEMA, mapping), "typed_points")
    got = spark.table("typed_points")
    assert got.count() == 2 and "typed_points" in catalog_tables(spark)
    assert dict(got.dtypes) == {
        "host": "string", "cpu": "double", "memory": "bigint", "_migration_time": "timestamp",
    }
    assert got.select(F.unix_micros("_migration_time")).first()[0] == 1000
    spark.sql("DROP TABLE typed_points")


def test_typed_table_takes_columns_and_refuses_types(spark):
    plain = Mapping(fields=(FieldMap("cpu", data_type="float"),))
    frame = spark.createDataFrame([("m", "a", 1.5, 3e9, 1_500_000)], COLUMNS)
    only_cpu = typed_rows(frame.drop("memory"), PointsSchema(("host",), ("cpu",)), plain)
    save_typed_table(only_cpu, "typed_wider")
    both = Mapping(fields=(FieldMap("cpu", data_type="float"), FieldMap("memory", data_type="int")))
    rows = typed_rows(frame, SCHEMA, both)
    save_typed_table(rows, "typed_wider")
    got = spark.table("typed_wider")
    assert sorted((r["memory"] or 0) for r in got.collect()) == [0, 3_000_000_000]
    with pytest.raises(ValueError, match="memory is bigint"):
        save_typed_table(rows.withColumn("memory", F.lit("x")), "typed_wider")
    spark.sql("DROP TABLE typed_wider")
    with pytest.raises(Exception, match="memory does not fit int"):
        typed_rows(frame, SCHEMA, both, super_table=True).collect()
    table = UpsertTable(spark, scratch_path(spark, "typed"), ["host", "_migration_time"], ["cpu"])
    for _ in range(2):
        table.upsert(rows)
    assert table.current().count() == 1


def test_flat_rows_refuse_tags(spark):
    frame = spark.createDataFrame([("m", "a", 1.5, 2.0, 1)], COLUMNS)
    with pytest.raises(ValueError, match="no tags"):
        flat_rows(frame, SCHEMA, [])


def test_payload_parts_are_bounded(spark):
    frame = spark.createDataFrame(
        [("m", "a", float(i), None, i) for i in range(1, 201)], COLUMNS
    ).withColumn("memory", F.lit(None).cast("double"))
    parts = payloads(frame, SCHEMA, 150, ["host"], ["time_ns"], max_bytes=500).collect()
    assert max(len(r["payload"]) for r in parts) < 600 and len(parts) > 5
    ordered = sorted(parts, key=lambda r: (r["batch_id"], r["part_no"]))
    lines = "\n".join(r["payload"] for r in ordered).split("\n")
    assert [int(line.rsplit(" ", 1)[1]) for line in lines] == list(range(1, 201))


def test_child_tables_bear_repeated_loads(spark):
    frame = spark.createDataFrame(
        [("m", f"h{i % 40}", float(i), None, i) for i in range(400)], COLUMNS
    )
    routed = route_to_children(frame, SCHEMA, F.lit("m"))
    target = ChildTables(spark, scratch_path(spark, "children"), SCHEMA, ["cpu"], buckets=4)
    for _ in range(2):
        target.upsert(routed)
    assert target.current().count() == 400
    assert target._files.names(f"{target.path}/data/v=2") and len(target._manifest()["slices"]) <= 4
    name = routed.where("host = 'h3'").first()["child_table"]
    assert {r["host"] for r in target.child(name).collect()} == {"h3"}
    assert target.child(name).count() == 10
    with pytest.raises(ValueError, match="child_table"):
        route_to_children(routed, SCHEMA, F.lit("m"))


def test_children_hold_one_series_each(spark):
    path = scratch_path(spark, "children")
    frame = spark.createDataFrame(
        [("m", f"h{i % 3}" if i % 4 else None, float(i), None, i) for i in range(120)], COLUMNS
    )
    write_children(route_to_children(frame, SCHEMA, F.lit("m")), path)
    back = spark.read.parquet(path)
    per_child = back.groupBy("child_table").agg(F.count_distinct(F.coalesce("host", F.lit(""))))
    assert back.count() == 120 and {r[1] for r in per_child.collect()} == {1}
    assert back.where("child_table = 'm'").where("host is not null").count() == 0


def test_tag_wins_over_field_of_its_name(spark):
    schema = PointsSchema(("a",), ("a", "b"))
    columns = "m string, a string, b double, time_ns bigint"
    frame = spark.createDataFrame([("m", "x", 1.0, 5)], columns)
    got = upsert_rows(frame, schema, [])
    assert got.columns == ["key_time_ns", "a", "b"] and got.first()["a"] == "x"


def _table(spark, label, slice_time="t"):
    return UpsertTable(spark, scratch_path(spark, label), ["t", "k"], ["seq"], slice_time)


def test_upsert_in_any_cut_equals_one_upsert(spark):
    rng = random.Random(1)
    names = ["a", "b", None]
    data = [(rng.randrange(5) * DAY, rng.choice(names), i, rng.random()) for i in range(300)]
    wanted = {}
    for t, k, seq, v in data:
        wanted[t, k] = (seq, v)
    table = _table(spark, "cut")
    for low, high in ((0, 120), (100, 200), (100, 200), (180, 300), (0, 60)):
        table.upsert(spark.createDataFrame(data[low:high], "t bigint, k string, seq int, v double"))
    assert {(r["t"], r["k"]): (r["seq"], r["v"]) for r in table.current().collect()} == wanted


def test_upsert_leaves_other_days_alone(spark):
    table = _table(spark, "days")
    columns = "t bigint, k string, seq int, v double"
    table.upsert(spark.createDataFrame([(d * DAY, "a", 1, 1.0) for d in range(4)], columns))
    table.upsert(spark.createDataFrame([(2 * DAY + 5, "b", 2, 2.0), (None, "c", 3, 3.0)], columns))
    slices = table._manifest()["slices"]
    assert sorted(slices.values()) == [1, 1, 1, 2, 2] and slices[str(2 * DAY)] == 2
    assert table.current().count() == 6
    part = table.between(DAY, 2 * DAY + 5)
    assert sorted(r["t"] for r in part.collect()) == [DAY, 2 * DAY]
    assert len(part.inputFiles()) <= 3 and table.between(50 * DAY, 60 * DAY) is None


def test_upsert_takes_new_columns(spark):
    table = _table(spark, "columns")
    start = "t bigint, k string, seq int"
    table.upsert(spark.createDataFrame([(1, "a", 1, 1.0)], f"{start}, v double"))
    table.upsert(spark.createDataFrame([(DAY, "a", 2, "x")], f"{start}, w string"))
    table.upsert(spark.createDataFrame([(2, "a", 3, 5.0)], f"{start}, v double"))
    got = sorted((r["t"], r["v"], r["w"]) for r in table.current().collect())
    assert got == [(1, 1.0, None), (2, 5.0, None), (DAY, None, "x")]


def test_crash_before_the_manifest_changes_nothing(spark, monkeypatch):
    table = _table(spark, "crash")
    columns = "t bigint, k string, seq int, v double"
    table.upsert(spark.createDataFrame([(1, "a", 1, 1.0)], columns))
    change = spark.createDataFrame([(1, "a", 2, 2.0), (DAY, "b", 3, 3.0)], columns)
    monkeypatch.setattr(table._files, "create", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.upsert(change)
    monkeypatch.undo()
    assert [tuple(r) for r in table.current().collect()] == [(1, "a", 1, 1.0)]
    table.upsert(change)
    got = sorted(tuple(r) for r in table.current().collect())
    assert got == [(1, "a", 2, 2.0), (DAY, "b", 3, 3.0)]


def test_columns_named_like_helpers_stay(spark):
    table = UpsertTable(spark, scratch_path(spark, "names"), ["t", "slice"], ["_newest"], "t")
    rows = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "t bigint, slice string, _newest int")
    table.upsert(rows)
    table.upsert(rows)
    assert sorted(tuple(r) for r in table.current().collect()) == [(1, "x", 1), (1, "y", 2)]


def test_types_widen_or_are_refused(spark):
    table = _table(spark, "types")
    table.upsert(spark.createDataFrame([(1, "a", 1, 5)], "t bigint, k string, seq int, v bigint"))
    more = spark.createDataFrame([(DAY, "a", 1, 0.5)], "t bigint, k string, seq bigint, v double")
    table.upsert(more)
    got = table.current()
    assert dict(got.dtypes) == {"t": "bigint", "k": "string", "seq": "bigint", "v": "double"}
    assert sorted((r["t"], r["v"]) for r in got.collect()) == [(1, 5.0), (DAY, 0.5)]
    version = table.version()
    wrong = spark.createDataFrame([(1, "a", 1, "x")], "t bigint, k string, seq int, v string")
    with pytest.raises(ValueError, match="v is double"):
        table.upsert(wrong)
    assert table.version() == version


def test_a_source_that_grows_is_read_once(spark, tmp_path):
    """Every evaluation of this source gives a row more, in another slice."""
    log = tmp_path / "calls"

    def more(batches):
        with open(log, "a") as f:
            f.write("x")
        n = len(log.read_text())
        assert sum(len(b) for b in batches) == 1
        import pandas as pd

        yield pd.DataFrame({"t": [d * DAY for d in range(n)], "k": "a", "seq": 1})

    table = _table(spark, "grows")
    table.upsert(spark.range(1, numPartitions=1).mapInPandas(more, "t bigint, k string, seq int"))
    read = table.current().count()
    assert read == len(table._manifest()["slices"]) == len(log.read_text()) == 1


def test_empty_upsert_and_expiry(spark):
    table = _table(spark, "expire", None)
    columns = "t bigint, k string, seq int"
    assert table.upsert(spark.createDataFrame([], columns)) == 0 and table.current() is None
    for i in range(4):
        table.upsert(spark.createDataFrame([(i, "a", i)], columns))
    table.expire(keep=2)
    assert table._versions() == [3, 4] and table.current().count() == 4
    assert table._files.names(f"{table.path}/data") == ["v=3", "v=4"]
    with pytest.raises(FileExistsError):
        table._files.create(f"{table.path}/manifest/{4:010d}.json", json.dumps({}))

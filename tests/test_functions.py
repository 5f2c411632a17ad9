"""Casts, time and text functions on the table-driven cases they must satisfy."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepoint.functions.casts import cast_value
from tidepoint.functions.keys import series_key, series_tags
from tidepoint.functions.textfn import escape_key_text, plain_decimal
from tidepoint.functions.timefn import (
    epoch_number_to_ns,
    ns_to_ms_text,
    ns_to_timestamp,
    parse_instant,
    parse_time_ns,
    time_literal,
    timestamp_to_ns,
)
from tidepoint.points import field_kind, widest_kind


def one(spark, value, sql_type, make):
    frame = spark.createDataFrame([(value,)], f"x {sql_type}")
    return frame.select(make(F.col("x"), frame.schema["x"].dataType).alias("y")).first()["y"]


def cast(spark, value, sql_type, to):
    return one(spark, value, sql_type, lambda c, kind: cast_value(c, kind, to))


# Inputs and results that every implementation of these casts must agree on.
@pytest.mark.parametrize(
    "value, sql_type, to, wanted",
    [
        (85.5, "double", "float", 85.5),
        (85, "int", "float", 85.0),
        (85, "smallint", "float", 85.0),
        (123, "int", "int", 123),
        ("123", "string", "int", 123),
        ("+7", "string", "integer", 7),
        (None, "double", "float", None),
        (None, "string", "int", None),
        ("invalid", "string", "float", 0.0),
        ("invalid", "string", "int", 0),
        ("1d", "string", "float", 0.0),
        (" 12 ", "string", "int", 0),
        ("12.5", "string", "int", 0),
        ("1e400", "string", "float", 0.0),
        ("-1.5e3", "string", "float", -1500.0),
        (".5", "string", "float", 0.5),
        ("Inf", "string", "float", float("inf")),
        ("99999999999999999999", "string", "int", 0),
        (85.9, "double", "int", 85),
        (-85.9, "double", "int", -85),
        (float("nan"), "double", "int", 0),
        (1e300, "double", "int", 0),
        (True, "boolean", "float", 0.0),
        (True, "boolean", "int", 0),
        (True, "boolean", "bool", True),
        ("true", "string", "bool", True),
        ("YES", "string", "boolean", True),
        ("on", "string", "bool", True),
        ("1", "string", "bool", True),
        (1, "int", "bool", True),
        (0, "bigint", "bool", False),
        (0.0, "double", "bool", False),
        ("false", "string", "bool", False),
        ("0", "string", "bool", False),
        (85.5, "double", "string", "85.5"),
        (1234567.89, "double", "string", "1234567.89"),
        (1e7, "double", "string", "10000000"),
        (-85.5, "double", "string", "-85.5"),
        (99.9, "float", "string", "99.9"),
        (123, "int", "string", "123"),
        (False, "boolean", "string", "false"),
        (bytearray(b"12"), "binary", "int", 12),
        ("kept", "string", "blob", "kept"),
        (7, "int", "blob", 7),
        (datetime(2024, 1, 1), "timestamp", "string", ""),
        (datetime(2024, 1, 1), "timestamp", "float", 0.0),
    ],
)
def test_cast(spark, value, sql_type, to, wanted):
    assert cast(spark, value, sql_type, to) == wanted


def test_nested_values_are_rejected():
    with pytest.raises(ValueError):
        field_kind(T.ArrayType(T.DoubleType()))


# Times and texts of the formats, with what they must give.
@pytest.mark.parametrize(
    "kinds, wanted",
    [
        (["int"], "int"),
        (["int", "float"], "float"),
        (["int", "string"], "string"),
        (["bool", "int"], "string"),
    ],
)
def test_widest_kind(kinds, wanted):
    assert widest_kind(kinds) == wanted


@pytest.mark.parametrize(
    "value, wanted",
    [
        (1e22, "1" + "0" * 22),
        (1.5e-7, "0.00000015"),
        (0.1 + 0.2, "0.30000000000000004"),
        (-0.0001, "-0.0001"),
        (float("inf"), "+Inf"),
        (float("-inf"), "-Inf"),
        (float("nan"), "NaN"),
    ],
)
def test_plain_decimal(spark, value, wanted):
    assert one(spark, value, "double", lambda c, kind: plain_decimal(c)) == wanted


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("2024-01-01T00:00:00Z", 1704067200000000000),
        ("2024-01-01T00:00:00.123456789Z", 1704067200123456789),
        ("2024-01-01T02:00:00.5+02:00", 1704067200500000000),
        ("2024-01-01 00:00:00", 1704067200000000000),
        ("2024-01-01 00:00:00.1234567", 1704067200123456700),
        ("1969-12-31T23:59:59.999999999Z", -1),
        ("2024-02-30T00:00:00Z", None),
        ("2024-01-01", None),
        ("2024-01-01T00:00:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_time(spark, text, wanted):
    assert one(spark, text, "string", lambda c, kind: parse_time_ns(c)) == wanted


@pytest.mark.parametrize(
    "value, wanted",
    [
        (1704067200.0, 1704067200 * 10**9),
        (1.7040672e18, 1704067200 * 10**9),
        (1e12, 10**12 * 10**9),
    ],
)
def test_epoch_number(spark, value, wanted):
    got = one(spark, value, "double", lambda c, kind: epoch_number_to_ns(c))
    assert got == (wanted if wanted < 2**63 else None)


def test_times_before_1970_round_down(spark):
    assert one(spark, -1, "bigint", lambda c, k: ns_to_ms_text(c)) == "1969-12-31 23:59:59.999"
    assert one(spark, -1, "bigint", lambda c, k: timestamp_to_ns(ns_to_timestamp(c))) == -1000


@pytest.mark.parametrize(
    "value, wanted",
    [
        ("2024-01-01T00:00:00Z", 1704067200000000000),
        ("2024-01-01T02:00:00.000000001+02:00", 1704067200000000001),
        (datetime(2024, 1, 1), 1704067200000000000),
        (5, 5),
    ],
)
def test_parse_instant(value, wanted):
    assert parse_instant(value) == wanted


def test_time_literal_rounds_up_to_the_column_unit(spark):
    frame = spark.range(1)
    for kind, unit in ((T.TimestampNTZType(), 1000), (T.DateType(), 86_400 * 10**9)):
        literal = time_literal(kind, 1704067200000000001)
        got = frame.select(timestamp_to_ns(literal).alias("y")).first()["y"]
        assert got == 1704067200000000000 + unit


@pytest.mark.parametrize(
    "key, wanted",
    [
        ("cpu,host=server1", {"host": "server1"}),
        ("cpu,host=server1,region=us", {"host": "server1", "region": "us"}),
        ("cpu", {}),
        ("cpu,host=a=b,odd", {"host": "a=b"}),
        ("cpu,host=a,host=b", {"host": "b"}),
        ("cpu,host=", {"host": ""}),
    ],
)
def test_series_tags(spark, key, wanted):
    assert one(spark, key, "string", lambda c, kind: series_tags(c)) == wanted


def test_series_key_sorts_tags_and_leaves_out_absent_ones(spark):
    frame = spark.createDataFrame(
        [("us", "a", None), ("", "b", "z")], "region string, host string, zone string"
    )
    keys = frame.select(series_key(F.lit("cpu"), ["region", "zone", "host"]).alias("k"))
    assert [r["k"] for r in keys.collect()] == ["cpu,host=a,region=us", "cpu,host=b,zone=z"]


def test_key_escape():
    assert escape_key_text("a,b=c d") == r"a\,b\=c\ d"

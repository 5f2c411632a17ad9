"""The supplied tables in the roles the queries use, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepoint.functions.timefn import parse_instant
from tidepoint.operators.mapping import union_points
from tidepoint.points import PointsSchema, to_points
from tidepoint.session import pin
from tidepoint.sinks.files import SharedFiles

DAY = 86_400 * 1_000_000_000
WEEK = 7 * DAY
ORIGIN = parse_instant("2024-01-01T00:00:00Z")

E_SCHEMA = PointsSchema(("event_type", "user_id"), ("value", "k"))
E_ID_SCHEMA = PointsSchema(("event_type", "user_id"), ("value", "k"), id_col="event_id")
L_SCHEMA = PointsSchema(
    ("l_returnflag", "l_linestatus"), ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)


def finished(frame: DataFrame, *folders: str) -> DataFrame:
    """The rows of ``frame``, fixed, after which the folders they came from are removed."""
    rows = pin(frame)
    files = SharedFiles(frame.sparkSession)
    for folder in folders:
        files.remove(folder)
    return rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number inside ``props`` as column ``k``; ``ts`` stays raw."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "user_id", "value", k.alias("k")
    )


def event_points(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    schema = E_ID_SCHEMA if with_id else E_SCHEMA
    return to_points(event_rows(spark, sf_dir), schema, "ts", "events")


def line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_points(table(spark, sf_dir, "lineitem"), L_SCHEMA, "l_shipdate", "lineitem")


def all_points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PointsSchema]:
    """Events and line items under the union of their columns."""
    points = union_points([event_points(spark, sf_dir), line_points(spark, sf_dir)])
    schema = PointsSchema(E_SCHEMA.tags + L_SCHEMA.tags, E_SCHEMA.fields + L_SCHEMA.fields)
    return points, schema


# The same views as common table expressions.
E_SQL = """e AS (
    SELECT 'events' AS measurement, event_type, CAST(user_id AS VARCHAR) AS user_id, value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id, ts,
           epoch_us(ts) * 1000 AS time_ns,
           'events,event_type=' || event_type || ',user_id=' || user_id AS series_key
    FROM events)"""
L_SQL = """l AS (
    SELECT 'lineitem' AS measurement, l_returnflag, l_linestatus, l_quantity, l_extendedprice,
           l_discount, l_tax, epoch_us(l_shipdate) * 1000 AS time_ns,
           'lineitem,l_linestatus=' || l_linestatus || ',l_returnflag=' || l_returnflag
               AS series_key
    FROM lineitem)"""


def number_sql(column: str) -> str:
    """Plain decimal text of a double with few digits."""
    return f"regexp_replace(CAST({column} AS VARCHAR), '\\.0$', '')"

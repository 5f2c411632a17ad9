"""Scans, predicates and row limits."""

from pyspark.sql import functions as F

from catalog import query
from catalog.views import E_SCHEMA, E_SQL, L_SQL, event_points, event_rows, line_points, table
from tidepoint.functions.timefn import timestamp_to_ns
from tidepoint.operators.filters import (
    drop_absent,
    first_rows,
    in_series,
    series_predicate,
    tag_filter,
)
from tidepoint.sources.scan import rows_to_points, scan_after, scan_points, scan_super_table


@query(
    "scan_range",
    f"""WITH {E_SQL}
    SELECT measurement, event_type, user_id, k, value, time_ns FROM e
    WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 12:30:00'""",
)
def scan_range(spark, sf_dir):
    return scan_points(
        event_rows(spark, sf_dir),
        E_SCHEMA,
        "ts",
        "events",
        "2024-01-08T00:00:00Z",
        "2024-01-22T12:30:00Z",
    )


@query(
    "scan_series_batch",
    f"""WITH {E_SQL}
    SELECT measurement, event_type, user_id, k, value, time_ns FROM e
    WHERE (event_type, user_id) IN (SELECT event_type, user_id FROM e WHERE value > 200)""",
)
def scan_series_batch(spark, sf_dir):
    points = event_points(spark, sf_dir)
    wanted = points.where(F.col("value") > 200).select("event_type", "user_id").distinct()
    return in_series(points, wanted, ["event_type", "user_id"])


@query(
    "series_list_filter",
    f"""WITH {L_SQL}
    SELECT l_returnflag, l_linestatus, count(*) AS points, max(time_ns) AS last_time_ns FROM l
    WHERE (l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N')
    GROUP BY ALL""",
)
def series_list_filter(spark, sf_dir):
    series = [{"l_returnflag": "A", "l_linestatus": "F"}, {"l_returnflag": "N"}]
    return (
        line_points(spark, sf_dir)
        .where(series_predicate(series))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("points"), F.max("time_ns").alias("last_time_ns"))
    )


_KEYSET = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
           'orders' AS measurement, epoch_us(o_orderdate) * 1000 AS time_ns
    FROM orders
    WHERE o_orderdate > TIMESTAMP '1998-03-05 00:00:00'
       OR (o_orderdate = TIMESTAMP '1998-03-05 00:00:00' AND o_orderkey > 60)"""


@query("scan_keyset", _KEYSET)
def scan_keyset(spark, sf_dir):
    rows = scan_after(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", "1998-03-05T00:00:00Z", 60
    )
    return rows_to_points(rows, "orders", "o_orderdate", "o_orderkey")[0]


@query(
    "keyset_page",
    _KEYSET + " ORDER BY o_orderdate, o_orderkey LIMIT 1000",
)
def keyset_page(spark, sf_dir):
    rows = scan_after(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        "o_orderkey",
        "1998-03-05T00:00:00Z",
        60,
        limit=1000,
    )
    return rows_to_points(rows, "orders", "o_orderdate", "o_orderkey")[0]


@query(
    "first_by_time",
    f"""WITH {E_SQL}
    SELECT event_id, event_type, user_id, value, time_ns FROM e
    ORDER BY time_ns, event_id LIMIT 100""",
)
def first_by_time(spark, sf_dir):
    points = event_points(spark, sf_dir, with_id=True)
    first = first_rows(points, ["time_ns", "event_id"], 100)
    return first.select("event_id", "event_type", "user_id", "value", "time_ns")


@query(
    "scan_supertable",
    """SELECT event_type || '_' || user_id AS tbname, epoch_us(ts) * 1000 AS ts,
           value AS col_1, CAST(json_extract_string(props, '$.k') AS BIGINT) AS col_2
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-24 00:00:00'""",
)
def scan_supertable(spark, sf_dir):
    rows = event_rows(spark, sf_dir).withColumn(
        "tbname", F.concat_ws("_", "event_type", F.col("user_id").cast("string"))
    )
    found = scan_super_table(
        rows,
        "ts",
        "tbname",
        ["value", "k"],
        "2024-01-03T00:00:00Z",
        "2024-01-24T00:00:00Z",
        sort=True,
    )
    return found.withColumn("ts", timestamp_to_ns(F.col("ts")))


@query(
    "tag_filter",
    f"""WITH {L_SQL}
    SELECT measurement, l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount,
           l_tax, time_ns FROM l
    WHERE l_returnflag IN ('A', 'R') AND l_linestatus IN ('F')""",
)
def tag_filter_query(spark, sf_dir):
    filters = {"l_returnflag": ["A", "R"], "l_linestatus": ["F"]}
    return tag_filter(line_points(spark, sf_dir), filters)


@query(
    "null_filter",
    f"""WITH {E_SQL}
    SELECT event_id, measurement, CASE WHEN event_type <> 'error' THEN event_type END
               AS event_type,
           user_id, CASE WHEN value >= 5 THEN value END AS value, k, time_ns
    FROM e""",
)
def null_filter(spark, sf_dir):
    points = event_points(spark, sf_dir, with_id=True).withColumns(
        {
            "event_type": F.when(F.col("event_type") == "error", "").otherwise(
                F.col("event_type")
            ),
            "value": F.when(F.col("value") >= 5, F.col("value")),
        }
    )
    return drop_absent(points, E_SCHEMA)

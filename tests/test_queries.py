"""Every registered query against its SQL on the same tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TIDEPOINT_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool) or value is None:
        return value
    if hasattr(value, "as_integer_ratio") and not isinstance(value, int):
        return float(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple((_plain(row[i]), type(_plain(row[i])).__name__) for i in order) for row in rows
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    found = _bag(frame.columns, frame.collect())
    cursor = duck.execute(ORACLES[name])
    wanted = _bag([d[0] for d in cursor.description], cursor.fetchall())
    assert found[0] == wanted[0]
    surplus, lack = found[1] - wanted[1], wanted[1] - found[1]
    assert not surplus and not lack, (list(surplus)[:3], list(lack)[:3])
    assert found[1], "an empty result shows nothing"

"""Queries that SQL can express, and the driver's contract."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from tidepoint.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = os.environ.get("TIDEPOINT_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_sql(spark, duck, name):
    frame = LLM_QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    cursor = duck.execute(f"SELECT {', '.join(columns)} FROM ({LLM_ORACLES[name]})")
    found = Counter(map(tuple, frame.select(*columns).collect()))
    assert found == Counter(cursor.fetchall())


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14))

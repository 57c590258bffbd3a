"""Every registered query against its SQL, on the smallest tables, and without Python in its plan."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import sorted_rows
from workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["borough", "road_type", "total_count"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    mine = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(entry.oracle_sql()[name])
    assert mine == sorted_rows([d[0] for d in result.description], result.fetchall())

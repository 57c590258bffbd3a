"""Queries with SQL against it, on the small tables."""

import glob
import os

import duckdb
import pytest

from tallymill.llm.queries import ORACLES, QUERIES
from tools.check_oracle import sorted_rows

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows([d[0] for d in result.description], result.fetchall())

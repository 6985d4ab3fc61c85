"""Queries that SQL can express, against DuckDB over a small data set."""

from pathlib import Path

import duckdb
import pytest

from strandforge.llm.queries import ORACLES, QUERIES
from tests.test_oracles import rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    got, want = QUERIES[name](spark, sf).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want) and len(got)

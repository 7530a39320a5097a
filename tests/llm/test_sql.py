"""The corpus queries that SQL can express, against it in DuckDB."""

from pathlib import Path

import duckdb
import pytest

from filingmill.llm import queries

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for p in DATA.iterdir():
        con.sql(f"create view {p.stem} as select * from '{p}'")
    sql = con.sql(queries.SQL[name])
    df = queries.QUERIES[name](spark, str(DATA))
    assert sorted(df.columns) == sorted(sql.columns)
    assert sorted(map(tuple, df.select(*sql.columns).collect()), key=str) == sorted(sql.fetchall(), key=str)

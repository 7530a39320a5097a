"""Every registered query of the library against its SQL in DuckDB."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from filingmill.plans import registry

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for p in DATA.iterdir():
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return str(v.normalize())
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, tables, name):
    df = registry.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(tuple(str(plain(r[c])) for c in columns) for r in df.collect())
    sql = tables.sql(registry.SQL[name])
    assert sorted(sql.columns) == columns
    at = [sql.columns.index(c) for c in columns]
    assert sorted(tuple(str(plain(r[i])) for i in at) for r in sql.fetchall()) == got


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {q for q in entry.queries() if q.startswith("q_")} == set(registry.QUERIES)

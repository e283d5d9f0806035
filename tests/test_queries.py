"""Each query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from quillmill.plans import engine_queries, io_queries, oracles, queries  # noqa: F401

DATA = "/root/testdata/sf0.001"
SQL = oracles.SQL | io_queries.SQL
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    rows, columns = df.collect(), sorted(df.columns)
    if name not in SQL:
        assert rows
        return
    found = duck.execute(SQL[name])
    assert sorted(c[0] for c in found.description) == columns
    wanted = duck.execute("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({SQL[name]})").fetchall()
    assert wanted
    assert sorted(str(tuple(str(r[c]) for c in columns)) for r in rows) == sorted(str(tuple(map(str, r))) for r in wanted)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0 and set(SQL) <= set(queries.QUERIES)

"""Every query with SQL against DuckDB on the tables that the correctness gate uses."""

import glob

import duckdb
import pytest

from tessera.plans import registry

SMALL = "/root/testdata/sf0.01"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def normal(rows):
    text = lambda v: "" if v is None else f"{float(v):.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[1].removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = normal(df.select(*[f"`{c}`" for c in columns]).collect())
    if name in SQL:
        quoted = ", ".join(f'"{c}"' for c in columns)
        assert got, "a query without rows checks nothing"
        assert got == normal(duck.execute(f"SELECT {quoted} FROM ({SQL[name]})").fetchall())
    else:
        assert got


def test_entry_module(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

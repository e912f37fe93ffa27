"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry
from graphtables.plans.registry import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(names, data) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = canonical(df.columns, df.collect())
    assert got == canonical(names, cursor.fetchall())
    assert got


def test_entry(spark, sf_dir):
    assert not entry(spark).isEmpty()

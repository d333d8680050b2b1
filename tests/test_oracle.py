"""Every registered query with SQL must equal it on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, bool):
            return str(int(value))
        return f"{value:.6f}" if isinstance(value, float) else str(value)

    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    # Beside the library's own queries, which all have SQL, there may be those of other packages.
    own = {name for name, query in contract.queries().items() if query.__module__.startswith("registry.")}
    assert own and own <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    expected = _canonical([d[0] for d in result.description], result.fetchall())
    assert _canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    assert contract.entry(spark).columns == ["collection", "shard", "docs"]

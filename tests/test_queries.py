"""Every registered query against its SQL oracle on the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def canonical(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(t[i] for i in order) for t in tuples]
    return sorted(names), sorted(picked, key=lambda t: [(x is None, str(x)) for x in t])


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert got == canonical(names, cursor.fetchall())
    else:
        assert got[1]


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)

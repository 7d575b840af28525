"""Every registered query against its SQL counterpart, on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
# the rest is held against brute force: see tests/llm
UNTOLD = {"op", "pipeline"}


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            con.sql(f"create view {name[:-8]} as select * from '{sf_dir}/{name}'")
    return con


def normal(value):
    if value is None:
        return ""
    return str(float(value)) if isinstance(value, float) else str(value)


def test_only_training_data_operators_lack_sql():
    assert {n.rstrip("0123456789") for n in (q.split("_")[0] for q in set(QUERIES) - set(ORACLES))} <= UNTOLD
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, tables, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    want = tables.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    places = [want.columns.index(c) for c in columns]
    got = sorted(tuple(normal(row[c]) for c in columns) for row in df.collect())
    expected = sorted(tuple(normal(row[i]) for i in places) for row in want.fetchall())
    assert got == expected


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1

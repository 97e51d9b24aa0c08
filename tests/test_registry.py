"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: "NULL" if v is None or (isinstance(v, float) and math.isnan(v)) else str(v)
    return sorted(tuple(clean(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows_as_sql(spark, sql, name):
    got = contract.queries()[name](spark, SF)
    want = sql.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0

"""Every query that has SQL against that SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from ledgerloom.plans import corpus, reference
from tools.compare import canonical

duckdb = pytest.importorskip("duckdb")
ORACLES = reference.ORACLES | corpus.ORACLES
QUERIES = reference.QUERIES | corpus.QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, con, name):
    got, want = QUERIES[name](spark, sf).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    QUERIES[name](spark, sf).count()


def test_entry(spark, sf):
    assert entry.entry(spark).count() >= 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())

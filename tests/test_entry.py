"""Driver contract: entry smoke, query/oracle registry, oracle parity."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, rows_of

SF = os.environ.get("PAXFLOW_TEST_SF", "/root/testdata/sf0.001")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "country", "day_of_week", "season", "passenger_count", "adults_count", "children_count", "average_age",
    ]
    assert df.count() > 0


def test_every_query_of_the_core_has_oracle_sql():
    from paxflow.plans import catalog

    assert set(catalog.QUERIES) == set(catalog.SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_what_is_not_installed_is_left_out():
    assert entry._optional("paxflow.not_there") is None
    assert entry._optional("paxflow.not_there.queries") is None
    assert entry._optional("paxflow.config").DEFAULT_AIRLINE == "KL"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    want, want_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want

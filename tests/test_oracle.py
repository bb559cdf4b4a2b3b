"""Every query with an oracle matches DuckDB on the sf0.001 tables (the driver runs the
same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from compare import compare
from conftest import SF_SMALL
from kestrel.session import TABLES

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srecs = [tuple(r) for r in sdf.collect()]
    duck.execute(f"CREATE OR REPLACE VIEW oracle_view AS {ORACLES[name]}")  # the driver wraps oracles in views
    cur = duck.execute("SELECT * FROM oracle_view")
    dcols = [d[0] for d in cur.description]
    assert compare(sdf.columns, srecs, dcols, cur.fetchall()) == []


def test_registry_consistent():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 150


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "user_id" in df.columns and "label" in df.columns
    assert df.count() >= 0

import duckdb
import pytest

from compare import compare
from kestrel.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    con.execute(f"CREATE VIEW o AS {ORACLES[name]}")
    want = con.execute("SELECT * FROM o")
    columns = [d[0] for d in want.description]
    df = QUERIES[name](spark, SMALL)
    assert not compare(df.columns, [tuple(r) for r in df.collect()], columns, want.fetchall())

"""Every corpus query with SQL against DuckDB on sf0.001."""
import duckdb
import pytest

from monthly_facts.llm import queries
from tests.conftest import SF_SMALL
from tests.test_oracle import digest

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(queries.ORACLES[name])
    names, want = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(rows) == len(want) > 0
    assert digest(rows, df.columns) == digest(want, names)

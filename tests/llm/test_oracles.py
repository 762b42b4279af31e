"""The training-data queries that SQL can express, against DuckDB."""

from collections import Counter

import duckdb
import pytest

from medallion.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    got = Counter(tuple(r[n] for n in names) for r in df.collect())
    assert got == Counter(cur.fetchall())

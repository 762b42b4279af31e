"""Driver contract: entry smoke check and every query against its SQL oracle."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from medallion.plans import acceptance, acceptance_storage

LIBRARY = acceptance.QUERIES | acceptance_storage.QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["prix", "surface", "type_bien", "latitude", "longitude"]


def test_every_query_has_an_oracle():
    assert set(LIBRARY) == set(acceptance.ORACLES | acceptance_storage.ORACLES)
    assert set(LIBRARY) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(LIBRARY))
def test_query_matches_oracle(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, cur.fetchall())

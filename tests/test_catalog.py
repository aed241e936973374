"""Every catalogue query against its DuckDB SQL twin on the smallest tables
(row count, column names and an order-insensitive value digest)."""

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import oracle_sql, queries
from recsmith.catalog import QUERIES, SQL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    from decimal import Decimal
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return str(v)
    return v


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql_twin(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted(tuple(_norm(x) for x in r) for r in df.collect())
    cur = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


def test_every_catalogue_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())

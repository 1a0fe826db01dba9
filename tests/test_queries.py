"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import math

import duckdb
import pytest

from lodestream.plans import registry as q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _shown(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return repr(round(float(v), 9)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(q.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rel = duck.sql(q.ORACLES[name])
    assert sorted(rel.columns) == columns
    mine = sorted(tuple(_shown(r[c]) for c in columns) for r in df.collect())
    theirs = sorted(tuple(_shown(r[rel.columns.index(c)]) for c in columns) for r in rel.fetchall())
    assert mine == theirs

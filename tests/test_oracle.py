"""Every registered query against its SQL counterpart, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _text(v):
    if v is None:
        return "~"
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(_text, r)) for r in df.select(*cols).collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(_text(r[i]) for i in at) for r in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 24


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.SQL)

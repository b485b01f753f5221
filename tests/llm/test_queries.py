"""Queries with SQL counterparts, on whole tables."""

import duckdb
import pytest

from coverlay.llm import queries as Q
from tests.conftest import DATA
from tests.test_oracle import TABLES, _text


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_matches_sql(spark, name):
    sf = f"{DATA}/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = Q.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(map(_text, r)) for r in df.select(*cols).collect())
    result = con.execute(Q.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(_text(r[i]) for i in at) for r in result.fetchall())

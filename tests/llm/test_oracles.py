"""Queries of the subpackage that SQL can express, against that SQL."""

import duckdb
import pytest

from priceloom.llm import queries
from tests.conftest import TESTDATA

TABLES = ("documents", "embeddings", "pages")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, duck, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir)
    cur = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(map(str, (tuple(v for _, v in sorted(zip(names, r, strict=True))) for r in cur.fetchall())))
    have = sorted(map(str, (tuple(r[c] for c in sorted(names)) for r in got.collect())))
    assert have == want

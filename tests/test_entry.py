"""The driver contract: entry(), queries() and oracle_sql(), each query
checked against DuckDB on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import digest, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_every_query_has_an_oracle():
    own = set(entry.queries()) - set(entry.EXTRA)
    assert own <= set(entry.oracle_sql())
    assert len(own) >= 37


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 41 and df.count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.EXTRA)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows) == digest(d_cols, d_rows)

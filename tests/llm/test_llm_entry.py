"""The registered queries, and their SQL on the smallest given tables."""

import os
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import digest, duck
from stockroute.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {m[1] for n in names if (m := re.match(r"op(\d+)_", n))} == {str(i) for i in range(1, 14)}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, rows) == digest(cols, cur.fetchall())

"""The registered queries against SQL, where there is one, on the smallest tables."""

import os
import sys

import pytest

from tomeworks.llm.registered import ORACLES, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import connect, rows_of  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(SF).execute(ORACLES[name])
    assert got == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

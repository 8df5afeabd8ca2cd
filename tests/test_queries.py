"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from oracle import compare, connect
from tomeworks.plans.registered import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    assert compare(spark, db, name, SF)[0] is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

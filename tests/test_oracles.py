"""Every registered query against its SQL, and what their plans must not contain."""

import os

import pytest
from compare import connect, difference, entry
from support import plan

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.QUERIES, entry.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    assert difference(df, ORACLES[name], con) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0

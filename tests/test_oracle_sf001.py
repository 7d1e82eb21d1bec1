"""The driver's correctness gate itself: every query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry
from logweave.plans.queries import QUERIES as OWN
from logweave.plans.verify import compare, duck
from tests.conftest import SF_MID

# the training-data queries have tests of their own in tests/llm
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF_MID)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf001(spark, con, name):
    res = compare(QUERIES[name](spark, SF_MID), con, ORACLES[name])
    assert res["ok"], res

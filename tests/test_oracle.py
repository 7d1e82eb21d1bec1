"""Every driver query against its DuckDB oracle (the driver's correctness gate), at sf0.001."""

import pytest

import __spark_entry__ as entry
from logweave.plans.queries import QUERIES as OWN
from logweave.plans.verify import compare, duck
from tests.conftest import SF_SMALL

# the training-data queries have tests of their own in tests/llm
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "ttl_s" in df.columns

"""Plan lint over every driver query: none of the shapes that do not scale.

No Cartesian product or nested-loop join (no cross joins, no all-pairs), no
exchange to a single partition (no window or sort without a key), no
row-at-a-time Python UDF. Checked on the final executed plans at sf0.001.
"""

import pytest

import __spark_entry__ as entry
from logweave.plans.queries import QUERIES as OWN
from tests.conftest import SF_SMALL

# the training-data queries have tests of their own in tests/llm
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_unscalable_shape(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    bad = [f for f in FORBIDDEN if f in final]
    assert not bad, (bad, final)

"""Plan guards: shapes that would not survive a large cluster are absent."""

import pytest

from support import SMALL_SF
from revtrace.plans.registry import queries

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "SortAggregate",
    "Window",
    "BatchEvalPython",
    "ArrowEvalPython",
)


@pytest.mark.parametrize("key", sorted(k for k in queries() if k != "ingest_stream"))
def test_no_forbidden_operators(spark, key):
    df = queries()[key](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, (key, found)


def test_report_filters_reach_the_scan(spark):
    df = queries()["trace_origin_by_material"](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the material parameter is pushed into the part scan as a brand filter
    assert "PushedFilters: [IsNotNull(p_brand), EqualTo(p_brand,Brand#1)" in plan or (
        "EqualTo(p_brand,Brand#1)" in plan
    )

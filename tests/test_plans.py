"""Structural guard over every registered query plan of the core: no cartesian
or nested-loop joins, no row-at-a-time Python UDFs."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_plan_shape(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"

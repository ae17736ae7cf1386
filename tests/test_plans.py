"""Physical-plan rules for every registered query: stay JVM-side, no cross joins, no sampling or row caps."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "Sample ", "CollectLimit", "GlobalLimit"]
TOP_K = {"insight_top_estados", "insight_hora_risco", "insight_melhor_dia"}


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_rules(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    allowed = {"GlobalLimit"} if name in TOP_K else set()
    bad = [node for node in FORBIDDEN if node in plan and node not in allowed]
    assert not bad, f"{name}: {bad}"
    if name in TOP_K:
        assert "TakeOrderedAndProject" in plan or "GlobalLimit" in plan

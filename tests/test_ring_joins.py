"""Rings meet by sorting, in tasks made by the number of edges, whatever the size of the files below."""

import pytest

import __spark_entry__
from limes import session
from limes.operators import geometry
from tests.test_ring_faults import box, edges

SF = "/root/testdata/sf0.001"


def plan_run(made):
    rows = sorted(map(repr, made.collect()))
    return made._jdf.queryExecution().executedPlan().toString(), rows


@pytest.mark.parametrize("name, bounded", [("ring_faults", 0), ("level_effects", 1)])
def test_nothing_that_grows_is_broadcast(spark, name, bounded):
    plan, _ = plan_run(__spark_entry__.queries()[name](spark, SF))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == bounded and "BroadcastNestedLoopJoin" not in final and "SortMergeJoin" in final


def test_steps_are_sorted_without_the_number_of_edges(spark):
    made = edges(spark, ("across", 0, 0, "outer", box(0, 0, 10)), ("across", 0, 1, "inner", box(8, 2, 6, 2)), ("bow", 0, 0, "outer", [(0, 0), (9, 9), (9, 0), (0, 5)]))
    for step, n in ((geometry.ring_faults, 2), (geometry.validity, 1), (geometry.representative_points, 2)):
        plan, rows = plan_run(step(made))
        assert "Broadcast" not in plan and len(rows) == n


def test_an_empty_table_has_no_faults(spark):
    none = edges(spark, ("good", 0, 0, "outer", box(0, 0, 10))).filter("part = 1")
    assert geometry.ring_faults(none, n_edges=0).count() == geometry.validity(none, 0).count() == geometry.representative_points(none, 0).count() == 0


@pytest.mark.parametrize("name", ["ring_faults", "level_effects"])
def test_tasks_grow_with_the_edges(spark, monkeypatch, name):
    query = __spark_entry__.queries()[name]
    whole = sorted(map(repr, query(spark, SF).collect()))
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    plan, rows = plan_run(query(spark, SF))
    n = spark.read.parquet(f"{SF}/customer.parquet").selectExpr("sum(4 + IF(c_custkey % 5 <> 3, 4, 0) + IF(c_custkey % 5 >= 3, 4, 0))").first()[0]
    for tasks in (-(-n // 100), -(-n * geometry.CELLS_PER_EDGE // 100)):
        assert tasks > 4 and f", {tasks}), REPARTITION_BY_NUM" in plan
    assert rows == whole

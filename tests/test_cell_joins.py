"""Joins on cells are sorted whatever the size of the files below, few corners meet without arrays, and cells are dealt over all tasks."""

import random

from limes.operators import rings
from limes.operators.noding import crossings
from limes.plans.shapes import _crossing_lines
from limes.session import written


def test_cells_and_groups_are_not_broadcast(spark):
    rows = written(spark.sql("SELECT id AS g, id AS line, explode(array(0, 1)) AS i, 0D AS x1, CAST(i AS DOUBLE) AS y1, 1D AS x2, 1D - i AS y2 FROM range(1000)"), "few")
    made = crossings(rows, "g")
    plan = made._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert made.count() == 2000 and made.selectExpr("min(x)", "max(x)", "min(y)", "max(y)").first() == (0.5, 0.5, 0.5, 0.5)


def test_holders_of_few_are_those_of_arrays(monkeypatch):
    rnd = random.Random(7)
    spot = lambda: (float(rnd.randrange(9)), float(rnd.randrange(9)))
    cases = [([[spot() for _ in range(rnd.randrange(3, 7))] for _ in range(rnd.randrange(1, 5))], [spot() for _ in range(8)]) for _ in range(200)]
    few = [rings.holders(*c) for c in cases]
    monkeypatch.setattr(rings, "FEW_PAIRS", 0)
    assert few == [rings.holders(*c) for c in cases] and any(any(f) for f in few)


def test_few_bytes_of_cells_take_all_tasks(spark):
    assert _crossing_lines(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4

"""Shapes of whole numbers far from the origin, whose products leave 32 bits."""

import pytest

from limes.operators import geometry, lookup
from tests.test_ring_faults import box

EDGES = "feature_id string, level int, part int, ring int, role string, seq int, x1 int, y1 int, x2 int, y2 int"
FAR = 4_000_000


def edges(spark, *rings):
    rows = [(f, level, part, ring, role, i, *p, *q) for f, level, part, ring, role, pts in rings for i, (p, q) in enumerate(zip(pts, [*pts[1:], pts[0]]))]
    return spark.createDataFrame(rows, EDGES)


def test_points_and_parents(spark):
    made = edges(spark, ("big", 4, 0, 0, "outer", box(2000, FAR, 60)), ("small", 6, 0, 0, "outer", box(2010, FAR + 10, 20)), ("small", 6, 1, 0, "outer", box(2040, FAR + 40, 4)))
    points = geometry.representative_points(made)
    assert {(r.feature_id, r.px, r.py) for r in points.collect()} == {("big", 2030.0, FAR + 30.0), ("small", 2020.0, FAR + 20.0)}
    placed = points.join(made.select("feature_id", "level").distinct(), "feature_id")
    assert {(r.feature_id, r.parent) for r in lookup.parents(placed, made, [4, 6], 25.0).collect()} == {("big", None), ("small", "big")}
    assert {(r.feature_id, r.area) for r in geometry.areas(made.filter("part = 0")).collect()} == {("big", 3600.0), ("small", 400.0)}


@pytest.mark.parametrize("wide", [60, 200_000])
def test_faults(spark, wide):
    made = edges(
        spark,
        ("good", 8, 0, 0, "outer", box(2000, FAR, wide)), ("good", 8, 0, 1, "inner", box(2005, FAR + 5, wide // 4)),
        ("away", 8, 0, 0, "outer", box(2000, FAR, wide)), ("away", 8, 0, 1, "inner", box(2005 + 2 * wide, FAR, wide // 4)),
        ("bow", 8, 0, 0, "outer", [(2000, FAR), (2000 + wide, FAR + wide), (2000 + wide, FAR), (2000, FAR + wide // 2)]),
    )
    assert {(r.feature_id, r.ring): r.reason for r in geometry.ring_faults(made).collect()} == {("away", 1): "hole_outside_shell"}
    assert {(r.feature_id, r.ring): r.reason for r in geometry.validity(made).collect()} == {("bow", 0): "self_crossing"}

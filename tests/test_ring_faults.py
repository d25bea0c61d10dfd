"""Faults between rings of one feature."""

from limes.operators import geometry

EDGES = "feature_id string, level int, part int, ring int, role string, seq int, x1 double, y1 double, x2 double, y2 double"


def edges(spark, *rings):
    rows = [(f, 8, part, ring, role, i, *map(float, (*p, *q))) for f, part, ring, role, pts in rings for i, (p, q) in enumerate(zip(pts, [*pts[1:], pts[0]]))]
    return spark.createDataFrame(rows, EDGES)


def box(x, y, w, h=None):
    h = h or w
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_faults_between_rings(spark):
    made = edges(
        spark,
        ("good", 0, 0, "outer", box(0, 0, 10)), ("good", 0, 1, "inner", box(2, 2, 6)), ("good", 1, 0, "outer", box(4, 4, 2)), ("good", 2, 0, "outer", box(20, 0, 5)),
        ("touch", 0, 0, "outer", box(0, 0, 10)), ("touch", 0, 1, "inner", [(0, 0), (3, 1), (1, 3)]),
        ("away", 0, 0, "outer", box(0, 0, 10)), ("away", 0, 1, "inner", box(30, 30, 2)),
        ("other", 0, 0, "outer", box(0, 0, 10)), ("other", 1, 0, "outer", box(20, 0, 10)), ("other", 1, 1, "inner", box(2, 2, 2)),
        ("across", 0, 0, "outer", box(0, 0, 10)), ("across", 0, 1, "inner", box(8, 2, 6, 2)),
        ("shells", 0, 0, "outer", box(0, 0, 10)), ("shells", 1, 0, "outer", box(2, 2, 3)),
        ("holes", 0, 0, "outer", box(0, 0, 10)), ("holes", 0, 1, "inner", box(2, 2, 6)), ("holes", 0, 2, "inner", box(3, 3, 2)),
    )
    got = {(r.feature_id, r.part, r.ring): r.reason for r in geometry.ring_faults(made).collect()}
    assert got == {
        ("away", 0, 1): "hole_outside_shell", ("other", 1, 1): "hole_outside_shell", ("across", 0, 0): "ring_crossing", ("across", 0, 1): "ring_crossing",
        ("shells", 1, 0): "nested_shells", ("holes", 0, 2): "nested_holes",
    }
    assert geometry.ring_faults(made.filter("feature_id = 'none'")).count() == 0

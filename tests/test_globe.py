"""Points against polygons by brute force on the grid's own lines, and distances over 180 degrees and near the poles."""

import random

import pytest

from limes.operators import geometry, lookup


def ring_edges(rings):
    return [(f, 8, r, "outer", i, *map(float, (*p, *q))) for f, r, pts in rings for i, (p, q) in enumerate(zip(pts, [*pts[1:], pts[0]]))]


EDGES = "feature_id string, level int, ring int, role string, seq int, x1 double, y1 double, x2 double, y2 double"


def inside(edges, px, py):
    n, on = 0, False
    for x1, y1, x2, y2 in edges:
        s = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
        n += (y1 > py) != (y2 > py) and (s > 0 if y2 > y1 else s < 0)
        on |= s == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2)
    return n % 2 == 1, on


@pytest.mark.parametrize("cell", [2.0, 3.0, 7.0])
def test_points_on_lines_corners_and_borders_of_the_grid(spark, cell):
    rng = random.Random(int(cell))
    spot = lambda: (rng.randint(-8, 12), rng.randint(-8, 12))  # noqa: E731  (small integers: corners lie on the grid's lines)
    rings = [(f"f{k}", 0, [spot() for _ in range(rng.randint(3, 7))]) for k in range(12)] + [("f0", 1, [spot() for _ in range(4)]), ("box", 0, [(-6, -6), (-6, 6), (6, 6), (6, -6)]), ("hole", 0, [(-6, -6), (6, -6), (6, 6), (-6, 6)]), ("hole", 1, [(-2, -2), (-2, 2), (2, 2), (2, -2)])]
    rows = ring_edges(rings)
    points = [(k, float(x) / 2, float(y) / 2) for k, (x, y) in enumerate((x, y) for x in range(-20, 28) for y in range(-20, 28))]
    df, where = spark.createDataFrame(rows, EDGES).coalesce(2).cache(), spark.createDataFrame(points, "pid long, px double, py double").coalesce(2).cache()
    told = {(p, f): inside([r[5:] for r in rows if r[0] == f], x, y) for p, x, y in points for f in {r[0] for r in rows}}
    for mode, keep in (("even_odd", lambda n, on: n), ("within", lambda n, on: n and not on), ("covers", lambda n, on: n or on)):
        got = sorted(map(tuple, geometry.containing(where, df, cell, mode).collect()))
        assert got == sorted(k for k, v in told.items() if keep(*v))


def nearest(spark, edges, points, km):
    df = spark.createDataFrame([(f, 8, *map(float, e)) for f, *e in edges], "feature_id string, level int, x1 double, y1 double, x2 double, y2 double")
    rows = lookup.nearest_km(spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "pid long, px double, py double"), df, km).collect()
    return {r.pid: (r.feature_id, round(r.distance, 3)) for r in rows}


def test_over_180_degrees(spark):
    edges = [("east", -179.999, 0, -179.999, 1), ("over", 179.9, 10, -179.9, 10), ("west", 179.999, 20, 179.999, 21)]
    got = nearest(spark, edges, [(179.999, 0.5), (-179.95, 10.01), (180, 10.01), (-180, 10.01), (-179.999, 20.5), (0, 10)], 2.0)
    assert got == {0: ("east", 0.223), 1: ("over", 1.113), 2: ("over", 1.113), 3: ("over", 1.113), 4: ("west", 0.209)}


def test_near_the_poles(spark):
    edges = [("a", 9.7, 88.9, 9.7, 89.1), ("b", -170, 85, -160, 85), ("c", 170, 89.99, -100, 89.99), ("d", 0, -89.5, 1, -89.5)]
    got = nearest(spark, edges, [(0, 89), (-165, 85.1), (175, 89.9), (-150, 89.95), (0.5, -89.4), (180, 90)], 20.0)
    assert got == {0: ("a", 18.845), 1: ("b", 11.132), 2: ("c", 10.019), 3: ("c", 4.453), 4: ("d", 11.132), 5: ("c", 1.113)}


def test_classes_over_180_degrees(spark):
    box = ring_edges([("f", 0, [(-179.9, 0), (-179.9, 1), (-179, 1), (-179, 0)])])
    points = [(0, -179.5, 0.5), (1, 179.99, 0.5), (2, -179.91, 0.5), (3, 179.5, 0.5)]
    got = lookup.nearby_class_km(spark.createDataFrame(points, "pid long, px double, py double"), spark.createDataFrame(box, EDGES), 0.5).collect()
    assert {r.pid: r["class"] for r in got} == {0: "inside", 1: "offshore", 2: "nearby", 3: "outside"}

"""Polygons of lines that cross, touch and overlap; nesting of very many rings."""

import math
import random
import time

import pytest

from limes.operators import rings


def polygons(spark, *members, gap=1.0):
    rows = [(1, role, k, [{"x": float(x), "y": float(y)} for x, y in pts]) for k, (role, pts) in enumerate(members)]
    df = spark.createDataFrame(rows, "rel long, role string, ref long, pts array<struct<x:double,y:double>>")
    return rings.relation_polygons(df, gap).collect()


def area_of(rows):
    ring = lambda r: abs(rings.area([(p.x, p.y) for p in r.pts[:-1]]))
    return sum(ring(r) * (1 if r.role == "outer" else -1) for r in rows if r.pts)


SQUARE = [("outer", [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)])]


def test_four_lines_that_cross_without_a_corner(spark):
    got = polygons(spark, ("outer", [(-1, 0), (11, 0)]), ("outer", [(0, -1), (0, 11)]), ("outer", [(-1, 10), (11, 10)]), ("outer", [(10, -1), (10, 11)]))
    assert len(got) == 1 and area_of(got) == pytest.approx(100) and got[0].reason is None


def test_lines_that_end_on_others_and_overlap(spark):
    got = polygons(spark, ("outer", [(0, 0), (10, 0)]), ("outer", [(2, 0), (2, 5)]), ("outer", [(8, 0), (8, 5)]), ("outer", [(0, 5), (6, 5)]), ("outer", [(4, 5), (9, 5)]))
    assert area_of(got) == pytest.approx(30)


def test_a_line_that_crosses_itself(spark):
    got = polygons(spark, ("outer", [(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]))
    assert area_of(got) == pytest.approx(50) and len(got) == 2


@pytest.mark.parametrize(
    "inner,want",
    [
        ([(5, 2), (15, 2), (15, 4), (5, 4), (5, 2)], 90),  # half outside
        ([(2, 0), (4, 0), (4, 3), (2, 3), (2, 0)], 94),  # along the border
        ([(20, 20), (22, 20), (22, 22), (20, 20)], 100),  # outside
        ([(-5, -5), (20, -5), (20, 5), (-5, 5), (-5, -5)], 50),  # cuts off one half
        ([(-5, 4), (20, 4), (20, 6), (-5, 6), (-5, 4)], 80),  # leaves two parts
        ([(3, 3), (5, 3), (5, 5), (3, 5), (3, 3)], 96),  # a hole
    ],
)
def test_inner_rings_are_taken_away(spark, inner, want):
    assert area_of(polygons(spark, *SQUARE, ("inner", inner))) == pytest.approx(want)


def test_nothing_left(spark):
    assert polygons(spark, *SQUARE, ("inner", SQUARE[0][1]))[0].reason == "empty_geometry"
    assert polygons(spark, *SQUARE, ("inner", [(-5, -5), (20, -5), (20, 20), (-5, 20), (-5, -5)]))[0].reason == "empty_geometry"


def test_a_closing_segment_is_cut_as_well(spark):
    got = polygons(spark, ("outer", [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0.5)]), ("outer", [(-0.3, 0.2), (0.3, 0.2), (0.3, 0.3), (-0.3, 0.3), (-0.3, 0.2)]))
    assert len([r for r in got if r.role == "outer"]) == 1 and got[0].repaired and area_of(got) == pytest.approx(100 + 0.03)


def test_over_the_antimeridian(spark):
    got = polygons(spark, ("outer", [(178, 0), (-178, 0)]), ("outer", [(179, -1), (179, 5)]), ("outer", [(178, 4), (-178, 4)]), ("outer", [(-179, -1), (-179, 5)]))
    assert area_of(got) == pytest.approx(8) and all(r.unwrapped for r in got) and len(got) == 2


def island(x, y, r, n):
    return [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)) for k in range(n)]


def test_holders_are_those_of_plain_counting():
    rng = random.Random(8)
    some = [island(rng.uniform(0, 50), rng.uniform(0, 50), rng.uniform(0.1, 20), rng.randint(3, 9)) for _ in range(80)] + [[(0, 0), (50, 0), (50, 50), (0, 50)]]
    probes = [(rng.uniform(-5, 55), rng.uniform(-5, 55)) for _ in range(300)]
    assert rings.holders(some, probes) == [[k for k, r in enumerate(some) if rings.holds(r, p)] for p in probes]
    assert rings.holders([], probes[:2]) == [[], []] and rings.holders(some, []) == []


def test_fifty_thousand_islands_in_under_a_minute():
    segments, n = [], 50_000
    for k in range(n):
        x, y = k % 250 * 10, k // 250 * 10
        segments += rings.sides(island(x, y, 3, 5))
        if k % 10 == 0:
            segments += rings.sides(island(x, y, 1, 4))
    began = time.time()
    made = rings.parity_rings(segments)
    parts = rings.parts_of(made)
    assert time.time() - began < 60
    assert len(made) == n + n // 10 and sum(role == "inner" for _, _, role in parts) == n // 10 and max(part for part, _, _ in parts) == n - 1

"""Generalisation that keeps what is where: nothing crosses, holes stay inside, neighbours keep their border."""

import math
import random

import pytest

from limes.operators import geometry, rings

EDGES = "feature_id string, level int, ring int, role string, seq int, x1 double, y1 double, x2 double, y2 double"


def frame(spark, shapes):
    rows = [(f, 4, r, "inner" if r else "outer", i, *map(float, (*p, *q))) for f, r, pts in shapes for i, (p, q) in enumerate(zip(pts, [*pts[1:], pts[0]]))]
    return spark.createDataFrame(rows, EDGES)


def crossing(segments):
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return [(s, t) for k, s in enumerate(segments) for t in segments[:k] if turn(*s, t[0]) * turn(*s, t[1]) < 0 and turn(*t, s[0]) * turn(*t, s[1]) < 0]


def simplified(spark, shapes, tolerance):
    rows = geometry.simplified_coverage(frame(spark, shapes), spark.createDataFrame([(4, tolerance)], "level int, tolerance double")).collect()
    return {(r.feature_id, r.ring): [(p.x, p.y) for p in r.pts[:-1]] for r in rows}


def test_a_hole_in_a_spike_stays_inside(spark):
    shell = [(0, 0), (40, 0), (40, 10), (22, 10), (21, 16), (20, 10), (0, 10)]
    hole = [(20.7, 11), (21.3, 11), (21, 13)]
    got = simplified(spark, [("a", 0, shell), ("a", 1, hole)], 8.0)
    assert rings.holds(got["a", 0], (21, 12)) and not crossing([s for r in got.values() for s in rings.sides(r)])
    assert len(simplified(spark, [("a", 0, shell)], 8.0)["a", 0]) < 7


def test_features_that_share_no_border_do_not_cross(spark):
    bay = [(0, 0), (100, 0), (100, 50), (60, 50), (50, 20), (40, 50), (0, 50)]
    pin = [(49, 60), (50, 24), (51, 60)]
    got = simplified(spark, [("bay", 0, bay), ("pin", 0, pin)], 31.0)
    assert not crossing([s for r in got.values() for s in rings.sides(r)])
    assert not rings.holds(got["bay", 0], (50, 40))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_stars_with_holes(spark, seed):
    rng = random.Random(seed)

    def star(x, y, low, high, n):
        return [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [rng.uniform(low, high)]]

    shapes = []
    for k in range(12):
        x, y = k % 4 * 25, k // 4 * 25
        shapes += [(f"f{k}", 0, star(x, y, 5, 12, 60)), (f"f{k}", 1, star(x, y, 1, 4.5, 25))]
    got = simplified(spark, shapes, 6.0)
    assert not crossing([s for r in got.values() for s in rings.sides(r)])
    assert all(rings.holds(got[f, 0], p) for (f, r), pts in got.items() if r for p in pts)
    assert sum(map(len, got.values())) < 0.8 * sum(len(p) for _, _, p in shapes) and all(len(r) >= 3 for r in got.values())


def test_rings_of_a_batch_are_cut_as_one_by_one():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    shapes = [([(float(rng.randrange(9)), float(rng.randrange(9))) for _ in range(n)], [rng.choice(["a", "a,b", "a,c"]) if mixed else "a" for _ in range(n)]) for n in (1, 2, 3, 5, 8, 40) for mixed in (False, True) for _ in range(30)]
    corners = pa.array([[{"x": x, "y": y, "sides": s} for (x, y), s in zip(*shape)] for shape in shapes])
    of, arc, turned, pts = geometry._cut_rings(corners.slice(7))
    got = [(k + 7, n, [(p["x"], p["y"]) for p in line], t) for k, n, t, line in zip(of.tolist(), arc.tolist(), turned.tolist(), pts.to_pylist())]
    assert got == [(k, n, line, t) for k, shape in enumerate(shapes) if k >= 7 for n, (line, t) in enumerate(geometry.arcs_of(*shape))]
    lines = [[(p["x"], p["y"]) for p in line] for line in pts.to_pylist()]
    x, y = (np.array([p[c] for line in lines for p in line]) for c in (0, 1))
    bounds = np.cumsum([0, *map(len, lines)])

    def kept(line, most, a, b):
        if b - a < 2:
            return []
        dx, dy = line[b][0] - line[a][0], line[b][1] - line[a][1]
        off = [abs(dx * (q - line[a][1]) - dy * (p - line[a][0])) / np.hypot(dx, dy) if dx or dy else np.hypot(p - line[a][0], q - line[a][1]) for p, q in line[a + 1 : b]]
        k = a + 1 + off.index(max(off))
        return [*kept(line, most, a, k), k, *kept(line, most, k, b)] if max(off) > most else []

    most = np.array([rng.choice([-1.0, 0.5, 3.0]) for _ in lines])
    keep = geometry.thinned_lines(x, y, bounds, most)
    assert [np.flatnonzero(keep[a:b]).tolist() for a, b in zip(bounds, bounds[1:])] == [sorted({0, *(kept(line, m, 0, len(line) - 1) if m > 0 else range(len(line))), len(line) - 1}) for line, m in zip(lines, most)]


def test_a_crossing_that_no_arc_can_give_up_is_carried_on(spark):
    bow = [(0, 0), (4, 4), (4, 0), (0, 4)]
    far = [(100 + x, y) for x, y in bow]
    round_ = [(50 + 9 * math.cos(k), 9 * math.sin(k)) for k in range(6)]
    got = simplified(spark, [("a", 0, bow), ("a", 1, far), ("b", 0, round_)], 3.0)
    assert set(got["a", 0]) == set(map(lambda p: tuple(map(float, p)), bow)) and len(got) == 3


def test_features_of_one_ring_meet_nothing(spark):
    alone = frame(spark, [("x", 0, [(0, 0), (9, 0), (0, 9)]), ("y", 1, [(0, 0), (9, 0), (0, 9)])])
    assert [(r.feature_id, r.reason) for r in geometry.ring_faults(alone).collect()] == [("y", "hole_outside_shell")]
    assert "several" in geometry.ring_faults(alone)._jdf.queryExecution().analyzed().toString()


def test_rings_that_lost_nothing_are_not_looked_at(spark, monkeypatch):
    bow, square = [(0, 0), (4, 4), (4, 0), (0, 4)], [(50, 0), (59, 0), (59, 9), (50, 9)]
    flat = [(0, 20), (5, 20.1), (9, 20), (9, 29), (0, 29)]
    edges = frame(spark, [("a", 0, bow), ("b", 0, square)]).unionByName(frame(spark, [("c", 0, flat)]).selectExpr("feature_id", "6 AS level", *EDGES.replace(",", "").split()[4::2]))
    seen, levels, nested = [], [], []
    for name, note in (("_thinned", lambda rows: seen.append(1)), ("ring_arcs", lambda rows: levels.extend(r.level for r in rows.select("level").distinct().collect())), ("ring_faults", lambda rows: nested.append(rows.count()))):
        monkeypatch.setattr(geometry, name, lambda rows, *a, f=getattr(geometry, name), note=note, **b: (note(rows), f(rows, *a, **b))[1])
    got = {r.feature_id: [(p.x, p.y) for p in r.pts[:-1]] for r in geometry.simplified_coverage(edges, spark.createDataFrame([(4, 1.0), (6, None)], "level int, tolerance double")).collect()}
    assert {k: set(v) for k, v in got.items()} == {k: {(float(x), float(y)) for x, y in v} for k, v in (("a", bow), ("b", square), ("c", flat))}
    assert len(seen) == 1 and levels == [4] and not nested

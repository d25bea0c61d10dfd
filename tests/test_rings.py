"""Rings by geometry, several parts, distances, releases: small cases and whole tables by brute force."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from limes.functions import names as N
from limes.operators import geometry, hierarchy, index, lookup, quality, rings
from limes.plans.fixtures import fixture
from limes.plans.queries import QUERIES
from limes.sources import tables
from tests.test_geometry import edges, points

SF = "/root/testdata/sf0.001"


def square(x, y, w):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]


def lines(spark, rows):
    """(rel, role, corners or None)"""
    made = [(rel, role, i, None if pts is None else [(float(x), float(y)) for x, y in pts]) for i, (rel, role, pts) in enumerate(rows)]
    return spark.createDataFrame(made, "rel long, role string, ref long, pts array<struct<x:double,y:double>>")


def test_islands_keep_a_point_each(spark):
    rows = [("isles", 8, 0, 0, "outer", square(0, 0, 1)), ("isles", 8, 1, 0, "outer", square(0, 9, 1.5))]
    data = [(n, lv, p, r, role, i, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for n, lv, p, r, role, pts in rows for i, (a, b) in enumerate(zip(pts, pts[1:] + pts[:1]))]
    shape = spark.createDataFrame(data, "feature_id string, level int, part int, ring int, role string, seq int, x1 double, y1 double, x2 double, y2 double")
    r = geometry.representative_points(shape).collect()
    assert [(x.feature_id, x.px, x.py) for x in r] == [("isles", 0.75, 9.75)]
    assert lookup.covered_by(geometry.representative_points(shape).withColumnRenamed("feature_id", "pid"), shape, 2.0).count() == 1
    assert index.quantized_hits(points(spark, [(0.5, 0.5), (0.5, 5), (1.2, 9.9)]), shape, 1.0).count() == 2


def test_all_lattice_points_are_inside_their_features(spark):
    land = fixture(spark, SF, "fx_land")
    reps = geometry.representative_points(land).withColumnRenamed("feature_id", "pid")
    found = geometry.containing(reps, land, {4: 300.0, 6: 100.0, 8: 100.0}, "within").filter("pid = feature_id")
    assert found.count() == reps.count() == land.select("feature_id").distinct().count()


def test_reasons_of_relations(spark):
    a, b, c, d = square(0, 0, 10)
    rows = [
        (1, "outer", [a, b, c]), (1, "outer", [a, d, c]), (1, "inner", square(2, 2, 2) + [(2, 2)]),
        (2, "outer", [a, b, c]), (2, "outer", None),
        (3, "outer", [a, b, c, d, a]), (3, "inner", [a, b, c, d, a]),
        (4, "outer", [a, b, c, d, (0, 0.5)]),
        (5, "outer", square(0, 0, 4) + [(0, 0)]), (5, "outer", square(4, 4, 4) + [(4, 4)]), (5, "outer", square(1, 1, 2) + [(1, 1)]),
        (6, None, [a, b, c, d, a]),
        (7, "outer", square(0, 0, 4) + [(0, 0)]), (7, "outer", square(4, 0, 4) + [(4, 0)]),
        (8, "outer", [(179, 0), (-179, 0), (-179, 2), (179, 2), (179, 0)]),
    ]
    got = {}
    for r in rings.relation_polygons(lines(spark, rows)).collect():
        size = None if r.pts is None else abs(rings.area([(p.x, p.y) for p in r.pts[:-1]]))
        got.setdefault(r.rel, []).append((r.part, r.role, size, r.reason, r.repaired))
    assert sorted(got[1]) == [(0, "inner", 4.0, None, False), (0, "outer", 100.0, None, False)]
    assert got[2] == [(None, None, None, "outer_polygonize_failed", False)] and got[6] == got[2]
    assert got[3] == [(None, None, None, "empty_geometry", False)]
    assert got[4] == [(0, "outer", 100.0, None, True)]
    assert sorted(got[5]) == [(0, "outer", 16.0, None, False), (1, "outer", 16.0, None, False)]  # touching rings apart, an outer ring inside another adds nothing
    assert got[7] == [(0, "outer", 32.0, None, False)]
    assert sorted(got[8]) == [(0, "outer", 2.0, None, False), (1, "outer", 2.0, None, False)]


def test_a_comb_falls_into_parts_at_the_meridian(spark):
    comb = [(170, 0), (190, 0), (190, 1), (175, 2), (190, 3), (190, 4), (170, 4)]
    turned = [(float(x - 360 if x > 180 else x), float(y)) for x, y in comb]
    data = [(1, *a, *b) for a, b in zip(turned, turned[1:] + turned[:1])]
    got = rings.split_at_antimeridian(spark.createDataFrame(data, "feature_id long, x1 double, y1 double, x2 double, y2 double")).collect()
    assert len(got) == 3 and sorted(round(abs(rings.area([(p.x, p.y) for p in r.pts[:-1]])), 3) for r in got) == [13.333, 13.333, 38.333]
    assert all(-180 <= p.x <= 180 for r in got for p in r.pts)


def keeps(line, tolerance):
    if len(line) < 3:
        return line
    (ax, ay), (bx, by) = line[0], line[-1]
    n = math.hypot(bx - ax, by - ay)
    off = [abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) / n if n else math.hypot(x - ax, y - ay) for x, y in line[1:-1]]
    if max(off) <= tolerance:
        return [line[0], line[-1]]
    k = off.index(max(off)) + 1
    return keeps(line[: k + 1], tolerance)[:-1] + keeps(line[k:], tolerance)


def test_simplified_lattice_against_brute_force(spark):
    land = [r for r in fixture(spark, SF, "fx_land").collect()]
    owners = {}
    for r in land:
        owners.setdefault((r.level, frozenset([(r.x1, r.y1), (r.x2, r.y2)])), set()).add(r.feature_id)
    want = {}
    by = {}
    for r in sorted(land, key=lambda r: r.seq):
        by.setdefault((r.feature_id, r.part, r.ring, r.level), []).append(r)
    for (name, part, ring, level), rows in by.items():
        if level == 4:  # a block's borders are listed in no order
            start, rows = {(r.x1, r.y1): r for r in rows}, [rows[0]]
            while len(rows) < len(start):
                rows.append(start[rows[-1].x2, rows[-1].y2])
        line = [(float(r.x1), float(r.y1)) for r in rows]
        tolerance = {4: 25.0, 8: 12.0}.get(level)
        if tolerance:
            near = [owners[level, frozenset([(r.x1, r.y1), (r.x2, r.y2)])] for r in rows]
            knots = [i for i in range(len(rows)) if near[i] != near[i - 1]]
            if len(knots) < 2:
                first = line.index(min(line))
                far = max(range(len(line)), key=lambda i: ((line[i][0] - line[first][0]) ** 2 + (line[i][1] - line[first][1]) ** 2, line[i]))
                knots = sorted({first, far})
            out = []
            for a, b in zip(knots, [*knots[1:], knots[0] + len(line)]):
                arc = [line[i % len(line)] for i in range(a, b + 1)]
                out += (keeps(arc, tolerance) if arc[0] <= arc[-1] else keeps(arc[::-1], tolerance)[::-1])[:-1]
            line = out if len(out) >= 3 else line
        want[name, part, ring] = (len(line) + 1, abs(rings.area(line)))
    got = {(r.feature_id, r.part, r.ring): (r.n_points, r.area) for r in QUERIES["simplified_rings"](spark, SF).collect()}
    assert got == {k: (n, pytest.approx(a)) for k, (n, a) in want.items()}


def test_common_borders_are_generalised_once(spark):
    rng = random.Random(2)
    border = [(10 + rng.uniform(-1, 1), y) for y in range(1, 20)]
    left = [(0, 0), (10, 0), *border, (10, 20), (0, 20)]
    right = [(10, 0), (20, 0), (20, 20), (10, 20), *border[::-1]]
    shape = edges(spark, [("l", 4, [("outer", left)]), ("r", 4, [("outer", right)])])
    got = {r.feature_id: {(p.x, p.y) for p in r.pts} for r in geometry.simplified_coverage(shape, spark.createDataFrame([(4, 0.8)], "level int, tolerance double")).collect()}
    inner = lambda s: {p for p in s if 0 < p[1] < 20}
    assert inner(got["l"]) == inner(got["r"]) and 0 < len(inner(got["l"])) < 19


def test_kilometres_shrink_with_latitude(spark):
    shape = edges(spark, [("a", 4, [("outer", square(0, 60, 1))]), ("b", 4, [("outer", square(0, 0, 1))])])
    where = points(spark, [(1.01, 60.5), (1.01, 0.5), (0.5, 61.01)])
    got = {(r.pid, r.feature_id): r.distance for r in lookup.nearest_km(where, shape, 2.0).collect()}
    assert got == {(0, "a"): pytest.approx(1.1132 * math.cos(math.radians(60.5))), (1, "b"): pytest.approx(1.1132 * math.cos(math.radians(0.5))), (2, "a"): pytest.approx(1.1132)}


def test_versions_are_checked_by_the_lookup(spark, tmp_path):
    shape = edges(spark, [("donut", 4, [("outer", square(0, 0, 10)), ("inner", square(4, 4, 2))])])
    where = points(spark, [(5, 5), (2, 2)])
    for version, want in ((1, 2), (2, 1), (3, 1)):
        index.write_index(shape, str(tmp_path / str(version)), version)
        assert index.index_lookup(spark, where, str(tmp_path / str(version)), 4.0, allow_first=True).count() == want
    with pytest.raises(PySparkException, match="version"):
        index.index_lookup(spark, where, str(tmp_path / "1"), 4.0).collect()
    with pytest.raises(ValueError):
        index.write_index(shape, str(tmp_path / "4"), 4)


def test_empty_results_that_are_errors(spark):
    polygons = spark.createDataFrame([(1, "xx", "X")], "id long, iso string, name string")
    assert tables.country_boundary(polygons, "xx").count() == 1 and tables.country_boundary(polygons).count() == 1
    with pytest.raises(PySparkException, match="no country polygon"):
        tables.country_boundary(polygons, "yy").collect()
    shape = edges(spark, [("a", 4, [("outer", square(0, 0, 10))])])
    features = spark.createDataFrame([("f", 8)], "id string, level int")
    reps = lambda x: spark.createDataFrame([("f", x, 5.0)], "feature_id string, px double, py double")
    assert lookup.country_features(features, reps(5.0), shape, 4.0).count() == 1
    with pytest.raises(PySparkException, match="inside the country"):
        lookup.country_features(features, reps(50.0), shape, 4.0).collect()
    files = spark.createDataFrame([("a", b"x")], "path string, content binary")
    with pytest.raises(PySparkException, match="missing: b"):
        quality.release_manifest(files, spark.createDataFrame([("a",), ("b",)], "path string"), {}).collect()
    with pytest.raises(PySparkException, match="empty country code"):
        spark.range(1).select(N.country_code(F.lit("  "))).collect()


def test_a_stage_that_was_cut_off_is_made_again(spark, tmp_path):
    rows = spark.range(3)
    rows.write.parquet(str(tmp_path / "stage=k" / "rows"))  # without its mark
    assert tables.staged(spark, str(tmp_path), "k", lambda: spark.range(5)).count() == 5
    assert tables.staged(spark, str(tmp_path), "k", lambda: spark.range(7)).count() == 5
    assert tables.staged(spark, str(tmp_path), "other", lambda: spark.range(7)).count() == 7


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from limes import session

    class Cluster:
        class conf:
            get = staticmethod(lambda k, d=None: {"spark.master": "spark://host:7077"}.get(k, d))

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(Cluster)


def test_dashed_languages_count(spark):
    rows = spark.createDataFrame([(["name:nan-Hant", "name:EN", "name:nan", "name:zh-yue", "name", "name:1x", "old_name:en"],)], "keys array<string>")
    assert {r.lang: r.n for r in N.alias_counts(rows, F.col("keys")).collect()} == {"nan-hant": 1, "en": 1, "zh-yue": 1, "1x": 1}


def test_unlevelled_nodes_are_passed(spark):
    nodes = spark.createDataFrame([("a", "A", 2), ("b", "B", None), ("c", "C", 6), ("d", "D", None), ("e", "E", 4)], "id string, name string, level int")
    down = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "parent string, child string")
    assert {(r.id, r.depth, r.above) for r in hierarchy.tree_listing(nodes, down, skip_unlevelled=True).collect()} == {("a", 0, None), ("c", 1, "a"), ("e", 0, None)}
    assert {r.id for r in hierarchy.tree_listing(nodes, down).collect()} == {"a", "b", "c", "d", "e"}

import random

import pytest
from pyspark.sql import functions as F

from limes.operators import geometry, hierarchy, index, lookup, stitch

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
HOLE = [(4, 4), (4, 6), (6, 6), (6, 4)]


def edges(spark, features):
    """features: (id, level, [(role, corners)])"""
    rows = []
    for name, level, rings in features:
        for k, (role, pts) in enumerate(rings):
            for i, ((ax, ay), (bx, by)) in enumerate(zip(pts, pts[1:] + pts[:1])):
                rows.append((name, level, k, role, i, float(ax), float(ay), float(bx), float(by)))
    return spark.createDataFrame(rows, "feature_id string, level int, ring int, role string, seq int, x1 double, y1 double, x2 double, y2 double")


def points(spark, pts):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "pid long, px double, py double")


def hits(df):
    return {(r.pid, r.feature_id) for r in df.collect()}


def test_donut_and_enclave(spark):
    shape = edges(spark, [("donut", 4, [("outer", SQUARE), ("inner", HOLE)]), ("enclave", 4, [("outer", HOLE)])])
    where = points(spark, [(5, 5), (2, 2), (20, 5), (9.5, 9.5)])
    for cell in (0.7, 3.0, 50.0):
        assert hits(geometry.containing(where, shape, cell)) == {(0, "enclave"), (1, "donut"), (3, "donut")}


def test_border_modes(spark):
    shape = edges(spark, [("a", 4, [("outer", SQUARE)])])
    where = points(spark, [(0, 5), (10, 10), (5, 5)])
    assert hits(geometry.containing(where, shape, 3.0, "covers")) == {(0, "a"), (1, "a"), (2, "a")}
    assert hits(geometry.containing(where, shape, 3.0, "within")) == {(2, "a")}


def test_neighbours_share_no_point(spark):
    shape = edges(spark, [("a", 4, [("outer", SQUARE)]), ("b", 4, [("outer", [(x + 10, y) for x, y in SQUARE])])])
    assert hits(geometry.containing(points(spark, [(9, 5), (11, 5)]), shape, 4.0)) == {(0, "a"), (1, "b")}


def test_random_polygons_against_ray_casting(spark):
    rng = random.Random(5)
    rings = [[(rng.uniform(0, 30), rng.uniform(0, 30)) for _ in range(rng.randint(3, 9))] for _ in range(6)]
    where = [(rng.uniform(-2, 32), rng.uniform(-2, 32)) for _ in range(200)]

    def inside(p, ring):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > p[1]) != (by > p[1]) and p[0] < ax + (bx - ax) * (p[1] - ay) / (by - ay):
                odd = not odd
        return odd

    want = {(i, f"f{k}") for i, p in enumerate(where) for k, r in enumerate(rings) if inside(p, r)}
    shape = edges(spark, [(f"f{k}", 4, [("outer", r)]) for k, r in enumerate(rings)])
    for cell in (1.3, 7.0):
        assert hits(geometry.containing(points(spark, where), shape, cell)) == want


def test_representative_points_are_inside(spark):
    shape = edges(spark, [("donut", 4, [("outer", SQUARE), ("inner", HOLE)]), ("l", 4, [("outer", [(0, 0), (9, 0), (9, 1), (1, 1), (1, 9), (0, 9)])])])
    reps = geometry.representative_points(shape).withColumnRenamed("feature_id", "pid")
    found = geometry.containing(reps, shape, 2.0, "within")
    assert {(r.pid, r.feature_id) for r in found.collect()} >= {("donut", "donut"), ("l", "l")}


def test_dissolve_keeps_the_area(spark):
    shape = edges(spark, [("a", 4, [("outer", SQUARE)]), ("b", 4, [("outer", [(x + 10, y) for x, y in SQUARE])])]).withColumn("g", F.lit("u"))
    assert geometry.dissolve(shape, "g").count() == 6
    assert {r.feature_id: r.area for r in geometry.areas(shape).collect()} == {"a": 100.0, "b": 100.0}


def test_simplify_keeps_small_rings_and_drops_flat_corners(spark):
    rows = [(1, [(0.0, 0.0), (5.0, 0.1), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)], 1.0), (2, [(0.0, 0.0), (0.1, 0.0), (0.1, 0.1), (0.0, 0.0)], 1.0), (3, [(0.0, 0.0), (5.0, 0.1), (10.0, 0.0), (0.0, 9.0), (0.0, 0.0)], None)]
    df = spark.createDataFrame(rows, "feature_id long, pts array<struct<x:double,y:double>>, tolerance double")
    assert {r.feature_id: len(r.pts) for r in geometry.simplified(df).collect()} == {1: 5, 2: 4, 3: 5}


def test_antimeridian_square(spark):
    rows = [(1, [(179.0, 0.0), (-179.0, 0.0), (-179.0, 2.0), (179.0, 2.0), (179.0, 0.0)]), (2, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)])]
    df = spark.createDataFrame(rows, "feature_id long, pts array<struct<x:double,y:double>>")
    got = {(r.feature_id, r.part): sorted({p.x for p in r.pts}) for r in geometry.split_at_antimeridian(df).collect()}
    assert got == {(1, 0): [179.0, 180.0], (1, 1): [-180.0, -179.0], (2, 0): [0.0, 1.0]}


def test_degenerate_span_quantises_to_zero(spark):
    from limes.functions.numbers import quantize

    row = spark.range(1).select(quantize(F.lit(5.0), F.lit(5.0), F.lit(0.0)).alias("a"), quantize(F.lit(9.0), F.lit(0.0), F.lit(8.0)).alias("b"), quantize(F.lit(-1.0), F.lit(0.0), F.lit(8.0)).alias("c")).first()
    assert (row.a, row.b, row.c) == (0, 65535, 0)


def test_quantised_and_exact_hits_agree_away_from_borders(spark):
    shape = edges(spark, [("donut", 4, [("outer", SQUARE), ("inner", HOLE)])])
    rng = random.Random(1)
    where = points(spark, [(rng.uniform(0.1, 9.9), rng.uniform(0.1, 9.9)) for _ in range(100)])
    assert index.hit_differences(where, shape, 3.0).count() == 0
    with pytest.raises(ValueError):
        index.version_checked(1)


def test_ring_walk(spark):
    rows = [(1, "outer", 0, 11, 1, 2, True), (1, "outer", 1, 12, 3, 2, True), (1, "outer", 2, 13, 3, 1, True), (2, "outer", 0, 21, 1, 2, True), (3, "inner", 0, 31, None, None, False), (4, "outer", 0, 41, 7, 7, True)]
    df = spark.createDataFrame(rows, "rel long, role string, pos int, ref long, first_node long, last_node long, present boolean")
    got = {(r.rel, r.reason): r.nodes for r in stitch.assembled(df).collect()}
    assert got == {(1, None): [1, 2, 3, 1], (2, "open_ring"): [1, 2], (3, "missing_way"): None, (4, None): [7, 7]}


def test_cycles_and_orphans(spark):
    nodes = spark.createDataFrame([("a", "c"), ("b", "a"), ("c", "b"), ("d", "a"), ("e", None), ("f", "e"), ("g", "zz")], "id string, parent_id string")
    assert {r.id for r in hierarchy.cycles(nodes).collect()} == {"a", "b", "c", "d"}
    assert hierarchy.cycles(nodes.filter("id IN ('e', 'f')")).count() == 0


def test_parent_needs_the_adjacent_level(spark):
    shape = edges(spark, [("n", 4, [("outer", SQUARE)]), ("p", 6, [("outer", HOLE)])])
    kids = spark.createDataFrame([("x", 8, 5.0, 5.0), ("y", 8, 1.0, 1.0)], "feature_id string, level int, px double, py double")
    assert {r.feature_id: r.parent for r in lookup.parents(kids, shape, [4, 6, 8], 3.0).collect()} == {"x": "p", "y": None}


def test_lookup_stream(spark, tmp_path):
    from limes.streaming.lookups import lookup_stream

    shape = edges(spark, [("a", 4, [("outer", SQUARE)])])
    where = points(spark, [(5, 5), (11, 5), (40, 40)])
    where.write.parquet(str(tmp_path / "in"))
    got = []
    stream = spark.readStream.schema(where.schema).parquet(str(tmp_path / "in"))
    q = lookup_stream(stream, shape, 3.0, lambda df, _: got.extend(df.collect()), str(tmp_path / "ck"), most=2.0)
    assert q.awaitTermination(120)
    assert {(r.pid, r.feature_id, r.distance) for r in got} == {(0, "a", None), (1, "a", 1.0)}

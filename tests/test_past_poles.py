"""Nearest borders where latitudes go on past a pole, and where edges lie on each other."""

from pyspark.sql import functions as F

from limes.operators import lookup


def test_nearest_past_the_pole(spark):
    edges = spark.createDataFrame([(f"e{k}", 8, k * 0.01, 149.0, k * 0.01, 151.0) for k in range(50)], "feature_id string, level int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(k, k * 0.01 + 0.001, 150.0) for k in range(50)], "pid long, px double, py double")
    found = lookup.nearest_km(points, edges, 1.0)
    assert {(r.pid, r.feature_id, round(r.distance, 4)) for r in found.collect()} == {(k, f"e{k}", 0.0964) for k in range(50)}
    columns = spark.range(1).select(*(lookup._columns(F.lit(int(y * lookup.KM_PER_DEGREE)), 1 / lookup.KM_PER_DEGREE).alias(f"y{y}") for y in (30, 150, 90, 270, 390))).first()
    assert columns.y90 == columns.y270 == 1 and columns.y150 > 30_000 and columns.y30 > 30_000 and columns.y390 > 30_000


def test_copies_of_an_edge_are_one(spark):
    edges = spark.createDataFrame([(f"e{k:03}", level, 1.0, 1.0, 1.0, 1.1) for k in range(200) for level in (6, 8)], "feature_id string, level int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(0, 1.001, 1.05)], "pid long, px double, py double")
    assert {(r.level, r.feature_id) for r in lookup.nearest_km(points, edges, 1.0).collect()} == {(6, "e000"), (8, "e000")}
    text = lookup.nearest_km(points, edges, 1.0)._jdf.queryExecution().toString()
    assert "min(feature_id" in text and "REPARTITION_BY_NUM" in text  # few cells with many edges stay apart

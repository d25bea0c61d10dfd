"""Index tables follow from one table of rings."""

from limes.operators import index


def test_indexes_count_rings_once_and_skip_what_has_no_number(spark):
    rows = [("a", 4, 0, 0, "outer"), ("a", 4, 0, 0, "inner"), ("a", 4, 0, 1, "inner"), ("a", 4, 1, 0, "outer"), ("a", 4, 1, None, "outer"), ("a", 4, None, 0, "outer"), ("b", 4, 0, 0, "outer")]
    edges = spark.createDataFrame([(*r, k, k, k, k) for r in rows for k in range(3)], "feature_id string, level int, part int, ring int, role string, x1 int, y1 int, x2 int, y2 int")
    made = index.feature_index(edges)
    assert "Expand" not in made._jdf.queryExecution().optimizedPlan().toString() and "Expand" not in index.ring_sizes(edges)._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.n_parts, r.n_rings, r.n_bytes) for r in made.orderBy("index").collect()] == [(2, 3, 72), (1, 1, 12)]
    assert [(r.part, r.n_rings) for r in index.geometry_index(edges).orderBy("index").collect()] == [(None, 1), (0, 2), (1, 1), (0, 1)]


def test_an_index_reads_edges_for_rings_boxes_and_corners_only(spark, tmp_path, monkeypatch):
    edges = spark.createDataFrame([("a", 4, 0, 0, "outer", k, k, k * k, k + 1, k) for k in range(4)], "feature_id string, level int, part int, ring int, role string, seq int, x1 int, y1 int, x2 int, y2 int")
    read = []
    plain = index.with_part
    monkeypatch.setattr(index, "with_part", lambda e: read.append(e) or plain(e))
    index.write_index(edges, str(tmp_path))
    assert len(read) == 4  # whole, rings, boxes, corners
    whole = {tuple(r) for r in index.quantized_rings(edges).collect()}
    assert {tuple(r)[:-1] for r in spark.read.parquet(f"{tmp_path}/corners").select(*index.quantized_rings(edges).columns, "version").collect()} == whole

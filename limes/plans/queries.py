"""The registered queries over the driver's tables, each beside its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.functions import names as N
from limes.functions import numbers as M
from limes.operators import geometry, hierarchy, index, lookup, policy, quality, select, stitch
from limes.plans.fixtures import fixture, oracle, table
from limes.session import scratch, sized
from limes.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: side of the grid's cells for the projected polygons
CELL = 250.0


def query(sql: str | None = None, *views: str):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = oracle(sql, *views)
        return f

    return register


INSIDE = "count(CASE WHEN (e.y1 > p.py) <> (e.y2 > p.py) AND e.x1 > p.px THEN 1 END) % 2 = 1"
HITS = f"+hits AS (SELECT p.pid, e.feature_id, e.level FROM fx_points p CROSS JOIN fx_edges e GROUP BY ALL HAVING {INSIDE})"
DISTANCE = "sqrt(power(greatest(least(e.x1, e.x2) - p.px, 0, p.px - greatest(e.x1, e.x2)), 2) + power(greatest(least(e.y1, e.y2) - p.py, 0, p.py - greatest(e.y1, e.y2)), 2))"


# --- lookups -------------------------------------------------------------------------------------------------------


@query(f"{HITS} SELECT * FROM hits", "fx_points", "fx_edges")
def point_lookup(spark, sf_dir):
    return lookup.point_lookup(fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges"), CELL)


@query(
    f"{HITS}, shapes AS (SELECT pid, string_agg(DISTINCT level::VARCHAR, '-' ORDER BY level::VARCHAR) AS shape FROM hits GROUP BY pid) "
    "SELECT p.pid, coalesce(s.shape, '') AS shape, CASE s.shape WHEN '2-4' THEN 'ok' WHEN '2' THEN 'partial' WHEN '4' THEN 'partial' ELSE 'failed' END AS status FROM fx_points p LEFT JOIN shapes s USING (pid)",
    "fx_points",
    "fx_edges",
)
def lookup_shape_status(spark, sf_dir):
    points = fixture(spark, sf_dir, "fx_points")
    hits = lookup.point_lookup(points, fixture(spark, sf_dir, "fx_edges"), CELL)
    return lookup.lookup_shapes(points, hits, policy.anchored_policy(spark, [2, 4], [2, 4]))


@query(f"{HITS} SELECT pid, feature_id AS country FROM hits WHERE level = 2", "fx_points", "fx_edges")
def country_resolution(spark, sf_dir):
    hits = geometry.containing(fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges").filter("level = 2"), CELL)
    return hits.select("pid", F.col("feature_id").alias("country"))


def _centres(spark, sf_dir) -> DataFrame:
    edges = fixture(spark, sf_dir, "fx_edges")
    return geometry.representative_points(edges).join(edges.select("feature_id", "level").distinct(), "feature_id")


POINTS = (
    "+reps AS (SELECT feature_id, level, CASE WHEN level = 2 THEN x0 + 500.0 WHEN CAST(substr(feature_id, 2) AS INT) % 2 = 0 THEN x0 + 200.0 ELSE x0 + 500.0 END AS px, "
    "CASE WHEN level = 2 THEN y0 + 2500.0 ELSE y0 + 500.0 END AS py FROM fx_rings WHERE role = 'outer')"
)


@query(f"{POINTS} SELECT feature_id, px, py FROM reps", "fx_rings")
def representative_points(spark, sf_dir):
    return geometry.representative_points(fixture(spark, sf_dir, "fx_edges"))


@query(
    f"{POINTS}, up AS (SELECT r.feature_id, max(e.feature_id) AS parent FROM reps r JOIN fx_rings e ON e.level = 2 AND r.level = 4 AND r.px > e.x0 AND r.px < e.x0 + 1000 AND r.py > e.y0 AND r.py < e.y0 + 5000 GROUP BY 1) "
    "SELECT r.feature_id, r.level, u.parent FROM reps r LEFT JOIN up u USING (feature_id)",
    "fx_rings",
)
def parent_inference(spark, sf_dir):
    return lookup.parents(_centres(spark, sf_dir), fixture(spark, sf_dir, "fx_edges"), [2, 4], CELL)


@query(f"{POINTS} SELECT feature_id, level FROM reps WHERE floor(px / 1000) IN (0, 2, 4)", "fx_rings")
def scope_filter(spark, sf_dir):
    allowed = fixture(spark, sf_dir, "fx_edges").filter("feature_id IN ('r0', 'r2', 'r4')")
    return lookup.covered_by(_centres(spark, sf_dir).withColumnRenamed("feature_id", "pid"), allowed, CELL).select(F.col("pid").alias("feature_id"), "level")


@query("SELECT pid, px BETWEEN 1000 AND 2000 AND py BETWEEN 0 AND 5000 AS in_scope FROM fx_points", "fx_points")
def scope_flag(spark, sf_dir):
    return lookup.scope_flags(fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges").filter("feature_id = 'r1'"), CELL)


@query(
    f"{HITS}, far AS (SELECT p.pid, e.level, e.feature_id, min({DISTANCE}) AS d FROM fx_points p CROSS JOIN fx_edges e WHERE p.pid NOT IN (SELECT pid FROM hits) GROUP BY ALL), "
    "best AS (SELECT *, row_number() OVER (PARTITION BY pid, level ORDER BY d, feature_id) AS rn FROM far WHERE d <= 600) SELECT pid, level, feature_id, round(d, 6) AS distance FROM best WHERE rn = 1",
    "fx_points",
    "fx_edges",
)
def nearest_feature(spark, sf_dir):
    points, edges = fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges")
    open_ = points.join(geometry.containing(points, edges, CELL).select("pid"), "pid", "left_anti")
    return lookup.nearest(open_, edges, 600.0).withColumn("distance", F.round("distance", 6))


@query(
    f"{HITS}, far AS (SELECT p.pid, min({DISTANCE}) AS d FROM fx_points p CROSS JOIN fx_edges e GROUP BY ALL) SELECT f.pid, CASE WHEN f.pid IN (SELECT pid FROM hits) THEN 'inside' WHEN d <= 200 THEN 'nearby' WHEN d <= 600 THEN 'offshore' ELSE 'outside' END AS class FROM far f",
    "fx_points",
    "fx_edges",
)
def offshore_class(spark, sf_dir):
    return lookup.nearby_class(fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges"), CELL, 200.0, 600.0)


@query(
    f"{HITS}, fours AS (SELECT * FROM hits WHERE level = 4), made AS (SELECT pid, min(concat('r', CAST(n_regionkey AS VARCHAR(20)))) AS feature_id, 2 AS level, true AS repaired FROM fours JOIN nation ON feature_id = concat('n', CAST(n_nationkey AS VARCHAR(20))) GROUP BY pid) "
    "SELECT pid, feature_id, level, false AS repaired FROM fours UNION ALL SELECT * FROM made",
    "fx_points",
    "fx_edges",
)
def hierarchy_repair(spark, sf_dir):
    fours = lookup.point_lookup(fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges").filter("level = 4"), CELL)
    return lookup.repaired(fours, hierarchy.ancestors(fixture(spark, sf_dir, "fx_nodes")), 2, [4, 8])


@query(
    f"{HITS}, moved AS (SELECT pid, feature_id, level FROM hits UNION ALL SELECT pid, concat('n', CAST((pid % 25) AS VARCHAR(20))), 4 FROM fx_points WHERE pid % 7 = 0), "
    "twice AS (SELECT DISTINCT pid, 'duplicate_level' AS reason FROM (SELECT pid, level FROM moved GROUP BY ALL HAVING count(*) > 1)), "
    "up AS (SELECT m.pid, concat('r', CAST(n_regionkey AS VARCHAR(20))) AS parent FROM moved m JOIN nation ON m.feature_id = concat('n', CAST(n_nationkey AS VARCHAR(20)))), "
    "other AS (SELECT u.pid, 'branching_parent' AS reason FROM up u JOIN moved m ON m.pid = u.pid AND m.level = 2 GROUP BY u.pid HAVING max(CASE WHEN u.parent = m.feature_id THEN 1 ELSE 0 END) = 0) SELECT * FROM twice UNION ALL SELECT * FROM other",
    "fx_points",
    "fx_edges",
)
def structural_violations(spark, sf_dir):
    points = fixture(spark, sf_dir, "fx_points")
    hits = lookup.point_lookup(points, fixture(spark, sf_dir, "fx_edges"), CELL)
    extra = points.filter("pid % 7 = 0").select("pid", F.expr("concat('n', CAST(pid % 25 AS STRING))").alias("feature_id"), F.lit(4).alias("level"))
    nodes = fixture(spark, sf_dir, "fx_nodes")
    up = nodes.filter("level = 4").select(F.col("id").alias("feature_id"), "parent_id", F.lit(2).alias("parent_level"))
    return lookup.structural_violations(hits.unionByName(extra), up)


@query(f"{HITS} SELECT pid, feature_id, level FROM hits WHERE false", "fx_points", "fx_edges")
def determinism_diff(spark, sf_dir):
    points, edges = fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges")
    first, second = lookup.point_lookup(points, edges, CELL), lookup.point_lookup(points.repartition(13, "px"), edges, 400.0)
    return quality.determinism(first, second).select("pid", "feature_id", "level")


# --- index tables --------------------------------------------------------------------------------------------------

BOX = "+box AS (SELECT feature_id, min(least(x1, x2)) AS minx, min(least(y1, y2)) AS miny, max(greatest(x1, x2)) AS maxx, max(greatest(y1, y2)) AS maxy FROM fx_edges GROUP BY 1)"
Q = lambda v, low, high: f"CAST(least(greatest(floor(({v} - {low}) * 65535.0::DOUBLE / ({high} - {low}) + 0.5), 0), 65535) AS INT)"


@query(f"{HITS}, {BOX[1:]} SELECT h.pid, h.feature_id, {Q('p.px', 'b.minx', 'b.maxx')} AS qx, {Q('p.py', 'b.miny', 'b.maxy')} AS qy FROM hits h JOIN fx_points p USING (pid) JOIN box b USING (feature_id)", "fx_points", "fx_edges")
def quantize_points(spark, sf_dir):
    points, edges = fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges")
    rows = geometry.containing(points, edges, CELL).join(points, "pid").join(index.part_boxes(edges), "feature_id")
    return rows.select("pid", "feature_id", M.quantize(F.col("px"), F.col("minx"), F.col("spanx")).alias("qx"), M.quantize(F.col("py"), F.col("miny"), F.col("spany")).alias("qy"))


@query(f"{BOX} SELECT feature_id, level, ring, role, seq, {', '.join(Q('e.' + c, 'b.min' + c[0], 'b.max' + c[0]) + ' AS q' + c for c in ('x1', 'y1', 'x2', 'y2'))} FROM fx_edges e JOIN box b USING (feature_id)", "fx_edges")
def quantized_rings(spark, sf_dir):
    return index.quantized_rings(fixture(spark, sf_dir, "fx_edges")).drop("part")


@query(
    "+s AS (SELECT feature_id, level, count(DISTINCT ring) AS n_rings, count(*) * 4 AS n_bytes FROM fx_edges GROUP BY ALL) SELECT *, row_number() OVER w - 1 AS index, sum(n_rings) OVER w - n_rings AS ring_start, sum(n_bytes) OVER w - n_bytes AS byte_start FROM s WINDOW w AS (ORDER BY level, feature_id)",
    "fx_edges",
)
def index_tables(spark, sf_dir):
    return index.feature_index(fixture(spark, sf_dir, "fx_edges")).drop("part_start", "n_parts")


@query("SELECT id, level, name, parent_id, row_number() OVER w - 1 AS index, sum(length(name)) OVER w - length(name) AS name_start, length(name) AS name_length FROM fx_nodes WINDOW w AS (ORDER BY level, name, id)", "fx_nodes")
def running_offsets(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_nodes").withColumn("name_length", F.length("name"))
    return index.with_offsets(rows, ["level", "name", "id"], {"name_start": "name_length"})


@query(f"{BOX} SELECT feature_id, level, b.minx, b.miny, b.maxx, b.maxy, b.maxx - b.minx AS spanx, b.maxy - b.miny AS spany FROM (SELECT DISTINCT feature_id, level FROM fx_edges) JOIN box b USING (feature_id)", "fx_edges")
def part_boxes(spark, sf_dir):
    return index.part_boxes(fixture(spark, sf_dir, "fx_edges")).select("feature_id", "level", "minx", "miny", "maxx", "maxy", "spanx", "spany")


QHITS = (
    f"{BOX}, qe AS (SELECT e.feature_id, {', '.join(Q('e.' + c, 'b.min' + c[0], 'b.max' + c[0]) + ' AS ' + c for c in ('x1', 'y1', 'x2', 'y2'))} FROM fx_edges e JOIN box b USING (feature_id)), "
    f"qp AS (SELECT p.pid, b.feature_id, {Q('p.px', 'b.minx', 'b.maxx')} AS px, {Q('p.py', 'b.miny', 'b.maxy')} AS py FROM fx_points p JOIN box b ON p.px BETWEEN b.minx AND b.maxx AND p.py BETWEEN b.miny AND b.maxy), "
    f"qhits AS (SELECT p.pid, p.feature_id FROM qp p JOIN qe e USING (feature_id) GROUP BY ALL HAVING {INSIDE})"
)


@query(f"{QHITS} SELECT * FROM qhits", "fx_points", "fx_edges")
def quantized_lookup(spark, sf_dir):
    return index.quantized_hits(fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges"), CELL)


@query(f"{QHITS}, {HITS[1:]} SELECT coalesce(q.pid, h.pid) AS pid, coalesce(q.feature_id, h.feature_id) AS feature_id, CASE WHEN q.pid IS NULL THEN 'exact' ELSE 'quantised' END AS only FROM qhits q FULL JOIN hits h ON q.pid = h.pid AND q.feature_id = h.feature_id WHERE q.pid IS NULL OR h.pid IS NULL", "fx_points", "fx_edges")
def containment_equivalence(spark, sf_dir):
    return index.hit_differences(fixture(spark, sf_dir, "fx_points"), fixture(spark, sf_dir, "fx_edges"), CELL)


@query("SELECT count(DISTINCT feature_id) AS features, count(DISTINCT (feature_id, part)) AS parts, count(DISTINCT (feature_id, part, ring)) AS rings, count(*) * 4 AS geometry_bytes FROM fx_land", "fx_land")
def export_totals(spark, sf_dir):
    return index.export_totals(fixture(spark, sf_dir, "fx_land"))


LOOPS = (
    "+loops AS (SELECT feature_id, 0 AS ring, seq, x AS x1, y AS y1, coalesce(lead(x) OVER w, first_value(x) OVER (PARTITION BY feature_id ORDER BY seq)) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER (PARTITION BY feature_id ORDER BY seq)) AS y2 "
    "FROM fx_loops WINDOW w AS (PARTITION BY feature_id ORDER BY seq))"
)


# --- geometry ------------------------------------------------------------------------------------------------------


@query(
    "+e AS (SELECT n_regionkey AS region, CASE WHEN (x1, y1) > (x2, y2) THEN x2 ELSE x1 END AS x1, CASE WHEN (x1, y1) > (x2, y2) THEN y2 ELSE y1 END AS y1, CASE WHEN (x1, y1) > (x2, y2) THEN x1 ELSE x2 END AS x2, "
    "CASE WHEN (x1, y1) > (x2, y2) THEN y1 ELSE y2 END AS y2 FROM fx_edges JOIN nation ON feature_id = concat('n', CAST(n_nationkey AS VARCHAR(20))) WHERE role = 'outer') SELECT region, x1, y1, x2, y2 FROM e GROUP BY ALL HAVING count(*) % 2 = 1",
    "fx_edges",
)
def dissolve_segments(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.expr("concat('n', CAST(n_nationkey AS STRING))").alias("feature_id"), F.col("n_regionkey").alias("region"))
    return geometry.dissolve(fixture(spark, sf_dir, "fx_edges").filter("role = 'outer'").join(nations, "feature_id"), "region")


@query(
    f"{LOOPS} SELECT feature_id, 0 AS level, abs(sum(x1 * y2 - x2 * y1)) / 2.0::DOUBLE AS area, min(x1) AS minx, min(y1) AS miny, max(x1) AS maxx, max(y1) AS maxy FROM loops GROUP BY 1",
    "fx_loops",
)
def ring_area_bbox(spark, sf_dir):
    return geometry.areas(geometry.loops(fixture(spark, sf_dir, "fx_loops")))


TURN = lambda p, q, r: f"sign(({q[0]} - {p[0]}) * ({r[1]} - {p[1]}) - ({q[1]} - {p[1]}) * ({r[0]} - {p[0]}))"
A1, A2, B1, B2 = (("a.x1", "a.y1"), ("a.x2", "a.y2"), ("b.x1", "b.y1"), ("b.x2", "b.y2"))


@query(
    f"{LOOPS}, per AS (SELECT feature_id, ring, count(*) AS n, abs(sum(x1 * y2 - x2 * y1)) AS twice, count(DISTINCT (x1, y1)) AS corners FROM loops GROUP BY ALL), "
    f"crossing AS (SELECT DISTINCT a.feature_id FROM loops a JOIN loops b ON a.feature_id = b.feature_id AND a.seq < b.seq WHERE {TURN(A1, A2, B1)} * {TURN(A1, A2, B2)} < 0 AND {TURN(B1, B2, A1)} * {TURN(B1, B2, A2)} < 0), "
    "said AS (SELECT feature_id, ring, CASE WHEN n < 3 THEN 'too_few_points' WHEN corners < n THEN 'repeated_vertex' WHEN twice = 0 THEN 'zero_area' WHEN feature_id IN (SELECT feature_id FROM crossing) THEN 'self_crossing' END AS reason FROM per) SELECT * FROM said WHERE reason IS NOT NULL",
    "fx_loops",
)
def ring_validity(spark, sf_dir):
    return geometry.validity(geometry.loops(fixture(spark, sf_dir, "fx_loops")), table(spark, sf_dir, "lineitem").count())


@query(
    f"{LOOPS}, areas AS (SELECT feature_id, abs(sum(x1 * y2 - x2 * y1)) / 2.0::DOUBLE AS area FROM loops GROUP BY 1), "
    "named AS (SELECT a.feature_id, area, CAST(feature_id % 3 AS INT) AS level, o_orderpriority AS name FROM areas a JOIN orders ON o_orderkey = feature_id) "
    "SELECT level, arg_max(feature_id, (area, feature_id)) AS feature_id, max(area) AS area, bool_or(name = '1-URGENT') AS has_expected FROM named GROUP BY level",
    "fx_loops",
)
def largest_feature(spark, sf_dir):
    areas = geometry.areas(geometry.loops(fixture(spark, sf_dir, "fx_loops")))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("feature_id"), F.col("o_orderpriority").alias("name"))
    return quality.largest(areas.join(orders, "feature_id").withColumn("level", (F.col("feature_id") % 3).cast("int")), "1-URGENT")


# --- hierarchy -----------------------------------------------------------------------------------------------------

PATHS = "+up AS (SELECT id, level, name, parent_id, [id] AS path FROM fx_nodes WHERE parent_id IS NULL UNION ALL SELECT n.id, n.level, n.name, n.parent_id, list_append(u.path, n.id) FROM fx_nodes n JOIN up u ON n.parent_id = u.id)"


def _nodes(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "fx_nodes")


@query(f"{PATHS} SELECT id, array_to_string(path, '>') AS path, path[1] AS root_id, coalesce(path[2], path[1]) AS branch_id FROM up", "fx_nodes")
def hierarchy_paths(spark, sf_dir):
    return hierarchy.branch_identity(_nodes(spark, sf_dir)).select("id", F.array_join("path_ids", ">").alias("path"), "root_id", "branch_id")


@query(f"{PATHS} SELECT id, sha256(array_to_string(path, chr(31))) AS path_signature FROM up", "fx_nodes")
def path_signature(spark, sf_dir):
    return hierarchy.branch_identity(_nodes(spark, sf_dir)).select("id", "path_signature")


@query("SELECT parent_id AS parent, id AS child, 'dataset_parent' AS method, 1.0::DOUBLE AS confidence FROM fx_nodes WHERE parent_id IS NOT NULL", "fx_nodes")
def dataset_hierarchy(spark, sf_dir):
    return hierarchy.dataset_edges(_nodes(spark, sf_dir))


@query("SELECT id, level, name FROM fx_nodes WHERE id NOT IN (SELECT id FROM fx_nodes WHERE parent_id IS NOT NULL)", "fx_nodes")
def roots(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    return hierarchy.roots(nodes, hierarchy.dataset_edges(nodes)).select("id", "level", "name")


@query(
    "+up AS (SELECT id, id AS root, 0 AS depth, [concat(name, chr(31), id)] AS way FROM fx_nodes WHERE parent_id IS NULL UNION ALL SELECT n.id, u.root, u.depth + 1, list_append(u.way, concat(n.name, chr(31), n.id)) FROM fx_nodes n JOIN up u ON n.parent_id = u.id) "
    "SELECT root, id, depth, row_number() OVER (PARTITION BY root ORDER BY way) AS place FROM up",
    "fx_nodes",
)
def tree_listing(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    listed = hierarchy.tree_listing(nodes, hierarchy.dataset_edges(nodes))
    return listed.selectExpr("root", "id", "depth", "row_number() OVER (PARTITION BY root ORDER BY sort_path) AS place")




@query(
    "+bad AS (SELECT * FROM fx_nodes WHERE id <> 'n3' UNION ALL SELECT id, level, name, parent_id FROM fx_nodes WHERE level = 8 AND id LIKE '%7' UNION ALL SELECT concat(id, 'x'), NULL, name, parent_id FROM fx_nodes WHERE id LIKE '%9') "
    "SELECT id, 'duplicate_id' AS reason FROM bad GROUP BY id HAVING count(*) > 1 UNION ALL SELECT id, 'missing_parent' FROM bad WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT id FROM bad) UNION ALL SELECT id, 'missing_field' FROM bad WHERE level IS NULL",
    "fx_nodes",
)
def orphans(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    bad = nodes.filter("id <> 'n3'").unionByName(nodes.filter("level = 8 AND id LIKE '%7'")).unionByName(nodes.filter("id LIKE '%9'").withColumn("id", F.concat("id", F.lit("x"))).withColumn("level", F.lit(None).cast("int")))
    return hierarchy.violations(bad)


@query("+walk AS (SELECT id, parent_id AS up FROM fx_chain UNION SELECT w.id, c.parent_id FROM walk w JOIN fx_chain c ON c.id = w.up) SELECT id FROM fx_chain WHERE id NOT IN (SELECT id FROM walk WHERE up IS NULL OR up NOT IN (SELECT id FROM fx_chain))", "fx_chain")
def cycles(spark, sf_dir):
    return hierarchy.cycles(fixture(spark, sf_dir, "fx_chain"))


CANDIDATES = "cand AS (SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))) AS child, concat('n', CAST(s_suppkey % 27 AS VARCHAR(20))) AS parent FROM supplier UNION ALL SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))), concat('r', CAST(s_suppkey % 6 AS VARCHAR(20))) FROM supplier)"


@query(
    f"+{CANDIDATES}, torn AS (SELECT id, level, name, CASE WHEN id LIKE '%5' THEN 'gone' WHEN id LIKE '%8' THEN NULL ELSE parent_id END AS parent_id FROM fx_nodes), "
    "best AS (SELECT c.child, c.parent, row_number() OVER (PARTITION BY c.child ORDER BY p.level DESC, c.parent) AS rn FROM cand c JOIN torn p ON p.id = c.parent JOIN torn n ON n.id = c.child WHERE p.level < n.level) "
    "SELECT t.id, t.level, t.name, CASE WHEN t.parent_id IN (SELECT id FROM torn) THEN t.parent_id ELSE b.parent END AS parent_id FROM torn t LEFT JOIN best b ON b.child = t.id AND b.rn = 1",
    "fx_nodes",
)
def parent_supplement(spark, sf_dir):
    torn = _nodes(spark, sf_dir).withColumn("parent_id", F.expr("CASE WHEN id LIKE '%5' THEN 'gone' WHEN id LIKE '%8' THEN NULL ELSE parent_id END"))
    s = table(spark, sf_dir, "supplier")
    child = F.expr("concat('s', CAST(s_suppkey AS STRING))").alias("child")
    cand = s.select(child, F.expr("concat('n', CAST(s_suppkey % 27 AS STRING))").alias("parent")).unionByName(s.select(child, F.expr("concat('r', CAST(s_suppkey % 6 AS STRING))").alias("parent")))
    return hierarchy.supplemented(torn, cand)


@query("SELECT id, level, name, CASE WHEN level = 8 AND id LIKE '%3' THEN 'n0' ELSE parent_id END AS parent_id FROM fx_nodes", "fx_nodes")
def parent_override(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    return hierarchy.overridden(nodes, nodes.filter("level = 8 AND id LIKE '%3'").select("id", F.lit("n0").alias("new_parent"))).select("id", "level", "name", "parent_id")


@query("SELECT id, level, CASE WHEN id LIKE 's%1' THEN concat('Site ', id) ELSE name END AS name, parent_id FROM fx_nodes", "fx_nodes")
def display_overlay(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    return hierarchy.renamed(nodes, nodes.filter("id LIKE 's%1'").select("id", F.concat(F.lit("Site "), "id").alias("display_name"))).select("id", "level", "name", "parent_id")


@query("SELECT id, level, name, coalesce(CASE WHEN id LIKE 's%4' THEN NULL ELSE parent_id END, CASE WHEN id LIKE 's%4' THEN 'r1' END) AS parent_id FROM fx_nodes", "fx_nodes")
def repair_anchors(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    cut = nodes.withColumn("parent_id", F.expr("CASE WHEN id LIKE 's%4' THEN NULL ELSE parent_id END"))
    return hierarchy.anchored(cut, nodes.filter("id LIKE 's%4'").select("id", F.lit("r1").alias("anchor"))).select("id", "level", "name", "parent_id")


@query(
    "+m AS (SELECT n_name AS name, min(c_mktsegment) AS region FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1), ids AS (SELECT region, row_number() OVER (ORDER BY region) AS n FROM (SELECT DISTINCT c_mktsegment AS region FROM customer)), "
    "real AS (SELECT 'MACHINERY' AS name, min(id) AS id FROM fx_nodes WHERE level = 2) SELECT m.name, m.region, coalesce(r.id, printf('fx_region_%02d', i.n)) AS region_id FROM m JOIN ids i USING (region) LEFT JOIN real r ON r.name = m.region",
    "fx_nodes",
)
def name_region_map(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    pairs = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"), F.col("c_mktsegment").alias("region"))
    real = _nodes(spark, sf_dir).filter("level = 2").agg(F.min("id").alias("id")).withColumn("name", F.lit("MACHINERY"))
    ids = hierarchy.region_ids(pairs, real, "fx")
    return hierarchy.smallest_region(pairs).join(ids, "region").select("name", "region", "region_id")


@query(f"{PATHS}, shapes AS (SELECT CASE len(path) WHEN 1 THEN '2' WHEN 2 THEN '2-4' ELSE '2-4-8' END AS shape FROM up) SELECT shape, count(*) AS n FROM shapes GROUP BY 1", "fx_nodes")
def observed_shapes(spark, sf_dir):
    return hierarchy.observed_shapes(_nodes(spark, sf_dir))


@query("+c AS (SELECT id AS ancestor_id, level AS ancestor_level FROM fx_nodes), up AS (SELECT id, id AS ancestor_id, parent_id FROM fx_nodes UNION ALL SELECT u.id, n.id, n.parent_id FROM up u JOIN fx_nodes n ON n.id = u.parent_id) SELECT u.id, u.ancestor_id, c.ancestor_level FROM up u JOIN c USING (ancestor_id)", "fx_nodes")
def ancestor_table(spark, sf_dir):
    return hierarchy.ancestors(_nodes(spark, sf_dir))


@query("SELECT id, level, name, parent_id, CASE WHEN level = 2 THEN NULL ELSE concat('en=', name) END AS names FROM fx_nodes", "fx_nodes")
def semantic_nodes(spark, sf_dir):
    nodes = _nodes(spark, sf_dir).withColumn("names", F.when(F.col("level") == 2, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("en"), F.col("name"))))
    return hierarchy.semantic(nodes).withColumn("names", F.when(F.col("names").isNotNull(), F.concat(F.lit("en="), F.try_element_at("names", F.lit("en")))))


NAMED = "tags AS (SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))) AS child, CASE WHEN s_suppkey % 10 = 0 THEN 'Nowhere' ELSE n_name END AS parent_name FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))), r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey), pool AS (SELECT id, name FROM fx_nodes UNION ALL SELECT concat(id, 'b'), name FROM fx_nodes WHERE id = 'r1')"


def _tagged(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("r_regionkey") == F.col("n_regionkey"))
    tags = F.create_map(F.lit("is_in"), F.expr("CASE WHEN s_suppkey % 10 = 0 THEN 'Nowhere' ELSE n_name END"), F.lit("is_in:region"), F.col("r_name"), F.lit("name"), F.col("s_name"))
    nodes = _nodes(spark, sf_dir).select("id", "name", "level")
    pool = nodes.unionByName(nodes.filter("id = 'r1'").withColumn("id", F.concat("id", F.lit("b"))))
    return rows.select(F.expr("concat('s', CAST(s_suppkey AS STRING))").alias("id"), tags.alias("tags")), pool


@query(f"+{NAMED}, one AS (SELECT name, min(id) AS parent, count(*) AS n FROM pool GROUP BY 1) SELECT t.child, t.parent_name, CASE WHEN n = 1 THEN parent END AS parent, coalesce(n = 1, false) AS is_resolved FROM tags t LEFT JOIN one ON one.name = t.parent_name", "fx_nodes")
def is_in_edges(spark, sf_dir):
    tagged, pool = _tagged(spark, sf_dir)
    edges = select.is_in_edges(tagged)
    good, open_ = hierarchy.resolved(edges, pool)
    names = pool.select(F.col("id").alias("parent"), F.col("name").alias("parent_name"))
    return good.join(names, "parent").select("child", "parent_name", "parent", F.lit(True).alias("is_resolved")).unionByName(open_.select("child", "parent_name", F.lit(None).cast("string").alias("parent"), F.lit(False).alias("is_resolved")))


@query(
    f"+{NAMED}, one AS (SELECT name, count(*) AS n FROM pool GROUP BY 1) SELECT 'nodes' AS what, count(*) AS n FROM pool UNION ALL SELECT 'edges', count(*) FROM tags t JOIN one ON one.name = t.parent_name AND n = 1 UNION ALL SELECT 'unresolved', count(*) FROM tags t LEFT JOIN one ON one.name = t.parent_name WHERE coalesce(n, 0) <> 1 "
    "UNION ALL SELECT concat('level ', CAST(level AS VARCHAR(20))), count(*) + CASE WHEN level = 2 THEN 1 ELSE 0 END FROM fx_nodes GROUP BY level",
    "fx_nodes",
)
def hierarchy_report(spark, sf_dir):
    tagged, pool = _tagged(spark, sf_dir)
    good, open_ = hierarchy.resolved(select.is_in_edges(tagged), pool)
    return hierarchy.report(pool, good, open_)


def _relations(spark, sf_dir) -> DataFrame:
    """Orders as relations: level and boundary tags, line items as members (every third a relation with role subarea)."""
    items = table(spark, sf_dir, "lineitem")
    member = F.expr("struct(l_linenumber AS pos, CASE WHEN l_linenumber % 3 = 0 THEN 'r' ELSE 'w' END AS type, CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey + l_linenumber ELSE l_partkey END AS ref, CASE WHEN l_linenumber % 6 = 3 THEN 'subarea' WHEN l_linenumber % 3 = 0 THEN 'label' ELSE 'outer' END AS role)")
    members = sized(items, items.count(), "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(member)).alias("members"))
    tags = F.expr("map_filter(map('boundary', CASE WHEN o_orderkey % 4 = 0 THEN 'political' ELSE 'administrative' END, 'admin_level', CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '6a' ELSE CAST(o_orderkey % 6 * 2 AS STRING) END, 'name', o_orderpriority), (k, v) -> v IS NOT NULL)")
    orders = table(spark, sf_dir, "orders")
    return orders.join(members.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("id"), tags.alias("tags"), "members")


LEVEL = "CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 6 * 2 AS INT) END"
RELS = "rels AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))"


@query(f"WITH {RELS} SELECT o_orderkey AS id, {LEVEL} AS level FROM rels WHERE o_orderkey % 4 <> 0 AND {LEVEL} IN (4, 6, 8)")
def admin_polygons(spark, sf_dir):
    return select.admin_polygons(_relations(spark, sf_dir), [4, 6, 8]).select("id", "level")


@query(f"WITH {RELS} SELECT o_orderkey AS id, {LEVEL} AS level FROM rels WHERE o_orderkey % 4 <> 0 OR o_orderkey % 5 <> 0")
def admin_hierarchy(spark, sf_dir):
    return select.admin_hierarchy_relations(_relations(spark, sf_dir)).select("id", "level")


@query("SELECT concat('r', CAST(l_orderkey AS VARCHAR(20))) AS parent, concat('r', CAST(l_orderkey + l_linenumber AS VARCHAR(20))) AS child, 'subarea' AS method, 1.0::DOUBLE AS confidence FROM lineitem WHERE l_linenumber % 6 = 3 AND l_orderkey IN (SELECT o_orderkey FROM orders)")
def subarea_edges(spark, sf_dir):
    return select.subarea_edges(_relations(spark, sf_dir))


@query(
    f"WITH {RELS}, kept AS (SELECT concat('r', CAST(o_orderkey AS VARCHAR(20))) AS id FROM rels WHERE o_orderkey % 4 <> 0 OR o_orderkey % 5 <> 0), e AS (SELECT concat('r', CAST(l_orderkey AS VARCHAR(20))) AS parent, concat('r', CAST(l_orderkey + l_linenumber AS VARCHAR(20))) AS child FROM lineitem WHERE l_linenumber % 6 = 3) "
    "SELECT parent, child FROM e WHERE parent IN (SELECT id FROM kept) AND child IN (SELECT id FROM kept)"
)
def relation_hierarchy(spark, sf_dir):
    kept = select.admin_hierarchy_relations(_relations(spark, sf_dir))
    nodes = kept.select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"))
    return hierarchy.inside(select.subarea_edges(kept), nodes).select("parent", "child")


@query(f"WITH {RELS} SELECT o_orderkey AS id, o_orderpriority AS name FROM rels WHERE lower(o_orderpriority) LIKE '%urgent%' OR lower(o_orderpriority) LIKE '%low%'")
def name_trace(spark, sf_dir):
    named = _relations(spark, sf_dir).select("id", N.pick_name(F.col("tags"), ["official_name", "name"]).alias("name"))
    return select.traced(named, ["Urgent", "LOW"])


@query("+t AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_quantity > 40), c AS (SELECT l_orderkey AS id, count(*) FILTER (WHERE l_linenumber % 3 <> 0) AS n_ways, count(*) FILTER (WHERE l_linenumber % 3 = 0) AS n_others FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1) SELECT t.id, n_ways IS NOT NULL AS found, n_ways, n_others FROM t LEFT JOIN c USING (id)", "fx_ways")
def target_relations(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select(F.concat(F.lit("r"), F.col("l_partkey").cast("string")).alias("target"))
    return select.target_relations(wanted, _relations(spark, sf_dir))


# --- stitching -----------------------------------------------------------------------------------------------------


def _joined(spark, sf_dir) -> DataFrame:
    return stitch.with_ways(fixture(spark, sf_dir, "fx_members"), fixture(spark, sf_dir, "fx_ways"))


def _joined_by_relation(spark, sf_dir) -> DataFrame:
    """The same, in tasks by the number of members: first a way's, to find it, then a relation's, as ends are counted and met there."""
    n = table(spark, sf_dir, "lineitem").count()
    return sized(stitch.with_ways(sized(fixture(spark, sf_dir, "fx_members"), n, "ref"), fixture(spark, sf_dir, "fx_ways")), n, "rel")


@query("+r AS (SELECT *, row_number() OVER (PARTITION BY rel ORDER BY n_ways DESC, extract_ord) AS rn FROM fx_copies) SELECT rel, extract_ord, n_ways FROM r WHERE rn = 1", "fx_copies")
def relation_dedupe(spark, sf_dir):
    return stitch.best_copies(fixture(spark, sf_dir, "fx_copies"))


@query("+r AS (SELECT *, max(n_ways) OVER (PARTITION BY rel ORDER BY extract_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM fx_copies) SELECT extract_ord, count(*) AS n FROM r WHERE n_ways <= b GROUP BY 1", "fx_copies")
def duplicate_count(spark, sf_dir):
    return stitch.losing_copies(fixture(spark, sf_dir, "fx_copies")).groupBy("extract_ord").agg(F.count("*").alias("n"))


WAYCOPIES = "SELECT l_partkey AS id, CAST(l_suppkey % 3 AS INT) AS extract_ord, CAST(min(l_linenumber) AS INT) AS content FROM lineitem GROUP BY ALL"


@query(f"WITH w AS ({WAYCOPIES}) SELECT id, min(extract_ord) AS extract_ord, arg_min(content, extract_ord) AS content, count(DISTINCT content) > 1 AS varies FROM w GROUP BY id")
def way_variants(spark, sf_dir):
    return stitch.first_copies(spark.sql(WAYCOPIES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem")), ["content"])


@query("SELECT ref, string_agg(DISTINCT extract_ord::VARCHAR, ',' ORDER BY extract_ord::VARCHAR) AS extracts FROM fx_members GROUP BY 1", "fx_members")
def extract_coverage(spark, sf_dir):
    return stitch.extract_coverage(fixture(spark, sf_dir, "fx_members"), "ref").withColumn("extracts", F.array_join(F.col("extracts").cast("array<string>"), ","))


@query("SELECT rel, count(DISTINCT ref) AS required, count(DISTINCT id) AS present, count(DISTINCT ref) - count(DISTINCT id) AS missing FROM fx_members LEFT JOIN fx_ways ON id = ref GROUP BY 1", "fx_members", "fx_ways")
def member_coverage(spark, sf_dir):
    return stitch.coverage(fixture(spark, sf_dir, "fx_members"), fixture(spark, sf_dir, "fx_ways"))


@query("SELECT DISTINCT ref AS id FROM fx_members WHERE ref NOT IN (SELECT id FROM fx_ways)", "fx_members", "fx_ways")
def missing_members(spark, sf_dir):
    return stitch.missing(fixture(spark, sf_dir, "fx_members"), fixture(spark, sf_dir, "fx_ways"))


@query("SELECT id, first_node, last_node FROM fx_ways WHERE id IN (SELECT ref FROM fx_members WHERE role = 'outer')", "fx_members", "fx_ways")
def used_ways(spark, sf_dir):
    return stitch.used(fixture(spark, sf_dir, "fx_ways"), fixture(spark, sf_dir, "fx_members").filter("role = 'outer'"), "ref").select("id", "first_node", "last_node")


@query("SELECT rel, CASE WHEN role = '' THEN '(empty)' ELSE role END AS role, count(*) AS n FROM fx_members GROUP BY ALL", "fx_members")
def member_stats(spark, sf_dir):
    return stitch.member_statistics(fixture(spark, sf_dir, "fx_members"))


ENDS = "ends AS (SELECT rel, unnest([first_node, last_node]) AS node FROM fx_members JOIN fx_ways ON id = ref), deg AS (SELECT rel, node, count(*) AS degree FROM ends GROUP BY ALL)"


@query(f"+{ENDS} SELECT * FROM deg", "fx_members", "fx_ways")
def endpoint_degrees(spark, sf_dir):
    return stitch.endpoint_degrees(_joined_by_relation(spark, sf_dir))


@query(
    f"+{ENDS}, odd AS (SELECT d.rel, d.node, lon, lat FROM deg d JOIN fx_vertices v ON v.id = d.node WHERE degree % 2 = 1), per AS (SELECT rel, count(*) AS n_odd, min((node, lon, lat)) AS a, max((node, lon, lat)) AS b FROM odd GROUP BY 1), "
    "p AS (SELECT rel, n_odd, struct_extract(a, 1) AS fn, struct_extract(b, 1) AS tn, sqrt(power(struct_extract(a, 2)::DOUBLE - struct_extract(b, 2)::DOUBLE, 2) + power(struct_extract(a, 3)::DOUBLE - struct_extract(b, 3)::DOUBLE, 2)) AS g FROM per) "
    "SELECT rel, n_odd, CASE WHEN n_odd = 2 THEN round(g, 6) END AS gap, CASE WHEN n_odd <> 2 THEN 'not_two_ends' WHEN g > 3.0 THEN 'gap_too_wide' ELSE 'closed' END AS outcome, CASE WHEN n_odd = 2 AND g <= 3.0 THEN fn END AS from_node, CASE WHEN n_odd = 2 AND g <= 3.0 THEN tn END AS to_node FROM p",
    "fx_members",
    "fx_ways",
    "fx_vertices",
)
def gap_candidates(spark, sf_dir):
    nodes = fixture(spark, sf_dir, "fx_vertices").withColumn("lon", F.col("lon").cast("double")).withColumn("lat", F.col("lat").cast("double"))
    return stitch.gap_repairs(_joined_by_relation(spark, sf_dir), nodes, most=3.0)


@query()
def ring_assembly(spark, sf_dir):
    rings = stitch.assembled(_joined(spark, sf_dir))
    return rings.select("rel", "role", "ring", F.size("ways").alias("n_ways"), "reason")


@query()
def assembly_outcomes(spark, sf_dir):
    return stitch.assembly_outcomes(stitch.assembled(_joined(spark, sf_dir)))


@query(
    f"+{ENDS}, cov AS (SELECT rel, count(DISTINCT ref) AS required, count(DISTINCT id) AS present, count(*) FILTER (WHERE first_node = last_node) AS closed_ways, string_agg(DISTINCT extract_ord::VARCHAR, ',' ORDER BY extract_ord::VARCHAR) AS extracts FROM fx_members LEFT JOIN fx_ways ON id = ref GROUP BY 1), "
    "odd AS (SELECT rel, count(*) AS odd_ends FROM deg WHERE degree % 2 = 1 GROUP BY 1) SELECT rel, required, present, required - present AS missing, closed_ways, extracts, coalesce(odd_ends, 0) AS odd_ends FROM cov LEFT JOIN odd USING (rel)",
    "fx_members",
    "fx_ways",
)
def relation_report(spark, sf_dir):
    return stitch.relation_report(fixture(spark, sf_dir, "fx_members"), fixture(spark, sf_dir, "fx_ways"))


NODEREFS = "SELECT l_orderkey AS id, array_agg(l_partkey ORDER BY l_linenumber) AS node_refs FROM lineitem GROUP BY 1"


@query(
    "+pts AS (SELECT l_orderkey AS id, l_linenumber AS pos, l_partkey AS part, n.id AS node, n.id * 3 AS x, n.id * 5 AS y FROM lineitem LEFT JOIN fx_ways n ON n.id = l_partkey), w AS (SELECT id, string_agg(concat(CAST(x AS VARCHAR(20)), ' ', CAST(y AS VARCHAR(20))), ',' ORDER BY pos, part) AS pts FROM pts GROUP BY id HAVING count(*) = count(node) AND count(*) >= 2) SELECT * FROM w",
    "fx_ways",
)
def way_geometry(spark, sf_dir):
    refs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("m"))
    ways = refs.select(F.col("l_orderkey").alias("id"), F.transform("m", lambda m: m["l_partkey"]).alias("node_refs"))
    nodes = fixture(spark, sf_dir, "fx_ways").select("id", (F.col("id") * 3).alias("lon"), (F.col("id") * 5).alias("lat"))
    return stitch.way_points(ways, nodes).select("id", F.array_join(F.transform("pts", lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ",").alias("pts"))


# --- counts, names, sets -------------------------------------------------------------------------------------------


@query("SELECT level, count(*) AS n FROM fx_nodes GROUP BY 1", "fx_nodes")
def level_counts(spark, sf_dir):
    return quality.level_counts(_nodes(spark, sf_dir), ["level"])


@query("SELECT extract_ord, role, count(*) AS n, grouping(extract_ord) AS total FROM fx_members GROUP BY GROUPING SETS ((extract_ord, role), (role))", "fx_members")
def level_counts_sets(spark, sf_dir):
    return quality.level_count_sets(fixture(spark, sf_dir, "fx_members"), "extract_ord", "role")


@query("SELECT level, id, name, row_number() OVER (PARTITION BY level ORDER BY name, id) AS rank FROM fx_nodes QUALIFY rank <= 5", "fx_nodes")
def samples_per_level(spark, sf_dir):
    return quality.samples(_nodes(spark, sf_dir).select("level", "id", "name"), "level", ["name", "id"], 5)


@query(
    "+r AS (SELECT DISTINCT extract_ord, rel FROM fx_members), e AS (SELECT DISTINCT extract_ord, rel FROM fx_members WHERE role <> 'inner'), a AS (SELECT DISTINCT extract_ord, rel FROM fx_members WHERE role = 'outer'), "
    "j AS (SELECT r.extract_ord, r.rel, e.rel IS NOT NULL AS em, a.rel IS NOT NULL AS am FROM r LEFT JOIN e ON e.extract_ord = r.extract_ord AND e.rel = r.rel LEFT JOIN a ON a.extract_ord = r.extract_ord AND a.rel = r.rel) "
    "SELECT extract_ord, count(*) AS relations, count(*) FILTER (WHERE em) AS emitted, count(*) FILTER (WHERE am) AS assembled, count(*) FILTER (WHERE rel % 9 = 4) AS invalid, count(*) FILTER (WHERE NOT em) AS relations_not_emitted, count(*) FILTER (WHERE em AND NOT am) AS emitted_not_assembled, count(*) FILTER (WHERE NOT am) AS relations_not_assembled, grouping(extract_ord) AS total FROM j GROUP BY ROLLUP (extract_ord)",
    "fx_members",
)
def funnel(spark, sf_dir):
    m = fixture(spark, sf_dir, "fx_members")
    return quality.funnel([("relations", m), ("emitted", m.filter("role <> 'inner'")), ("assembled", m.filter("role = 'outer'"))], "rel", "extract_ord", {"invalid": m.filter("rel % 9 = 4")})


@query("SELECT doc_id, CASE WHEN n_chars % 4 > 0 AND trim(text) <> '' THEN md5(text) ELSE source END AS name FROM documents")
def pick_name(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tags = F.create_map(F.lit("name"), F.expr("CASE WHEN n_chars % 4 > 0 AND trim(text) <> '' THEN md5(text) ELSE '' END"), F.lit("official_name"), F.col("source"))
    return docs.select("doc_id", N.pick_name(tags, ["name:xx", "name", "official_name"]).alias("name"))


@query(
    "+one AS (SELECT rel // 4 AS rel, substr(k, 6) AS lang, regexp_replace(arg_min(v, rel), '^\\s+|\\s+$', '', 'g') AS v FROM fx_tags WHERE v <> '' GROUP BY ALL), once AS (SELECT rel, v, min(lang) AS lang FROM one GROUP BY ALL) SELECT rel, string_agg(concat(lang, '=', v), ';' ORDER BY lang) AS names FROM once GROUP BY rel", "fx_tags"
)
def alias_names(spark, sf_dir):
    grouped = fixture(spark, sf_dir, "fx_tags").filter("v <> ''").withColumn("g", F.expr("rel div 4")).groupBy("g", "k").agg(F.min_by("v", "rel").alias("v"))
    tags = grouped.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("tags"))
    names = N.alias_names(F.col("tags"), ["en", "de", "fr", "es"])
    return tags.select(F.col("g").alias("rel"), F.array_join(F.transform(F.array_sort(F.map_entries(names)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("names"))



#: keys of two characters or with a dash count, whatever their case; others do not
LANGUAGES = (
    "+l AS (SELECT concat('name:', CASE WHEN doc_id % 7 = 0 THEN concat(upper(lang), '-Hant') WHEN doc_id % 11 = 0 THEN 'nan-Hant' WHEN doc_id % 13 = 0 THEN 'nan' WHEN doc_id % 17 = 0 THEN '1x' ELSE lang END) AS k FROM documents), "
    "c AS (SELECT lower(substr(k, 6)) AS lang, count(*) AS n FROM l WHERE length(k) = 7 OR contains(k, '-') GROUP BY 1)"
)


def _languages(spark, sf_dir) -> DataFrame:
    key = F.expr("concat('name:', CASE WHEN doc_id % 7 = 0 THEN concat(upper(lang), '-Hant') WHEN doc_id % 11 = 0 THEN 'nan-Hant' WHEN doc_id % 13 = 0 THEN 'nan' WHEN doc_id % 17 = 0 THEN '1x' ELSE lang END)")
    return table(spark, sf_dir, "documents").select(F.create_map(key, F.lit("x")).alias("tags"))


@query(
    f"{LANGUAGES}, kept AS (SELECT *, row_number() OVER (ORDER BY n DESC, lang) AS rank FROM c WHERE n >= 0.1 * (SELECT max(n) FROM c)) SELECT lang, n, rank FROM kept WHERE rank <= 5",
    "fx_tags",
)
def alias_language_policy(spark, sf_dir):
    return N.alias_policy(N.alias_counts(_languages(spark, sf_dir), F.map_keys("tags")))


@query("SELECT id, CASE level WHEN 2 THEN 'admin_country' WHEN 4 THEN 'admin_region' WHEN 8 THEN 'admin_locality' END AS label, concat(name, ' [level=', CAST(level AS VARCHAR(20)), '] [id=', id, ']') AS shown, substr(id, 2) AS bare FROM fx_nodes", "fx_nodes")
def labels(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    prefixed = F.concat(F.lit("fx_"), F.substring("id", 2, 99))
    return nodes.select("id", N.level_label(F.col("level")).alias("label"), N.node_label(F.col("name"), F.col("level"), F.col("id")).alias("shown"), N.runtime_id(prefixed, "fx").alias("bare"))


@query("SELECT id, level, name, parent_id FROM fx_nodes WHERE id NOT LIKE 's%2'", "fx_nodes")
def exclude_features(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    return select.without(nodes, nodes.filter("id LIKE 's%2'").select("id")).select("id", "level", "name", "parent_id")


SUPPLEMENTS = "SELECT concat('c', CAST(c_custkey % 40 AS VARCHAR(20))) AS id, 4 AS level, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE concat('City ', CAST(c_custkey % 40 AS VARCHAR(20))) END AS name, CAST(NULL AS VARCHAR(20)) AS parent_id FROM customer JOIN nation ON n_nationkey = c_nationkey"


@query(
    f"+sup AS ({SUPPLEMENTS}), a AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id) AS rn FROM sup), b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY name) AS rn2 FROM a WHERE rn = 1) "
    "SELECT id, level, name, parent_id FROM fx_nodes UNION ALL SELECT id, level, name, parent_id FROM b WHERE rn2 = 1 AND name NOT IN (SELECT name FROM fx_nodes) AND id NOT IN (SELECT id FROM fx_nodes)",
    "fx_nodes",
)
def supplement_features(spark, sf_dir):
    sup = spark.sql(SUPPLEMENTS.replace("FROM customer JOIN nation", "FROM {customer} JOIN {nation}"), customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"))
    return select.with_supplements(_nodes(spark, sf_dir), sup)


@query("+u AS (SELECT p_partkey AS id, 0 AS source_ord, p_name AS name FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 1, p_brand FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 2, p_type FROM part) SELECT id, min(source_ord) AS source_ord, arg_min(name, source_ord) AS name FROM u GROUP BY id", "fx_ways")
def source_union(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    sources = [part.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name")), part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("name"))]
    return select.first_of_sources(sources)


@query("SELECT id, level, CASE WHEN id LIKE 's%6' THEN 'Curated' ELSE name END AS name, parent_id FROM fx_nodes UNION ALL SELECT 'q1', 8, 'New', 'n1'", "fx_nodes")
def curated_upsert(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    curated = nodes.filter("id LIKE 's%6'").withColumn("name", F.lit("Curated")).unionByName(spark.createDataFrame([("q1", 8, "New", "n1")], nodes.schema))
    return select.upserted(nodes, curated)


@query(
    "+lv AS (SELECT n_name AS country, list(DISTINCT CAST(s_suppkey % 5 * 2 AS INT)) AS levels FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1), m AS (SELECT country, list_sort(levels) AS levels, unnest(range(1, CAST(power(2, len(levels)) AS BIGINT))) AS mask FROM lv), "
    "s AS (SELECT country, list_filter(levels, lambda l, i: ((mask >> (i - 1)) & 1) = 1) AS shape FROM m) SELECT country, array_to_string(shape, '-') AS shape, CASE WHEN list_contains(shape, 4) THEN 'ok' ELSE 'partial' END AS status FROM s",
    "fx_nodes",
)
def level_shapes(spark, sf_dir):
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    levels = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country")).agg(F.array_sort(F.collect_set(F.expr("CAST(s_suppkey % 5 * 2 AS INT)"))).alias("levels"))
    rules = levels.select("country", F.array(F.lit(4)).alias("required"))
    return policy.ruled_shapes(policy.level_shapes(levels), rules)


@query(
    "+lv AS (SELECT n_name AS country, list_sort(list(DISTINCT CAST(s_suppkey % 5 * 2 AS INT))) AS levels FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1), m AS (SELECT country, levels, unnest(range(1, CAST(power(2, len(levels)) AS BIGINT))) AS mask FROM lv), "
    "s AS (SELECT country, levels, list_filter(levels, lambda l, i: ((mask >> (i - 1)) & 1) = 1) AS shape FROM m) SELECT country, array_to_string(shape, '-') AS shape, CASE WHEN len(shape) = len(levels) THEN 'ok' ELSE 'partial' END AS status FROM s",
    "fx_nodes",
)
def default_policy(spark, sf_dir):
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    levels = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country")).agg(F.array_sort(F.collect_set(F.expr("CAST(s_suppkey % 5 * 2 AS INT)"))).alias("levels"))
    return policy.default_policy(policy.level_shapes(levels), levels)


@query("SELECT id, level, CASE level WHEN 4 THEN 0.01::DOUBLE WHEN 8 THEN 0.001::DOUBLE ELSE 0.005::DOUBLE END AS tolerance FROM fx_nodes", "fx_nodes")
def level_tolerance(spark, sf_dir):
    policies = spark.createDataFrame([("xx", 4, 0.01), ("xx", 8, 0.001)], "country string, level int, tolerance double")
    fallback = spark.createDataFrame([("xx", 0.005)], "country string, tolerance double")
    return policy.with_policy(_nodes(spark, sf_dir).withColumn("country", F.lit("xx")), policies, fallback).select("id", "level", "tolerance")


@query("SELECT level, count(*) AS n_before, count(*) FILTER (WHERE id NOT LIKE '%4') AS n_after, count(*) FILTER (WHERE id LIKE '%4') AS removed FROM fx_nodes GROUP BY 1", "fx_nodes")
def policy_effects(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    return quality.policy_effects(nodes, nodes.filter("id NOT LIKE '%4'"), "id")


@query("SELECT level, name, id, row_number() OVER (ORDER BY level, name, id) - 1 AS index FROM fx_nodes", "fx_nodes")
def global_order(spark, sf_dir):
    return index.with_offsets(_nodes(spark, sf_dir).select("level", "name", "id"), ["level", "name", "id"], {})


# --- release and sources -------------------------------------------------------------------------------------------


def _files(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), F.coalesce("text", F.lit("")).cast("binary").alias("content"), "source", "doc_id", "text")


@query("SELECT concat('doc/', CAST(doc_id AS VARCHAR(20))) AS path, sha256(coalesce(text, '')) AS sha256, octet_length(encode(coalesce(text, ''))) AS size FROM documents")
def build_manifest(spark, sf_dir):
    return quality.manifest(_files(spark, sf_dir))


@query(
    "SELECT concat('doc/', CAST(doc_id AS VARCHAR(20))) AS path, CASE WHEN doc_id % 10 = 0 THEN 'missing' WHEN doc_id % 10 = 1 THEN 'not_listed' WHEN doc_id % 10 = 2 THEN 'invalid_digest' WHEN doc_id % 10 = 3 THEN 'digest_mismatch' ELSE 'size_mismatch' END AS reason FROM documents WHERE doc_id % 10 <= 4"
)
def manifest_verify(spark, sf_dir):
    built = quality.manifest(_files(spark, sf_dir).filter("doc_id % 10 <> 0"))
    listed = _files(spark, sf_dir).filter("doc_id % 10 <> 1").select("path", F.expr("CASE doc_id % 10 WHEN 2 THEN 'xyz' WHEN 3 THEN sha2(concat('x', path), 256) ELSE sha2(content, 256) END").alias("sha256"), F.expr("CASE doc_id % 10 WHEN 4 THEN -1L WHEN 5 THEN NULL ELSE CAST(octet_length(content) AS BIGINT) END").alias("size"))
    return quality.verified(listed, built)


@query("+f AS (SELECT source, concat(concat('doc/', CAST(doc_id AS VARCHAR(20))), '=', sha256(coalesce(text, ''))) AS line, doc_id FROM documents) SELECT source, sha256(string_agg(line, chr(10) ORDER BY line)) AS composite, max(doc_id) AS latest, count(*) AS n_files FROM f GROUP BY source", "fx_tags")
def source_digest(spark, sf_dir):
    files = _files(spark, sf_dir).select("source", "path", F.sha2("content", 256).alias("sha256"), F.col("doc_id").alias("stamp"))
    return quality.source_identity(files, "source")


@query("SELECT doc_id, sha256(concat('{\"doc_id\":', CAST(doc_id AS VARCHAR(20)), ',\"lang\":\"', lang, '\",\"source\":\"', source, '\"}')) AS digest FROM documents")
def canonical_digest(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", M.canonical_digest("source", "doc_id", "lang").alias("digest"))


@query("+f AS (SELECT source, concat_ws('|', CAST(doc_id AS VARCHAR(20)), CAST(n_chars AS VARCHAR(20)), lang) AS line FROM documents) SELECT source, sha256(string_agg(line, chr(10) ORDER BY line)) AS stage_key FROM f GROUP BY 1", "fx_tags")
def stage_keys(spark, sf_dir):
    listing = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("name"), F.col("n_chars").alias("size"), F.col("lang").alias("mtime"))
    return tables.stage_key(listing, "source")


@query("+s AS (SELECT unnest(['Supplier#00000', 'Supplier#000000001', 'Supplier#0000000']) AS stem) SELECT stem, max(s_name) AS name FROM s JOIN supplier ON starts_with(s_name, stem) GROUP BY stem", "fx_nodes")
def latest_components(spark, sf_dir):
    listing = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return tables.latest_of_stems(listing, ["Supplier#00000", "Supplier#000000001", "Supplier#0000000"])


@query("SELECT rel, pos, ref, extract_ord FROM fx_members", "fx_members")
def multi_extract_scan(spark, sf_dir):
    names = ["north", "middle", "south"]
    path = scratch(spark, "elements")
    extract = F.element_at(F.array(*(F.lit(n) for n in names)), F.col("extract_ord") + 1)
    fixture(spark, sf_dir, "fx_members").select("rel", "pos", "ref", extract.alias("extract")).write.partitionBy("extract").parquet(path)
    return tables.read_elements(spark, path, names).select("rel", "pos", "ref", "extract_ord")


@query("SELECT CASE WHEN level = 8 THEN parent_id ELSE 'world' END AS country, level AS at_level, row_number() OVER (PARTITION BY CASE WHEN level = 8 THEN parent_id ELSE 'world' END, level ORDER BY id) - 1 AS pos, id, name, parent_id AS parent FROM fx_nodes", "fx_nodes")
def document_source(spark, sf_dir):
    features = _nodes(spark, sf_dir).select(F.when(F.col("level") == 8, F.col("parent_id")).otherwise("world").alias("country"), "id", F.col("id").alias("osm_id"), "name", "level", F.col("parent_id").alias("parent"), F.lit(None).cast("map<string,string>").alias("names"))
    path = scratch(spark, "documents-json")
    tables.documents_of(features).write.json(path)
    return tables.read_documents(spark, path).select("country", "at_level", "pos", "id", "name", "parent")


@query("SELECT id, name, parent_id, level FROM fx_nodes", "fx_nodes")
def dataset_sink(spark, sf_dir):
    path = scratch(spark, "dataset")
    tables.write_dataset(_nodes(spark, sf_dir), path, ["level"])
    tables.write_dataset(_nodes(spark, sf_dir).filter("level = 4"), path, ["level"])
    return spark.read.parquet(path).select("id", "name", "parent_id", "level")


@query("SELECT extract_ord, count(DISTINCT rel) AS relations, count(*) AS members FROM fx_members GROUP BY 1", "fx_members")
def report_csv(spark, sf_dir):
    path = scratch(spark, "report")
    rows = fixture(spark, sf_dir, "fx_members").groupBy("extract_ord").agg(F.countDistinct("rel").alias("relations"), F.count("*").alias("members"))
    tables.write_report(rows, path)
    return spark.read.csv(path, header=True, schema="extract_ord int, relations long, members long")


@query("SELECT pid, px % 360 - 180 AS lon, CASE WHEN px % 360 < 180 THEN px % 360 + 180 ELSE px % 360 - 180 END AS unwrapped FROM fx_points", "fx_points")
def longitude_unwrap(spark, sf_dir):
    points = fixture(spark, sf_dir, "fx_points").withColumn("lon", F.col("px") % 360 - 180)
    return points.select("pid", "lon", M.unwrap_longitude(F.col("lon")).alias("unwrapped"))


# --- the remaining inventory ---------------------------------------------------------------------------------------


@query("SELECT l_orderkey AS rel, l_linenumber AS pos, l_partkey AS ref, 'outer' AS role FROM lineitem WHERE l_linenumber % 3 <> 0 AND l_orderkey IN (SELECT o_orderkey FROM orders)")
def way_members(spark, sf_dir):
    return select.members_of(_relations(spark, sf_dir), "w")


@query("SELECT CASE WHEN role IN ('', 'outer') THEN 'outer' WHEN role = 'inner' THEN 'inner' END AS ring_role, count(*) AS n FROM fx_members GROUP BY 1", "fx_members")
def ring_roles(spark, sf_dir):
    return quality.level_counts(fixture(spark, sf_dir, "fx_members").withColumn("ring_role", select.ring_role(F.col("role"))), ["ring_role"])


@query(f"{LANGUAGES} SELECT lang, n FROM c", "fx_tags")
def alias_counts(spark, sf_dir):
    return N.alias_counts(_languages(spark, sf_dir), F.map_keys("tags"))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_regionkey = 2 OR n_name = 'NATION_9'")
def country_boundary(spark, sf_dir):
    polygons = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("iso"))
    return tables.country_boundary(polygons, "2", "NATION_9").select("id", "name")


@query(
    "+spec AS (SELECT concat('m', CAST(n_nationkey % 4 AS VARCHAR(20))) AS region_id, concat('n', CAST(n_nationkey AS VARCHAR(20))) AS child_id FROM nation), "
    "e AS (SELECT region_id, CASE WHEN (x1, y1) > (x2, y2) THEN x2 ELSE x1 END AS x1, CASE WHEN (x1, y1) > (x2, y2) THEN y2 ELSE y1 END AS y1, CASE WHEN (x1, y1) > (x2, y2) THEN x1 ELSE x2 END AS x2, CASE WHEN (x1, y1) > (x2, y2) THEN y1 ELSE y2 END AS y2 "
    "FROM fx_edges JOIN spec ON feature_id = child_id WHERE role = 'outer' AND region_id <> 'm1') SELECT region_id, x1, y1, x2, y2 FROM e GROUP BY ALL HAVING count(*) % 2 = 1",
    "fx_edges",
)
def province_supplements(spark, sf_dir):
    specs = table(spark, sf_dir, "nation").selectExpr("concat('m', CAST(n_nationkey % 4 AS STRING)) AS region_id", "concat('n', CAST(n_nationkey AS STRING)) AS child_id")
    existing = specs.filter("region_id = 'm1'").select(F.col("region_id").alias("id")).distinct()
    return hierarchy.missing_regions(specs, fixture(spark, sf_dir, "fx_edges").filter("role = 'outer'"), existing)


@query(
    "+g AS (SELECT feature_id // 3 AS parent, feature_id, count(*) AS n FROM fx_loops GROUP BY ALL), p AS (SELECT parent, n, row_number() OVER (PARTITION BY parent ORDER BY feature_id) - 1 AS k FROM g) SELECT parent AS feature_id, CAST(k // 2 AS INT) AS part, CAST(k % 2 AS INT) AS ring, CASE WHEN k % 2 = 0 THEN 'outer' ELSE 'inner' END AS role, CAST(n AS INT) AS n_points FROM p",
    "fx_loops",
)
def part_expansion(spark, sf_dir):
    loops = fixture(spark, sf_dir, "fx_loops").groupBy("feature_id").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("pts"))
    rings = loops.groupBy(F.expr("feature_id div 3").alias("parent")).agg(F.array_sort(F.collect_list(F.struct("feature_id", "pts"))).alias("rings"))
    nested = F.expr("transform(sequence(0, cast((size(rings) - 1) div 2 as int)), k -> transform(slice(rings, 2 * k + 1, 2), r -> r.pts))")
    return geometry.expanded(rings.select(F.col("parent").alias("feature_id"), nested.alias("parts")))


@query("+d AS (SELECT rel, unnest([first_node, last_node]) AS node FROM fx_members JOIN fx_ways ON id = ref), g AS (SELECT rel, node, count(*) AS degree FROM d GROUP BY ALL) SELECT degree, count(*) AS n FROM g GROUP BY 1", "fx_members", "fx_ways")
def degree_distribution(spark, sf_dir):
    return stitch.degree_distribution(stitch.endpoint_degrees(_joined_by_relation(spark, sf_dir)))


@query(
    "+r AS (SELECT *, max(n_ways) OVER (PARTITION BY rel ORDER BY extract_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM fx_copies), l AS (SELECT extract_ord, count(*) AS duplicates FROM r WHERE n_ways <= b GROUP BY 1), "
    "m AS (SELECT extract_ord, count(DISTINCT rel) AS relations, count(*) AS members, count(*) FILTER (WHERE id IS NULL) AS missing_members FROM fx_members LEFT JOIN fx_ways ON id = ref GROUP BY 1) SELECT m.*, coalesce(duplicates, 0) AS duplicates FROM m LEFT JOIN l USING (extract_ord)",
    "fx_copies",
    "fx_ways",
)
def assembly_report(spark, sf_dir):
    return stitch.assembly_report(fixture(spark, sf_dir, "fx_copies"), fixture(spark, sf_dir, "fx_members"), fixture(spark, sf_dir, "fx_ways"))


@query("SELECT id, first_node, extract_ord, varies FROM (SELECT id, min(e) AS extract_ord, arg_min(f, e) AS first_node, count(DISTINCT f) > 1 AS varies FROM (SELECT id, 0 AS e, first_node AS f FROM fx_ways WHERE id % 2 = 0 UNION ALL SELECT id, 1, first_node + CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END FROM fx_ways) GROUP BY id)", "fx_ways")
def stitched_union(spark, sf_dir):
    ways = fixture(spark, sf_dir, "fx_ways").select("id", "first_node")
    one = ways.filter("id % 2 = 0").withColumn("extract_ord", F.lit(0))
    two = ways.withColumn("first_node", F.expr("first_node + CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END")).withColumn("extract_ord", F.lit(1))
    return stitch.stitched([one, two], ["first_node"]).select("id", "first_node", "extract_ord", "varies")


@query("SELECT id, level, CASE WHEN id LIKE 's%2' THEN NULL ELSE name END AS name FROM fx_nodes WHERE id NOT LIKE 's%2'", "fx_nodes")
def named_nodes(spark, sf_dir):
    return select.named(_nodes(spark, sf_dir).withColumn("name", F.expr("CASE WHEN id LIKE 's%2' THEN '' ELSE name END"))).select("id", "level", "name")


@query("SELECT id, level, name, parent_id, row_number() OVER (ORDER BY name, id) AS place FROM fx_nodes", "fx_nodes")
def supplement_order(spark, sf_dir):
    return tables.ordered_index(_nodes(spark, sf_dir), ["name", "id"])


from limes.plans import land, shapes  # noqa: E402, F401  (they register their queries here)

"""Queries over shapes that the other projections lack: shared children, deep trees, lines that cross, borders on both sides of 180 degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.operators import hierarchy, lookup, quality, rings
from limes.plans.fixtures import fixture, table
from limes.plans.land import _ring_area
from limes.plans.queries import query
from limes.session import scratch, spread
from limes.sources import releases

# --- trees: blocks of 40 parts, a spine of 20 levels and a node beside each level that hangs from the spine and from its like above ----------

LADDER = (
    "ln AS (SELECT p_partkey AS id, p_name AS name, p_partkey % 40 AS k FROM part), "
    "le AS (SELECT id - 2 AS parent, id AS child FROM ln WHERE k > 1 UNION ALL SELECT id - 3, id FROM ln WHERE k > 2 AND k % 2 = 1 UNION ALL SELECT id - 1, id FROM ln WHERE k = 1), "
    "lw AS (SELECT id AS root, id, 0 AS depth, [concat(name, chr(31), id)] AS way FROM ln WHERE k = 0 OR NOT EXISTS (SELECT 1 FROM le WHERE child = ln.id AND parent IN (SELECT id FROM ln)) "
    "UNION ALL SELECT w.root, n.id, w.depth + 1, list_append(w.way, concat(n.name, chr(31), n.id)) FROM lw w JOIN le e ON e.parent = w.id JOIN ln n ON n.id = e.child)"
)


def _ladder(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS name", "p_partkey % 40 AS k")
    edges = parts.filter("k > 1").selectExpr("id - 2 AS parent", "id AS child").unionByName(parts.filter("k > 2 AND k % 2 = 1").selectExpr("id - 3 AS parent", "id AS child")).unionByName(parts.filter("k = 1").selectExpr("id - 1 AS parent", "id AS child"))
    return parts, hierarchy.inside(edges, parts)


@query(f"+{LADDER}, f AS (SELECT root, id, min(way) AS way FROM lw GROUP BY ALL) SELECT root, id, len(way) - 1 AS depth, row_number() OVER (PARTITION BY root ORDER BY way) AS place FROM f", "fx_ways")
def shared_children(spark, sf_dir):
    """A tree listing in which every second node has two parents, 20 levels deep."""
    nodes, edges = _ladder(spark, sf_dir)
    return hierarchy.tree_listing(nodes, edges).selectExpr("root", "id", "depth", "row_number() OVER (PARTITION BY root ORDER BY sort_path) AS place")


SPINE = "+sp AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 40 > 1 THEN p_partkey - 2 END AS parent_id FROM part), su AS (SELECT id, [id] AS path FROM sp WHERE parent_id IS NULL UNION ALL SELECT s.id, list_append(u.path, s.id) FROM sp s JOIN su u ON s.parent_id = u.id)"


@query(f"{SPINE} SELECT id, array_to_string(path, '>') AS path FROM su", "fx_ways")
def deep_paths(spark, sf_dir):
    nodes = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "CASE WHEN p_partkey % 40 > 1 THEN p_partkey - 2 END AS parent_id")
    return hierarchy.paths(nodes).select("id", F.array_join("path_ids", ">").alias("path"))


# --- rings: the four sides of every cell, a quarter longer at both ends, so that they cross and share no corner ----------------------------------

CELL_SIDES = [("a", "e"), ("e", "c"), ("c", "d"), ("d", "a")]


def _crossing_lines(spark, sf_dir) -> DataFrame:
    longer = lambda p, q: f"struct({p}x + ({p}x - {q}x) * 0.25D AS x, {p}y + ({p}y - {q}y) * 0.25D AS y)"
    lines = ", ".join(f"struct('outer' AS role, {n}L AS ref, array({longer(p, q)}, {longer(q, p)}) AS pts)" for n, (p, q) in enumerate(CELL_SIDES))
    spot = lambda a, b: f"struct(CAST(i * 100 + {a} AS DOUBLE) AS x, CAST(j * 100 + {b} AS DOUBLE) AS y)"
    hole = f"struct('inner' AS role, 9L AS ref, array({', '.join(spot(*p) for p in ((60, 50), (60, 70), (80, 70), (80, 50), (60, 50)))}) AS pts)"
    every = f"CASE WHEN k % 3 = 0 THEN array({lines}, {hole}) ELSE array({lines}) END"
    cells = spread(fixture(spark, sf_dir, "fx_cells"), "k")  # few bytes in one file, though all their lines and what these meet follow
    return cells.selectExpr("CAST(k AS BIGINT) AS rel", f"explode({every}) AS m").select("rel", "m.*")


@query("SELECT CAST(k AS BIGINT) AS rel, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS n_rings, round(abs(ax*ey - ex*ay + ex*cy - cx*ey + cx*dy - dx*cy + dx*ay - ax*dy) / 2::DOUBLE - CASE WHEN k % 3 = 0 THEN 400 ELSE 0 END, 4) AS area FROM fx_cells", "fx_cells")
def crossing_polygons(spark, sf_dir):
    """Polygons of lines that cross without a common corner; every third has a hole."""
    made = rings.relation_polygons(_crossing_lines(spark, sf_dir), most_gap=0.0)
    signed = F.expr(f"CASE WHEN role = 'inner' THEN -1 ELSE 1 END * {_ring_area()}")
    return made.groupBy("rel").agg(F.count("ring").cast("int").alias("n_rings"), F.round(F.sum(signed), 4).alias("area"))


# --- distances on the globe: every cell as a box a tenth of a degree wide, in rows from pole to pole and across 180 degrees -----------------------

GLOBE = (
    "gb AS (SELECT k, CASE WHEN i < 12 THEN 178.9::DOUBLE + i * 0.1::DOUBLE ELSE -179.9::DOUBLE + (i - 12) * 0.1::DOUBLE END AS x, -88.0::DOUBLE + (j * 37) % 176 AS y FROM fx_cells), "
    "ge AS (SELECT concat('g', CAST(k AS VARCHAR(20))) AS feature_id, 8 AS level, x AS x1, y AS y1, x AS x2, y + 0.1::DOUBLE AS y2 FROM gb UNION ALL SELECT concat('g', CAST(k AS VARCHAR(20))), 8, x, y + 0.1::DOUBLE, CASE WHEN x > 179.85::DOUBLE THEN -180 + 0.1::DOUBLE ELSE x + 0.1::DOUBLE END, y + 0.1::DOUBLE FROM gb "
    "UNION ALL SELECT concat('g', CAST(k AS VARCHAR(20))), 6, x + 0.05::DOUBLE, y, x + 0.05::DOUBLE, y - 0.05::DOUBLE FROM gb), "
    "gp AS (SELECT pid, CASE WHEN px % 5 = 0 THEN (px % 360) - 180 WHEN px % 2 = 0 THEN 178.5::DOUBLE + (px % 149) * 0.01::DOUBLE ELSE -180 + (px % 149) * 0.01::DOUBLE END AS px, "
    "-88.0::DOUBLE + (py * 37 + pid) % 177 + ((px + py) % 40 - 20) * 0.01::DOUBLE AS py FROM fx_spots WHERE px >= 0 AND py >= 0)"
)
_GD = "(e.{c} - p.px + CAST(v AS DOUBLE)) * 111.32::DOUBLE * cos(radians(p.py))"
_GX1, _GX2 = _GD.format(c="x1"), "(CASE WHEN e.x2 - e.x1 < -180 THEN e.x2 + 360 ELSE e.x2 END - p.px + CAST(v AS DOUBLE)) * 111.32::DOUBLE * cos(radians(p.py))"


@query(
    f"+{GLOBE}, gd AS (SELECT p.pid, e.level, e.feature_id, {_GX1} AS a, (e.y1 - p.py) * 111.32::DOUBLE AS b, {_GX2} - ({_GX1}) AS dx, (e.y2 - e.y1) * 111.32::DOUBLE AS dy FROM gp p JOIN ge e ON e.y1 BETWEEN p.py - 0.6 AND p.py + 0.6 CROSS JOIN (VALUES (0), (360), (-360)) w(v)), "
    "gt AS (SELECT *, greatest(0, least(1, coalesce(-(a * dx + b * dy) / nullif(dx * dx + dy * dy, 0), 0))) AS t FROM gd), gm AS (SELECT pid, level, min(sqrt(power(a + t * dx, 2) + power(b + t * dy, 2))) AS km FROM gt GROUP BY ALL) SELECT pid, level, round(km, 6) AS km FROM gm WHERE km <= 20",
    "fx_cells",
    "fx_spots",
)
def nearest_on_globe(spark, sf_dir):
    """Borders within 20 km on both sides of 180 degrees and up to 88 degrees of latitude."""
    names = {n: fixture(spark, sf_dir, n) for n in ("fx_cells", "fx_spots")}
    parts = GLOBE.replace("::DOUBLE", "D").replace("FROM fx_cells", "FROM {fx_cells}").replace("FROM fx_spots", "FROM {fx_spots}")
    points, edges = (spark.sql(f"WITH {parts} SELECT * FROM {t}", **names) for t in ("gp", "ge"))
    return lookup.nearest_km(points, edges, 20.0).select("pid", "level", F.round("distance", 6).alias("km"))


# --- files: documents by source and number as text files, a file a key -------------------------------------------------------------------------

FILES = "fk AS (SELECT concat('key=', source, '-', CAST(doc_id % 16 AS VARCHAR(20))) AS path, doc_id, concat(coalesce(text, ''), chr(10)) AS line FROM documents)"


def _written_files(docs: DataFrame, path: str) -> str:
    keyed = docs.select(F.expr("concat(source, '-', doc_id % 16)").alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    keyed.repartition("key").sortWithinPartitions("key", "doc_id").select("key", "value").write.partitionBy("key").text(path)
    return path


def _folders(files: DataFrame) -> DataFrame:
    """Files by their folder's name, since Spark names the file itself anew each time."""
    return files.withColumn("path", F.substring_index("path", "/", 1))


@query(f"WITH {FILES} SELECT path, sha256(string_agg(line, '' ORDER BY doc_id)) AS sha256, CAST(sum(octet_length(encode(line))) AS BIGINT) AS size FROM fk GROUP BY path")
def file_digests(spark, sf_dir):
    path = _written_files(table(spark, sf_dir, "documents"), scratch(spark, "files"))
    return _folders(releases.digested_files(spark, path))


@query(
    f"WITH {FILES} SELECT DISTINCT path, CASE doc_id % 16 WHEN 3 THEN 'missing' WHEN 5 THEN 'digest_mismatch' ELSE 'not_listed' END AS reason FROM fk WHERE doc_id % 16 IN (3, 5, 9)"
)
def file_verification(spark, sf_dir):
    """Files against the manifest of an earlier build, from which some differ, some are gone and some are new."""
    docs = table(spark, sf_dir, "documents")
    before = _written_files(docs.filter("doc_id % 16 <> 9"), scratch(spark, "files"))
    changed = docs.filter("doc_id % 16 <> 3").withColumn("text", F.when(F.expr("doc_id % 16 = 5"), F.concat(F.lit("!"), F.coalesce("text", F.lit("")))).otherwise(F.col("text")))
    after = _written_files(changed, scratch(spark, "files"))
    expected, built = (_folders(releases.digested_files(spark, p)) for p in (before, after))
    return quality.verified(expected, built)


@query("SELECT 'feature_meta' AS what, id, level, name FROM fx_nodes UNION ALL SELECT 'hierarchy', id, NULL, parent_id FROM fx_nodes WHERE parent_id IS NOT NULL UNION ALL SELECT 'faults', 'none', 0, NULL", "fx_nodes")
def release_contents(spark, sf_dir):
    """The current release's contents; a later one that was cut off before its mark is not seen, and no file differs from its manifest."""
    path, nodes = scratch(spark, "releases"), fixture(spark, sf_dir, "fx_nodes")
    made = {"feature_meta": nodes.select("id", "level", "name"), "hierarchy": hierarchy.dataset_edges(nodes)}
    releases.publish(spark, path, "1.0.0", {k: v.limit(3) for k, v in made.items()})
    releases.publish(spark, path, "1.1.0", made)
    nodes.limit(1).select("id", "level", "name").write.parquet(f"{path}/versions/1.2.0/feature_meta")  # all that a writer did before it was lost
    meta, tree = (releases.read_release(spark, path, t) for t in ("feature_meta", "hierarchy"))
    faults = releases.release_faults(spark, path).agg(F.count("*").cast("int").alias("level")).selectExpr("'faults' AS what", "'none' AS id", "level", "CAST(NULL AS STRING) AS name")
    rows = meta.select(F.lit("feature_meta").alias("what"), "id", "level", "name").unionByName(tree.selectExpr("'hierarchy' AS what", "child AS id", "CAST(NULL AS INT) AS level", "parent AS name"))
    return rows.unionByName(faults)

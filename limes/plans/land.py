"""Queries over a lattice of slanted, multi-part features that grows with the tables, and the rest of the inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.functions import names as N
from limes.functions import numbers as M
from limes.operators import geometry, hierarchy, index, lookup, policy, quality, rings, select, stitch
from limes.plans.fixtures import fixture, table
from limes.plans.queries import NAMED, NODEREFS, RELS, _files, _nodes, _relations, _tagged, query
from limes.session import scratch, written, written_wide
from limes.sources import profiles, releases, tables

#: sides of the grid's cells by level
SIDES = {4: 300.0, 6: 100.0, 8: 100.0}


def _land(spark, sf_dir, *levels: int) -> DataFrame:
    rows = written(fixture(spark, sf_dir, "fx_land"), "land")  # a table, as features are anywhere but here
    return rows.filter(F.col("level").isin(list(levels))) if levels else rows


def _spots(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "fx_spots")


SIDE = lambda p: f"((e.x2 - e.x1) * ({p}.py - e.y1) - (e.y2 - e.y1) * ({p}.px - e.x1))"
CROSSED = lambda p: f"count(CASE WHEN (e.y1 > {p}.py) <> (e.y2 > {p}.py) AND CASE WHEN e.y2 > e.y1 THEN {SIDE(p)} > 0 ELSE {SIDE(p)} < 0 END THEN 1 END) % 2 = 1"
LBOX = "lb AS (SELECT feature_id, level, min(least(x1, x2)) AS minx, min(least(y1, y2)) AS miny, max(greatest(x1, x2)) AS maxx, max(greatest(y1, y2)) AS maxy FROM fx_land GROUP BY ALL)"
LHITS = f"+{LBOX}, lh AS (SELECT p.pid, e.feature_id, e.level FROM fx_spots p JOIN lb ON p.px BETWEEN minx AND maxx AND p.py BETWEEN miny AND maxy JOIN fx_land e ON e.feature_id = lb.feature_id GROUP BY ALL HAVING {CROSSED('p')})"


@query(f"{LHITS} SELECT * FROM lh", "fx_land", "fx_spots")
def land_lookup(spark, sf_dir):
    return lookup.point_lookup(_spots(spark, sf_dir), _land(spark, sf_dir), SIDES)


REPS = (
    "+rr AS (SELECT feature_id, part, ring, abs(sum(x1 * y2 - x2 * y1)) AS twice, (min(least(y1, y2)) + max(greatest(y1, y2))) / 2::DOUBLE AS mid FROM fx_land GROUP BY ALL), rb AS (SELECT feature_id, arg_max(mid, (twice, -part, -ring)) AS mid FROM rr GROUP BY 1), "
    "re AS (SELECT feature_id, y1 AS y FROM fx_land UNION SELECT feature_id, y2 FROM fx_land), rl AS (SELECT re.feature_id, (max(CASE WHEN y <= mid THEN y END) + min(CASE WHEN y > mid THEN y END)) / 2::DOUBLE AS py FROM re JOIN rb USING (feature_id) GROUP BY 1), "
    "rc AS (SELECT feature_id, py, x1 + (x2 - x1) * (py - y1) / (y2 - y1) AS x FROM fx_land JOIN rl USING (feature_id) WHERE (y1 > py) <> (y2 > py)), rn AS (SELECT feature_id, py, x, lead(x) OVER w AS t, row_number() OVER w AS n FROM rc WINDOW w AS (PARTITION BY feature_id ORDER BY x)), "
    "reps AS (SELECT b.feature_id, f.level, (x + t) / 2 AS px, py FROM (SELECT *, row_number() OVER (PARTITION BY feature_id ORDER BY t - x DESC, x) AS k FROM rn WHERE n % 2 = 1) b JOIN (SELECT DISTINCT feature_id, level FROM fx_land) f USING (feature_id) WHERE k = 1)"
)
RHITS = f"{REPS}, {LBOX}, rh AS (SELECT p.feature_id AS child, p.level AS child_level, e.feature_id AS holder, e.level FROM reps p JOIN lb ON p.px BETWEEN minx AND maxx AND p.py BETWEEN miny AND maxy AND lb.level < p.level JOIN fx_land e ON e.feature_id = lb.feature_id GROUP BY ALL HAVING {CROSSED('p')})"


def _reps(spark, edges: DataFrame) -> DataFrame:
    return written(geometry.representative_points(edges).join(edges.select("feature_id", "level").distinct(), "feature_id"), "reps")


@query(f"{REPS} SELECT feature_id, level, round(px, 6) AS px, py FROM reps", "fx_land")
def land_points(spark, sf_dir):
    return _reps(spark, _land(spark, sf_dir)).withColumn("px", F.round("px", 6))


@query(f"{RHITS} SELECT p.feature_id, p.level, max(CASE WHEN h.level = p.level - 2 THEN holder END) AS parent FROM reps p LEFT JOIN rh h ON h.child = p.feature_id GROUP BY ALL", "fx_land")
def land_parents(spark, sf_dir):
    land = _land(spark, sf_dir)
    return lookup.parents(_reps(spark, land), land, [4, 6, 8], SIDES)


def _features(land: DataFrame) -> DataFrame:
    return land.select(F.col("feature_id").alias("id"), "level", F.col("feature_id").alias("name")).distinct()


@query(f"{RHITS} SELECT DISTINCT feature_id AS id, level FROM reps WHERE (level = 4 AND CAST(substr(feature_id, 2) AS INT) % 2 = 0) OR feature_id IN (SELECT child FROM rh WHERE level = 4 AND CAST(substr(holder, 2) AS INT) % 2 = 0)", "fx_land")
def land_scope(spark, sf_dir):
    land = _land(spark, sf_dir)
    features = _features(land)
    names = features.filter("level = 4 AND CAST(substr(id, 2) AS INT) % 2 = 0").select("name")
    return lookup.in_scope(features, _reps(spark, land), land, names, 4, SIDES).select("id", "level")


@query("SELECT DISTINCT feature_id AS id, level FROM fx_land", "fx_land")
def land_scope_skipped(spark, sf_dir):
    land = _land(spark, sf_dir)
    names = _features(land).filter("level = 8").select("name")  # none is a level-4 feature's
    return lookup.in_scope(_features(land), _reps(spark, land), land, names, 4, SIDES).select("id", "level")


@query(f"{RHITS} SELECT DISTINCT child AS id, child_level AS level FROM rh WHERE level = 4 AND CAST(substr(holder, 2) AS INT) % 5 IN (1, 2) AND child_level > 4", "fx_land")
def land_country_filter(spark, sf_dir):
    land = _land(spark, sf_dir)
    country = land.filter("level = 4 AND CAST(substr(feature_id, 2) AS INT) % 5 IN (1, 2)")
    small = _features(land).filter("level > 4")
    return lookup.country_features(small, _reps(spark, land).filter("level > 4").select("feature_id", "px", "py"), country, SIDES).select("id", "level")


# --- distances in km: the lattice at 40 degrees north, a hundredth of a degree a cell -----------------------------------

OPEN = f"{LHITS}, op AS (SELECT pid, px, py, cos(radians(40 + py * 0.0001::DOUBLE)) AS shrink FROM fx_spots WHERE pid NOT IN (SELECT pid FROM lh WHERE level = 8))"
# the same in degrees, where a point on a border may fall on either side
OPEN_DEGREES = (
    f"+{LBOX}, dp AS (SELECT pid, px * 0.0001::DOUBLE AS px, py * 0.0001::DOUBLE + 40 AS py FROM fx_spots), de AS (SELECT feature_id, x1 * 0.0001::DOUBLE AS x1, y1 * 0.0001::DOUBLE + 40 AS y1, x2 * 0.0001::DOUBLE AS x2, y2 * 0.0001::DOUBLE + 40 AS y2 FROM fx_land WHERE level = 8), "
    f"dh AS (SELECT dp.pid, e.feature_id FROM fx_spots s JOIN lb ON s.px BETWEEN minx AND maxx AND s.py BETWEEN miny AND maxy AND lb.level = 8 JOIN dp ON dp.pid = s.pid JOIN de e ON e.feature_id = lb.feature_id GROUP BY ALL HAVING {CROSSED('dp')}), "
    "op AS (SELECT pid, px, py, cos(radians(40 + py * 0.0001::DOUBLE)) AS shrink FROM fx_spots WHERE pid NOT IN (SELECT pid FROM dh))"
)
_U = [f"((e.{c} - op.{'p' + c[0]}) * 0.0001::DOUBLE * {'111.32::DOUBLE * shrink' if c[0] == 'x' else '111.32::DOUBLE'})" for c in ("x1", "y1", "x2", "y2")]
KM = (
    f"kk AS (SELECT pid, e.level, {_U[0]} AS a, {_U[1]} AS b, {_U[2]} - {_U[0]} AS dx, {_U[3]} - {_U[1]} AS dy FROM op JOIN fx_land e ON e.x1 BETWEEN px - 400 AND px + 400 AND e.y1 BETWEEN py - 400 AND py + 400), "
    "kt AS (SELECT *, greatest(0, least(1, coalesce(-(a * dx + b * dy) / nullif(dx * dx + dy * dy, 0), 0))) AS t FROM kk), kd AS (SELECT pid, level, min(sqrt(power(a + t * dx, 2) + power(b + t * dy, 2))) AS km FROM kt GROUP BY ALL)"
)


def _degrees(rows: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        rows = rows.withColumn(c, F.col(c) * F.lit(0.0001) + (40.0 if "y" in c else 0.0))
    return rows


@query(f"{OPEN}, {KM} SELECT pid, level, round(km, 6) AS km FROM kd WHERE km <= 1", "fx_land", "fx_spots")
def land_nearest_km(spark, sf_dir):
    points, land = _spots(spark, sf_dir), _land(spark, sf_dir)
    open_ = points.join(geometry.containing(points, land.filter("level = 8"), SIDES).select("pid"), "pid", "left_anti")
    edges = _degrees(land, "x1", "y1", "x2", "y2")
    return lookup.nearest_km(_degrees(open_, "px", "py"), edges, 1.0).select("pid", "level", F.round("distance", 6).alias("km"))


@query(
    f"{OPEN_DEGREES}, {KM} SELECT s.pid, CASE WHEN s.pid NOT IN (SELECT pid FROM op) THEN 'inside' WHEN km <= 0.2 THEN 'nearby' WHEN km <= 0.6 THEN 'offshore' ELSE 'outside' END AS class FROM fx_spots s LEFT JOIN kd ON kd.pid = s.pid AND kd.level = 8",
    "fx_land",
    "fx_spots",
)
def land_offshore_km(spark, sf_dir):
    edges = _degrees(_land(spark, sf_dir, 8), "x1", "y1", "x2", "y2")
    return lookup.nearby_class_km(_degrees(_spots(spark, sf_dir), "px", "py"), edges, 0.0137, 0.2, 0.6)


# --- index tables ------------------------------------------------------------------------------------------------------


@query(
    "+s AS (SELECT level, feature_id, part, count(DISTINCT ring) AS n_rings FROM fx_land GROUP BY ALL) SELECT *, row_number() OVER w - 1 AS index, sum(n_rings) OVER w - n_rings AS ring_start FROM s WINDOW w AS (ORDER BY level, feature_id, part)",
    "fx_land",
)
def geometry_index(spark, sf_dir):
    return index.geometry_index(_land(spark, sf_dir))


@query(
    "+s AS (SELECT level, feature_id, part, ring, role, count(*) AS n_points FROM fx_land GROUP BY ALL) SELECT *, row_number() OVER w - 1 AS index, 4 * (sum(n_points) OVER w - n_points) AS byte_start FROM s WINDOW w AS (ORDER BY level, feature_id, part, role = 'inner', ring)",
    "fx_land",
)
def ring_index(spark, sf_dir):
    return index.ring_index(_land(spark, sf_dir))


@query(
    "+s AS (SELECT feature_id, level, count(DISTINCT part) AS n_parts, count(DISTINCT (part, ring)) AS n_rings, count(*) * 4 AS n_bytes FROM fx_land GROUP BY ALL) "
    "SELECT *, row_number() OVER w - 1 AS index, sum(n_parts) OVER w - n_parts AS part_start, sum(n_rings) OVER w - n_rings AS ring_start, sum(n_bytes) OVER w - n_bytes AS byte_start FROM s WINDOW w AS (ORDER BY level, feature_id)",
    "fx_land",
)
def feature_index(spark, sf_dir):
    return index.feature_index(_land(spark, sf_dir))


Q = lambda v, low, high: f"CAST(least(greatest(floor(({v} - {low}) * 65535.0::DOUBLE / ({high} - {low}) + 0.5), 0), 65535) AS BIGINT)"
PBOX = "+pb AS (SELECT feature_id, part, min(least(x1, x2)) AS minx, min(least(y1, y2)) AS miny, max(greatest(x1, x2)) AS maxx, max(greatest(y1, y2)) AS maxy FROM fx_land GROUP BY ALL)"


@query(
    f"{PBOX}, qe AS (SELECT e.feature_id, e.part, {', '.join(Q('e.' + c, 'b.min' + c[0], 'b.max' + c[0]) + ' AS ' + c for c in ('x1', 'y1', 'x2', 'y2'))} FROM fx_land e JOIN pb b USING (feature_id, part)), "
    f"qp AS (SELECT p.pid, b.feature_id, b.part, {Q('p.px', 'b.minx', 'b.maxx')} AS px, {Q('p.py', 'b.miny', 'b.maxy')} AS py FROM fx_spots p JOIN pb b ON p.px BETWEEN b.minx AND b.maxx AND p.py BETWEEN b.miny AND b.maxy), "
    f"qh AS (SELECT qp.pid, qp.feature_id, qp.part FROM qp JOIN qe e USING (feature_id, part) GROUP BY ALL HAVING {CROSSED('qp')}) SELECT DISTINCT pid, feature_id FROM qh",
    "fx_land",
    "fx_spots",
)
def index_lookup(spark, sf_dir):
    """Through a written index, whose version the lookup checks."""
    path = scratch(spark, "index")
    index.write_index(_land(spark, sf_dir), path, 3)
    return index.index_lookup(spark, _spots(spark, sf_dir), path, 150.0)


# --- rings -------------------------------------------------------------------------------------------------------------

EAST = "u AS (SELECT feature_id, part, ring, role, 120 + x1 * 0.05::DOUBLE AS u1, y1 AS v1, 120 + x2 * 0.05::DOUBLE AS u2, y2 AS v2 FROM fx_land WHERE level > 4)"
CLAMPED = (
    "CASE WHEN u1 <= 180 AND u2 <= 180 THEN (u1 + u2) / 2 * (v2 - v1) WHEN u1 >= 180 AND u2 >= 180 THEN 180.0::DOUBLE * (v2 - v1) WHEN u1 < 180 THEN (u1 + 180) / 2 * (180 - u1) / (u2 - u1) * (v2 - v1) + 180 * (1 - (180 - u1) / (u2 - u1)) * (v2 - v1) "
    "ELSE 180 * (180 - u1) / (u2 - u1) * (v2 - v1) + (180 + u2) / 2 * (1 - (180 - u1) / (u2 - u1)) * (v2 - v1) END"
)


def _ring_area(pts: str = "pts") -> str:
    """Area of a closed array of corners."""
    return f"abs(aggregate(transform(sequence(1, size({pts}) - 1), i -> {pts}[i - 1].x * {pts}[i].y - {pts}[i].x * {pts}[i - 1].y), 0D, (s, v) -> s + v)) / 2"


@query(
    f"+{EAST}, r AS (SELECT feature_id, part, ring, CASE WHEN role = 'inner' THEN -1 ELSE 1 END AS sign, abs(sum({CLAMPED})) AS west, abs(sum((u1 + u2) / 2 * (v2 - v1))) AS whole FROM u GROUP BY ALL), "
    "a AS (SELECT feature_id, sum(sign * west) AS west, sum(sign * whole) AS whole FROM r GROUP BY 1) SELECT feature_id, 'west' AS side, round(west, 5) AS area FROM a WHERE west > 0.000001 UNION ALL SELECT feature_id, 'east', round(whole - west, 5) FROM a WHERE whole - west > 0.000001",
    "fx_land",
)
def antimeridian_parts(spark, sf_dir):
    """Features on both sides of the meridian, with the area of their parts on either side."""
    turned = _land(spark, sf_dir, 6, 8)
    for c in ("x1", "x2"):
        turned = turned.withColumn(c, F.expr(f"120 + {c} * 0.05D")).withColumn(c, F.expr(f"CASE WHEN {c} > 180 THEN {c} - 360 ELSE {c} END"))
    parts = rings.split_at_antimeridian(turned)
    side = F.expr("CASE WHEN exists(pts, p -> p.x < 0) THEN 'east' ELSE 'west' END")
    signed = F.expr(f"CASE WHEN role = 'inner' THEN -1 ELSE 1 END * {_ring_area()}")
    return parts.groupBy("feature_id", side.alias("side")).agg(F.round(F.sum(signed), 5).alias("area"))


CELLAREA = "ca AS (SELECT CAST(floor(i/5) AS INT) + 5 * CAST(floor(j/6) AS INT) AS rel, sum(abs(ax*ey - ex*ay + ex*cy - cx*ey + cx*dy - dx*cy + dx*ay - ax*dy)) / 2 AS area FROM fx_cells GROUP BY 1)"


@query(f"+{CELLAREA} SELECT rel AS block, 1 AS n_rings, n_corners, area FROM ca JOIN (SELECT bi + 5 * bj AS rel, count(*) AS n_corners FROM fx_borders GROUP BY 1) USING (rel)", "fx_borders")
def dissolved_rings(spark, sf_dir):
    """Blocks of cells as the outlines of their dissolved cells."""
    cells = fixture(spark, sf_dir, "fx_sides").withColumn("block", F.expr("CAST(floor(i/5) AS INT) + 5 * CAST(floor(j/6) AS INT)"))
    made = rings.outlines(geometry.dissolve(cells, "block"), "block")
    return made.groupBy("block").agg(F.count("*").cast("int").alias("n_rings"), F.sum(F.size("pts") - 1).alias("n_corners"), F.sum(F.expr(_ring_area())).alias("area"))


HOLED = "CAST(floor(k/25) AS INT) % 6 = 2 AND k % 5 = 2"  # the cell of a block that may have a hole
WAYS = (
    "+bw AS (SELECT bi + 5 * bj AS rel, seq AS ref, x1, y1, x2, y2, seq = min(seq) OVER (PARTITION BY bi, bj) AS is_first FROM fx_borders), "
    f"{CELLAREA}, hc AS (SELECT rel FROM (SELECT CAST(floor(i/5) AS INT) + 5 * CAST(floor(j/6) AS INT) AS rel, k FROM fx_cells WHERE {HOLED}) WHERE rel % 5 = 1), "
    "gone AS (SELECT rel, sqrt(power((x1 - x2) * 0.01::DOUBLE, 2) + power((y1 - y2) * 0.01::DOUBLE, 2)) AS gap FROM bw WHERE is_first AND rel % 3 = 0), "
    "out AS (SELECT rel, CASE WHEN gap > 1 THEN 'outer_polygonize_failed' WHEN rel % 7 = 3 THEN 'empty_geometry' ELSE 'assembled' END AS outcome, coalesce(gap <= 1, false) AS repaired, CASE WHEN rel IN (SELECT rel FROM hc) THEN 2 ELSE 1 END AS n, area - CASE WHEN rel IN (SELECT rel FROM hc) THEN 400 ELSE 0 END AS units FROM ca LEFT JOIN gone USING (rel))"
)


#: nodes are numbered by column and row; the lattice grows by rows, which stay below this
NODE_ROWS = 1_000_000_000_000


def _blocks(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members, ways and nodes: borders of blocks as relations of two-node ways from numbered nodes; some ways are missing, some relations have inner ways."""
    own = fixture(spark, sf_dir, "fx_borders").selectExpr("bi + 5 * bj AS rel", "CAST(seq AS BIGINT) AS ref", "x1", "y1", "x2", "y2", "seq = min(seq) OVER (PARTITION BY bi, bj) AS is_first")
    cells = fixture(spark, sf_dir, "fx_cells").filter(HOLED).selectExpr("CAST(floor(i/5) AS INT) + 5 * CAST(floor(j/6) AS INT) AS rel", "CAST(k AS BIGINT) + 2000000000 AS ref", "i*100 AS x", "j*100 AS y").filter("rel % 5 = 1")
    refs = "array({})".format(", ".join(f"CAST(x + {a} AS BIGINT) * {NODE_ROWS} + y + {b}" for a, b in ((60, 50), (60, 70), (80, 70), (80, 50), (60, 50))))
    holes = cells.selectExpr("rel", "'inner' AS role", "ref", f"{refs} AS node_refs")
    segment = f"array(CAST(x1 AS BIGINT) * {NODE_ROWS} + y1, CAST(x2 AS BIGINT) * {NODE_ROWS} + y2)"
    outer = own.selectExpr("rel", "CASE WHEN ref % 2 = 0 THEN 'outer' ELSE '' END AS role", "ref", f"{segment} AS node_refs", "is_first AND rel % 3 = 0 AS gone")
    again = own.filter("rel % 7 = 3").selectExpr("rel", "'inner' AS role", "ref + 1000000000 AS ref", f"{segment} AS node_refs", "false AS gone")
    every = outer.unionByName(again).unionByName(holes.withColumn("gone", F.lit(False)))
    ways = every.filter("NOT gone").selectExpr("ref AS id", "node_refs")
    nodes = every.select(F.explode("node_refs").alias("id")).distinct().selectExpr("id", f"(id div {NODE_ROWS}) * 0.01D AS lon", f"(id % {NODE_ROWS}) * 0.01D AS lat")
    return every.select(F.col("rel").cast("long").alias("rel"), "role", "ref"), ways, nodes


def _lines(spark, sf_dir) -> DataFrame:
    return stitch.member_lines(*_blocks(spark, sf_dir))


@query(f"{WAYS} SELECT rel, outcome, repaired, CASE WHEN outcome = 'assembled' THEN n ELSE 0 END AS n_rings, CASE WHEN outcome = 'assembled' THEN round(units / 10000::DOUBLE, 6) END AS area FROM out", "fx_borders")
def relation_polygons(spark, sf_dir):
    made = rings.relation_polygons(_lines(spark, sf_dir))
    signed = F.expr(f"CASE WHEN role = 'inner' THEN -1 ELSE 1 END * {_ring_area()}")
    return made.groupBy("rel").agg(F.coalesce(F.max("reason"), F.lit("assembled")).alias("outcome"), F.max("repaired").alias("repaired"), F.count("ring").alias("n_rings"), F.round(F.sum(signed), 6).alias("area"))


@query(f"{WAYS} SELECT CASE WHEN outcome = 'assembled' THEN 4 + rel % 2 * 2 END AS level, outcome, count(*) AS n, count(*) FILTER (WHERE repaired) AS repaired FROM out GROUP BY ALL", "fx_borders")
def polygon_outcomes(spark, sf_dir):
    made = rings.relation_polygons(_lines(spark, sf_dir))
    levels = fixture(spark, sf_dir, "fx_borders").selectExpr("CAST(bi + 5 * bj AS BIGINT) AS rel", "4 + (bi + 5 * bj) % 2 * 2 AS level").distinct()
    return stitch.polygon_outcomes(made, levels)


@query(
    f"{WAYS}, req AS (SELECT rel FROM bw UNION ALL SELECT rel FROM bw WHERE rel % 7 = 3 UNION ALL SELECT rel FROM hc), w AS (SELECT concat('c', CAST(rel % 4 AS VARCHAR(20))) AS country, count(*) AS ways_required FROM req GROUP BY 1), g AS (SELECT concat('c', CAST(rel % 4 AS VARCHAR(20))) AS country, count(*) AS n FROM gone GROUP BY 1), "
    "f AS (SELECT concat('c', CAST(rel % 4 AS VARCHAR(20))) AS country, outcome, count(*) AS n FROM out WHERE outcome <> 'assembled' GROUP BY ALL), "
    "o AS (SELECT concat('c', CAST(rel % 4 AS VARCHAR(20))) AS country, count(*) AS relations, count(*) FILTER (WHERE outcome = 'assembled') AS assembled, count(*) FILTER (WHERE outcome <> 'assembled') AS failed, count(*) FILTER (WHERE repaired) AS gaps_closed, count(*) FILTER (WHERE outcome = 'assembled' AND rel % 2 = 0) AS simplified FROM out GROUP BY 1) "
    "SELECT o.country, relations, ways_required, coalesce(g.n, 0) AS ways_missing, assembled, failed, gaps_closed, simplified, 0::BIGINT AS invalid, coalesce((SELECT string_agg(concat(outcome, '=', CAST(n AS VARCHAR(20))), ',' ORDER BY outcome) FROM f WHERE f.country = o.country), '') AS failures FROM o JOIN w USING (country) LEFT JOIN g USING (country)",
    "fx_borders",
)
def country_report(spark, sf_dir):
    """One row a country: members, outcomes and what the policy did, from the polygons themselves."""
    members, ways, nodes = _blocks(spark, sf_dir)
    made = rings.relation_polygons(stitch.member_lines(members, ways, nodes))
    countries = members.select("rel", F.expr("concat('c', rel % 4)").alias("country"), F.expr("CAST(4 + rel % 2 * 2 AS INT)").alias("level")).distinct()
    report = stitch.country_report(countries, members, ways, nodes, made, spark.createDataFrame([(4, 25.0)], "level int, tolerance double"))
    return report.drop("nodes_required", "nodes_missing")


def _ring_ordered(spark, sf_dir) -> DataFrame:
    """The lattice with the outlines of level 4 walked, whose edges have no order of their own."""
    land = _land(spark, sf_dir)
    columns = ["feature_id", "level", "part", "ring", "role", "seq", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2"))]
    walked = geometry.closed_edges(rings.outlines(land.filter("level = 4"), "feature_id")).withColumn("level", F.lit(4))
    return land.filter("level > 4").select(*columns).unionByName(written(walked.select(*columns), "land-rings"))


@query()
def simplified_rings(spark, sf_dir):
    """Generalised by the level's policy, common borders once; the tests compare whole tables with brute force."""
    tolerances = spark.createDataFrame([(4, 25.0), (6, None), (8, 12.0)], "level int, tolerance double")
    return geometry.simplified_coverage(_ring_ordered(spark, sf_dir), tolerances).select("feature_id", "part", "ring", F.size("pts").alias("n_points"), F.expr(f"{_ring_area()}").alias("area"))


@query(
    "+own AS (SELECT * FROM fx_land WHERE level = 4 AND (CAST(substr(feature_id, 2) AS INT) % 7 = 1 OR feature_id = 'b0')), seg AS (SELECT least(x1*100000 + y1, x2*100000 + y2) AS lo, greatest(x1*100000 + y1, x2*100000 + y2) AS hi, x1, y1, x2, y2 FROM own), "
    "odd AS (SELECT min(least(x1, x2)) AS a, min(least(y1, y2)) AS b, max(greatest(x1, x2)) AS c, max(greatest(y1, y2)) AS d FROM seg GROUP BY lo, hi HAVING count(*) % 2 = 1), "
    f"{CELLAREA} SELECT min(a) AS minx, min(b) AS miny, max(c) AS maxx, max(d) AS maxy, (SELECT sum(area) FROM ca WHERE rel % 7 = 1 OR rel = 0) AS area FROM odd",
    "fx_land",
)
def country_outline(spark, sf_dir):
    land = _land(spark, sf_dir, 4)
    polygons = _features(land).withColumn("iso", F.expr("CAST(CAST(substr(id, 2) AS INT) % 7 AS STRING)"))
    outline, box = tables.country_outline(land, tables.country_boundary(polygons, "1", "b0"))
    signed = F.expr(f"CASE WHEN role = 'inner' THEN -1 ELSE 1 END * {_ring_area()}")
    return box.join(outline.groupBy("country").agg(F.sum(signed).alias("area")), "country").select("minx", "miny", "maxx", "maxy", "area")


@query("SELECT level, count(DISTINCT feature_id) AS n, 0 AS faults FROM fx_land GROUP BY level", "fx_land")
def generalised_faults(spark, sf_dir):
    """Rings of a coarse generalisation that cross themselves or no longer fit each other, by level."""
    tolerances = spark.createDataFrame([(4, 90.0), (6, 45.0), (8, 45.0)], "level int, tolerance double")
    land = _ring_ordered(spark, sf_dir)
    made = written(geometry.simplified_coverage(land, tolerances), "generalised")
    n_edges = made.agg(F.sum(F.size("pts") - 1)).first()[0] or 0
    made = geometry.closed_edges(made)
    alone = made.withColumn("ring", F.col("part") * 1_000_000 + F.col("ring"))
    faults = geometry.validity(alone, n_edges).select("feature_id").unionByName(geometry.ring_faults(made).select("feature_id")).distinct().withColumn("bad", F.lit(1))
    return _features(land).select("level", F.col("id").alias("feature_id")).join(faults, "feature_id", "left").groupBy("level").agg(F.count("*").alias("n"), F.count("bad").cast("int").alias("faults"))


# --- datasets and releases ---------------------------------------------------------------------------------------------


@query(
    f"+{LBOX}, f AS (SELECT feature_id AS id, level, feature_id AS name FROM lb) SELECT f.id, f.id AS osm_id, f.level, CASE f.level WHEN 4 THEN 'admin_region' WHEN 6 THEN 'admin_municipality' ELSE 'admin_locality' END AS label, f.name, CASE WHEN f.level = 8 THEN concat('en=', f.name) END AS names, concat_ws(',', minx, miny, maxx, maxy) AS bbox, NULL::VARCHAR AS parent FROM f JOIN lb ON lb.feature_id = f.id",
    "fx_land",
)
def dataset_features(spark, sf_dir):
    names = F.when(F.col("level") == 8, F.create_map(F.lit("en"), F.col("name"))).otherwise(F.create_map().cast("map<string,string>"))
    land = _land(spark, sf_dir)
    features = _features(land).withColumn("names", names).withColumn("parent_id", F.lit(None).cast("string"))
    path = scratch(spark, "dataset-features")
    tables.write_dataset(tables.dataset_rows(features, index.part_boxes(land)), path, ["level"])
    shown = spark.read.parquet(path).withColumn("names", F.when(F.col("names").isNotNull(), F.concat(F.lit("en="), F.try_element_at("names", F.lit("en")))))
    return shown.withColumn("bbox", F.array_join(F.transform("bbox", lambda v: v.cast("long").cast("string")), ","))


@query(
    "SELECT 'features' AS what, count(DISTINCT feature_id) AS n FROM fx_land UNION ALL SELECT 'parts', count(DISTINCT (feature_id, part)) FROM fx_land UNION ALL SELECT 'boxes', count(DISTINCT (feature_id, part)) FROM fx_land UNION ALL SELECT 'rings', count(DISTINCT (feature_id, part, ring)) FROM fx_land "
    "UNION ALL SELECT 'corners', count(*) FROM fx_land UNION ALL SELECT 'feature_meta', count(*) FROM fx_nodes UNION ALL SELECT 'hierarchy', count(*) FROM fx_nodes UNION ALL SELECT 'policy', 3",
    "fx_land",
    "fx_nodes",
)
def release_tables(spark, sf_dir):
    path, nodes, land = scratch(spark, "release"), _nodes(spark, sf_dir), _land(spark, sf_dir)
    meta = nodes.select(F.col("id").alias("feature_id"), "level", "name", "parent_id")
    for release, rows in (("1.0.0", land.filter("level = 4")), ("1.1.0", land)):  # the later one is read
        releases.publish_runtime(spark, path, release, rows, meta, hierarchy.branch_identity(nodes), policy.anchored_policy(spark, [2, 4], [2]))
    return quality.metrics({t.rpartition("/")[2]: releases.read_release(spark, path, t) for t in (*(f"geometry/{t}" for t in ("features", "parts", "boxes", "rings", "corners")), "feature_meta", "hierarchy", "policy")})


@query(
    f"+{NAMED}, one AS (SELECT name, count(*) AS n FROM pool GROUP BY 1), j AS (SELECT t.*, coalesce(n, 0) = 1 AS good FROM tags t LEFT JOIN one ON one.name = t.parent_name) "
    "SELECT 'nodes' AS what, count(*) AS n FROM pool UNION ALL SELECT 'edges', count(*) FROM j WHERE good UNION ALL SELECT 'unresolved', least(20, count(*)) FROM j WHERE NOT good UNION ALL SELECT 'report', 3 + count(DISTINCT level) FROM fx_nodes",
    "fx_nodes",
)
def hierarchy_tables(spark, sf_dir):
    tagged, pool = _tagged(spark, sf_dir)
    good, open_ = hierarchy.resolved(select.is_in_edges(tagged), pool)
    path = scratch(spark, "hierarchy")
    hierarchy.write_hierarchy(pool, good, open_, path)
    return quality.metrics({t: spark.read.parquet(f"{path}/{t}") for t in ("nodes", "edges", "unresolved", "report")})


@query(f"+{NAMED}, one AS (SELECT name, count(*) AS n FROM pool GROUP BY 1) SELECT parent_name, child FROM tags t LEFT JOIN one ON one.name = t.parent_name WHERE coalesce(n, 0) <> 1 ORDER BY parent_name, child LIMIT 20", "fx_nodes")
def unresolved_samples(spark, sf_dir):
    tagged, pool = _tagged(spark, sf_dir)
    return hierarchy.unresolved_samples(hierarchy.resolved(select.is_in_edges(tagged), pool)[1])


@query(
    "+t AS (SELECT extract_ord, count(DISTINCT rel) AS relations, count(*) AS members FROM fx_members GROUP BY 1), l AS (SELECT CAST(l_suppkey % 3 AS INT) AS extract_ord, l_orderkey AS name, count(*) AS area FROM lineitem WHERE l_linenumber < 5 GROUP BY ALL), "
    "e AS (SELECT extract_ord, max(name) AS expected_name FROM l WHERE area = 4 GROUP BY 1) SELECT t.extract_ord, relations, members, expected_name, expected_name IS NOT NULL AS expected_found, (SELECT arg_max(name, (area, name)) FROM l WHERE l.extract_ord = t.extract_ord) AS largest_name, (SELECT max(area) FROM l WHERE l.extract_ord = t.extract_ord) AS largest_area "
    "FROM t LEFT JOIN e USING (extract_ord)",
    "fx_members",
)
def diagnostics_csv(spark, sf_dir):
    totals = fixture(spark, sf_dir, "fx_members").groupBy(F.col("extract_ord").alias("extract")).agg(F.countDistinct("rel").alias("relations"), F.count("*").alias("members"))
    largest = table(spark, sf_dir, "lineitem").filter("l_linenumber < 5").groupBy(F.expr("CAST(l_suppkey % 3 AS INT)").alias("extract"), F.col("l_orderkey").alias("name")).agg(F.count("*").alias("area"))
    expected = largest.filter("area = 4").groupBy("extract").agg(F.max("name").alias("name"))
    path = scratch(spark, "diagnostics")
    tables.write_report(tables.diagnostics(totals, largest, expected), path)
    back = spark.read.csv(path, header=True, schema="extract int, relations long, members long, expected_name long, expected_found boolean, largest_name long, largest_area long")
    return back.withColumnRenamed("extract", "extract_ord")


@query("SELECT id, level, name FROM fx_nodes WHERE level < 8", "fx_nodes")
def stage_reuse(spark, sf_dir):
    """A stage under the key of its inputs is made once; asked for again it is read, whatever would be made then."""
    nodes, folder = _nodes(spark, sf_dir).select("id", "level", "name"), scratch(spark, "stages")
    listing = table(spark, sf_dir, "nation").select(F.lit("nation").alias("source"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("size"), F.col("n_regionkey").alias("mtime"))
    key = tables.stage_key(listing, "source").first()["stage_key"]
    tables.staged(spark, folder, key, lambda: nodes.filter("level < 8"))
    return tables.staged(spark, folder, key, lambda: nodes.filter("level = 8"))


@query("+f AS (SELECT source, concat('{\"path\":\"doc/', CAST(doc_id AS VARCHAR(20)), '\",\"sha256\":\"', sha256(coalesce(text, '')), '\"}') AS line FROM documents) SELECT source, sha256(concat('[', string_agg(line, ',' ORDER BY line), ']')) AS digest FROM f GROUP BY 1", "fx_tags")
def file_list_digest(spark, sf_dir):
    files = quality.manifest(_files(spark, sf_dir)).withColumn("doc_id", F.expr("CAST(substr(path, 5) AS BIGINT)")).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return M.list_digest(files, "source", M.canonical_json("path", "sha256"), "digest", form=("[", ",", "]"))


@query("SELECT concat('doc/', CAST(doc_id AS VARCHAR(20))) AS path, sha256(coalesce(text, '')) AS sha256, octet_length(encode(coalesce(text, ''))) AS size, 'xx' AS country_iso, 'Example' AS country_name, 'xx-admin' AS dataset_id, '1.0.0' AS dataset_version, 'by_tag' AS name_schema FROM documents WHERE doc_id % 2 = 0")
def release_manifest(spark, sf_dir):
    files = _files(spark, sf_dir)
    identity = {"country_iso": "xx", "country_name": "Example", "dataset_id": "xx-admin", "dataset_version": "1.0.0", "name_schema": "by_tag"}
    return quality.release_manifest(files.select("path", "content"), files.filter("doc_id % 2 = 0").select("path"), identity)


@query(
    "SELECT concat('doc/', CAST(doc_id AS VARCHAR(20))) AS path, CASE WHEN doc_id % 10 = 0 THEN 'missing' WHEN doc_id % 10 = 1 THEN 'not_a_file' WHEN doc_id % 10 = 2 THEN 'digest_mismatch' WHEN doc_id % 10 = 3 THEN 'invalid_digest' ELSE 'size_mismatch' END AS reason FROM documents WHERE doc_id % 10 <= 4 AND NOT (doc_id % 20 = 4)"
)
def manifest_schemas(spark, sf_dir):
    """Manifests of both schemas, one for each document: even ones are of version 2 and have digests only."""
    files = _files(spark, sf_dir)
    digest = "CASE doc_id % 10 WHEN 2 THEN sha2(concat('x', path), 256) WHEN 3 THEN '' ELSE sha2(content, 256) END"
    size = "octet_length(content) + CASE WHEN doc_id % 10 = 4 THEN 1 ELSE 0 END"
    entry = f"""CASE WHEN doc_id % 20 IN (4, 6) THEN concat('"', {digest}, '"') ELSE concat('{{"sha256":"', {digest}, '","size":', {size}, '}}') END"""
    body = f"""concat('{{"', path, '":', {entry}, '}}')"""
    texts = files.selectExpr(f"""CASE WHEN doc_id % 2 = 0 THEN concat('{{"schema_version":2,"checksums":{{"files":', {body}, '}}}}') ELSE concat('{{"schema_version":1,"files":', {body}, '}}') END AS manifest""")
    built = quality.manifest(files.filter("doc_id % 10 <> 0")).withColumn("is_file", F.expr("CAST(substr(path, 5) AS BIGINT) % 10 <> 1"))
    return quality.verified(quality.manifest_entries(texts), built)


@query("SELECT source, CASE CAST(substr(source, 4) AS INT) % 3 WHEN 1 THEN 'digest_mismatch' ELSE 'timestamp_mismatch' END AS reason FROM documents WHERE CAST(substr(source, 4) AS INT) % 3 > 0 GROUP BY source")
def unpinned_sources(spark, sf_dir):
    files = _files(spark, sf_dir).select("source", "path", F.sha2("content", 256).alias("sha256"), F.col("doc_id").alias("stamp"))
    identity = quality.source_identity(files, "source")
    pins = identity.withColumn("k", F.expr("CAST(substr(source, 4) AS INT) % 3")).select("source", F.when(F.col("k") == 1, "other").otherwise(F.col("composite")).alias("composite"), F.when(F.col("k") == 2, F.col("latest") + 1).otherwise(F.col("latest")).alias("latest"))
    return quality.unpinned(identity, pins, "source")


# --- predicates, members, trees ------------------------------------------------------------------------------------------


@query("SELECT concat(s_name, CASE WHEN s_suppkey % 2 = 0 THEN '-latest.osm.pbf' ELSE '.osm.pbf' END) AS name, s_suppkey % 3 = 0 OR s_suppkey % 2 <> 0 AS filtered FROM supplier")
def country_filter_choice(spark, sf_dir):
    listing = table(spark, sf_dir, "supplier").selectExpr("concat(s_name, CASE WHEN s_suppkey % 2 = 0 THEN '-latest.osm.pbf' ELSE '.osm.pbf' END) AS name", "s_suppkey % 3 = 0 AS has_boundary")
    return select.needs_country_filter(listing).select("name", "filtered")


@query("SELECT o_orderkey AS rel, concat(CASE WHEN o_orderkey % 3 = 0 THEN 'adm' WHEN o_orderkey % 3 = 1 THEN 'xa' ELSE 'zz' END, '_r', CAST(o_orderkey AS VARCHAR(20))) AS id FROM orders")
def feature_ids(spark, sf_dir):
    country = F.expr("CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'XA' ELSE 'zz' END")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rel"), N.feature_id(F.col("o_orderkey"), country).alias("id"))


@query("SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN 'gb' ELSE concat('c', CAST(s_nationkey AS VARCHAR(20))) END AS code FROM supplier")
def country_codes(spark, sf_dir):
    text = F.expr("CASE WHEN s_suppkey % 5 = 0 THEN ' Uk' ELSE concat(' C', CAST(s_nationkey AS STRING), '  ') END")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), N.country_code(text).alias("code"))


@query(
    f"+{RELS}, every AS (SELECT 'relations' AS source, 'kept' AS status, concat('r', CAST(o_orderkey AS VARCHAR(20))) AS id, o_orderpriority AS name FROM rels UNION ALL SELECT 'nodes', 'level 8', id, name FROM fx_nodes WHERE level = 8 UNION ALL SELECT 'nodes', 'above', id, name FROM fx_nodes WHERE level < 8) SELECT * FROM every WHERE contains(lower(name), 'urgent') OR contains(lower(name), '#00000000') OR contains(lower(name), 'nation_1')",
    "fx_nodes",
)
def name_trace_sources(spark, sf_dir):
    relations = _relations(spark, sf_dir).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"), N.pick_name(F.col("tags"), ["name"]).alias("name"))
    nodes = _nodes(spark, sf_dir)
    sources = {("relations", "kept"): relations, ("nodes", "level 8"): nodes.filter("level = 8"), ("nodes", "above"): nodes.filter("level < 8")}
    return select.traced_sources(sources, ["URGENT", "#00000000", "Nation_1"])


@query("SELECT l_orderkey AS rel, 'type' AS what, CASE WHEN l_linenumber % 3 = 0 THEN 'r' ELSE 'w' END AS value, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY ALL UNION ALL SELECT l_orderkey, 'role', CASE WHEN l_linenumber % 6 = 3 THEN 'subarea' WHEN l_linenumber % 3 = 0 THEN 'label' ELSE 'outer' END, count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY ALL")
def member_types(spark, sf_dir):
    return stitch.member_types(_relations(spark, sf_dir))


def _elements(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Line items as the ways of suppliers' relations, their parts as nodes; some of either are missing."""
    items = table(spark, sf_dir, "lineitem")
    members = items.select(F.col("l_suppkey").alias("rel"), F.col("l_orderkey").alias("ref"))
    ways = spark.sql(NODEREFS.replace("FROM lineitem", "FROM {lineitem}").replace("array_agg(l_partkey ORDER BY l_linenumber)", "array_sort(collect_list(l_partkey))"), lineitem=items).filter("id % 7 <> 0")
    return members, ways, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")).filter("id % 11 <> 0")


ELEMENTS = (
    "m AS (SELECT DISTINCT l_suppkey AS rel, l_orderkey AS id FROM lineitem), wn AS (SELECT DISTINCT m.rel, l_partkey AS id FROM m JOIN lineitem ON l_orderkey = m.id WHERE m.id % 7 <> 0), "
    "e AS (SELECT rel, 'way' AS kind, id, id % 7 <> 0 AS there FROM m UNION ALL SELECT rel, 'node', id, id % 11 <> 0 AND id IN (SELECT p_partkey FROM part) FROM wn)"
)


@query(f"WITH {ELEMENTS} SELECT rel, kind, count(*) AS required, count(*) FILTER (WHERE there) AS present, count(*) FILTER (WHERE NOT there) AS missing FROM e GROUP BY rel, kind UNION ALL SELECT NULL, kind, count(*), count(*) FILTER (WHERE there), count(*) FILTER (WHERE NOT there) FROM (SELECT DISTINCT kind, id, there FROM e) GROUP BY kind")
def element_coverage(spark, sf_dir):
    return stitch.element_coverage(*_elements(spark, sf_dir))


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 11 <> 0 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_orderkey % 7 <> 0)")
def used_nodes(spark, sf_dir):
    _, ways, nodes = _elements(spark, sf_dir)
    return stitch.used_nodes(nodes, ways).select("id")


@query(
    f"WITH {ELEMENTS}, v AS (SELECT l_partkey AS id FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey % 3) > 1) SELECT 'relations' AS what, count(DISTINCT rel) AS n FROM m UNION ALL SELECT 'ways required', count(DISTINCT id) FROM m UNION ALL SELECT 'ways missing', count(DISTINCT id) FROM m WHERE id % 7 = 0 "
    "UNION ALL SELECT 'nodes required', count(DISTINCT id) FROM wn UNION ALL SELECT 'nodes missing', count(DISTINCT id) FROM e WHERE kind = 'node' AND NOT there UNION ALL SELECT 'variant nodes', count(*) FROM v"
)
def build_report(spark, sf_dir):
    members, ways, nodes = _elements(spark, sf_dir)
    refs = members.select(F.col("ref").alias("id")).distinct()
    wanted = stitch.used(ways, members, "ref").select(F.explode("node_refs").alias("id")).distinct()
    copies = table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS id", "CAST(l_suppkey % 3 AS INT) AS extract_ord", "CAST(l_suppkey % 3 AS INT) AS content")
    parts = {"relations": members.select("rel").distinct(), "ways required": refs, "ways missing": refs.join(ways, "id", "left_anti"), "nodes required": wanted, "nodes missing": wanted.join(nodes, "id", "left_anti"), "variant nodes": stitch.variants(copies, ["content"])}
    return quality.metrics(parts)


@query("SELECT level, count(*) AS n, CASE WHEN level = 6 THEN 0 ELSE count(*) END AS simplified, count(*) FILTER (WHERE kind IN (1, 2, 3)) AS repaired FROM (SELECT DISTINCT feature_id, level, kind FROM fx_boxes) GROUP BY level", "fx_boxes")
def level_effects(spark, sf_dir):
    """What a policy does to boxes by level; invalid are those in whose rings the checks find a fault."""
    tolerances = spark.createDataFrame([(4, 0.01), (8, 0.001)], "level int, tolerance double")
    boxes = written_wide(fixture(spark, sf_dir, "fx_boxes"), "boxes")
    n_edges = boxes.count()
    invalid = geometry.validity(boxes.filter("part = 0"), n_edges).select("feature_id").unionByName(geometry.ring_faults(boxes, n_edges=n_edges).select("feature_id")).select(F.col("feature_id").alias("id"))
    return quality.level_effects(_features(boxes), tolerances, invalid)


@query(
    "SELECT DISTINCT feature_id, part, ring, CASE kind WHEN 1 THEN 'hole_outside_shell' WHEN 2 THEN 'ring_crossing' ELSE 'nested_shells' END AS reason FROM fx_boxes WHERE (kind = 1 AND ring = 1) OR kind = 2 OR (kind = 3 AND part = 1)",
    "fx_boxes",
)
def ring_faults(spark, sf_dir):
    boxes = written_wide(fixture(spark, sf_dir, "fx_boxes"), "boxes")
    return geometry.ring_faults(boxes, n_edges=boxes.count())


PART_TREE = (
    "+tree AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE CAST(p_partkey % 5 * 2 AS INT) END AS level, CASE WHEN p_partkey < 7 THEN NULL ELSE CAST(floor(p_partkey / 7) AS BIGINT) END AS parent FROM part), "
    "up AS (SELECT id, id AS root, CASE WHEN level IS NULL THEN -1 ELSE 0 END AS depth, CASE WHEN level IS NOT NULL THEN id END AS listed, NULL::BIGINT AS above FROM tree WHERE parent IS NULL "
    "UNION ALL SELECT t.id, u.root, u.depth + CASE WHEN t.level IS NULL THEN 0 ELSE 1 END, CASE WHEN t.level IS NULL THEN u.listed ELSE t.id END, u.listed FROM tree t JOIN up u ON t.parent = u.id)"
)


def _part_tree(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Parts as a tree of seven below each; every fourth has no level."""
    nodes = table(spark, sf_dir, "part").selectExpr("CAST(p_partkey AS BIGINT) AS id", "p_name AS name", "CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE CAST(p_partkey % 5 * 2 AS INT) END AS level")
    return nodes, nodes.filter("id >= 7").selectExpr("CAST(floor(id / 7) AS BIGINT) AS parent", "id AS child")


@query(f"{PART_TREE} SELECT u.id, u.root, u.depth, u.above FROM up u JOIN tree t USING (id) WHERE t.level IS NOT NULL", "fx_ways")
def levelled_tree(spark, sf_dir):
    nodes, edges = _part_tree(spark, sf_dir)
    return hierarchy.tree_listing(nodes, edges, skip_unlevelled=True).select("id", "root", "depth", "above")


@query(f"{PART_TREE} SELECT t.id AS feature_id, t.level, t.name, u.above AS parent_id FROM tree t JOIN up u USING (id) WHERE t.level IS NOT NULL", "fx_ways")
def raw_tree_semantics(spark, sf_dir):
    return hierarchy.raw_semantics(*_part_tree(spark, sf_dir))


@query(
    "+m AS (SELECT n_name AS name, min(c_mktsegment) AS region FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 6 <> 5 GROUP BY 1), ids AS (SELECT region, printf('fx_region_%02d', row_number() OVER (ORDER BY region)) AS region_id FROM (SELECT DISTINCT c_mktsegment AS region FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 6 <> 5)) "
    "SELECT n.id, 4 AS level, n.name, i.region_id AS parent_id, true AS in_scope FROM fx_nodes n LEFT JOIN m USING (name) LEFT JOIN ids i USING (region) WHERE n.level = 4 UNION ALL SELECT region_id, 3, region, NULL, NULL FROM ids WHERE region IN (SELECT region FROM m)",
    "fx_nodes",
)
def region_tree(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").filter("n_nationkey % 6 <> 5")
    pairs = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"), F.col("c_mktsegment").alias("region"))
    prefectures = _nodes(spark, sf_dir).filter("level = 4").select("id", "name")
    ids = hierarchy.region_ids(pairs, prefectures.filter("false"), "fx")
    return hierarchy.region_tree(prefectures, pairs, ids, 3, 4)


@query(
    f"{LHITS}, li AS (SELECT pid, feature_id, CASE WHEN pid % 11 = 0 THEN 10 - level ELSE level END AS level, row_number() OVER (PARTITION BY pid ORDER BY level, feature_id) AS pos FROM lh UNION ALL SELECT pid, 'a', 8, 9 FROM fx_spots WHERE pid % 13 = 0), "
    "st AS (SELECT pid, level, feature_id, lag(level) OVER w AS l, lag(feature_id) OVER w AS f FROM li WINDOW w AS (PARTITION BY pid ORDER BY pos)) SELECT DISTINCT pid, CASE WHEN level < l THEN 'level_order' ELSE 'id_order' END AS reason FROM st WHERE level < l OR (level = l AND feature_id <= f)",
    "fx_land",
    "fx_spots",
)
def order_violations(spark, sf_dir):
    """Listed results, some of them turned around, some with another hit behind."""
    hits = lookup.point_lookup(_spots(spark, sf_dir), _land(spark, sf_dir), SIDES)
    listed = hits.selectExpr("pid", "feature_id", "CASE WHEN pid % 11 = 0 THEN 10 - level ELSE level END AS level", "row_number() OVER (PARTITION BY pid ORDER BY level, feature_id) AS pos")
    return lookup.order_violations(listed.unionByName(_spots(spark, sf_dir).filter("pid % 13 = 0").selectExpr("pid", "'a' AS feature_id", "8 AS level", "9 AS pos")))


PROFILE_VALUES = ", ".join(f"('{code.lower()}', {levels})" for code, levels in profiles.LEVELS.items())


@query(
    f"+pr AS (SELECT *, row_number() OVER (ORDER BY country) - 1 AS k FROM (VALUES {PROFILE_VALUES}) v(country, levels)), own AS (SELECT DISTINCT country, levels FROM supplier JOIN pr ON pr.k = s_suppkey % (SELECT count(*) FROM pr)), m AS (SELECT country, levels, unnest(range(1, CAST(power(2, len(levels)) AS BIGINT))) AS mask FROM own), "
    "s AS (SELECT country, levels, list_filter(levels, lambda l, i: ((mask >> (i - 1)) & 1) = 1) AS shape FROM m), r AS (SELECT country, array_to_string(shape, '-') AS shape, CASE WHEN list_contains(shape, levels[1]) THEN 'ok' ELSE 'partial' END AS status FROM s WHERE country <> 'be') "
    "SELECT * FROM r UNION ALL SELECT country, unnest(['4-6-8', '4-8', '4']), unnest(['ok', 'ok', 'partial']) FROM own WHERE country = 'be'",
    "fx_nodes",
)
def country_policy(spark, sf_dir):
    """Shape policies of the countries that suppliers come from: by the first level, but for a country that lists its shapes."""
    levels = index.with_offsets(profiles.level_table(spark), ["country"], {})
    own = table(spark, sf_dir, "supplier").selectExpr(f"s_suppkey % {len(profiles.LEVELS)} AS index").distinct().join(levels, "index").select("country", "levels")
    shapes = F.expr("map('4-6-8', 'ok', '4-8', 'ok', '4', 'partial')")
    listed = own.filter("country = 'be'").select("country", F.explode(shapes).alias("shape", "status"))
    return policy.country_policy(own, listed)


SETS = ", ".join(f"('{code.lower()}', {sets})" for code, sets in profiles.ALTERNATIVES.items())
LISTED = ", ".join(f"('{code.lower()}', '{ok}', '{partial}')" for code, (ok, partial) in profiles.LISTED_SHAPES.items())
POLICIES = (
    f"pr AS (SELECT *, row_number() OVER (ORDER BY country) - 1 AS k FROM (VALUES {PROFILE_VALUES}) v(country, levels)), alt AS (SELECT * FROM (VALUES {SETS}) v(country, sets)), lst AS (SELECT * FROM (VALUES {LISTED}) v(country, ok, partial)), "
    "ms AS (SELECT country, levels, unnest(range(1, CAST(power(2, len(levels)) AS BIGINT))) AS mask FROM pr WHERE country NOT IN (SELECT country FROM lst)), sh AS (SELECT country, levels, list_filter(levels, lambda l, i: ((mask >> (i - 1)) & 1) = 1) AS held FROM ms), "
    "pol AS (SELECT country, array_to_string(held, '-') AS shape, CASE WHEN (sets IS NULL AND held[1] = levels[1]) OR len(list_filter(sets, lambda s: list_has_all(held, s))) > 0 THEN 'ok' ELSE 'partial' END AS status FROM sh LEFT JOIN alt USING (country) "
    "UNION ALL SELECT country, unnest(string_split(ok, ' ')), 'ok' FROM lst UNION ALL SELECT country, unnest(string_split(partial, ' ')), 'partial' FROM lst WHERE partial <> '')"
)


def _policies(spark, levels: DataFrame) -> DataFrame:
    return policy.shape_policies(levels, profiles.shape_alternatives(spark), profiles.listed_shapes(spark))


@query(f"+{POLICIES} SELECT country, shape, status FROM pol WHERE country IN (SELECT country FROM pr JOIN customer ON k = c_custkey % (SELECT count(*) FROM pr))", "fx_nodes")
def shape_policies(spark, sf_dir):
    """Shapes of the countries that customers come from, each country by its own rule or list."""
    levels = index.with_offsets(profiles.level_table(spark), ["country"], {})
    own = table(spark, sf_dir, "customer").selectExpr(f"c_custkey % {len(profiles.LEVELS)} AS index").distinct().join(levels, "index").select("country", "levels")
    return _policies(spark, own)


@query(
    f"{LHITS}, {POLICIES}, sp AS (SELECT pid, array_to_string(list_sort(list(DISTINCT level)), '-') AS shape FROM lh GROUP BY pid) "
    "SELECT p.pid, pr.country, coalesce(sp.shape, '') AS shape, coalesce(pol.status, 'failed') AS status FROM fx_spots p JOIN pr ON pr.k = p.pid % (SELECT count(*) FROM pr) LEFT JOIN sp ON sp.pid = p.pid LEFT JOIN pol ON pol.country = pr.country AND pol.shape = sp.shape",
    "fx_land",
    "fx_spots",
)
def country_shape_status(spark, sf_dir):
    """Points by the shape of what they hit, each under the policy of a country of its own."""
    levels = index.with_offsets(profiles.level_table(spark), ["country"], {})
    points = _spots(spark, sf_dir).withColumn("index", F.col("pid") % len(profiles.LEVELS)).join(levels.select("index", "country"), "index")
    hits = lookup.point_lookup(points.select("pid", "px", "py"), _land(spark, sf_dir), SIDES)
    return lookup.lookup_shapes_by_country(points, hits, _policies(spark, levels.select("country", "levels")))

"""The boundary tables as projections of the driver's tables; each statement runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from limes.session import sized

VIEWS = {
    "fx_nodes": """SELECT concat('r', CAST(r_regionkey AS VARCHAR(20))) AS id, 2 AS level, r_name AS name, CAST(NULL AS VARCHAR(20)) AS parent_id FROM region
UNION ALL SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))), 4, n_name, concat('r', CAST(n_regionkey AS VARCHAR(20))) FROM nation
UNION ALL SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))), 8, s_name, concat('n', CAST(s_nationkey AS VARCHAR(20))) FROM supplier""",
    "fx_rings": """SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))) AS feature_id, 4 AS level, 0 AS ring, 'outer' AS role, n_regionkey*1000 AS x0, CAST(floor(n_nationkey/5) AS INT)*1000 AS y0, 1000 AS w FROM nation
UNION ALL SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))), 4, 1, 'inner', n_regionkey*1000+400, CAST(floor(n_nationkey/5) AS INT)*1000+400, 200 FROM nation WHERE n_nationkey % 2 = 0
UNION ALL SELECT concat('r', CAST(r_regionkey AS VARCHAR(20))), 2, 0, 'outer', r_regionkey*1000, 0, 5000 FROM region""",
    "fx_edges": """SELECT feature_id, level, ring, role, 0 AS seq, x0 AS x1, y0 AS y1, x0 AS x2, y0+w AS y2 FROM fx_rings
UNION ALL SELECT feature_id, level, ring, role, 1, x0, y0+w, x0+CASE WHEN level=2 THEN 1000 ELSE w END, y0+w FROM fx_rings
UNION ALL SELECT feature_id, level, ring, role, 2, x0+CASE WHEN level=2 THEN 1000 ELSE w END, y0+w, x0+CASE WHEN level=2 THEN 1000 ELSE w END, y0 FROM fx_rings
UNION ALL SELECT feature_id, level, ring, role, 3, x0+CASE WHEN level=2 THEN 1000 ELSE w END, y0, x0, y0 FROM fx_rings""",
    "fx_points": "SELECT event_id AS pid, (event_id*7919) % 6000 + 1 AS px, (event_id*104729 + user_id*31) % 5500 + 1 AS py FROM events",
    "fx_members": """SELECT l_orderkey AS rel, l_linenumber AS pos, l_partkey AS ref, CASE WHEN l_returnflag='R' THEN 'inner' WHEN l_returnflag='A' THEN 'outer' ELSE '' END AS role,
CAST(l_suppkey % 3 AS INT) AS extract_ord FROM lineitem""",
    "fx_ways": "SELECT p_partkey AS id, p_partkey % 97 AS first_node, (p_partkey*13+5) % 97 AS last_node FROM part WHERE p_partkey % 11 <> 0",
    "fx_tags": "SELECT doc_id AS rel, concat('name:', lang) AS k, CASE WHEN trim(text) = '' THEN '' ELSE md5(text) END AS v FROM documents",
    "fx_vertices": "SELECT first_node AS id, first_node * 0.25 AS lon, ((first_node * 37) % 97) * 0.25 AS lat FROM fx_ways UNION SELECT last_node, last_node * 0.25, ((last_node * 37) % 97) * 0.25 FROM fx_ways",
    "fx_copies": "SELECT rel, extract_ord, count(*) AS n_ways FROM fx_members GROUP BY rel, extract_ord",
    "fx_loops": "SELECT l_orderkey AS feature_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT) AS seq, CAST(l_partkey % 89 AS INT) AS x, CAST((l_suppkey * 7 + l_linenumber * 11) % 83 AS INT) AS y FROM lineitem",
    # A lattice of slanted cells, 25 a row; customers are cells, so it grows with the scale factor.
    "fx_cells": """SELECT k, i, j, i*100 + (i*7 + j*3) % 3 * 20 AS ax, j*100 + (i*5 + j*11) % 4 * 10 AS ay, i*100 + (i*7 + (j+1)*3) % 3 * 20 AS ex, (j+1)*100 + (i*5 + (j+1)*11) % 4 * 10 AS ey,
(i+1)*100 + ((i+1)*7 + (j+1)*3) % 3 * 20 AS cx, (j+1)*100 + ((i+1)*5 + (j+1)*11) % 4 * 10 AS cy, (i+1)*100 + ((i+1)*7 + j*3) % 3 * 20 AS dx, j*100 + ((i+1)*5 + j*11) % 4 * 10 AS dy
FROM (SELECT CAST(c_custkey AS INT) AS k, CAST(c_custkey % 25 AS INT) AS i, CAST(floor(c_custkey/25) AS INT) AS j FROM customer) g""",
    "fx_sides": """SELECT k, i, j, 0 AS seq, ax AS x1, ay AS y1, ex AS x2, ey AS y2 FROM fx_cells UNION ALL SELECT k, i, j, 1, ex, ey, cx, cy FROM fx_cells
UNION ALL SELECT k, i, j, 2, cx, cy, dx, dy FROM fx_cells UNION ALL SELECT k, i, j, 3, dx, dy, ax, ay FROM fx_cells""",
    # Level 8: cells, every fourth with a hole.  Level 6: two cells with two rows between them, as two parts.  Level 4: the border of five by six cells.
    "fx_land": """SELECT concat('c', CAST(k AS VARCHAR(20))) AS feature_id, 8 AS level, 0 AS part, 0 AS ring, 'outer' AS role, seq, x1, y1, x2, y2 FROM fx_sides
UNION ALL SELECT concat('c', CAST(k AS VARCHAR(20))), 8, 0, 1, 'inner', 0, i*100+60, j*100+50, i*100+60, j*100+70 FROM fx_cells WHERE k % 4 = 0
UNION ALL SELECT concat('c', CAST(k AS VARCHAR(20))), 8, 0, 1, 'inner', 1, i*100+60, j*100+70, i*100+80, j*100+70 FROM fx_cells WHERE k % 4 = 0
UNION ALL SELECT concat('c', CAST(k AS VARCHAR(20))), 8, 0, 1, 'inner', 2, i*100+80, j*100+70, i*100+80, j*100+50 FROM fx_cells WHERE k % 4 = 0
UNION ALL SELECT concat('c', CAST(k AS VARCHAR(20))), 8, 0, 1, 'inner', 3, i*100+80, j*100+50, i*100+60, j*100+50 FROM fx_cells WHERE k % 4 = 0
UNION ALL SELECT concat('m', CAST(i + 25 * (j % 3 + 3 * CAST(floor(j/6) AS INT)) AS VARCHAR(20))), 6, CAST(floor(j % 6 / 3) AS INT), 0, 'outer', seq, x1, y1, x2, y2 FROM fx_sides
UNION ALL SELECT concat('b', CAST(bi + 5 * bj AS VARCHAR(20))), 4, 0, 0, 'outer', seq, x1, y1, x2, y2 FROM fx_borders""",
    "fx_borders": """SELECT bi, bj, min(seq) AS seq, min(x1) AS x1, min(y1) AS y1, min(x2) AS x2, min(y2) AS y2 FROM
(SELECT CAST(floor(i/5) AS INT) AS bi, CAST(floor(j/6) AS INT) AS bj, k*4 + seq AS seq, x1, y1, x2, y2, least(x1*100000 + y1, x2*100000 + y2) AS lo, greatest(x1*100000 + y1, x2*100000 + y2) AS hi FROM fx_sides) s
GROUP BY bi, bj, lo, hi HAVING count(*) = 1""",
    # Boxes with a second ring: a hole, one outside, one across the border, a shell inside, or a hole with an island in it.
    "fx_boxes": """SELECT concat('x', CAST(k AS VARCHAR(20))) AS feature_id, CASE k % 3 WHEN 0 THEN 4 WHEN 1 THEN 6 ELSE 8 END AS level, k % 5 AS kind, part, ring, role, seq,
x0 + CASE WHEN seq IN (0, 1) THEN 0 ELSE w END AS x1, y0 + CASE WHEN seq IN (0, 3) THEN 0 ELSE w END AS y1, x0 + CASE WHEN seq IN (0, 3) THEN 0 ELSE w END AS x2, y0 + CASE WHEN seq IN (2, 3) THEN 0 ELSE w END AS y2
FROM (SELECT k, 0 AS part, 0 AS ring, 'outer' AS role, i*100 AS x0, j*100 AS y0, 90 AS w FROM fx_cells
UNION ALL SELECT k, 0, 1, 'inner', i*100 + CASE k % 5 WHEN 1 THEN 200 WHEN 2 THEN 80 WHEN 4 THEN 10 ELSE 20 END, j*100 + CASE k % 5 WHEN 4 THEN 10 ELSE 20 END, CASE k % 5 WHEN 4 THEN 60 ELSE 20 END FROM fx_cells WHERE k % 5 <> 3
UNION ALL SELECT k, 1, 0, 'outer', i*100 + 30, j*100 + 30, 10 FROM fx_cells WHERE k % 5 >= 3) r CROSS JOIN (SELECT 0 AS seq UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) q""",
    "fx_spots": "SELECT event_id AS pid, CAST((event_id*7919) % 2700 - 80 AS INT) AS px, CAST((event_id*104729 + user_id*31) % (SELECT 100 * CAST(floor(count(*)/25) AS INT) + 200 FROM customer) - 80 AS INT) AS py FROM events",
    "fx_chain": "SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE (p_partkey * 7 + 3) % 2000 END AS parent_id FROM part",
}
_NEEDS = {"fx_edges": ["fx_rings"], "fx_copies": ["fx_members"], "fx_vertices": ["fx_ways"], "fx_sides": ["fx_cells"], "fx_boxes": ["fx_cells"], "fx_borders": ["fx_cells", "fx_sides"], "fx_land": ["fx_cells", "fx_sides", "fx_borders"]}
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the projections, by Spark SQL over the driver's files."""
    text = VIEWS[name]
    given = {}
    for t in [*_TABLES, *_NEEDS.get(name, [])]:
        if f" {t}" in text:
            given[t] = fixture(spark, sf_dir, t) if t in VIEWS else table(spark, sf_dir, t)
            if name == "fx_loops":  # loops are numbered and closed by windows over whole relations
                given[t] = sized(given[t], given[t].count(), "l_orderkey")
            text = _renamed(text, t)
    return spark.sql(text, **given)


def _renamed(text: str, table: str) -> str:
    import re

    return re.sub(rf"\bFROM {table}\b", f"FROM {{{table}}}", text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def oracle(select: str, *names: str) -> str:
    """A DuckDB statement over some of the projections; ``select`` may begin with further WITH parts."""
    order: list[str] = []
    for n in names:
        order += [d for d in (*_NEEDS.get(n, []), n) if d not in order]
    parts = ", ".join(f"{n} AS ({VIEWS[n]})" for n in order)
    return f"WITH RECURSIVE {parts}{', ' if select.lstrip().startswith('+') else ' '}{select.lstrip().lstrip('+')}" if parts else select

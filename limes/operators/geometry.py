"""Polygons as tables of edges: ``feature_id, level, ring, role, seq, x1, y1, x2, y2``, and ``part`` where features have several.

Points meet polygons through a grid.  A feature's cells are its border cells, which an edge touches, and the interior cells between
its crossings of a band's middle line.  A point in an interior cell is inside.  Of every border cell it is known whether its lower left corner is
inside, by a running sum along the band, so a point there counts the crossings on its way to that corner, among the edges of
its own cell.  Joins are on cells, so no point is paired with a polygon that is not near it, nor with edges outside its cell.
Cells that very many points fall into are skewed join keys, which adaptive execution splits on the points' side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from limes.session import sized, written, written_wide

#: side of a grid's cells: one for all levels, or one for each
Sides = float | dict[int, float]


def _side(cell: Sides) -> Column:
    if not isinstance(cell, dict):
        return F.lit(float(cell))
    return F.try_element_at(F.create_map(*(F.lit(x) for k, v in cell.items() for x in (k, float(v)))), F.col("level"))


def bands(edges: DataFrame, cell: Sides) -> DataFrame:
    """Each edge in every row band that its height meets, with the ``side`` of its level's cells."""
    sided = edges.withColumn("side", _side(cell))
    low, high = F.floor(F.least("y1", "y2") / F.col("side")), F.floor(F.greatest("y1", "y2") / F.col("side"))
    return sided.withColumn("band", F.explode(F.sequence(low, high)))


def _x_at(y: Column) -> Column:
    return F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0)))


def along(banded: DataFrame, width: Column | None = None) -> DataFrame:
    """Edges of ``bands`` in every cell that they pass, so a long edge has cells along its line, not in all its box.

    Cells are as wide as bands are high, or ``width``.
    """
    side = F.col("side")
    low, high = F.greatest(F.least("y1", "y2"), F.col("band") * side), F.least(F.greatest("y1", "y2"), (F.col("band") + 1) * side)
    flat = F.col("y1") == F.col("y2")
    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(_x_at(low), _x_at(high)))
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(_x_at(low), _x_at(high)))
    width = side if width is None else width
    return banded.withColumn("col", F.explode(F.sequence(F.floor(left / width - 1e-9), F.floor(right / width + 1e-9))))


# Products of coordinates are of doubles, as those of whole numbers leave their type far from the origin.
#: twice the area below an edge
_SHOELACE = "CAST(x1 AS DOUBLE) * y2 - CAST(x2 AS DOUBLE) * y1"
#: above 0 where (px, py) is to the left of the edge
_SIDE = "(CAST(x2 - x1 AS DOUBLE) * ({y} - y1) - CAST(y2 - y1 AS DOUBLE) * ({x} - x1))"
_TO_THE_RIGHT = f"(y1 > {{y}}) <> (y2 > {{y}}) AND CASE WHEN y2 > y1 THEN {_SIDE} > 0 ELSE {_SIDE} < 0 END"


def cover(edges: DataFrame, cell: Sides) -> DataFrame:
    """``feature_id, side, band, col, border, corner``: the cells of every feature, and of border cells whether their lower left corner is inside."""
    banded = bands(edges, cell)
    cell_of = ["feature_id", "side", "band", "col"]
    border = along(banded).select(*cell_of).distinct()
    side = F.col("side")
    middle = (F.col("band") + 0.5) * side
    crossing = banded.filter((F.col("y1") > middle) != (F.col("y2") > middle)).select("feature_id", "side", "band", _x_at(middle).alias("x"))
    order = Window.partitionBy("feature_id", "side", "band").orderBy("x")
    pairs = crossing.withColumn("n", F.row_number().over(order)).withColumn("to", F.lead("x").over(order)).filter("n % 2 = 1 AND to IS NOT NULL")
    inner = pairs.select("feature_id", "side", "band", (F.floor(F.col("x") / side) + 1).alias("a"), (F.floor(F.col("to") / side) - 1).alias("b")).filter("a <= b")
    inner = inner.select("feature_id", "side", "band", F.explode(F.sequence("a", "b")).alias("col")).distinct()
    inner = inner.join(border, cell_of, "left_anti").select(*cell_of, F.lit(False).alias("border"), F.lit(True).alias("corner"))
    return _with_corners(border, banded).unionByName(inner)


def _with_corners(border: DataFrame, banded: DataFrame) -> DataFrame:
    """Border cells with the parity of the crossings to the right of their lower left corner, along the band's lower line.

    A crossing is numbered by the last corner strictly to its left, which the edge's own side test decides, so corners on an edge agree with ``containing``.
    """
    base = F.col("band") * F.col("side")
    cut = banded.withColumn("base", base).filter("(y1 > base) <> (y2 > base)").withColumn("k", F.round(_x_at(F.col("base")) / F.col("side")).cast("long")).withColumn("x", F.col("k") * F.col("side"))
    right = F.expr(_TO_THE_RIGHT.format(x="x", y="base"))
    events = cut.select("feature_id", "side", "band", F.when(right, F.col("k")).otherwise(F.col("k") - 1).alias("col"), F.lit(1).alias("crossing"))
    along_band = Window.partitionBy("feature_id", "side", "band").orderBy(F.desc("col"), F.desc("crossing")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = border.withColumn("crossing", F.lit(0)).unionByName(events).withColumn("n", F.sum("crossing").over(along_band))
    return rows.filter("crossing = 0").select("feature_id", "side", "band", "col", F.lit(True).alias("border"), (F.col("n") % 2 == 1).alias("corner"))


def containing(points: DataFrame, edges: DataFrame, cell: Sides, mode: str = "even_odd", covered: DataFrame | None = None) -> DataFrame:
    """``pid, feature_id`` of every point ``pid, px, py`` in a polygon.

    ``even_odd`` counts crossings, which also serves holes; ``within`` leaves out the border and ``covers`` takes it in.  ``covered`` is
    ``cover(edges, cell)`` where that has been written before.
    """
    grids = sorted({float(v) for v in cell.values()}) if isinstance(cell, dict) else [float(cell)]
    placed = points.withColumn("side", F.explode(F.array(*(F.lit(g) for g in grids)))) if len(grids) > 1 else points.withColumn("side", F.lit(grids[0]))
    placed = placed.withColumn("band", F.floor(F.col("py") / F.col("side"))).withColumn("col", F.floor(F.col("px") / F.col("side")))
    near = placed.join(cover(edges, cell) if covered is None else covered, ["side", "band", "col"])
    sure = near.filter("NOT border").select("pid", "feature_id")
    own = along(bands(edges, cell)).select("feature_id", "side", "band", "col", "x1", "y1", "x2", "y2")
    tested = near.filter("border").join(own, ["feature_id", "side", "band", "col"]).withColumns({"cx": F.col("col") * F.col("side"), "cy": F.col("band") * F.col("side")})
    # from the point left to the cell's left line, then down to the corner; what lies on that line counts as left of it, on the way's height as below it
    level = F.expr(f"{_TO_THE_RIGHT.format(x='cx', y='py')} AND NOT ({_TO_THE_RIGHT.format(x='px', y='py')})")
    up = lambda y: f"sign({_SIDE.format(x='cx', y=y)}) * sign(x2 - x1)"
    rises = "sign(x2 - x1) * sign(y2 - y1) > 0"
    upright = F.expr(f"(x1 > cx) <> (x2 > cx) AND ({up('cy')} < 0 OR ({up('cy')} = 0 AND {rises})) AND ({up('py')} > 0 OR ({up('py')} = 0 AND NOT ({rises})))")
    touches = F.expr(f"{_SIDE.format(x='px', y='py')} = 0 AND px BETWEEN least(x1, x2) AND greatest(x1, x2) AND py BETWEEN least(y1, y2) AND greatest(y1, y2)")
    counted = tested.groupBy("pid", "feature_id").agg((F.sum(level.cast("int")) + F.sum(upright.cast("int")) + F.max(F.col("corner").cast("int"))).alias("n"), F.max(touches).alias("on"))
    keep = {"even_odd": "n % 2 = 1", "within": "n % 2 = 1 AND NOT on", "covers": "n % 2 = 1 OR on"}[mode]
    return sure.unionByName(counted.filter(keep).select("pid", "feature_id"))


def with_part(edges: DataFrame) -> DataFrame:
    """Edges with a ``part``: 0 where there is no such column."""
    return edges if "part" in edges.columns else edges.withColumn("part", F.lit(0))


def _dealt(rows: DataFrame, n_rows: int | None, *keys: str) -> DataFrame:
    """Rows for joins on keys, which sort them; with their number, tasks are made by it."""
    return (rows if n_rows is None else sized(rows, n_rows, *keys)).hint("merge")


def representative_points(edges: DataFrame, n_edges: int | None = None) -> DataFrame:
    """``feature_id, px, py``: a point inside each feature.

    It lies on the line midway between the vertex heights that bracket the middle of the largest ring, in the middle of the feature's widest run there.
    With the number of edges, tasks are made by it, not by the session's partitions.
    """
    edges = _dealt(edges, n_edges, "feature_id")
    rings = with_part(edges).groupBy("feature_id", "part", "ring").agg(F.abs(F.sum(F.expr(_SHOELACE))).alias("twice"), ((F.min(F.least("y1", "y2")) + F.max(F.greatest("y1", "y2"))) / 2).alias("mid"))
    box = rings.groupBy("feature_id").agg(F.max_by("mid", F.struct("twice", (-F.col("part")).alias("p"), (-F.col("ring")).alias("r"))).alias("mid"))
    ends = edges.select("feature_id", F.explode(F.array("y1", "y2")).alias("y")).distinct()
    around = ends.join(box.hint("merge"), "feature_id").groupBy("feature_id").agg(F.max(F.when(F.col("y") <= F.col("mid"), F.col("y"))).alias("a"), F.min(F.when(F.col("y") > F.col("mid"), F.col("y"))).alias("b"))
    line = around.select("feature_id", ((F.col("a") + F.col("b")) / 2).alias("py"))
    cut = edges.join(line.hint("merge"), "feature_id").filter("(y1 > py) <> (y2 > py)").withColumn("x", F.expr("x1 + (x2 - x1) * (py - y1) / (y2 - y1)"))
    order = Window.partitionBy("feature_id").orderBy("x")
    runs = cut.withColumn("n", F.row_number().over(order)).withColumn("to", F.lead("x").over(order)).filter("n % 2 = 1")
    best = runs.groupBy("feature_id").agg(F.max_by(F.struct("x", "to", "py"), F.struct((F.col("to") - F.col("x")).alias("width"), (-F.col("x")).alias("left"))).alias("r"))
    return best.select("feature_id", ((F.col("r.x") + F.col("r.to")) / 2).alias("px"), F.col("r.py").alias("py"))


def areas(edges: DataFrame) -> DataFrame:
    """Area (holes subtract) and bounds of every feature; shoelace sums ring by ring."""
    ring = edges.groupBy("feature_id", "level", "ring", "role").agg(
        F.abs(F.sum(F.expr(_SHOELACE))).alias("twice"),
        *(f(g(a, b)).alias(n) for n, f, g, a, b in (("minx", F.min, F.least, "x1", "x2"), ("miny", F.min, F.least, "y1", "y2"), ("maxx", F.max, F.greatest, "x1", "x2"), ("maxy", F.max, F.greatest, "y1", "y2"))),
    )
    signed = F.when(F.col("role") == "inner", -F.col("twice")).otherwise(F.col("twice"))
    return ring.groupBy("feature_id", "level").agg((F.sum(signed) / 2).alias("area"), F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def dissolve(edges: DataFrame, group: str) -> DataFrame:
    """Border segments of the union of features that share vertices: a segment that occurs twice is inside."""
    swap = F.expr("(x1, y1) > (x2, y2)")
    norm = edges.select(group, *(F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))))
    return norm.groupBy(group, "x1", "y1", "x2", "y2").agg(F.count("*").alias("n")).filter("n % 2 = 1").drop("n")


def loops(points: DataFrame) -> DataFrame:
    """Edges of closed rings from ``feature_id, seq, x, y``."""
    order = Window.partitionBy("feature_id").orderBy("seq")
    first = Window.partitionBy("feature_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to = points.select("feature_id", F.col("seq").cast("int").alias("seq"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.coalesce(F.lead("x").over(order), F.first("x").over(first)).alias("x2"), F.coalesce(F.lead("y").over(order), F.first("y").over(first)).alias("y2"))
    return to.withColumn("ring", F.lit(0)).withColumn("role", F.lit("outer")).withColumn("level", F.lit(0))


def _turn(p: str, q: str, r: str) -> str:
    return f"sign(CAST(x{q} - x{p} AS DOUBLE) * (y{r} - y{p}) - CAST(y{q} - y{p} AS DOUBLE) * (x{r} - x{p}))"


#: edges a and b cross inside both
_APART = f"{_turn('1a', '2a', '1b')} * {_turn('1a', '2a', '2b')} < 0 AND {_turn('1b', '2b', '1a')} * {_turn('1b', '2b', '2a')} < 0"


#: about so many cells of its ring's grid an edge passes
CELLS_PER_EDGE = 4


def validity(edges: DataFrame, n_edges: int | None = None) -> DataFrame:
    """``feature_id, reason`` for rings with under three corners, no area, repeated corners or crossing edges (first that holds).

    Edges meet only where they pass one cell of their ring's own grid, which has about as many rows as the root of its number of edges.
    With the number of edges, tasks are made by it, not by the session's partitions.
    """
    edges = edges if n_edges is None else sized(edges, n_edges, "feature_id", "ring")
    box = edges.groupBy("feature_id", "ring").agg(F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("span"), F.count("*").alias("n"), F.abs(F.sum(F.expr(_SHOELACE))).alias("twice"), F.countDistinct("x1", "y1").alias("corners"))
    side = F.greatest(F.col("span"), F.lit(1e-9)) / F.ceil(F.sqrt(F.col("n")))
    low, high = F.floor(F.least("y1", "y2") / F.col("side")), F.floor(F.greatest("y1", "y2") / F.col("side"))
    sided = edges.join(box.select("feature_id", "ring", side.alias("side")).hint("merge"), ["feature_id", "ring"]).withColumn("band", F.explode(F.sequence(low, high)))
    cells = along(sided).select("feature_id", "ring", "band", "col", "seq", "x1", "y1", "x2", "y2")
    cells = _dealt(cells, n_edges and CELLS_PER_EDGE * n_edges, "feature_id", "ring", "band", "col")
    a, b = (cells.select("feature_id", "ring", "band", "col", *(F.col(c).alias(c + s) for c in ("seq", "x1", "y1", "x2", "y2"))) for s in ("a", "b"))
    crossing = a.join(b, ["feature_id", "ring", "band", "col"]).filter(f"seqa < seqb AND {_APART}").select("feature_id", "ring").distinct().withColumn("crosses", F.lit(True))
    reason = F.when(F.col("n") < 3, "too_few_points").when(F.col("corners") < F.col("n"), "repeated_vertex").when(F.col("twice") == 0, "zero_area").when(F.col("crosses"), "self_crossing")
    return box.join(crossing.hint("merge"), ["feature_id", "ring"], "left").select("feature_id", "ring", reason.alias("reason")).filter("reason IS NOT NULL")


def ring_faults(edges: DataFrame, crossings: bool = True, n_edges: int | None = None) -> DataFrame:
    """``feature_id, part, ring, reason`` of rings that do not fit the other rings of their feature (first that holds).

    Rings that cross (not looked for without ``crossings``), holes outside the shell of their part, holes inside holes, shells inside shells (but for
    islands in holes).  Edges of different rings meet only within cells of the feature's own grid; of every ring one inner point meets the edges of
    its row band.  A feature of one ring has nothing to meet, so its edges take no part in either.  Whatever grows with the edges is sorted, never
    broadcast; with their number, the tasks in which rings and edges meet are made by it.
    """
    rows, n_cells = with_part(edges), n_edges and CELLS_PER_EDGE * n_edges
    span = lambda lo, hi: F.max(F.greatest(lo, hi)) - F.min(F.least(lo, hi))
    several = (F.min("part") < F.max("part")) | (F.min("ring") < F.max("ring"))
    box = rows.groupBy("feature_id").agg((F.greatest(span("x1", "x2"), span("y1", "y2"), F.lit(1e-9)) / F.ceil(F.sqrt(F.count("*")))).alias("side"), several.alias("several")).filter("several").drop("several").hint("merge")
    low, high = F.floor(F.least("y1", "y2") / F.col("side")), F.floor(F.greatest("y1", "y2") / F.col("side"))
    banded = rows.join(box, "feature_id").withColumn("band", F.explode(F.sequence(low, high)))
    cells = _dealt(along(banded).select("feature_id", "band", "col", "part", "ring", "x1", "y1", "x2", "y2"), n_cells, "feature_id", "band", "col")
    a, b = (cells.select("feature_id", "band", "col", *(F.col(c).alias(c + s) for c in ("part", "ring", "x1", "y1", "x2", "y2"))) for s in ("a", "b"))
    crossing = a.join(b, ["feature_id", "band", "col"]).filter(f"(parta, ringa) < (partb, ringb) AND {_APART}")
    crossing = crossing.select("feature_id", F.explode(F.expr("array(struct(parta AS part, ringa AS ring), struct(partb AS part, ringb AS ring))")).alias("r")).select("feature_id", "r.part", "r.ring").distinct().withColumn("crosses", F.lit(True))

    of_ring = ["feature_id", "part", "ring"]
    size = rows.groupBy(*of_ring, "role").agg(F.abs(F.sum(F.expr(_SHOELACE))).alias("twice"))
    key = F.to_json(F.struct(*of_ring)).alias("key")
    own = rows.join(box, "feature_id", "left_semi").select(key.alias("feature_id"), F.lit(0).alias("part"), F.lit(0).alias("ring"), "x1", "y1", "x2", "y2")
    inner = representative_points(own, n_edges).withColumnRenamed("feature_id", "key").hint("merge")
    probes = size.join(box, "feature_id").select("*", key).join(inner, "key").select("feature_id", *(F.col(c).alias(f"own_{c}") for c in ("part", "ring", "role", "twice")), "px", "py", F.floor(F.col("py") / F.col("side")).alias("band"))
    of_band = _dealt(banded.select(*of_ring, "role", "band", "x1", "y1", "x2", "y2"), n_cells, "feature_id", "band")
    met = probes.join(of_band, ["feature_id", "band"]).filter("(part, ring) <> (own_part, own_ring)").filter(_TO_THE_RIGHT.format(x="px", y="py"))
    # a ring's point is in one band
    held = met.groupBy("feature_id", "band", "own_part", "own_ring", "own_role", "own_twice", *of_ring[1:], "role").agg(F.count("*").alias("n")).filter("n % 2 = 1")
    size = _dealt(size, n_edges, *of_ring)
    holders = held.join(size.select(*of_ring, "twice"), of_ring).filter("twice > own_twice").groupBy("feature_id", F.col("own_part").alias("at_part"), F.col("own_ring").alias("at_ring"))
    same = F.col("part") == F.col("own_part")
    counts = holders.agg(F.count("*").alias("depth"), F.count(F.when(same & (F.col("role") == "outer"), 1)).alias("shells"), F.count(F.when(same & (F.col("role") == "inner"), 1)).alias("holes"))
    placed = size.join(counts.withColumnsRenamed({"at_part": "part", "at_ring": "ring"}), of_ring, "left").fillna(0, ["depth", "shells", "holes"])
    placed = placed.join(crossing.hint("merge"), of_ring, "left") if crossings else placed.withColumn("crosses", F.lit(False))
    reason = (
        F.when(F.col("crosses"), "ring_crossing")
        .when((F.col("role") == "inner") & (F.col("shells") == 0), "hole_outside_shell")
        .when((F.col("role") == "inner") & (F.col("holes") > 0), "nested_holes")
        .when((F.col("role") == "outer") & (F.col("depth") % 2 == 1), "nested_shells")
    )
    return placed.select(*of_ring, reason.alias("reason")).filter("reason IS NOT NULL")


def thinned_lines(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, tolerance: np.ndarray) -> np.ndarray:
    """Which corners open lines keep by Douglas-Peucker, all lines in step: line ``k`` is ``bounds[k]`` to ``bounds[k + 1]``; below 0 it keeps all."""
    keep = np.zeros(len(x), dtype=bool)
    a, b, most = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64) - 1, np.asarray(tolerance, dtype=float)
    keep[a[b >= a]] = keep[b[b >= a]] = True
    while True:
        wide = b - a > 1
        a, b, most = a[wide], b[wide], most[wide]
        if not len(a):
            return keep
        n = b - a - 1
        first = np.cumsum(n) - n
        of = np.repeat(np.arange(len(a)), n)
        at = np.arange(len(of)) - first[of] + a[of] + 1
        dx, dy = x[b] - x[a], y[b] - y[a]
        px, py = x[at] - x[a][of], y[at] - y[a][of]
        length = np.hypot(dx, dy)[of]
        with np.errstate(divide="ignore", invalid="ignore"):
            off = np.where(length == 0, np.hypot(px, py), np.abs(dx[of] * py - dy[of] * px) / length)
        farthest = np.maximum.reduceat(off, first)
        far = farthest > most
        hit = np.flatnonzero((off == farthest[of]) & far[of])
        k = at[hit[np.unique(of[hit], return_index=True)[1]]]
        keep[k] = True
        a, b, most = np.concatenate([a[far], k]), np.concatenate([k, b[far]]), np.concatenate([most[far], most[far]])


def douglas_peucker(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Indices of the corners that an open line keeps."""
    return np.flatnonzero(thinned_lines(x, y, np.array([0, len(x)]), np.array([tolerance])))


def with_sides(edges: DataFrame) -> DataFrame:
    """Edges with ``sides``: the features of the level that have the segment, joined in order."""
    swap = F.expr("(x1, y1) > (x2, y2)")
    key = [F.when(swap, F.col(b)).otherwise(F.col(a)).alias(f"k{a}") for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]
    keyed = edges.filter("x1 + y1 + x2 + y2 IS NOT NULL").select("*", *key)
    same = Window.partitionBy("level", "kx1", "ky1", "kx2", "ky2")
    return keyed.withColumn("sides", F.array_join(F.array_sort(F.collect_set(F.col("feature_id").cast("string")).over(same)), ",")).drop("kx1", "ky1", "kx2", "ky2")


def simplified(rings: DataFrame) -> DataFrame:
    """``feature_id, pts, tolerance``: closed rings generalised each by itself; a ring that would keep under four points stays as it is."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for pts, tolerance in zip(frame["pts"], frame["tolerance"]):
                line = [(p["x"], p["y"]) for p in pts][:-1]
                if tolerance is not None and tolerance == tolerance:
                    line = generalised(line, [""] * len(line), float(tolerance))
                made.append([{"x": float(x), "y": float(y)} for x, y in [*line, line[0]]])
            yield frame.assign(pts=made)

    return rings.mapInPandas(run, rings.schema)


#: after so many halvings of its tolerance an arc stays as it is
MOST_HALVINGS = 6
_RING = ["feature_id", "level", "part", "ring", "role"]
_LINE = ["feature_id", "part", "ring", "role"]


def _list_of_points(x: np.ndarray, y: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.float64()), pa.array(y, pa.float64())], names=["x", "y"]))


def _points_of(lists: pa.ListArray) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray]:
    """The values of lists with ``x`` and ``y``, these two, and where each list begins."""
    bounds, flat = lists.offsets.to_numpy(), lists.flatten()
    return flat, *(pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("x", "y")), bounds - bounds[0]


def _cut_rings(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.ListArray]:
    """``ring, arc, turned, pts`` of all arcs of some rings of corners ``x, y, sides``, as ``arcs_of`` cuts them."""
    return _cut_from(lists)[:4]


def _cut_from(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.ListArray, np.ndarray]:
    """As ``_cut_rings``, and the corner that each arc begins at, as its ring walks it."""
    flat, x, y, bounds = _points_of(lists)
    sides = pc.struct_field(flat, "sides").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    n, start = np.diff(bounds), bounds[:-1]
    ring = np.repeat(np.arange(len(n)), n)
    before = np.arange(len(x)) - 1
    before[start] = bounds[1:] - 1
    knot = sides != sides[before]
    lone = np.flatnonzero((np.bincount(ring[knot], minlength=len(n)) < 2)[ring])
    if len(lone):  # no neighbour, or one all around: the smallest corner and the one farthest from it
        knot[lone] = False
        leading = lambda order: order[np.unique(ring[order], return_index=True)[1]]
        first = leading(lone[np.lexsort((y[lone], x[lone], ring[lone]))])
        origin = np.empty(len(n), dtype=np.int64)
        origin[ring[first]] = first
        origin = origin[ring[lone]]
        away = (x[lone] - x[origin]) ** 2 + (y[lone] - y[origin]) ** 2
        far = leading(lone[np.lexsort((-y[lone], -x[lone], -away, ring[lone]))])
        knot[first] = knot[far] = True
    knots = np.flatnonzero(knot)
    of = ring[knots]
    per = np.bincount(of, minlength=len(n))
    leader = np.repeat(np.cumsum(per) - per, per)
    arc = np.arange(len(knots)) - leader
    last = arc == per[of] - 1
    size = np.where(last, knots[leader] + n[of], knots[np.where(last, 0, np.arange(len(knots)) + 1)]) - knots
    end = start[of] + (knots - start[of] + size) % n[of]
    turned = (x[knots] > x[end]) | ((x[knots] == x[end]) & (y[knots] > y[end]))
    arc_bounds = np.concatenate([[0], np.cumsum(size + 1)])
    mine = np.repeat(np.arange(len(knots)), size + 1)
    step = np.arange(len(mine)) - arc_bounds[mine]
    step = np.where(turned[mine], size[mine] - step, step)
    at = start[of][mine] + ((knots - start[of])[mine] + step) % n[of][mine]
    return of, arc, turned, _list_of_points(x[at], y[at], arc_bounds), knots


def ring_arcs(edges: DataFrame) -> DataFrame:
    """``feature_id, level, part, ring, role, arc, turned, key, once, pts``: rings cut where their neighbour changes, each arc from its smaller end.

    Neighbours so have the same arcs along their common border, of the same ``key``.  The first of those that share it has it ``once``, or twice if it
    has the border twice itself; ``turned`` tells who walks it the other way.
    """
    corner = F.struct("seq", F.col("x1").cast("double").alias("x"), F.col("y1").cast("double").alias("y"), "sides")
    rings = with_sides(with_part(edges)).groupBy(*_RING).agg(F.array_sort(F.collect_list(corner)).alias("corners"))
    kind = rings.schema["feature_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = {"level": pa.int32(), "part": pa.int32(), "ring": pa.int32()}
        for batch in batches:
            if not batch.num_rows:
                continue
            of, arc, turned, pts, begin = _cut_from(batch.column("corners"))
            own = [batch.column(c).take(pa.array(of)) for c in _RING]
            own = [v.cast(whole[c]) if c in whole else v for c, v in zip(_RING, own)]
            sides = pc.struct_field(batch.column("corners").flatten(), "sides").take(pa.array(begin))
            yield pa.RecordBatch.from_arrays([*own, pa.array(arc, pa.int32()), pa.array(turned), pts, sides], [*_RING, "arc", "turned", "pts", "sides"])

    schema = f"feature_id {kind}, level int, part int, ring int, role string, arc int, turned boolean, pts array<struct<x:double,y:double>>, sides string"
    made = rings.mapInArrow(run, schema).withColumn("key", F.xxhash64("level", "pts"))
    return made.withColumn("once", F.startswith(F.concat("sides", F.lit(",")), F.concat(F.col("feature_id").cast("string"), F.lit(",")))).drop("sides")


def _thinned(arcs: DataFrame) -> DataFrame:
    """``kept``: the corners of ``pts`` that the arc's ``tolerance`` leaves; all without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, x, y, bounds = _points_of(batch.column("pts"))
            tolerance = batch.column("tolerance").to_numpy(zero_copy_only=False)
            keep = thinned_lines(x, y, bounds, np.where(tolerance > 0, tolerance, -1.0))
            left = np.concatenate([[0], np.cumsum(keep)])[bounds]
            yield pa.RecordBatch.from_arrays([*batch.columns, _list_of_points(x[keep], y[keep], left)], [*batch.schema.names, "kept"])

    rows = arcs.drop("kept")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("kept", rows.schema["pts"].dataType)]))


def _arc_edges(made: DataFrame, *more: str) -> DataFrame:
    sides = F.posexplode(F.expr("arrays_zip(slice(kept, 1, size(kept) - 1), slice(kept, 2, size(kept) - 1))")).alias("i", "s")
    ends = [F.expr(f"CASE WHEN turned THEN s['{1 - k}'].{c} ELSE s['{k}'].{c} END").alias(f"{c}{k + 1}") for k in (0, 1) for c in ("x", "y")]
    return made.select(*_RING, "arc", "key", "turned", *more, sides).select(*_RING, "arc", "key", *more, "i", *ends)  # as the ring walks them


def _crossing_arcs(made: DataFrame) -> DataFrame:
    """``keya, keyb`` of arcs of a level that cross themselves or each other, whoever owns them, at least one of each two ``fresh``; edges meet within cells of their level's ``side``."""
    once = _arc_edges(made.filter("once"), "fresh", "side")
    low, high = F.floor(F.least("y1", "y2") / F.col("side")), F.floor(F.greatest("y1", "y2") / F.col("side"))
    cells = along(once.withColumn("band", F.explode(F.sequence(low, high))))
    a, b = (cells.select("level", "band", "col", *(F.col(c).alias(c + s) for c in ("key", "i", "fresh", "x1", "y1", "x2", "y2"))) for s in ("a", "b"))
    met = a.filter("fresha").join(b.hint("merge"), ["level", "band", "col"]).filter(f"(NOT freshb OR (keya, ia) < (keyb, ib)) AND {_APART}")
    return met.select("keya", "keyb").distinct()


def simplified_coverage(edges: DataFrame, tolerances: DataFrame) -> DataFrame:
    """``feature_id, part, ring, role, pts``: closed rings generalised by their level's policy, ``level, tolerance`` (null or absent: as they are); a feature is of one level.

    Arcs are generalised, so neighbours keep a common border.  Arcs that then cross an arc of their level, and those of features whose rings
    no longer fit each other, are generalised again by half their tolerance until nothing crosses; after ``MOST_HALVINGS`` they stay as they are.
    All arcs of a ring that would keep under three corners stay as they are.  A round looks only at what the last one changed: crossings of other arcs are
    carried on, and a smaller tolerance never keeps fewer corners.  So arcs that have all their corners are at no fault that could be mended: the first
    round looks at levels and features where an arc has lost some.
    """
    policy = F.broadcast(tolerances.select("level", F.col("tolerance").cast("double").alias("tolerance")))
    whole_numbers = {c: F.col(c).cast("int") for c in ("part", "ring")}
    ruled = with_part(edges).withColumns(whole_numbers).filter("x1 + y1 + x2 + y2 IS NOT NULL").join(policy, "level", "left").fillna(0.0, ["tolerance"])
    arcs = ring_arcs(ruled.filter("tolerance > 0").drop("tolerance")).join(policy, "level")
    arcs = written(_with_loss(_thinned(arcs)).withColumn("fresh", F.lit(True)), "arcs", "level")
    long = F.expr("aggregate(transform(slice(kept, 2, size(kept) - 1), (p, k) -> greatest(abs(p.x - kept[k].x), abs(p.y - kept[k].y))), 0D, (s, v) -> s + v)")
    lost = arcs.groupBy("level").agg(F.greatest(2 * F.sum(long) / F.sum(F.size("kept") - 1), F.lit(1e-9)).alias("side"), F.bool_or("lost").alias("lost"))
    side = {r["level"]: r["side"] for r in lost.filter("lost").collect()}  # a row a level
    made, standing = arcs.filter(F.col("level").isin(list(side))).withColumn("side", _side(side)), None
    whole = arcs.filter(~F.col("level").isin(list(side)))
    for n in range(MOST_HALVINGS + 2 if side else 0):
        several = (F.min("part") < F.max("part")) | (F.min("ring") < F.max("ring")) | F.bool_or(F.col("role") == "inner")  # else it is one outer ring, which fits
        seen = made.groupBy("feature_id").agg(F.bool_or("lost" if n == 0 else "fresh").alias("seen"), several.alias("several")).filter("seen").hint("merge")
        changed = made.join(seen, "feature_id", "left_semi")
        crossing = _crossing_arcs(made)
        crossing = written_wide(crossing if standing is None else crossing.unionByName(standing), "arcs-crossing")
        own = lambda s: changed.select("feature_id", *(F.col(c).alias(c + s) for c in ("key", "part", "ring")))  # noqa: B023, E731
        across = crossing.join(own("a"), "keya").join(own("b"), ["feature_id", "keyb"]).filter("(parta, ringa) <> (partb, ringb)").select("feature_id")
        nested = made.join(seen.filter("several").hint("merge"), "feature_id", "left_semi")
        as_rings = written_wide(_arc_edges(nested).withColumn("seq", F.col("arc") * 1_000_000 + F.col("i")), "arcs-nested")
        unfit = made.join(ring_faults(as_rings, crossings=False).select("feature_id").unionByName(across).distinct().hint("merge"), "feature_id", "left_semi")
        met = made.join(crossing.select(F.explode(F.array("keya", "keyb")).alias("key")).distinct().hint("merge"), "key", "left_semi")
        found = unfit.unionByName(met).filter("lost").select("key", F.lit(False).alias("flat"))
        if n == 0:
            few = made.groupBy(*_RING).agg(F.sum(F.size("kept") - 1).alias("n")).filter("n < 3").select(*_RING)
            found = found.unionByName(made.filter("lost").join(few, _RING, "left_semi").select("key", F.lit(True).alias("flat")))
        wrong = written_wide(found.groupBy("key").agg(F.bool_or("flat").alias("flat")), "arcs-wrong")
        if wrong.isEmpty():
            break
        kept = lambda c: wrong.select(F.col("key").alias(c))  # noqa: B023, E731
        standing = crossing.join(kept("keya"), "keya", "left_anti").join(kept("keyb"), "keyb", "left_anti").select("keya", "keyb")
        less = F.when(F.col("flat").isNull(), F.col("tolerance")).when(F.col("flat") | F.lit(n >= MOST_HALVINGS), F.lit(0.0)).otherwise(F.col("tolerance") / 2)
        again = made.join(wrong, "key", "left").withColumn("tolerance", less).withColumn("fresh", F.col("flat").isNotNull()).drop("flat")
        made = written(_with_loss(_thinned(again)), "arcs")
    part = F.struct("arc", F.expr("slice(CASE WHEN turned THEN reverse(kept) ELSE kept END, 1, size(kept) - 1)").alias("p"))
    cut = made.drop("side").unionByName(whole).groupBy(*_LINE).agg(F.flatten(F.transform(F.array_sort(F.collect_list(part)), lambda a: a["p"])).alias("open"))
    corner = F.struct("seq", F.col("x1").cast("double").alias("x"), F.col("y1").cast("double").alias("y"))
    as_is = ruled.filter("NOT tolerance > 0").groupBy(*_LINE).agg(F.transform(F.array_sort(F.collect_list(corner)), lambda p: F.struct(p["x"], p["y"])).alias("open"))
    return cut.unionByName(as_is).select(*_LINE, F.concat("open", F.slice("open", 1, 1)).alias("pts"))


def _with_loss(arcs: DataFrame) -> DataFrame:
    """Has the arc ``lost`` any of its corners?"""
    return arcs.withColumn("lost", F.size("kept") < F.size("pts"))


def arcs_of(line: list[tuple[float, float]], sides: list[str]) -> list[tuple[list[tuple[float, float]], bool]]:
    """The arcs of a ring in order, each from its smaller end, and whether the ring walks it the other way; ``sides[i]`` names the features along the edge from corner i on."""
    n = len(line)
    knots = [i for i in range(n) if sides[i] != sides[i - 1]]
    if len(knots) < 2:  # no neighbour, or one all around: the smallest corner and the one farthest from it
        first = line.index(min(line))
        far = max(range(n), key=lambda i: ((line[i][0] - line[first][0]) ** 2 + (line[i][1] - line[first][1]) ** 2, line[i]))
        knots = sorted({first, far})
    out = []
    for a, b in zip(knots, [*knots[1:], knots[0] + n]):
        arc = [line[i % n] for i in range(a, b + 1)]
        turned = arc[0] > arc[-1]
        out.append((arc[::-1] if turned else arc, turned))
    return out


def generalised(line: list[tuple[float, float]], sides: list[str], tolerance: float) -> list[tuple[float, float]]:
    """Corners that a ring keeps by itself."""
    kept: list[tuple[float, float]] = []
    for arc, turned in arcs_of(line, sides):
        some = [arc[i] for i in douglas_peucker(np.array([x for x, _ in arc]), np.array([y for _, y in arc]), tolerance)]
        kept += (some[::-1] if turned else some)[:-1]
    return kept if len(kept) >= 3 else line


def closed_edges(rings: DataFrame) -> DataFrame:
    """Edge rows of closed rings ``feature_id, part, ring, role, pts``."""
    sides = F.posexplode(F.expr("arrays_zip(slice(pts, 1, size(pts) - 1), slice(pts, 2, size(pts) - 1))")).alias("seq", "s")
    ends = [F.expr(f"s['{k}'].{c}").alias(f"{c}{k + 1}") for k in (0, 1) for c in ("x", "y")]
    return rings.select("feature_id", "part", "ring", "role", sides).select("feature_id", "part", "ring", "role", "seq", *ends)


def ring_arrays(edges: DataFrame) -> DataFrame:
    """``feature_id, ring, role, pts``: closed arrays of corners from edges."""
    corner = F.struct("seq", F.col("x1").cast("double").alias("x"), F.col("y1").cast("double").alias("y"))
    gathered = edges.groupBy("feature_id", "ring", "role").agg(F.array_sort(F.collect_list(corner)).alias("c"))
    open_ = F.transform("c", lambda p: F.struct(p["x"], p["y"]))
    return gathered.select("feature_id", "ring", "role", F.concat(open_, F.slice(open_, 1, 1)).alias("pts"))


def expanded(features: DataFrame, version: int = 3) -> DataFrame:
    """``feature_id, part, ring, role, n_points`` of ``feature_id, parts`` (arrays of rings of corners); empty rings are skipped.

    Version 1 keeps outer rings only. A feature without any part is an error.
    """
    parts = features.select("feature_id", F.posexplode_outer("parts").alias("part", "rings"))
    checked = parts.withColumn("part", F.coalesce("part", F.raise_error(F.concat(F.lit("no part in feature "), F.col("feature_id").cast("string"))).cast("int")))
    rings = checked.select("feature_id", "part", F.posexplode("rings").alias("ring", "pts")).filter("size(pts) > 0")
    rows = rings.select("feature_id", "part", "ring", F.when(F.col("ring") == 0, "outer").otherwise("inner").alias("role"), F.size("pts").alias("n_points"))
    return rows.filter("ring = 0") if version == 1 else rows


def split_at_antimeridian(rings: DataFrame) -> DataFrame:
    """``feature_id, part, pts`` of closed rings ``feature_id, pts``, as ``rings.split_at_antimeridian`` does it for edges."""
    from limes.operators.rings import split_at_antimeridian as cut_features

    at = lambda i: F.element_at("pts", i)
    sides = rings.select("feature_id", "pts", F.explode(F.sequence(F.lit(1), F.size("pts") - 1)).alias("i"))
    edges = sides.select("feature_id", at(F.col("i"))["x"].alias("x1"), at(F.col("i"))["y"].alias("y1"), at(F.col("i") + 1)["x"].alias("x2"), at(F.col("i") + 1)["y"].alias("y2"))
    return cut_features(edges).select("feature_id", "part", "pts")

"""Corners where lines cross: lines of a group are cut at their crossings, and where one ends on another, before rings are walked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.operators.geometry import along
from limes.session import written_wide


def _turn(p: str, q: str, r: str) -> str:
    return f"((x{q} - x{p}) * (y{r} - y{p}) - (y{q} - y{p}) * (x{r} - x{p}))"


def crossings(segments: DataFrame, group: str) -> DataFrame:
    """``line, i, t, x, y``: where segment ``i`` of a line has to be cut, ``t`` the square of the distance from its start.

    ``segments`` is ``group, line, i, x1, y1, x2, y2``.  Segments meet only where they pass one cell of their group's own grid, which has about as
    many rows as the root of its number of segments; a group of any size is so spread over its cells.  Two segments that cross are cut at one
    and the same point; a segment on which another ends, or that overlaps it, is cut at that end.
    """
    box = segments.groupBy(group).agg(
        F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2")), F.lit(1e-9)).alias("span"), F.ceil(F.sqrt(F.count("*"))).alias("rows")
    )
    # sorted on both sides: Spark takes sizes from the files below, which are a small part of what cells and groups hold, and would broadcast either
    sided = segments.filter("x1 <> x2 OR y1 <> y2").join(box.select(group, (F.col("span") / F.col("rows")).alias("side")).hint("merge"), group)
    low, high = F.floor(F.least("y1", "y2") / F.col("side") - 1e-9), F.floor(F.greatest("y1", "y2") / F.col("side") + 1e-9)
    cells = along(sided.withColumn("band", F.explode(F.sequence(low, high))))
    a, b = (cells.select(group, "band", "col", *(F.col(c).alias(c + s) for c in ("line", "i", "x1", "y1", "x2", "y2"))) for s in ("a", "b"))
    met = a.join(b.hint("merge"), [group, "band", "col"]).filter("(linea, ia) < (lineb, ib)").filter("least(x1a, x2a) <= greatest(x1b, x2b) AND least(x1b, x2b) <= greatest(x1a, x2a) AND least(y1a, y2a) <= greatest(y1b, y2b) AND least(y1b, y2b) <= greatest(y1a, y2a)")
    met = met.selectExpr("*", *(f"{_turn(*t)} AS {n}" for n, t in (("b1", ("1a", "2a", "1b")), ("b2", ("1a", "2a", "2b")), ("a1", ("1b", "2b", "1a")), ("a2", ("1b", "2b", "2a")))))
    met = met.filter("sign(b1) * sign(b2) <= 0 AND sign(a1) * sign(a2) <= 0")
    crossing = "b1 <> 0 AND b2 <> 0 AND a1 <> 0 AND a2 <> 0"
    at = {"x": "x1a + (x2a - x1a) * a1 / (a1 - a2)", "y": "y1a + (y2a - y1a) * a1 / (a1 - a2)"}
    cut = lambda s, when, x, y: f"CASE WHEN {when} THEN named_struct('line', line{s}, 'i', i{s}, 't', pow({x} - x1{s}, 2) + pow({y} - y1{s}, 2), 'x', {x}, 'y', {y}) END"
    ends = [(s, f"{o}{k} = 0 AND x{k}{o} BETWEEN least(x1{s}, x2{s}) AND greatest(x1{s}, x2{s}) AND y{k}{o} BETWEEN least(y1{s}, y2{s}) AND greatest(y1{s}, y2{s}) AND (x{k}{o}, y{k}{o}) <> (x1{s}, y1{s}) AND (x{k}{o}, y{k}{o}) <> (x2{s}, y2{s})", f"x{k}{o}", f"y{k}{o}") for s, o in (("a", "b"), ("b", "a")) for k in (1, 2)]
    every = [cut("a", crossing, "px", "py"), cut("b", crossing, "px", "py"), *(cut(*e) for e in ends)]
    met = met.selectExpr("*", *(f"CASE WHEN {crossing} THEN {v} END AS p{c}" for c, v in at.items()))
    return met.select(F.explode(F.expr(f"filter(array({', '.join(every)}), c -> c IS NOT NULL)")).alias("c")).select("c.*").distinct()


def noded(members: DataFrame) -> DataFrame:
    """Lines ``rel, role, ref, pts`` with a corner more wherever they meet another line of their relation; lines without a role stay as they are.

    Relations that reach both below -120 and above 120 degrees are unwrapped for it.
    """
    rows = written_wide(members.select("rel", "role", "ref", "pts").withColumn("line", F.monotonically_increasing_id()), "lines")
    lines = rows.filter("rel IS NOT NULL AND role IS NOT NULL AND size(pts) > 1")
    pairs = lines.select("rel", "line", F.posexplode(F.expr("arrays_zip(slice(pts, 1, size(pts) - 1), slice(pts, 2, size(pts) - 1))")).alias("i", "s"))
    raw = pairs.selectExpr("rel", "line", "i", "CAST(s['0'].x AS DOUBLE) AS x1", "CAST(s['0'].y AS DOUBLE) AS y1", "CAST(s['1'].x AS DOUBLE) AS x2", "CAST(s['1'].y AS DOUBLE) AS y2")
    wide = raw.groupBy("rel").agg((F.min(F.least("x1", "x2")) < -120).alias("west"), (F.max(F.greatest("x1", "x2")) > 120).alias("east")).filter("west AND east").select("rel", F.lit(True).alias("turned"))
    ahead = lambda c: F.when(F.col("turned") & (F.col(c) < 0), F.col(c) + 360).otherwise(F.col(c)).alias(c)
    placed = raw.join(wide, "rel", "left").select("rel", "line", "i", ahead("x1"), "y1", ahead("x2"), "y2")
    cuts = crossings(placed, "rel").select("line", F.struct("i", "t", "x", "y").alias("c"))
    cuts = cuts.groupBy("line").agg(F.array_sort(F.collect_list("c")).alias("cuts"))
    more = "flatten(transform(pts, (p, k) -> concat(array(p), transform(filter(cuts, c -> c.i = k), c -> named_struct('x', CASE WHEN turned AND c.x > 180 THEN c.x - 360 ELSE c.x END, 'y', c.y)))))"
    shape = "transform(pts, p -> named_struct('x', CAST(p.x AS DOUBLE), 'y', CAST(p.y AS DOUBLE)))"
    cut = rows.withColumn("pts", F.expr(shape)).join(cuts, "line", "left").join(wide, "rel", "left")
    return cut.select("rel", "role", "ref", F.expr(f"CASE WHEN cuts IS NULL THEN pts ELSE {more} END").alias("pts"))

"""Point lookups: containment, nearest borders, shapes, repair and invariants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.operators.geometry import Sides, along, bands, containing
from limes.session import raised_if_empty, spread

#: of a degree of latitude
KM_PER_DEGREE = 111.32


def point_lookup(points: DataFrame, edges: DataFrame, cell: Sides) -> DataFrame:
    """``pid, feature_id, level``; a stateless join, so ``points`` may be a stream."""
    levels = edges.select("feature_id", "level").distinct()
    return containing(points, edges, cell).join(levels, "feature_id").select("pid", "feature_id", "level")


def parents(children: DataFrame, edges: DataFrame, levels: list[int], cell: Sides) -> DataFrame:
    """``feature_id, parent``: for each two adjacent levels the polygon that strictly holds the child's point ``feature_id, level, px, py``.

    Of several the one with the largest id; a child whose next level has no polygon around it gets none, even if a higher one does.
    """
    above = F.create_map(*(F.lit(x) for a, b in zip(levels, levels[1:]) for x in (b, a)))
    points = children.select(F.col("feature_id").alias("pid"), F.try_element_at(above, F.col("level")).alias("above"), "px", "py").filter("above IS NOT NULL")
    hits = containing(points.select("pid", "px", "py"), edges, cell, "within")
    level_of = edges.select("feature_id", F.col("level").alias("above")).distinct()
    found = hits.join(level_of, "feature_id").join(points.select("pid", "above"), ["pid", "above"]).groupBy("pid").agg(F.max("feature_id").alias("parent"))
    return children.select("feature_id", "level").join(found.withColumnRenamed("pid", "feature_id"), "feature_id", "left")


def covered_by(points: DataFrame, edges: DataFrame, cell: Sides) -> DataFrame:
    """Points in any of the polygons or on a border; existence only."""
    return points.join(containing(points.select("pid", "px", "py"), edges, cell, "covers").select("pid"), "pid", "left_semi")


def scope_flags(points: DataFrame, boundary: DataFrame | None, cell: Sides) -> DataFrame:
    """``pid, in_scope``: null without a boundary."""
    if boundary is None:
        return points.select("pid", F.lit(None).cast("boolean").alias("in_scope"))
    hit = containing(points, boundary, cell, "covers").select("pid").distinct().withColumn("in_scope", F.lit(True))
    return points.select("pid").join(hit, "pid", "left").select("pid", F.coalesce("in_scope", F.lit(False)).alias("in_scope"))


def segment_distance(px: Column, py: Column, wide: Column | float = 1.0, high: Column | float = 1.0) -> Column:
    """Distance of (px, py) from the segment x1, y1, x2, y2 of the row; ``wide`` and ``high`` are the lengths of a unit of x and y."""
    x1, x2, y1, y2 = ((F.col(c) - o) * s for c, o, s in (("x1", px, wide), ("x2", px, wide), ("y1", py, high), ("y2", py, high)))
    dx, dy = x2 - x1, y2 - y1
    along_ = -(x1 * dx + y1 * dy) / F.nullif(dx * dx + dy * dy, F.lit(0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along_, F.lit(0.0))))
    return F.sqrt(F.pow(x1 + t * dx, 2) + F.pow(y1 + t * dy, 2))


def nearest(points: DataFrame, edges: DataFrame, most: float) -> DataFrame:
    """``pid, level, feature_id, distance``: the nearest border within ``most``, for each level; ties go to the smaller id.

    An edge is listed in the cells of side ``most`` along its line, a point looks into its own cell and those around it.
    """
    return _nearest(points, edges, most)


def _columns(band: Column, high: float) -> Column:
    """How many columns a row band of ``high`` degrees has: each as wide as a band is high, at the highest latitude of the band and its neighbours."""
    low, top = (band - 1) * high, (band + 2) * high
    pole = F.floor((low + 90) / 180) != F.floor((top + 90) / 180)
    least = F.when(pole, 0.0).otherwise(F.least(F.abs(F.cos(F.radians(low))), F.abs(F.cos(F.radians(top)))))
    return F.greatest(F.lit(1), F.floor(360 * least / high)).cast("long")


def nearest_km(points: DataFrame, edges: DataFrame, most_km: float) -> DataFrame:
    """As ``nearest`` for longitudes and latitudes, with distances in km by scaling degrees at the point's latitude, anywhere on the globe.

    The globe is cut into row bands ``most_km`` high, each band into columns of its own width, which close up at 180 degrees.  An edge is listed in the
    cells along its line, a point looks into the columns in reach of its own band and of the two beside it: some nine cells, and
    all of a band near a pole.  An edge between longitudes more than 180 degrees apart goes the short way, over 180.  Latitudes past 90 are
    scaled by the size of their cosine.  Edges of a level that lie on each other are one, of the smallest id, which wins their ties.
    """
    high = most_km / KM_PER_DEGREE
    once = edges.groupBy("level", "x1", "y1", "x2", "y2").agg(F.min("feature_id").alias("feature_id"))
    flat = once.withColumns({"x1": F.col("x1").cast("double"), "x2": F.col("x2").cast("double")})
    ahead = flat.withColumns({"x1": F.when(F.col("x2") - F.col("x1") > 180, F.col("x1") + 360).otherwise(F.col("x1")), "x2": F.when(F.col("x1") - F.col("x2") > 180, F.col("x2") + 360).otherwise(F.col("x2"))})
    width = 360 / F.col("columns")
    banded = bands(ahead, high).withColumn("columns", _columns(F.col("band"), high))
    cells = along(banded, width).select("feature_id", "level", "x1", "y1", "x2", "y2", "band", F.pmod("col", "columns").alias("col")).distinct()
    reach = F.least(F.lit(181.0), F.lit(high) / F.greatest(F.lit(1e-12), F.abs(F.cos(F.radians(F.col("py"))))))
    own = points.withColumn("reach", reach).withColumn("band", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("py") / high) + d)))
    own = own.withColumn("columns", _columns(F.col("band"), high))
    low, to = F.floor((F.col("px") - F.col("reach")) / width - 1e-9), F.floor((F.col("px") + F.col("reach")) / width + 1e-9)
    own = own.withColumn("col", F.explode(F.sequence(low, F.least(to, low + F.col("columns") - 1)))).withColumn("col", F.pmod("col", "columns")).drop("columns")
    near = spread(own, "band", "col").join(spread(cells, "band", "col"), ["band", "col"])
    # the copy of an edge whose middle is nearest is the nearest one, unless the point's reach goes around
    turns = F.round((F.col("px") - (F.col("x1") + F.col("x2")) / 2) / 360) * 360
    copies = F.when(F.col("reach") + F.abs(F.col("x2") - F.col("x1")) / 2 >= 180, F.array(turns, turns - 360, turns + 360)).otherwise(F.array(turns))
    turned = near.withColumn("turn", F.explode(copies)).select("pid", "level", "feature_id", "py", (F.col("px") - F.col("turn")).alias("px"), "x1", "y1", "x2", "y2", (F.cos(F.radians(F.col("py"))) * KM_PER_DEGREE).alias("wide"))
    return _best(turned.withColumn("d", segment_distance(F.col("px"), F.col("py"), F.col("wide"), KM_PER_DEGREE)).filter(F.col("d") <= most_km))


def _nearest(points: DataFrame, edges: DataFrame, side: float) -> DataFrame:
    cells = along(bands(edges, side)).select("feature_id", "level", "x1", "y1", "x2", "y2", "band", "col")
    around = lambda c: F.explode(F.sequence(F.floor(F.col(f"p{c}") / side) - 1, F.floor(F.col(f"p{c}") / side) + 1))
    near = points.withColumn("band", around("y")).withColumn("col", around("x")).join(cells, ["band", "col"])
    return _best(near.withColumn("d", segment_distance(F.col("px"), F.col("py"))).filter(F.col("d") <= side))


def _best(near: DataFrame) -> DataFrame:
    best = near.groupBy("pid", "level").agg(F.min(F.struct("d", "feature_id")).alias("best"))
    return best.select("pid", "level", "best.feature_id", F.col("best.d").alias("distance"))


def nearby_class(points: DataFrame, edges: DataFrame, cell: Sides, nearby: float, offshore: float) -> DataFrame:
    """``pid, class``: inside, nearby, offshore or outside, by distance to the nearest border."""
    return _nearby(points, edges, cell, nearby, offshore, nearest)


def nearby_class_km(points: DataFrame, edges: DataFrame, cell: Sides, nearby_km: float = 2.0, offshore_km: float = 20.0) -> DataFrame:
    """As ``nearby_class``, by km; without other limits those that most countries have."""
    return _nearby(points, edges, cell, nearby_km, offshore_km, nearest_km)


def _nearby(points: DataFrame, edges: DataFrame, cell: Sides, nearby: float, offshore: float, find: Callable[[DataFrame, DataFrame, float], DataFrame]) -> DataFrame:
    hit = containing(points, edges, cell).select("pid").distinct().withColumn("hit", F.lit(True))
    open_ = points.join(hit, "pid", "left_anti")
    close = find(open_, edges, offshore).groupBy("pid").agg(F.min("distance").alias("d"))
    kind = F.when(F.col("hit"), "inside").when(F.col("d") <= nearby, "nearby").when(F.col("d") <= offshore, "offshore").otherwise("outside")
    return points.select("pid").join(hit, "pid", "left").join(close, "pid", "left").select("pid", kind.alias("class"))


def shape_of(levels: Column) -> Column:
    return F.array_join(F.array_sort(levels).cast("array<string>"), "-")


def lookup_shapes(points: DataFrame, hits: DataFrame, policy: DataFrame) -> DataFrame:
    """``pid, shape, status``: the levels hit, and their status by ``policy(shape, status)``; others fail."""
    shapes = hits.groupBy("pid").agg(shape_of(F.collect_set("level")).alias("shape"))
    rows = points.select("pid").join(shapes, "pid", "left").withColumn("shape", F.coalesce("shape", F.lit("")))
    return rows.join(F.broadcast(policy), "shape", "left").select("pid", "shape", F.coalesce("status", F.lit("failed")).alias("status"))


def lookup_shapes_by_country(points: DataFrame, hits: DataFrame, policies: DataFrame) -> DataFrame:
    """``pid, country, shape, status``: as ``lookup_shapes``, each point by its country's rows of ``policies(country, shape, status)``.

    A point that hits nothing, or has a country without policies or none, fails.
    """
    shapes = hits.groupBy("pid").agg(shape_of(F.collect_set("level")).alias("shape"))
    rows = points.select("pid", "country").join(shapes, "pid", "left").withColumn("shape", F.coalesce("shape", F.lit("")))
    return rows.join(policies, ["country", "shape"], "left").select("pid", "country", "shape", F.coalesce("status", F.lit("failed")).alias("status"))


def repaired(hits: DataFrame, ancestors: DataFrame, parent_level: int, child_levels: list[int]) -> DataFrame:
    """Hits plus the ancestors at ``parent_level`` of hits at ``child_levels``, for points that hit nothing at that level."""
    have = hits.filter(F.col("level") == parent_level).select("pid")
    lacking = hits.filter(F.col("level").isin(child_levels)).join(have, "pid", "left_anti")
    up = ancestors.filter(F.col("ancestor_level") == parent_level).select(F.col("id").alias("feature_id"), F.col("ancestor_id").alias("up"))
    made = lacking.join(up, "feature_id").groupBy("pid").agg(F.min("up").alias("feature_id")).select("pid", "feature_id", F.lit(parent_level).alias("level"), F.lit(True).alias("repaired"))
    return hits.select("pid", "feature_id", "level", F.lit(False).alias("repaired")).unionByName(made)


def structural_violations(hits: DataFrame, parents_of: DataFrame) -> DataFrame:
    """``pid, reason``: a level that is hit twice, or hits at the deepest levels whose parent is not among the hits of its level."""
    twice = hits.groupBy("pid", "level").count().filter("count > 1").select("pid", F.lit("duplicate_level").alias("reason")).distinct()
    up = hits.join(parents_of, "feature_id").select("pid", "parent_id", "parent_level")
    at = hits.select("pid", F.col("level").alias("parent_level"), F.col("feature_id").alias("hit_parent"))
    other = up.join(at, ["pid", "parent_level"]).groupBy("pid").agg(F.max((F.col("parent_id") == F.col("hit_parent")).cast("int")).alias("ok")).filter("ok = 0").select("pid", F.lit("branching_parent").alias("reason"))
    return twice.unionByName(other)


def order_violations(listed: DataFrame) -> DataFrame:
    """``pid, reason`` of results ``pid, pos, feature_id, level``: levels must ascend, and ids within a level as well."""
    before = Window.partitionBy("pid").orderBy("pos")
    steps = listed.select("pid", "level", "feature_id", F.lag("level").over(before).alias("l"), F.lag("feature_id").over(before).alias("f"))
    reason = F.when(F.col("level") < F.col("l"), "level_order").when((F.col("level") == F.col("l")) & (F.col("feature_id") <= F.col("f")), "id_order")
    return steps.select("pid", reason.alias("reason")).filter("reason IS NOT NULL").distinct()


def in_scope(features: DataFrame, points: DataFrame, edges: DataFrame, names: DataFrame, level: int, cell: Sides) -> DataFrame:
    """Features ``id, level, name`` inside those of ``level`` that ``names(name)`` lists, which stay themselves; all if no such feature is there.

    ``points(feature_id, px, py)`` are the features' representative points.
    """
    allowed = features.filter(F.col("level") == level).join(names, "name", "left_semi")
    inside = edges.join(allowed.select(F.col("id").alias("feature_id")), "feature_id", "left_semi")
    held = containing(points.select(F.col("feature_id").alias("pid"), "px", "py"), inside, cell, "covers").select(F.col("pid").alias("id")).distinct()
    scoped = features.filter(F.col("level") != level).join(held, "id", "left_semi").unionByName(allowed)
    some = allowed.agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(1).alias("__some"))  # one row at most
    everything = features.withColumn("__some", F.lit(1)).join(F.broadcast(some), "__some", "left_anti").drop("__some")
    return scoped.select(*features.columns).unionByName(everything)


def country_features(features: DataFrame, points: DataFrame, boundary: DataFrame, cell: Sides) -> DataFrame:
    """Features whose representative point the boundary covers; reading the result is an error if there is none."""
    held = covered_by(points.withColumnRenamed("feature_id", "pid"), boundary, cell).select(F.col("pid").alias("id"))
    kept = features.join(held, "id", "left_semi")
    return kept.unionByName(raised_if_empty(kept, "no feature is inside the country"))

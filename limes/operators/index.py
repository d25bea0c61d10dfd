"""Quantised spatial-index tables with running offsets, and lookups on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.functions.numbers import STEPS, quantize
from limes.operators.geometry import containing, with_part
from limes.session import written, written_wide

VERSIONS = (1, 2, 3)


def with_offsets(rows: DataFrame, order: list[str], sizes: dict[str, str]) -> DataFrame:
    """Dense ``index`` and running offsets (name: size column) in a global order, without a window over all rows.

    Rows are range-partitioned, written, summed by partition; each partition then starts from the total of those before it.
    """
    placed = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    placed = written(placed, "offsets")
    sums = placed.groupBy("__part").agg(F.count("*").alias("__index"), *(F.sum(c).alias(f"__{n}") for n, c in sizes.items()))
    names = {"index": "__index", **{n: f"__{n}" for n in sizes}}
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sums.select("__part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_0") for c in names.values()))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(starts, "__part")
    counted = joined.select(
        *rows.columns,
        (F.col("__index_0") + F.coalesce(F.count("*").over(inside), F.lit(0))).alias("index"),
        *((F.col(f"__{n}_0") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sizes.items()),
    )
    return counted


def part_boxes(edges: DataFrame) -> DataFrame:
    """The box of each part over all its rings; the doubles quantise, the float columns only reject and are an ulp wider."""
    box = with_part(edges).groupBy("feature_id", "level", "part").agg(F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"), F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"))
    ulp = lambda c: F.greatest(F.abs(F.col(c)), F.lit(1e-30)) * F.lit(2.0**-23)
    floats = [((F.col(c) - ulp(c)) if c.startswith("min") else (F.col(c) + ulp(c))).cast("float").alias(f"{c}_f") for c in ("minx", "miny", "maxx", "maxy")]
    return box.select("*", *floats).withColumn("spanx", F.col("maxx") - F.col("minx")).withColumn("spany", F.col("maxy") - F.col("miny"))


def ring_sizes(edges: DataFrame) -> DataFrame:
    """``level, feature_id, part, ring, role, n_points`` of every ring, from which all indexes follow."""
    return with_part(edges).groupBy("level", "feature_id", "part", "ring", "role").agg(F.count("*").alias("n_points"))


def _part_sizes(rings: DataFrame) -> DataFrame:
    once = rings.groupBy("level", "feature_id", "part", "ring").agg(F.sum("n_points").alias("n_points"))  # a ring of two roles is one
    return once.groupBy("level", "feature_id", "part").agg(F.count("ring").alias("n_rings"), F.sum("n_points").alias("n_points"))


def feature_index(edges: DataFrame) -> DataFrame:
    """``feature_id, level, index, part_start, n_parts, ring_start, n_rings, byte_start, n_bytes``: features by level and id; two 16-bit numbers a corner."""
    return _feature_index(ring_sizes(edges))


def _feature_index(rings: DataFrame) -> DataFrame:
    held = F.when(F.col("part").isNotNull(), F.col("n_rings")).otherwise(F.lit(0))
    sized = _part_sizes(rings).groupBy("feature_id", "level").agg(F.count("part").alias("n_parts"), F.sum(held).alias("n_rings"), (F.sum("n_points") * 4).alias("n_bytes"))
    return with_offsets(sized, ["level", "feature_id"], {"part_start": "n_parts", "ring_start": "n_rings", "byte_start": "n_bytes"})


def geometry_index(edges: DataFrame) -> DataFrame:
    """``index, feature_id, part, ring_start, n_rings``: one row for each part, by level, feature and part."""
    return _geometry_index(ring_sizes(edges))


def _geometry_index(rings: DataFrame) -> DataFrame:
    return with_offsets(_part_sizes(rings).drop("n_points"), ["level", "feature_id", "part"], {"ring_start": "n_rings"})


def ring_index(edges: DataFrame) -> DataFrame:
    """``index, feature_id, part, ring, role, byte_start, n_points``: one row for each ring, outer ones first."""
    return _ring_index(ring_sizes(edges))


def _ring_index(rings: DataFrame) -> DataFrame:
    sized = rings.withColumn("n_bytes", F.col("n_points") * 4)
    return with_offsets(sized.withColumn("is_inner", F.col("role") == "inner"), ["level", "feature_id", "part", "is_inner", "ring"], {"byte_start": "n_bytes"}).drop("is_inner", "n_bytes")


def write_index(edges: DataFrame, path: str, version: int = 3) -> None:
    """The five tables of an index, each in a folder of its own, with the version that lookups check; version 1 has outer rings only.

    Edges are read three times, for rings, boxes and corners; the indexes follow from the rings, corners from the boxes that were written.
    """
    edges = with_part(edges)
    edges = edges.filter("role <> 'inner'") if version_checked(version, allow_first=True) == 1 else edges
    rings = written_wide(ring_sizes(edges), "ring-sizes")
    boxes = part_boxes(edges)
    made = {
        "features": lambda: _feature_index(rings),
        "parts": lambda: _geometry_index(rings),
        "boxes": lambda: boxes,
        "rings": lambda: _ring_index(rings),
        "corners": lambda: _quantized(edges, edges.sparkSession.read.schema(boxes.schema).parquet(f"{path}/boxes").hint("merge")),
    }
    for name, rows in made.items():
        rows().withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{path}/{name}")


def quantized_rings(edges: DataFrame) -> DataFrame:
    """Corners on the grid of their part's box."""
    return _quantized(edges, part_boxes(edges))


def _quantized(edges: DataFrame, boxes: DataFrame) -> DataFrame:
    rows = with_part(edges).join(boxes.drop("level"), ["feature_id", "part"])
    q = {f"q{c}": quantize(F.col(c), F.col(f"min{c[0]}"), F.col(f"span{c[0]}")) for c in ("x1", "y1", "x2", "y2")}
    return rows.select("feature_id", "level", "part", "ring", "role", "seq", *(v.alias(k) for k, v in q.items()))


def version_checked(version: int, allow_first: bool = False) -> int:
    if version not in VERSIONS:
        raise ValueError(f"no index version {version}")
    if version == 1 and not allow_first:
        raise ValueError("version 1 has outer rings only; allow it explicitly")
    return version


def quantized_hits(points: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """``pid, feature_id`` by integer parity on each part's own grid; boxes reject first."""
    return _hits(points, part_boxes(edges), quantized_rings(edges), cell)


def index_lookup(spark: SparkSession, points: DataFrame, path: str, cell: float, allow_first: bool = False) -> DataFrame:
    """Hits in a written index.  Any other version than 2 and 3 is an error, but for version 1 where it is allowed."""
    boxes, corners = (spark.read.parquet(f"{path}/{t}") for t in ("boxes", "corners"))
    good = F.col("version").isin(*(VERSIONS if allow_first else VERSIONS[1:]))
    refused = F.raise_error(F.concat(F.lit("index version is not read: "), F.col("version").cast("string"))).cast("boolean")
    return _hits(points, boxes.filter(F.when(good, F.lit(True)).otherwise(refused)), corners, cell)


def _hits(points: DataFrame, boxes: DataFrame, corners: DataFrame, cell: float) -> DataFrame:
    """A point meets the boxes of its cell, and of a part only the edges in its own row band of the part's grid, some eight a band."""
    rows = corners.groupBy("feature_id", "part").agg(F.least(F.lit(STEPS), F.ceil(F.count("*") / 8)).cast("long").alias("rows"))
    outline = boxes.select("feature_id", "part", F.explode(F.sequence(F.floor(F.col("minx") / cell), F.floor(F.col("maxx") / cell))).alias("col"), *("miny", "maxy", "minx", "maxx", "spanx", "spany", "minx_f", "miny_f", "maxx_f", "maxy_f"))
    outline = outline.withColumn("band", F.explode(F.sequence(F.floor(F.col("miny") / cell), F.floor(F.col("maxy") / cell))))
    placed = points.withColumn("band", F.floor(F.col("py") / cell)).withColumn("col", F.floor(F.col("px") / cell))
    near = placed.join(outline, ["band", "col"]).filter("px BETWEEN minx_f AND maxx_f AND py BETWEEN miny_f AND maxy_f").filter("px BETWEEN minx AND maxx AND py BETWEEN miny AND maxy")
    local = near.select("pid", "feature_id", "part", quantize(F.col("px"), F.col("minx"), F.col("spanx")).cast("long").alias("qx"), quantize(F.col("py"), F.col("miny"), F.col("spany")).cast("long").alias("qy"))
    row = lambda q: F.expr(f"{q} * rows div {STEPS + 1}")
    q = corners.select("feature_id", "part", *(F.col(c).cast("long").alias(c) for c in ("qx1", "qy1", "qx2", "qy2"))).filter("qy1 <> qy2").join(rows, ["feature_id", "part"])
    q = q.withColumn("row", F.explode(F.sequence(row("least(qy1, qy2)"), row("greatest(qy1, qy2)")))).drop("rows")
    side = "(qx2 - qx1) * (qy - qy1) - (qy2 - qy1) * (qx - qx1)"
    crosses = F.expr(f"(qy1 > qy) <> (qy2 > qy) AND CASE WHEN qy2 > qy1 THEN {side} > 0 ELSE {side} < 0 END")
    tested = local.join(rows, ["feature_id", "part"]).withColumn("row", row("qy")).join(q, ["feature_id", "part", "row"])
    counted = tested.groupBy("pid", "feature_id", "part").agg(F.sum(crosses.cast("int")).alias("n"))
    return counted.filter("n % 2 = 1").select("pid", "feature_id").distinct()


def hit_differences(points: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """``pid, feature_id, only``: hits that only the exact or only the quantised lookup has."""
    exact = containing(points, edges, cell).withColumn("exact", F.lit(True))
    grid = quantized_hits(points, edges, cell).withColumn("grid", F.lit(True))
    both = exact.join(grid, ["pid", "feature_id"], "full")
    return both.filter("exact IS NULL OR grid IS NULL").select("pid", "feature_id", F.when(F.col("exact"), "exact").otherwise("quantised").alias("only"))


def export_totals(edges: DataFrame) -> DataFrame:
    """One row: features, parts, rings and bytes of corners."""
    return with_part(edges).agg(F.countDistinct("feature_id").alias("features"), F.countDistinct("feature_id", "part").alias("parts"), F.countDistinct("feature_id", "part", "ring").alias("rings"), (F.count("*") * 4).alias("geometry_bytes"))

"""Parents and children: edges, roots, paths, cycles, supplements, overrides and regions by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.functions.numbers import path_signature
from limes.operators.index import with_offsets
from limes.session import written, written_wide


def resolved(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges by parent name: those whose name exactly one node has, and the rest."""
    index = nodes.filter("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("n"), F.min("id").alias("parent"))
    joined = edges.join(index.withColumnRenamed("name", "parent_name"), "parent_name", "left")
    return joined.filter("n = 1").select("parent", "child", "method", "confidence"), joined.filter("n IS NULL OR n > 1").select("parent_name", "child", "method", "confidence")


def inside(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both of whose ends are nodes."""
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "parent"), "parent", "left_semi").join(ids.withColumnRenamed("id", "child"), "child", "left_semi")


def dataset_edges(nodes: DataFrame) -> DataFrame:
    return nodes.filter("parent_id IS NOT NULL").select(F.col("parent_id").alias("parent"), F.col("id").alias("child"), F.lit("dataset_parent").alias("method"), F.lit(1.0).alias("confidence"))


def report(nodes: DataFrame, edges: DataFrame, unresolved: DataFrame) -> DataFrame:
    """``what, n``: nodes, edges, unresolved edges and nodes by level."""
    one = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    levels = nodes.groupBy("level").agg(F.count("*").alias("n")).select(F.concat(F.lit("level "), F.coalesce(F.col("level").cast("string"), F.lit("none"))).alias("what"), "n")
    return one(nodes, "nodes").unionByName(one(edges, "edges")).unionByName(one(unresolved, "unresolved")).unionByName(levels)


def roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.join(edges.select(F.col("child").alias("id")), "id", "left_anti")


def paths(nodes: DataFrame) -> DataFrame:
    """``id, path_ids`` from the root down, to any depth; nodes without a way up to a root are not in the result.

    Ways are put together by doubling: each round joins every open way to the way of the node it has come to, so a depth of n takes log n rounds.
    A way that comes to a node twice is behind a cycle and ends.
    """
    up = nodes.select("id", F.col("parent_id").alias("up"), F.array("id").alias("path_ids"))
    done, open_ = up.filter("up IS NULL"), written(up.filter("up IS NOT NULL"), "paths-open")
    while not open_.isEmpty():
        ahead = done.unionByName(open_).select(F.col("id").alias("up"), F.col("up").alias("further"), F.col("path_ids").alias("before"))
        longer = open_.join(ahead, "up").select("id", F.col("further").alias("up"), F.concat("before", "path_ids").alias("path_ids"))
        longer = written(longer.filter("size(array_distinct(path_ids)) = size(path_ids) AND NOT coalesce(array_contains(path_ids, up), false)"), "paths-longer")
        done, open_ = done.unionByName(longer.filter("up IS NULL")), longer.filter("up IS NOT NULL")
    return done.select("id", "path_ids")


def branch_identity(nodes: DataFrame) -> DataFrame:
    """Root, branch, path and signature of every node that reaches a root."""
    p = paths(nodes)
    return p.select("id", F.element_at("path_ids", 1).alias("root_id"), F.coalesce(F.try_element_at("path_ids", F.lit(2)), F.element_at("path_ids", 1)).alias("branch_id"), "path_ids", path_signature(F.col("path_ids")).alias("path_signature"))


def tree_listing(nodes: DataFrame, edges: DataFrame, skip_unlevelled: bool = False) -> DataFrame:
    """``root, id, depth, sort_path``: preorder by name and id below every root, to any depth; a root lists a node once, where the walk first comes to it.

    That is the node's smallest way down that passes no node twice: every round carries on only the ways that are smaller than what the
    root had for a node, so shared children do not multiply, and it ends when no way gets smaller.  With ``skip_unlevelled`` nodes
    without a level are passed but not listed, and add no depth, so their children come below the nearest listed one.
    """
    told = F.lit(True) if not skip_unlevelled else F.col("level").isNotNull()
    named = nodes.select("id", F.coalesce("name", F.lit("")).alias("name"), told.alias("told"))
    step = lambda name, i: F.array(F.concat_ws("\x1f", name, i))
    start = roots(nodes, edges).select("id").join(named, "id")
    first = start.select(F.col("id").alias("root"), "id", step("name", "id").alias("sort_path"), F.array("id").alias("way"), F.when(F.col("told"), F.lit(0)).otherwise(-1).alias("depth"), "told", F.when(F.col("told"), F.col("id")).alias("listed"), F.lit(None).cast(nodes.schema["id"].dataType).alias("above"))
    down = written_wide(edges.select("parent", "child").distinct().join(named.select(F.col("id").alias("child"), "name", F.col("told").alias("child_told")), "child"), "tree-edges")
    better = written_wide(first, "tree-ways")
    every = better
    while not better.isEmpty():
        further = (
            better.join(down, better["id"] == down["parent"])
            .filter(~F.array_contains("way", F.col("child")))
            .select(
                "root",
                F.col("child").alias("id"),
                F.concat("sort_path", step("name", "child")).alias("sort_path"),
                F.concat("way", F.array("child")).alias("way"),
                (F.col("depth") + F.col("child_told").cast("int")).alias("depth"),
                F.col("child_told").alias("told"),
                F.when(F.col("child_told"), F.col("child")).otherwise(F.col("listed")).alias("listed"),
                F.col("listed").alias("above"),
            )
        )
        best = _smallest(further)
        known = every.groupBy("root", "id").agg(F.min("sort_path").alias("known"))
        better = written_wide(best.join(known, ["root", "id"], "left").filter("known IS NULL OR sort_path < known").drop("known"), "tree-ways")
        every = every.unionByName(better)
    return _smallest(every).filter("told").select("root", "id", "depth", "sort_path", "above")


def _smallest(ways: DataFrame) -> DataFrame:
    """Of each root's ways to a node the first by path."""
    rest = [c for c in ways.columns if c not in ("root", "id")]
    return ways.groupBy("root", "id").agg(F.min(F.struct("sort_path", *(c for c in rest if c != "sort_path"))).alias("w")).select("root", "id", *(F.col(f"w.{c}").alias(c) for c in rest))


def raw_semantics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``feature_id, level, name, parent_id``: the listed tree itself as semantic nodes; of several places the first root's, then the first by path."""
    listed = tree_listing(nodes, edges, skip_unlevelled=True)
    first = listed.groupBy("id").agg(F.min(F.struct("root", "sort_path", "above")).alias("at"))
    return nodes.join(first, "id").select(F.col("id").alias("feature_id"), "level", "name", F.col("at.above").alias("parent_id"))


def unresolved_samples(unresolved: DataFrame, most: int = 20) -> DataFrame:
    """The first unresolved edges by name and child, for the report."""
    return unresolved.select("parent_name", "child").orderBy("parent_name", "child").limit(most)


def write_hierarchy(nodes: DataFrame, edges: DataFrame, unresolved: DataFrame, path: str) -> None:
    """Nodes, edges, report and unresolved samples, each in a folder of its own."""
    for name, rows in (("nodes", nodes), ("edges", edges), ("report", report(nodes, edges, unresolved)), ("unresolved", unresolved_samples(unresolved))):
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def violations(nodes: DataFrame) -> DataFrame:
    """``id, reason``: repeated ids, parents that do not exist, fields that are missing."""
    repeated = nodes.groupBy("id").count().filter("count > 1").select("id", F.lit("duplicate_id").alias("reason"))
    orphans = nodes.filter("parent_id IS NOT NULL").join(nodes.select(F.col("id").alias("parent_id")), "parent_id", "left_anti").select("id", F.lit("missing_parent").alias("reason"))
    blank = nodes.filter("id IS NULL OR name IS NULL OR name = '' OR level IS NULL").select("id", F.lit("missing_field").alias("reason"))
    return repeated.unionByName(orphans).unionByName(blank)


def cycles(nodes: DataFrame, most_rounds: int = 40) -> DataFrame:
    """Nodes on or behind a parent cycle: pointers are doubled until those that end have all ended."""
    up, open_ = nodes.filter("parent_id IS NOT NULL").select("id", F.col("parent_id").alias("up")), None
    for _ in range(most_rounds):
        ahead = up.select(F.col("id").alias("up"), F.col("up").alias("further"))
        up = written(up.join(ahead, "up").filter("further IS NOT NULL").select("id", F.col("further").alias("up")), "pointers")
        n = up.count()
        if n == open_:
            break
        open_ = n
    return up.select("id")


def supplemented(nodes: DataFrame, candidates: DataFrame) -> DataFrame:
    """Keep a parent that exists; else the deepest, then smallest candidate ``child, parent`` that exists above the child; else null."""
    known = nodes.select(F.col("id").alias("parent"), F.col("level").alias("parent_level"))
    allowed = candidates.join(known, "parent").join(nodes.select(F.col("id").alias("child"), "level"), "child").filter("parent_level < level")
    best = allowed.groupBy("child").agg(F.min_by("parent", F.struct((-F.col("parent_level")).alias("up"), "parent")).alias("best"))
    there = nodes.join(known.select(F.col("parent").alias("parent_id"), F.lit(True).alias("there")), "parent_id", "left")
    return there.join(best.withColumnRenamed("child", "id"), "id", "left").select("id", "level", "name", F.when(F.col("there"), F.col("parent_id")).otherwise(F.col("best")).alias("parent_id"))


def overridden(nodes: DataFrame, overrides: DataFrame) -> DataFrame:
    """``overrides(id, new_parent)`` replace parents."""
    return nodes.join(overrides, "id", "left").withColumn("parent_id", F.coalesce("new_parent", "parent_id")).drop("new_parent")


def renamed(nodes: DataFrame, overlay: DataFrame) -> DataFrame:
    """``overlay(id, display_name)`` replaces names; levels, rows and order stay."""
    return nodes.join(overlay, "id", "left").withColumn("name", F.coalesce("display_name", "name")).drop("display_name")


def anchored(nodes: DataFrame, anchors: DataFrame) -> DataFrame:
    """Nodes without a parent take their explicit anchor, if there is one."""
    return nodes.join(anchors, "id", "left").withColumn("parent_id", F.coalesce("parent_id", "anchor")).drop("anchor")


def region_ids(names: DataFrame, existing: DataFrame, prefix: str) -> DataFrame:
    """Region names numbered from 1 in order, as ``<prefix>_region_nn`` unless a feature ``id, name`` by that name exists."""
    numbered = with_offsets(names.select("region").distinct(), ["region"], {}).select("region", (F.col("index") + 1).alias("n"))
    real = existing.groupBy("name").agg(F.min("id").alias("real"))
    return numbered.join(real, numbered["region"] == real["name"], "left").select("region", F.coalesce("real", F.format_string(f"{prefix}_region_%02d", "n")).alias("region_id"))


def smallest_region(mapping: DataFrame) -> DataFrame:
    """``name, region``: of conflicting regions of a name the smaller."""
    return mapping.groupBy("name").agg(F.min("region").alias("region"))


def region_tree(prefectures: DataFrame, mapping: DataFrame, ids: DataFrame, region_level: int, level: int) -> DataFrame:
    """``id, level, name, parent_id, in_scope``: the mapped regions as nodes above their prefectures ``id, name``.

    ``mapping`` is ``name, region``, ``ids`` is ``region, region_id``.  Prefectures without a region have no parent; all are in scope, whatever their flag was.
    """
    known = smallest_region(mapping).join(ids, "region")
    regions = known.select(F.col("region_id").alias("id"), F.lit(region_level).alias("level"), F.col("region").alias("name")).distinct()
    below = prefectures.join(known.select("name", "region_id"), "name", "left")
    rows = below.select("id", F.lit(level).alias("level"), "name", F.col("region_id").alias("parent_id"), F.lit(True).alias("in_scope"))
    return rows.unionByName(regions.select("id", "level", "name", F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("boolean").alias("in_scope")))


def semantic(nodes: DataFrame) -> DataFrame:
    """``id, level, name, parent_id, names``; empty alias maps are null."""
    return nodes.select("id", "level", "name", "parent_id", F.when(F.size("names") > 0, F.col("names")).alias("names"))


def ancestors(nodes: DataFrame) -> DataFrame:
    """``id, ancestor_id, ancestor_level`` including the node itself."""
    p = paths(nodes).select("id", F.explode("path_ids").alias("ancestor_id"))
    return p.join(nodes.select(F.col("id").alias("ancestor_id"), F.col("level").alias("ancestor_level")), "ancestor_id")


def observed_shapes(nodes: DataFrame) -> DataFrame:
    """Level combinations that occur from a node up to its root, with how often."""
    shapes = ancestors(nodes).groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("ancestor_level")).cast("array<string>"), "-").alias("shape"))
    return shapes.groupBy("shape").agg(F.count("*").alias("n"))


def missing_regions(specs: DataFrame, edges: DataFrame, existing: DataFrame) -> DataFrame:
    """Features that do not exist yet, as dissolved borders of their listed children: ``region_id`` with its segments."""
    from limes.operators.geometry import dissolve

    wanted = specs.join(existing.select(F.col("id").alias("region_id")), "region_id", "left_anti")
    return dissolve(edges.join(wanted, edges["feature_id"] == wanted["child_id"]).drop("feature_id", "child_id"), "region_id")

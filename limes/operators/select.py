"""Which relations and features take part: predicates on tags, exclusions, scopes and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.functions.names import level_of


def tag(key: str, tags: str = "tags") -> Column:
    return F.try_element_at(F.col(tags), F.lit(key))


def admin_polygons(relations: DataFrame, levels: list[int]) -> DataFrame:
    """Relations that are administrative and have one of the levels, with ``level``."""
    found = relations.withColumn("level", level_of(tag("admin_level")))
    return found.filter((tag("boundary") == "administrative") & F.col("level").isin(levels))


def admin_hierarchy_relations(relations: DataFrame, levels: list[int] | None = None) -> DataFrame:
    """The looser choice: administrative, or with any ``admin_level``; ``level`` is null unless it is digits."""
    if levels is not None and not levels:
        raise ValueError("no level is asked for")
    kept = relations.filter((tag("boundary") == "administrative") | tag("admin_level").isNotNull()).withColumn("level", level_of(tag("admin_level")))
    return kept if levels is None else kept.filter(F.col("level").isin(levels))


def members_of(relations: DataFrame, kind: str, role: str | None = None) -> DataFrame:
    """``rel, pos, ref, role``: a row for each member of one type."""
    wanted = F.filter("members", lambda m: (m["type"] == kind) & (F.lit(True) if role is None else m["role"] == role))
    return relations.select(F.col("id").alias("rel"), F.explode(wanted).alias("m")).select("rel", "m.pos", "m.ref", "m.role")


def ring_role(role: Column) -> Column:
    """``outer`` for blank or outer, ``inner`` for inner, else null."""
    return F.when(role.isin("", "outer"), "outer").when(role == "inner", "inner")


def subarea_edges(relations: DataFrame) -> DataFrame:
    rows = members_of(relations, "r", "subarea")
    return rows.select(F.concat(F.lit("r"), "rel").alias("parent"), F.concat(F.lit("r"), "ref").alias("child"), F.lit("subarea").alias("method"), F.lit(1.0).alias("confidence"))


def is_in_edges(nodes: DataFrame) -> DataFrame:
    """``parent_name, child``: the whole value of every tag whose key starts with ``is_in``."""
    tags = F.map_filter("tags", lambda k, v: F.startswith(k, F.lit("is_in")))
    return nodes.select(F.col("id").alias("child"), F.explode(tags)).select(F.col("value").alias("parent_name"), "child", F.lit("is_in").alias("method"), F.lit(0.7).alias("confidence"))


def needs_country_filter(listing: DataFrame) -> DataFrame:
    """An extract is filtered if a boundary is given, else unless it is one country's own (``-latest.osm.pbf``)."""
    return listing.withColumn("filtered", F.col("has_boundary") | ~F.endswith("name", F.lit("-latest.osm.pbf")))


def named(nodes: DataFrame) -> DataFrame:
    return nodes.filter("id IS NOT NULL AND length(name) > 0")


def without(features: DataFrame, excluded: DataFrame) -> DataFrame:
    return features.join(excluded, "id", "left_anti")


def with_supplements(features: DataFrame, supplements: DataFrame) -> DataFrame:
    """Add supplements whose name and id are both new; of repeated supplements the first by id and name."""
    by_name = supplements.withColumn("__n", F.row_number().over(Window.partitionBy("name").orderBy("id"))).filter("__n = 1").drop("__n")
    once = by_name.withColumn("__n", F.row_number().over(Window.partitionBy("id").orderBy("name"))).filter("__n = 1").drop("__n")
    new = once.join(features.select("name"), "name", "left_anti").join(features.select("id"), "id", "left_anti")
    return features.unionByName(new.select(*features.columns))


def first_of_sources(sources: list[DataFrame], key: str = "id") -> DataFrame:
    """Union in order of priority; a key keeps its row from the first source that has it."""
    every = None
    for rank, source in enumerate(sources):
        rows = source.withColumn("source_ord", F.lit(rank))
        every = rows if every is None else every.unionByName(rows)
    first = F.row_number().over(Window.partitionBy(key).orderBy("source_ord"))
    return every.withColumn("__n", first).filter("__n = 1").drop("__n")


def upserted(features: DataFrame, curated: DataFrame) -> DataFrame:
    """Hand-made features replace those of their id or are added."""
    return features.join(curated.select("id"), "id", "left_anti").unionByName(curated.select(*features.columns))


def traced(rows: DataFrame, needles: list[str]) -> DataFrame:
    """Rows whose name holds any needle, whatever its case."""
    low = F.lower("name")
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(low, F.lit(needle.lower()))
    return rows.filter(hit)


def traced_sources(sources: dict[tuple[str, str], DataFrame], needles: list[str]) -> DataFrame:
    """``source, status, id, name`` of all traced rows of several tables, which are given by source and status."""
    out = None
    for (source, status), rows in sources.items():
        one = traced(rows.select("id", "name"), needles).select(F.lit(source).alias("source"), F.lit(status).alias("status"), "id", "name")
        out = one if out is None else out.unionByName(one)
    return out


def target_relations(wanted: DataFrame, relations: DataFrame) -> DataFrame:
    """Listed ids (``r`` optional) with their members split into ways and others; ``found`` tells absent ones."""
    ids = wanted.select(F.regexp_replace("target", "^r", "").cast("long").alias("id")).distinct()
    counted = relations.select("id", F.size(F.filter("members", lambda m: m["type"] == "w")).alias("n_ways"), F.size(F.filter("members", lambda m: m["type"] != "w")).alias("n_others"))
    return ids.join(counted, "id", "left").select("id", F.col("n_ways").isNotNull().alias("found"), "n_ways", "n_others")

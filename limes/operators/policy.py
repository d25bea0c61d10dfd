"""Level and shape policies of countries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def level_shapes(levels: DataFrame) -> DataFrame:
    """``country, shape``: all non-empty subsets of ``country, levels``, at most 1023 for ten levels."""
    masks = levels.withColumn("mask", F.explode(F.expr("sequence(1, CAST(pow(2, size(levels)) AS INT) - 1)")))
    picked = F.expr("filter(levels, (l, i) -> (mask & shiftleft(1, i)) <> 0)")
    return masks.select("country", F.array_join(F.array_sort(picked).cast("array<string>"), "-").alias("shape"))


def ruled_shapes(shapes: DataFrame, rules: DataFrame) -> DataFrame:
    """``country, shape, status``: ok if the shape holds all of ``rules(country, required)``, else partial."""
    has = F.size(F.array_except("required", F.split("shape", "-").cast("array<int>"))) == 0
    return shapes.join(F.broadcast(rules), "country").select("country", "shape", F.when(has, "ok").otherwise("partial").alias("status"))


def country_policy(levels: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """``country, shape, status`` of all shapes of ``country, levels``: ok if the shape has the country's first level, else partial.

    ``listed(country, shape, status)`` replaces the rule: a country that is in it has these shapes only.
    """
    anchor = levels.select("country", F.array(F.array_min("levels")).alias("required"))
    ruled = ruled_shapes(level_shapes(levels), anchor)
    if listed is None:
        return ruled
    return ruled.join(F.broadcast(listed.select("country").distinct()), "country", "left_anti").unionByName(listed.select("country", "shape", "status"))


def shape_policies(levels: DataFrame, alternatives: DataFrame, listed: DataFrame) -> DataFrame:
    """``country, shape, status`` of every country in ``country, levels``, each by its own rule.

    A country in ``listed(country, shape, status)`` has these shapes only.  Else a shape of its levels is ok if it holds all levels of one of the
    country's sets in ``alternatives(country, alternatives)``, or its first level if the country has none, and partial if not.  Shapes that
    do not come out are not allowed.  All three tables have some rows for each country, whatever the data.
    """
    own = levels.join(F.broadcast(alternatives), "country", "left").select("country", F.coalesce("alternatives", F.array(F.array(F.array_min("levels")))).alias("sets"))
    held = F.split("shape", "-").cast("array<int>")
    has = F.exists("sets", lambda s: F.size(F.array_except(s, held)) == 0)
    open_ = levels.join(F.broadcast(listed.select("country").distinct()), "country", "left_anti")
    ruled = level_shapes(open_).join(F.broadcast(own), "country").select("country", "shape", F.when(has, "ok").otherwise("partial").alias("status"))
    return ruled.unionByName(listed.join(F.broadcast(levels.select("country").distinct()), "country", "left_semi").select("country", "shape", "status"))


def default_policy(shapes: DataFrame, levels: DataFrame) -> DataFrame:
    """ok for the full set of levels only."""
    full = levels.select("country", F.array_join(F.array_sort("levels").cast("array<string>"), "-").alias("full"))
    return shapes.join(F.broadcast(full), "country").select("country", "shape", F.when(F.col("shape") == F.col("full"), "ok").otherwise("partial").alias("status"))


def explicit_policy(spark: SparkSession, ok: list[list[int]], partial: list[list[int]]) -> DataFrame:
    """A policy listed shape by shape; its size is the argument's."""
    rows = [("-".join(map(str, sorted(s))), status) for status, shapes in (("ok", ok), ("partial", partial)) for s in shapes]
    return spark.createDataFrame(sorted(set(rows)), "shape string, status string")


def anchored_policy(spark: SparkSession, levels: list[int], required: list[int]) -> DataFrame:
    """All shapes of the levels: ok with all ``required`` levels, else partial."""
    shapes = [list(c) for k in range(1, len(levels) + 1) for c in combinations(sorted(levels), k)]
    return explicit_policy(spark, [s for s in shapes if set(required) <= set(s)], [s for s in shapes if not set(required) <= set(s)])


def with_policy(features: DataFrame, policies: DataFrame, fallback: DataFrame) -> DataFrame:
    """Each feature's tolerance: its level's policy, else the country's fallback, else null. Policies are small tables by level."""
    named = features.join(F.broadcast(policies), ["country", "level"], "left")
    return named.join(F.broadcast(fallback.withColumnRenamed("tolerance", "spare")), "country", "left").withColumn("tolerance", F.coalesce("tolerance", "spare")).drop("spare")

"""Counts, funnels, manifests and release checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.functions.numbers import list_digest


def level_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def level_count_sets(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Counts by both columns and by the second alone, in one pass."""
    grouped = rows.groupingSets([[first, second], [second]], first, second).agg(F.count("*").alias("n"), F.grouping(first).cast("int").alias("total"))
    return grouped.select(first, second, "n", "total")


def samples(rows: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in a given order."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def funnel(stages: list[tuple[str, DataFrame]], key: str, extract: str, marks: dict[str, DataFrame] | None = None) -> DataFrame:
    """For every extract and in total: how many ids reach each stage, how many stop before the next, and how many miss the last.

    ``marks`` are ids told by name beside the stages, such as invalid or empty ones.
    """
    flags = None
    for name, rows in [*stages, *(marks or {}).items()]:
        one = rows.select(extract, key).distinct().withColumn(name, F.lit(1))
        flags = one if flags is None else flags.join(one, [extract, key], "full")
    names = [n for n, _ in stages]
    sums = [F.sum(F.coalesce(n, F.lit(0))).alias(n) for n in [*names, *(marks or {})]]
    steps = [*zip(names, names[1:]), *([(names[0], names[-1])] if len(names) > 2 else [])]
    lost = [F.sum(F.when(F.col(a).isNotNull() & F.col(b).isNull(), 1).otherwise(0)).alias(f"{a}_not_{b}") for a, b in steps]
    return flags.rollup(extract).agg(*sums, *lost, F.grouping(extract).cast("int").alias("total"))


def largest(features: DataFrame, expected: str) -> DataFrame:
    """By level: the largest feature, its area, and whether one has the expected name."""
    return features.groupBy("level").agg(F.max_by("feature_id", F.struct("area", "feature_id")).alias("feature_id"), F.max("area").alias("area"), F.bool_or(F.col("name") == expected).alias("has_expected"))


def policy_effects(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows before and after a scope filter and those it removed, by level."""
    joined = before.select(key, "level").join(after.select(key).withColumn("stays", F.lit(1)), key, "left")
    return joined.groupBy("level").agg(F.count("*").alias("n_before"), F.count("stays").alias("n_after"), (F.count("*") - F.count("stays")).alias("removed"))


def manifest(files: DataFrame) -> DataFrame:
    """``path, sha256, size`` of ``path, content``."""
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size"))


def release_manifest(files: DataFrame, listed: DataFrame, identity: dict[str, str]) -> DataFrame:
    """``path, sha256, size`` of the listed release files with the release's identity in columns; a listed file that is not there is an error."""
    made = listed.select("path").join(manifest(files), "path", "left")
    lacking = F.raise_error(F.concat(F.lit("a release file is missing: "), F.col("path")))
    return made.select("path", F.coalesce("sha256", lacking.cast("string")).alias("sha256"), "size", *(F.lit(v).alias(k) for k, v in identity.items()))


def manifest_entries(manifests: DataFrame) -> DataFrame:
    """``path, sha256, size`` of manifests as JSON texts, of either schema.

    Version 2 lists files under ``checksums.files``, others under ``files``; a file has its digest, or an object with digest and size.
    """
    files = F.when(F.get_json_object("manifest", "$.schema_version") == "2", F.get_json_object("manifest", "$.checksums.files")).otherwise(F.get_json_object("manifest", "$.files"))
    given = F.coalesce(files, F.raise_error(F.lit("a manifest lists no files")).cast("string"))
    rows = manifests.select(F.explode(F.from_json(given, "map<string,string>")).alias("path", "entry"))
    nested = F.startswith("entry", F.lit("{"))
    return rows.select(
        "path",
        F.when(nested, F.get_json_object("entry", "$.sha256")).otherwise(F.col("entry")).alias("sha256"),
        F.when(nested, F.get_json_object("entry", "$.size")).cast("long").alias("size"),
    )


def verified(expected: DataFrame, built: DataFrame) -> DataFrame:
    """``path, reason`` of all files that are missing, extra, no regular file, of no valid digest, or differ in digest or size; a size may be unknown.

    ``built`` may tell by ``is_file`` what is no regular file.
    """
    pair = expected.select("path", F.col("sha256").alias("want"), F.col("size").alias("want_size")).withColumn("listed", F.lit(True))
    regular = F.coalesce("is_file", F.lit(True)) if "is_file" in built.columns else F.lit(True)
    have = built.select("path", "sha256", "size", regular.alias("is_file")).withColumn("built", F.lit(True))
    both = pair.join(have, "path", "full")
    reason = (
        F.when(F.col("built").isNull(), "missing")
        .when(F.col("listed").isNull(), "not_listed")
        .when(~F.col("is_file"), "not_a_file")
        .when(~F.coalesce(F.col("want").rlike("^[0-9a-f]{64}$"), F.lit(False)), "invalid_digest")
        .when(F.col("want") != F.col("sha256"), "digest_mismatch")
        .when(F.col("want_size") != F.col("size"), "size_mismatch")
    )
    return both.select("path", reason.alias("reason")).filter("reason IS NOT NULL")


def unpinned(identity: DataFrame, pins: DataFrame, group: str) -> DataFrame:
    """``group, reason`` of sources ``group, composite, latest`` that are not what ``pins`` of the same columns say."""
    pinned = pins.select(group, F.col("composite").alias("want"), F.col("latest").alias("want_latest"))
    reason = (
        F.when(F.col("composite").isNull(), "missing")
        .when(F.col("composite") != F.col("want"), "digest_mismatch")
        .when(~F.col("latest").eqNullSafe(F.col("want_latest")), "timestamp_mismatch")
    )
    return pinned.join(identity, group, "left").select(group, reason.alias("reason")).filter("reason IS NOT NULL")


def level_effects(features: DataFrame, tolerances: DataFrame, invalid: DataFrame) -> DataFrame:
    """``level, n, simplified, repaired``: what a geometry policy does to ``id, level``; ``invalid(id)`` are repaired or reported."""
    joined = features.join(F.broadcast(tolerances.select("level", "tolerance")), "level", "left").join(invalid.select("id", F.lit(1).alias("bad")).distinct().hint("merge"), "id", "left")
    return joined.groupBy("level").agg(F.count("*").alias("n"), F.count("tolerance").alias("simplified"), F.count("bad").alias("repaired"))


def metrics(parts: dict[str, DataFrame]) -> DataFrame:
    """``what, n``: how many rows each part of a report has."""
    out = None
    for name, rows in parts.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def source_identity(files: DataFrame, group: str) -> DataFrame:
    """One digest over the sorted (path, digest) list of each group, and its latest stamp."""
    return list_digest(files, group, F.concat_ws("=", "path", "sha256"), "composite", stamp="stamp")


def determinism(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that only one of two runs gave, with how often."""
    a, b = first.exceptAll(second).withColumn("only", F.lit("first")), second.exceptAll(first).withColumn("only", F.lit("second"))
    return a.unionByName(b)

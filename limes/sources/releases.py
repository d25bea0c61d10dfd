"""Releases as folders of files: each version in a folder of its own with a manifest, read only once its mark is there."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.operators.index import write_index
from limes.operators.quality import verified

#: Spark reads a file as one value up to this size
MOST_BYTES = 2_147_483_647


def _relative(path: Column, folder: str) -> Column:
    """What follows the folder's own name; schemes and hosts are told in different ways."""
    name = "/" + folder.rstrip("/").split("://")[-1].strip("/").rpartition("/")[2] + "/"
    return F.substring_index(path, name, -1)


def file_list(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size, mtime`` of all files below a folder, paths relative to it; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(_relative(F.col("path"), folder).alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def digested_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, sha256, size`` of all files below a folder; each is hashed where it is read.

    A file over ``MOST_BYTES`` is an error that names it: releases are written in parts far below that.  Spark's readers pass over files without
    a byte, so these are not in the result; a manifest that lists one finds it missing.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    size = F.when(F.col("length") > MOST_BYTES, F.raise_error(F.concat(F.lit("too large to hash as one value: "), F.col("path"))).cast("long")).otherwise(F.col("length"))
    return files.select(_relative(F.col("path"), folder).alias("path"), F.sha2("content", 256).alias("sha256"), size.alias("size"))


def _marks(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("release string, at long").json(f"{path}/marks")
    except AnalysisException:
        return None


def publish(spark: SparkSession, path: str, release: str, tables: dict[str, DataFrame | Callable[[str], None]], identity: dict[str, str] | None = None) -> None:
    """Write all tables of a release, then its manifest, then its mark; what is no table is called with the folder it may write to.

    Readers see the release only with its mark, so never a part of it or a mixture with another; a write that was cut off is
    done again under the same name.  A marked release is never written again.
    """
    marks = _marks(spark, path)
    if marks is not None and not marks.filter(F.col("release") == release).isEmpty():
        raise ValueError(f"release {release} is there already")
    folder = f"{path}/versions/{release}"
    for name, rows in tables.items():
        if isinstance(rows, DataFrame):
            rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        else:
            rows(f"{folder}/{name}")
    made = digested_files(spark, folder).select("path", "sha256", "size", *(F.lit(v).alias(k) for k, v in (identity or {}).items()))
    made.write.mode("overwrite").json(f"{path}/manifests/{release}")
    mark = spark.range(1).select(F.lit(release).alias("release"), F.lit(time.time_ns()).alias("at"))
    mark.coalesce(1).write.mode("append").json(f"{path}/marks")


def publish_runtime(spark: SparkSession, path: str, release: str, edges: DataFrame, meta: DataFrame, hierarchy: DataFrame, policy: DataFrame, version: int = 3) -> None:
    """A release of the runtime's tables: geometry index (five tables), feature metadata, hierarchy and policy, seen all together or not at all."""
    publish(spark, path, release, {"geometry": lambda folder: write_index(edges, folder, version), "feature_meta": meta, "hierarchy": hierarchy, "policy": policy})


def current_release(spark: SparkSession, path: str) -> str:
    """The release that was marked last; an error if none was."""
    marks = _marks(spark, path)
    last = None if marks is None else marks.agg(F.max_by("release", "at")).first()[0]
    if last is None:
        raise FileNotFoundError(f"no complete release under {path}")
    return last


def read_release(spark: SparkSession, path: str, name: str, release: str | None = None) -> DataFrame:
    """A table of the given release or the current one."""
    return spark.read.parquet(f"{path}/versions/{release or current_release(spark, path)}/{name}")


def release_faults(spark: SparkSession, path: str, release: str | None = None) -> DataFrame:
    """``path, reason`` of files of a release that differ from its manifest; no row if all is as it was published."""
    release = release or current_release(spark, path)
    expected = spark.read.schema("path string, sha256 string, size long").json(f"{path}/manifests/{release}")
    return verified(expected, digested_files(spark, f"{path}/versions/{release}"))

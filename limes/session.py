"""Durable intermediate tables in the folder that a cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or an own folder where the session names none and runs on one machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="limes-"))
    return f"file://{_own[0]}"


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/limes/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write a table and read it back, which cuts the lineage and survives lost executors; with files apart ``by`` columns of few values, of which a filter reads its own."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def written_wide(df: DataFrame, label: str) -> DataFrame:
    """As ``written``, for a table that grows with the input: joins sort it.  Files of regular rows are a hundredth of what they hold, so by their size Spark would broadcast it."""
    return written(df, label).hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by keys over all of the session's shuffle partitions: adaptive execution would put few rows into one task, though much follows from each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: rows of some hundred bytes that a task sorts and groups without spilling
ROWS_PER_TASK = 1_000_000


def sized(df: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """Rows dealt out by keys over as many tasks as ``n_rows`` need: the session's partitions do not grow with the input, and adaptive execution puts them together by their packed bytes."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // ROWS_PER_TASK)), *keys)


def raised_if_empty(rows: DataFrame, message: str) -> DataFrame:
    """No rows, of the same columns, for a union: reading them is an error if ``rows`` is empty."""
    n = rows.agg(F.count("*").alias("n"))
    wrong = F.when(F.col("n") == 0, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(False))
    return n.filter(wrong).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields))

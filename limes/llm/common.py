"""What the training-data operators share: input columns, sizing and durable intermediate tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.session import written  # noqa: F401  (the operators take it from here)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), plus the columns named; nothing else is read."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *(F.col(c) for c in more),
    )


#: exchanges have no more partitions than a driver can schedule; beyond, partitions grow, while groups and buckets keep their size
MOST_PARTS = 100_000


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, counted in one pass over that column, so it holds after any join or filter."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts(spark: SparkSession, size: int, bytes_per_part: int) -> int:
    """Partitions for an exchange of ``size`` bytes, and never under the session's own setting."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_PARTS, math.ceil(size / bytes_per_part)))


def first_by_hash(df: DataFrame, most: int, *keys: str, of: int | None = None, spare: int = 2) -> DataFrame:
    """At most ``most`` rows, the first by a hash of ``keys``; ties by the keys.

    ``of`` tells how many rows ``df`` has (else they are counted).  Only the lowest hashes, ``spare * most`` rows to be expected, go
    into the final ordering, so what meets in one task has a bound of its own, however large ``df`` is.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    n = df.count() if of is None else of
    low = df if n <= spare * most else df.filter(place < F.lit(math.ceil((1 << 40) * spare * most / n)))
    return low.orderBy(place, *keys).limit(most)

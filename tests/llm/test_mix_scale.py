"""The mix at sizes that no fixture has: very many sources, a source of many blocks, pieces over many partitions."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from limes.llm import mixing


def plan(sizes, **given):
    rows = pa.table({"no_source": np.zeros(len(sizes), dtype=bool), "src": [f"{i:08}" for i in range(len(sizes))], "source_size": np.asarray(sizes, dtype=np.int64)})
    made = mixing.plan_sources(rows, **given)
    return {c: made.column(c).to_numpy() if c != "shard_ends" else made.column(c).combine_chunks().flatten().to_numpy().reshape(len(sizes), -1) for c in made.column_names}


def test_two_million_sources():
    sizes = np.random.default_rng(1).integers(0, 3000, 2_000_000)
    made = plan(sizes)
    assert made["n_blocks"].sum() <= mixing.MOST_BLOCKS and made["quota"].sum() < 10**9
    ends = made["shard_ends"]
    assert (ends[:, -1] == made["quota"]).all() and (np.diff(ends, axis=1) >= 0).all()
    shares = np.diff(np.concatenate([np.zeros((len(ends), 1), dtype=np.int64), ends], axis=1), axis=1).sum(axis=0)
    assert shares.max() - shares.min() <= math.ceil(math.log2(len(shares)))
    block = sizes / np.maximum(made["n_blocks"], 1)
    assert (np.abs(made["quota"] * block - made["target"]) <= block / 2 + 1e-6).all() and made["target"].sum() == np.float64(sizes.sum())
    assert (np.gcd(made["step"], made["n_blocks"]) == 1).all()


def test_blocks_and_shards_grow_with_the_words():
    made = plan([10**13, 10**9, 5 * 10**8, 2000, 3, 0])
    assert made["n_blocks"][0] >= 10**13 // (1 << 20) * 0.5 and made["n_blocks"].tolist()[2:] == [1024, 1024, 3, 1] and made["n_blocks"].sum() <= mixing.MOST_BLOCKS
    assert made["shard_ends"].shape[1] == mixing.MOST_SHARDS and plan([10**6, 5])["shard_ends"].shape[1] == mixing.SHARDS
    assert plan([10**6, 5], shards=4)["shard_ends"].shape[1] == 4


def test_one_source_of_a_third_spreads_over_many_partitions(spark):
    sizes = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2)).alias("source"), F.lit(50).cast("long").alias("size"), F.col("id").alias("check"))
    pieces = mixing._pieces(mixing.places(sizes), mixing.SEED).select("shard", "spot", "doc_id", "source", "draw")
    spread = mixing._dealt(pieces, 1_500 * mixing.PART_BYTES // 8, 8).withColumn("p", F.spark_partition_id())
    rows = spread.groupBy("p").agg(F.count("*").alias("n"), F.count(F.when(F.col("source") == "hot", 1)).alias("hot")).collect()
    assert len(rows) > 1024 and sum(r.hot > 0 for r in rows) > 1024 and max(r.n for r in rows) < 6 * sum(r.n for r in rows) / len(rows)


def test_documents_are_shuffled_within_a_shard(spark):
    sizes = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(10).cast("long").alias("size"), F.col("id").alias("check"))
    draws = mixing.draws(mixing.places(sizes, shards=1)).collect()
    start = [r.start for r in draws]
    assert sum(abs(a - b) <= 10 for a, b in zip(start, start[1:])) < 0.02 * len(start)  # neighbours on the line do not stand together


def test_rows_without_ids_are_told_apart_by_their_text(spark):
    docs = spark.createDataFrame([(None, f"word{i} and more", "s") for i in range(600)], "doc_id long, text string, source string")
    placed = mixing.places(mixing.word_counts(docs)).select("chunk").distinct().count()
    assert placed == math.ceil(600 / mixing.CHUNK_DOCS)

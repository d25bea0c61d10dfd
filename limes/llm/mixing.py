"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents lie on a line of words in a keyed order.  The line is cut into equal blocks (``BLOCKS`` of a source, more where these
would have over ``BLOCK_WORDS`` words), a source's target becomes an exact quota of block draws, and a binary tree splits the vector of quotas among
the output shards: each node gives its left half a multivariate-hypergeometric draw of its blocks.  A shard then owns an interval of
each source's draws; draw ``j`` is block ``j`` of the source's permuted block sequence (another pass over the source every
``n_blocks`` draws), so shards hold disjoint draws.  The pieces of documents in a shard's blocks are shuffled within the shard by a keyed hash of
each piece, over as many partitions as its words ask for.  What is taken of a document is the sum of its draws; a document that crosses a
block's edge is cut there, between words.

Cumulated sizes come from three levels: within chunks of some hundred documents of a source (dealt by a hash of id, size and text, so a source
that holds a third of all rows is spread over all tasks), over the chunks of a run of chunks, and over the runs of a source.
The tree is made in one task from one row of some 200 bytes for each source; documents, chunks and runs never meet there.  With very many sources
each has fewer blocks (``MOST_BLOCKS`` in all) and there are fewer shards (``MOST_CELLS`` of the tree's last level), so that task stays small.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, the last; repeated rows are
separate documents; an empty table gives an empty table; extra columns are not read.  All draws depend on the seed,
the ids and the sizes alone, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.llm.arrow_text import blocks, tidied
from limes.llm.common import parts, table, texts, written

SHARDS, BLOCKS, CHUNK_DOCS, RUN_CHUNKS, MOST_REPEATS, SEED = 16, 1024, 256, 4096, 3, 7
BLOCK_WORDS, SHARD_WORDS, MOST_SHARDS, MOST_BLOCKS, MOST_CELLS, PART_BYTES = 1 << 20, 1 << 32, 256, 1 << 28, 1 << 25, 32 << 20


def word_counts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, source, size``, the text's hash ``check`` and ``more`` columns of type long; a document is known by its row, so repeated rows stay."""
    names = ["doc_id", "source", "size", "check", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                size = np.diff(block.words()[2]).astype(np.int64)
                rest = [batch.column(3 + i)[lo:hi] for i in range(len(more) + 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array(size), *rest], names)

    given = texts(docs, "source", *more)
    given = given.select("doc_id", "text", "source", F.xxhash64("text").alias("check"), *more)
    return given.mapInArrow(tidied(run), ", ".join(["doc_id long, source string, size long, check long", *(f"{c} long" for c in more)]))


def shares(sizes: np.ndarray, weights: np.ndarray, most: float = MOST_REPEATS) -> np.ndarray:
    """Weights' shares of all sizes; what is above ``most`` times a source's size is shared again among the others."""
    caps, total = most * sizes.astype(float), float(sizes.sum())
    target, free = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool)
    while free.any():
        left = total - caps[~free].sum()
        trial = left * weights / weights[free].sum()
        over = free & (trial > caps)
        if not over.any():
            target[free] = trial[free]
            break
        free &= ~over
    target[~free] = caps[~free]
    return target


def split(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """The tree: rows are sources, columns shards; each node's left child gets a multivariate-hypergeometric draw."""
    level = [quotas]
    depth = 0
    while len(level) < shards:
        level = [half.astype(np.int32) for k, node in enumerate(level) for half in _halves(node.astype(np.int64), [seed, depth, k])]
        depth += 1
    return np.stack(level, axis=1)


def _halves(node: np.ndarray, key: list[int]) -> tuple[np.ndarray, np.ndarray]:
    left = np.random.default_rng(key).multivariate_hypergeometric(node, int(node.sum()) // 2, method="marginals")
    return left, node - left


def block_counts(sizes: np.ndarray, blocks_per_source: int = BLOCKS) -> np.ndarray:
    """Blocks of each source, ``MOST_BLOCKS`` in all at most; three draws of each are below the 10⁹ that one draw of the tree may hold."""
    usual = max(1, min(blocks_per_source, MOST_BLOCKS // (2 * max(1, len(sizes)))))
    words = max(BLOCK_WORDS, -(-int(sizes.sum()) // (MOST_BLOCKS // 4)))
    return np.maximum(np.minimum(usual, np.maximum(sizes, 1)), -(-sizes // words))


def plan_sources(rows: pa.Table, seed: int = SEED, shards: int | None = None, blocks_per_source: int = BLOCKS) -> pa.Table:
    """``PLAN`` of ``no_source, src, source_size``; the number of shards grows with the words, if it is not given."""
    rows = rows.take(pa.compute.sort_indices(rows, sort_keys=[("no_source", "ascending"), ("src", "ascending")]))
    sizes = rows.column("source_size").to_numpy().astype(np.int64)
    weights = np.arange(len(sizes)) % 3 + 1.0
    target = shares(sizes, weights)
    n = block_counts(sizes, blocks_per_source)
    quota = np.where(sizes > 0, np.rint(target * n / np.maximum(sizes, 1)), 0).astype(np.int64)
    quota = np.minimum(quota, MOST_REPEATS * n)
    if shards is None:
        wanted = min(MOST_SHARDS, max(SHARDS, int(sizes.sum()) // SHARD_WORDS))
        shards = 1 << (max(1, min(wanted, MOST_CELLS // max(1, len(sizes)))).bit_length() - 1)
    ends = np.cumsum(split(quota, shards, seed), axis=1, dtype=np.int64)
    step = np.maximum(1, (n * 0.618).astype(np.int64))
    while (apart := np.gcd(step, n) > 1).any():
        step += apart
    turn = (seed * 7919 + 31 * np.arange(len(n))) % n
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * shards), pa.array(ends.reshape(-1)))
    made = {"weight": weights, "target": target, "n_blocks": n, "quota": quota, "step": step, "turn": turn}
    return pa.table({c: rows.column(c) for c in ("no_source", "src", "source_size")} | {c: pa.array(v) for c, v in made.items()} | {"shard_ends": lists})


PLAN = "no_source boolean, src string, source_size long, weight double, target double, n_blocks long, quota long, step long, turn long, shard_ends array<long>"


def places(sizes: DataFrame, seed: int = SEED, shards: int | None = None, blocks_per_source: int = BLOCKS) -> DataFrame:
    """Each row of ``doc_id, source, size, check`` (and what else it has) with its place on the source's line.

    ``shards`` is a power of two.  The plan of the sources is one row each, made in one small task; documents never are.
    """
    chunks = max(1, math.ceil(sizes.count() / CHUNK_DOCS))
    before = lambda order, *keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = lambda size, over: F.coalesce(F.sum(size).over(over), F.lit(0))
    rows = sizes.select(
        "*",
        F.coalesce("source", F.lit("")).alias("src"),
        F.col("source").isNull().alias("no_source"),
        F.xxhash64(F.lit(seed), "doc_id", "size", "check").alias("key"),
    ).withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(chunks)))
    by_source = ["no_source", "src"]
    totals = rows.groupBy(*by_source, "chunk").agg(F.sum("size").alias("chunk_size"))
    totals = totals.withColumn("run", F.expr(f"chunk div {RUN_CHUNKS}"))
    runs = totals.groupBy(*by_source, "run").agg(F.sum("chunk_size").alias("run_size"))
    plan = runs.groupBy(*by_source).agg(F.sum("run_size").alias("source_size")).groupBy().applyInArrow(lambda rows: plan_sources(rows, seed, shards, blocks_per_source), PLAN)
    run_starts = runs.select(*by_source, "run", ahead("run_size", before(["run"], *by_source)).alias("run_start")).join(plan, by_source)
    starts = totals.withColumn("in_run", ahead("chunk_size", before(["chunk"], *by_source, "run"))).drop("chunk_size").join(run_starts, [*by_source, "run"])
    starts = starts.withColumn("chunk_start", F.col("run_start") + F.col("in_run")).drop("run", "run_start", "in_run")
    inside = before(["key", "doc_id", "size", *(c for c in sizes.columns if c not in ("doc_id", "source", "size"))], *by_source, "chunk")
    placed = rows.withColumn("ahead", ahead("size", inside)).join(starts, [*by_source, "chunk"])
    placed = placed.withColumn("start", F.col("chunk_start") + F.col("ahead"))
    return placed.withColumn("first_block", F.expr("((start + 1) * n_blocks - 1) div greatest(source_size, 1)")).withColumn(
        "last_block", F.expr("((start + size) * n_blocks - 1) div greatest(source_size, 1)")
    )


#: what tells rows with words apart: their places on the sources' lines do not overlap
ROW = ["no_source", "src", "start", "size"]


def layout(sizes: DataFrame, seed: int = SEED, shards: int | None = None, blocks_per_source: int = BLOCKS) -> DataFrame:
    """The rows of ``places`` with the words ``taken`` of each: the sum of its draws, 0 where it has none."""
    placed = written(places(sizes, seed, shards, blocks_per_source), "places")
    mix = written(draws(placed, seed), "mix")
    taken = mix.groupBy(*ROW).agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return placed.join(taken, ROW, "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def draws(placed: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself, one row for each piece of a document that a shard gets: words [from_word, to_word) of ``doc_id``.

    A shard's rows lie in partitions of its own, shuffled by a keyed hash.
    """
    rows = _pieces(placed, seed).select("shard", "spot", "doc_id", "source", "draw", "from_word", "to_word", *ROW)
    return _dealt(rows, placed.agg(F.sum("size")).first()[0] or 0, 0)


def _dealt(rows: DataFrame, words: int, word_bytes: int) -> DataFrame:
    """Pieces by shard and, within it, by their hash: partitions as the words ask for, and no key that holds more than a piece."""
    n = parts(rows.sparkSession, words * max(1, word_bytes), PART_BYTES)
    return rows.repartition(n, "shard", F.pmod("spot", F.lit(4 * n))).sortWithinPartitions("shard", "spot")


def _pieces(placed: DataFrame, seed: int) -> DataFrame:
    return (
        placed.filter("size > 0")
        .withColumn("block", F.expr("explode(sequence(first_block, last_block))"))
        .withColumn("rank", F.expr("(step * block + turn) % n_blocks"))
        .withColumn("from_word", F.expr("greatest(0, (block * source_size) div n_blocks - start)"))
        .withColumn("to_word", F.expr("least(size, ((block + 1) * source_size) div n_blocks - start)"))
        .withColumn("passes", F.expr("quota div n_blocks + CASE WHEN rank < quota % n_blocks THEN 1 ELSE 0 END"))
        .filter("passes > 0 AND to_word > from_word")
        .withColumn("pass", F.expr("explode(sequence(0L, passes - 1))"))
        .withColumn("draw", F.expr("pass * n_blocks + rank"))
        .withColumn("shard", F.expr("size(filter(shard_ends, e -> e <= draw))"))
        .withColumn("spot", F.xxhash64(F.lit(seed), "no_source", "src", "draw", "start", "from_word"))
    )


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """All columns of ``docs``, a row for each draw's piece of a document, shard by shard in a shuffled order.

    Each source gives exactly the words of its quota of blocks.  A piece keeps the white space up to the next one, so the pieces of one pass over
    a document make its text again; ``n_chars`` and ``n_words`` (if there are any) of a cut document are the piece's own.
    """
    keyed = written(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    sizes = written(word_counts(keyed, "__row"), "sizes")
    pieces = _pieces(places(sizes, seed), seed)
    # A document is cut once a block and taken MOST_REPEATS times at most, which bounds its list.
    lists = pieces.groupBy("__row").agg(F.collect_list(F.struct("shard", "spot", "from_word", "to_word")).alias("__pieces"))
    words = sizes.agg(F.sum("size")).first()[0] or 0
    mixed = _dealt(_cut(keyed.join(lists.hint("shuffle_hash"), "__row"), docs), words, 8)
    return mixed.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def _cut(listed: DataFrame, docs: DataFrame) -> DataFrame:
    """One row for each piece: the columns of ``docs`` by number, and what orders the mix."""
    names = [c.lower() for c in docs.columns]
    at, n = names.index("text"), len(names)
    counts = {c: names.index(c) for c in ("n_chars", "n_words") if c in names}
    keys = ["shard", "spot"]
    schema = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns))).schema
    for c in keys:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(at)):
                starts, _, first = block.words()
                raw, lists = block.data.tobytes(), batch.column(n)[lo:hi].to_pylist()
                row = np.repeat(np.arange(hi - lo), [len(x) for x in lists])
                parts = [p for x in lists for p in x]
                begin, end = (np.array([p[c] for p in parts], dtype=np.int64) for c in ("from_word", "to_word"))
                size = np.diff(first)[row]
                edge = np.append(starts, len(raw))
                a = np.where(begin == 0, block.offs[row], edge[first[row] + begin])
                b = np.where(end == size, block.offs[row + 1], edge[first[row] + end])
                piece_texts = [raw[x:y].decode("utf-8", "replace") for x, y in zip(a.tolist(), b.tolist())]
                columns = [batch.column(i)[lo:hi].take(pa.array(row)) if i != at else pa.array(piece_texts, batch.schema.field(at).type) for i in range(n)]
                whole = (begin == 0) & (end == size)
                for name, i in counts.items():
                    own = [len(t) for t in piece_texts] if name == "n_chars" else (end - begin).tolist()
                    columns[i] = pa.array([x if w else y for x, y, w in zip(columns[i].to_pylist(), own, whole.tolist())], columns[i].type)
                yield pa.RecordBatch.from_arrays(columns + [pa.array([p[c] for p in parts], pa.int64()) for c in keys], names=schema.names)

    return listed.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)), "__pieces").mapInArrow(tidied(run), schema)


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    placed = layout(written(word_counts(table(spark, sf_dir, "documents")), "sizes"))
    return placed.select("doc_id", "size", "source_size", "target", "taken", "source", "quota", "n_blocks")

"""Ranked lexical search by bag deduplication: every item against all documents, in blocks of items.

A document is cut down to its bag: how often it holds each term of a block's items, term by term in one order.  Its score with any item
depends on that bag and on its length norm ``m`` alone, so documents that agree in both are one class.  Classes are formed by hash and verified
by the whole bag (both are grouping keys), are scored once, and only the classes that win a place for some item are expanded into members,
by ascending doc_id.  A class stands before another by score, then by its smallest doc_id; the ten best classes of an item so hold its ten
best documents, however many members a class has.

Items come in blocks of about ``BLOCK_BYTES`` of text, each with a pass over the documents of its own: what a task holds (vocabulary,
postings, weights) has that bound, while the number of items has none.  Terms are compared by 64-bit hashes, members find their class by 128
bits.  Texts over ``SLICE`` bytes are counted slice by slice, cut between terms.

Defined results: null and empty texts, and texts without a term, count nowhere and are never found; repeated rows are documents of their own and
take ranks of their own; a null doc_id comes last among equal scores; each row of the items is an item of its own, also with a null or
repeated item_id; items without a term, or with terms that no document holds, have no rows; empty tables give an empty table; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.llm.arrow_text import LOWER, Block, string_buffers, tidied
from limes.llm.common import table, texts, written
from limes.llm.slices import slices

TOP, BLOCK_BYTES, SLICE, STEP_CELLS = 10, 4 << 20, 2 << 20, 2_000_000
RESULT = "item_id long, rank int, doc_id long, score long"

#: bytes of terms in lower case, all else a blank
TERM_BYTE = np.full(256, 32, dtype=np.uint8)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    TERM_BYTE[_lo : _hi + 1] = LOWER[_lo : _hi + 1]


def term_blocks(column: pa.Array, most_bytes: int = SLICE) -> Iterator[tuple[np.ndarray, Block]]:
    """Runs of texts, with the row of each, in which terms are what stands between blanks."""
    for rows, block in slices(column, most_bytes, TERM_BYTE == 32):
        yield rows, Block(TERM_BYTE[block.data], block.offs)


class Queries:
    """A block of items: the sorted hashes of their terms, and for each term the items that hold it."""

    def __init__(self, item_ids: list[int | None], item_texts: list[str]):
        self.item_ids = item_ids
        own, hashes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for rows, block in term_blocks(pa.array(item_texts, pa.large_string())):
            own.append(rows[block.text_of_word()])
            hashes.append(block.word_hashes())
        self.vocabulary, term = np.unique(np.concatenate(hashes), return_inverse=True)
        pair, times = np.unique(term.reshape(-1) * np.int64(max(1, len(item_ids))) + np.concatenate(own), return_counts=True)
        self.item, self.times = pair % max(1, len(item_ids)), times.astype(np.int64)
        self.first = np.searchsorted(pair // max(1, len(item_ids)), np.arange(len(self.vocabulary) + 1))


def bags(docs: DataFrame, queries: Queries) -> DataFrame:
    """``doc_id``, the number ``n`` of terms and the ``bag``: pairs of a term's number in the vocabulary and its occurrences."""
    vocabulary = queries.vocabulary
    v = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, keys, counts = np.zeros(batch.num_rows, dtype=np.int64), [], []
            for rows, block in term_blocks(batch.column(1)):
                np.add.at(size, rows, np.diff(block.words()[2]))
                hashes = block.word_hashes()
                term = np.minimum(np.searchsorted(vocabulary, hashes), v - 1)
                known = vocabulary[term] == hashes if len(vocabulary) else np.zeros(len(hashes), dtype=bool)
                key, count = np.unique(rows[block.text_of_word()[known]] * np.int64(v) + term[known], return_counts=True)
                keys.append(key)
                counts.append(count)
            key, at = np.unique(np.concatenate(keys or [np.zeros(0, dtype=np.int64)]), return_inverse=True)
            count = np.bincount(at.reshape(-1), np.concatenate(counts or [np.zeros(0)]), len(key)).astype(np.uint32)
            pairs = np.stack([(key % v).astype(np.uint32), count], axis=1)
            bounds = (np.searchsorted(key // v, np.arange(batch.num_rows + 1)) * 8).astype(np.int64)
            packed = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(pairs.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), packed.cast(pa.binary())], ["doc_id", "n", "bag"])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, n long, bag binary")


def _opened(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bounds of each bag among all pairs, the terms and their occurrences."""
    data, offs = string_buffers(column)
    pairs = np.ascontiguousarray(data).view(np.uint32).reshape(-1, 2).astype(np.int64)
    return offs // 8, pairs[:, 0], pairs[:, 1]


def classes(found: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """One row for each different (bag, m): its digest, its smallest doc_id and its number of members."""
    return digested(found, n_docs, n_terms).groupBy("h1", "h2", "m", "bag").agg(F.min("doc_id").alias("first"), F.count("*").alias("members"))


def digested(found: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Rows with a term of the vocabulary, with their norm ``m`` and the class's digest; decimals keep the product whole."""
    m = F.expr(f"CAST(25 + (CAST(n AS DECIMAL(15, 0)) * CAST({75 * n_docs} AS DECIMAL(22, 0))) DIV CAST({n_terms} AS DECIMAL(22, 0)) AS LONG)")
    rows = found.filter(F.octet_length("bag") > 0).withColumn("m", m)
    return rows.withColumns({"h1": F.xxhash64("bag", "m"), "h2": F.xxhash64("m", F.lit(1), "bag")})


def document_frequencies(own: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary; a task sums up before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            bounds, term, _ = _opened(batch.column(0))
            np.add.at(total, term, np.repeat(batch.column(1).to_numpy(), np.diff(bounds)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "docs"])

    counted = own.select("bag", "members").mapInArrow(tidied(run), "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toPandas()
    out = np.zeros(size, dtype=np.int64)
    out[counted["term"].to_numpy(np.int64)] = counted["docs"].to_numpy(np.int64)
    return out


def weights(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in frequencies.tolist()], dtype=np.int64)


class Best:
    """The best ``TOP`` classes of each item so far, by score and then smallest doc_id."""

    def __init__(self, n_items: int):
        self.limit = np.ones(n_items, dtype=np.int64)
        self.rows = np.zeros((0, 5), dtype=np.int64)  # item, score, first, h1, h2

    def add(self, scores: np.ndarray, first: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.limit)
        rows = np.concatenate([self.rows, np.stack([item, scores[row, item], first[row], h1[row], h2[row]], axis=1)])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        start = np.searchsorted(rows[:, 0], np.arange(len(self.limit) + 1))
        rank = np.arange(len(rows)) - start[rows[:, 0]]
        tenth = rank == TOP - 1
        self.limit[rows[tenth, 0]] = rows[tenth, 1]
        self.rows = rows[rank < TOP]


def scored(own: DataFrame, queries: Queries, weight: np.ndarray) -> DataFrame:
    """The best classes of each item in each task, from one pass over the classes."""
    n_items = len(queries.item_ids)
    degree = np.diff(queries.first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items)
        for batch in batches:
            bounds, term, times = _opened(batch.column(0))
            m, h1, h2 = (batch.column(i).to_numpy() for i in (1, 3, 4))
            smallest = batch.column(2).fill_null((1 << 63) - 1).to_numpy()
            own_row = np.repeat(np.arange(len(m)), np.diff(bounds))
            part = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[own_row]))
            meets = np.concatenate([[0], np.cumsum(degree[term])])[bounds]
            lo = 0
            while lo < len(m):
                most = int(np.searchsorted(meets, meets[lo] + STEP_CELLS, side="right")) - 1
                hi = min(len(m), max(lo + 1, min(most, lo + STEP_CELLS // n_items)))
                a, b = bounds[lo], bounds[hi]
                each = degree[term[a:b]]
                end = np.cumsum(each)
                place = np.arange(end[-1] if len(end) else 0) + np.repeat(queries.first[term[a:b]] - (end - each), each)
                scores = np.zeros((hi - lo, n_items), dtype=np.int64)
                cell = np.repeat((own_row[a:b] - lo) * n_items, each) + queries.item[place]
                np.add.at(scores.reshape(-1), cell, np.repeat(part[a:b], each) * queries.times[place])
                best.add(scores, smallest[lo:hi], h1[lo:hi], h2[lo:hi])
                lo = hi
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.rows.T], ["item", "score", "first", "h1", "h2"])

    return own.select("bag", "m", "first", "h1", "h2").mapInArrow(tidied(run), "item long, score long, first long, h1 long, h2 long")


def _first_of(rows: DataFrame, name: str, keys: list[str], *order) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= TOP)


def _expanded(best: DataFrame, found: DataFrame, queries: Queries, n_docs: int, n_terms: int) -> DataFrame:
    """Documents of the winning classes: of each class its ``TOP`` smallest ids at most, which the window cuts down before it shuffles."""
    chosen = written(_first_of(best, "place", ["item"], F.desc("score"), F.asc("first")).select("item", "score", "h1", "h2"), "search-classes")
    wanted = chosen.select("h1", "h2").distinct()
    rows = digested(found, n_docs, n_terms).select("doc_id", "h1", "h2").join(F.broadcast(wanted), ["h1", "h2"], "left_semi")
    members = _first_of(rows, "nth", ["h1", "h2"], F.asc_nulls_last("doc_id")).select("h1", "h2", "doc_id")
    ids = found.sparkSession.createDataFrame(list(enumerate(queries.item_ids)), "item long, item_id long")
    ranked = _first_of(chosen.join(members, ["h1", "h2"]), "rank", ["item"], F.desc("score"), F.asc_nulls_last("doc_id"))
    return ranked.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``TOP`` best documents of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``.

    Items of one block come to the driver, ``block_bytes`` of them by expectation (a longer one stands alone); blocks are dealt by a hash.
    """
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") > 0)
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out, n_docs, n_terms = [], None, None
    for k in range(n_blocks):
        rows = asked.filter(block == k).orderBy("item_id", "text").collect() if size else []
        if not rows:
            continue
        queries = Queries([r.item_id for r in rows], [r.text for r in rows])
        found = written(bags(docs, queries), "search-bags")
        if n_docs is None:
            n_docs, n_terms = (x or 0 for x in found.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first())
        if not n_terms or not len(queries.vocabulary):
            continue
        own = written(classes(found, n_docs, n_terms), "search-bag-classes")
        weight = weights(document_frequencies(own, len(queries.vocabulary)), n_docs)
        out.append(_expanded(scored(own, queries, weight), found, queries, n_docs, n_terms))
    return reduce(DataFrame.unionByName, out) if out else docs.sparkSession.createDataFrame([], RESULT)


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = rf"""
WITH words AS (SELECT doc_id, row_number() OVER () AS d, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
long_docs AS (SELECT doc_id, d, len(terms) AS n, terms FROM words WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM long_docs),
asked AS (SELECT item_id, i, unnest(terms) AS term FROM (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS terms FROM benchmark WHERE text IS NOT NULL)),
wanted AS (SELECT item_id, i, term, count(*) AS times FROM asked GROUP BY ALL),
tf AS (
    SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(terms) AS term FROM long_docs) GROUP BY d, term
),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
weight AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, corpus),
norm AS (SELECT d, doc_id, (25 + (75 * n * nn) // ll)::BIGINT AS m FROM long_docs, corpus),
scores AS (
    SELECT item_id, i, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (d) GROUP BY ALL
),
ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
    FROM scores JOIN norm USING (d) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

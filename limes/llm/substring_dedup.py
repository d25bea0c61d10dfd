"""Substring deduplication: Rabin-Karp hashes of every fixed-length token window, counted in Spark.

A window is ``width`` consecutive words of one document.  A word is removed if a window covers it whose word sequence also starts in
a document with a smaller ``doc_id``; windows are judged on the input.

1. Each task hashes all windows of its documents and settles what it can alone: of equal windows in hand, only those of
   the smallest document are still open, so a passage that stands in a third of all documents leaves a task once.
2. Open windows are dealt by the leading bits of their hash, packed by thousands into binary values.  Where a hash comes from
   several documents, all windows but the smallest document's are settled.
3. Settled windows go to their documents' group and meet the texts there; overlapping ones merge into maximal intervals.

A reply names its document by ``doc_id`` and carries the window's place and hash.  Where rows share a doc_id (or have none), they are told apart by
hash: a row loses the windows it holds of those that its id lost.  Groups are made from id and text, so such rows are spread over all groups.

Hashes are below 2**61, so two different windows among n agree by chance with probability n**2 / 2**62.  A partition holds about
``PART_BYTES`` of texts in ``GROUPS_IN_PART`` groups, a bucket about ``BUCKET_BYTES`` of hashes, at any size; there is no most number
of buckets, but beyond some 10 TB a task's payload for one bucket holds few windows, and its overhead of some 40 bytes shows.

Defined results: null and empty texts have no words; shorter texts than a window lose nothing; rows that repeat a doc_id are not smaller than
each other, so both keep what they share; a null doc_id counts as the largest one and stays null; a text must fit a Python worker
some twenty times; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import collections
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.arrow_text import U64, Block, blocks, string_buffers, tidied, tidy
from limes.llm.common import parts, table, text_bytes, texts
from limes.llm.packed import NO_ID, group_column, group_of, key_column, pack, runs, steps, unpack

WIDTH, HELD_WINDOWS = 50, 5 << 19
PART_BYTES, GROUPS_IN_PART, BUCKET_BYTES, HASHES_OF_TEXT = 27 << 20, 2, 8 << 20, 1.8


def settled_rows(ids: np.ndarray, group: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(group, payload) of windows by document and place."""
    if not len(ids):
        return
    order = np.lexsort((at, ids, group))
    ids, group, at, hashes = ids[order], group[order], at[order], hashes[order]
    for s, n in zip(*runs(group)):
        own = slice(s, s + n)
        first, many = runs(ids[own])
        yield int(group[s]), pack(ids[own][first], many.astype(np.uint32), steps(at[own].astype(np.uint32)), hashes[own])


class _Open:
    """Windows that a task holds until they are sent."""

    def __init__(self, bits: int, groups: int):
        self.bits, self.groups = bits, groups
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.rows, self.at, self.ids, self.group, self.n = [], [], [], [], [], 0

    def add(self, ids: np.ndarray, block: Block, width: int) -> None:
        hashes, word = block.windows(width, block.word_hashes())
        row = block.text_of_word()[word] if len(word) else word
        self.hashes.append(hashes)
        self.rows.append((row + sum(map(len, self.ids))).astype(np.uint32))
        self.at.append((word - block.words()[2][row]).astype(np.uint32))
        self.ids.append(ids)
        checks = np.array([zlib.crc32(block.data[block.offs[i] : block.offs[i + 1]]) for i in range(block.n)], dtype=np.int64)
        self.group.append(group_of(ids, checks, self.groups).astype(np.uint32))
        self.n += len(hashes)

    def send(self) -> Iterator[tuple[int, bool, bytes]]:
        if not self.n:
            self._clear()
            return
        hashes, rows, at, ids, group = (np.concatenate(x) for x in (self.hashes, self.rows, self.at, self.ids, self.group))
        self._clear()
        beaten = larger_holders(hashes, ids[rows])
        for k, payload in settled_rows(ids[rows[beaten]], group[rows[beaten]], at[beaten], hashes[beaten]):
            yield k & ((1 << self.bits) - 1), True, np.int64(k).tobytes() + payload
        still = np.ones(len(hashes), dtype=bool)
        still[beaten] = False
        still = np.flatnonzero(still)
        bucket = hashes[still] >> U64(64 - self.bits)
        by = np.argsort(bucket, kind="stable")
        order, bucket = still[by], bucket[by]
        for k, size in zip(*runs(bucket)):
            own = order[k : k + size]
            s, n = runs(rows[own])
            first = rows[own][s]
            low = np.ascontiguousarray(np.ascontiguousarray(hashes[own]).view(np.uint8).reshape(-1, 8)[:, :7].T)
            head = pack(steps(ids[first]), group[first], n.astype(np.uint32), steps(at[own]))
            yield int(bucket[k]), False, np.array([len(own), len(head)], dtype=np.int64).tobytes() + head + low.tobytes()


def larger_holders(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of windows that also stand in a document with a smaller id."""
    order = np.argsort(hashes)
    sorted_hashes = hashes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[order], first) if len(first) else ids[:0]
    many = np.diff(np.append(first, len(order)))
    return order[ids[order] > np.repeat(least, many)]


def _unpack_open(data: bytes, top: int) -> tuple[np.ndarray, ...]:
    """Hashes (``top`` is their first byte), ids, groups and places."""
    n, head = np.frombuffer(data, dtype=np.int64, count=2).tolist()
    ids, group, many, at = unpack(data[16 : 16 + head], np.int64, np.uint32, np.uint32, np.uint32)
    whole = np.full((n, 8), top, dtype=np.uint8)
    whole[:, :7] = np.frombuffer(data, dtype=np.uint8, count=7 * n, offset=16 + head).reshape(7, n).T
    return whole.view(U64).reshape(n), np.repeat(np.cumsum(ids), many), np.repeat(group, many), np.cumsum(at, dtype=np.uint32)


_SENT = ("bucket", pa.int64()), ("settled", pa.bool_()), ("payload", pa.binary())


def windows(docs: DataFrame, width: int, bits: int, groups: int) -> DataFrame:
    """``bucket, settled, payload`` from ``key, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Open(bits, groups)
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for lo, hi, block in blocks(batch.column(1)):
                held.add(ids[lo:hi], block, width)
                if held.n >= HELD_WINDOWS:
                    yield from _sent(held)
        yield from _sent(held)

    return docs.mapInArrow(tidied(run), "bucket long, settled boolean, payload binary")


def _sent(held: _Open) -> Iterator[pa.RecordBatch]:
    rows = held.send()
    while some := list(itertools.islice(rows, 64)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*some), _SENT)], [n for n, _ in _SENT])


def settle(open_windows: DataFrame, bits: int) -> DataFrame:
    """``grp, payload``: all settled windows, by group of documents."""

    def run(rows: pa.Table) -> pa.Table:
        tidy()
        out, opened = [], []
        for bucket, done, data in zip(*(rows.column(n).to_pylist() for n, _ in _SENT)):
            if done:
                out.append((int(np.frombuffer(data, dtype=np.int64, count=1)[0]), data[8:]))
            else:
                opened.append(_unpack_open(data, bucket >> (bits - 8)))
        if opened:
            hashes, ids, group, at = (np.concatenate(c) for c in zip(*opened))
            beaten = larger_holders(hashes, ids)
            out += settled_rows(ids[beaten], group[beaten], at[beaten], hashes[beaten])
        return pa.table({"grp": pa.array([g for g, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    return open_windows.groupBy("bucket").applyInArrow(run, "grp int, payload binary")


def covered(at: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal intervals that windows starting at ``at`` cover."""
    at = np.unique(at).astype(np.int64)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > width) + 1
    begin, last = at[np.concatenate([[0], cut])], at[np.append(cut, len(at)) - 1]
    return list(zip(begin.tolist(), (last + width).tolist()))


def lost_windows(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and hashes of a group's settled windows by doc_id."""
    found: dict[int, list] = {}
    for data in rows.column("payload").to_pylist():
        ids, many, at, hashes = unpack(data, np.int64, np.uint32, np.uint32, U64)
        cuts = np.cumsum(many)[:-1]
        at = np.cumsum(at, dtype=np.uint32)
        for i, *piece in zip(ids.tolist(), np.split(at, cuts), np.split(hashes, cuts)):
            found.setdefault(i, []).append(piece)
    return {k: tuple(np.concatenate(c) for c in zip(*v)) for k, v in found.items()}


def _of_row(data: np.ndarray, hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the windows of a text that have one of these hashes."""
    block = Block(data, np.array([0, len(data)]))
    own, at = block.windows(width, block.word_hashes())
    return at[np.isin(own, hashes)]


DEDUPED = "doc_id long, n_words long, kept string, removed array<struct<from_word:long,to_word:long>>"
_SPANS = pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())]))


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each document's kept words, joined by one space, and the intervals of words that were removed."""
    rows = texts(docs)
    size = text_bytes(rows)
    n = parts(docs.sparkSession, size, PART_BYTES)
    groups = GROUPS_IN_PART * n
    bits = max(8, math.ceil(math.log2(max(1, HASHES_OF_TEXT * size / BUCKET_BYTES))))
    keyed = rows.select("doc_id", key_column().alias("key"), "text")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        found = lost_windows(right)
        data, offs = string_buffers(left.column("text"))
        raw = data.tobytes()
        keys, out = left.column("key").to_pylist(), []
        rows_of = collections.Counter(keys)
        for i, (doc, key) in enumerate(zip(left.column("doc_id").to_pylist(), keys)):
            words, spans = raw[offs[i] : offs[i + 1]].split(), []
            if key in found:
                at, hashes = found[key]
                spans = covered(at if rows_of[key] == 1 else _of_row(data[offs[i] : offs[i + 1]], hashes, width), width)
            kept, done = [], 0
            for a, b in spans:
                kept += words[done:a]
                done = b
            kept += words[done:]
            out.append((doc, len(words), b" ".join(kept).decode("utf-8", "replace"), [{"from_word": a, "to_word": b} for a, b in spans]))
        columns = list(zip(*out)) or [[]] * 4
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("doc_id", "n_words", "kept", "removed"), columns, (pa.int64(), pa.int64(), pa.string(), _SPANS))})

    # Exchanges are sized by the input, whatever the session's number of shuffle partitions.
    opened = windows(keyed.select("key", "text"), width, bits, groups).repartition(n, "bucket")
    replies = settle(opened, bits).repartition(n, "grp")
    grouped = keyed.withColumn("grp", group_column(F.col("key"), F.col("text"), groups)).repartition(n, "grp")
    return grouped.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(run, DEDUPED)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    rows = deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["to_word"] - s["from_word"])
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))

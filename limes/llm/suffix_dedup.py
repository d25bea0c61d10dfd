"""Suffix-array deduplication: equal segments are settled by hash counts, all others by suffix arrays from two-stage sorting.

A byte is removed if it is covered by a string of ``LENGTH`` bytes that also starts anywhere else, in the same document or another; strings are
judged on the input and never cross documents.

Spreading.  Every string of ``LENGTH`` bytes holds an anchor: of its substrings of ``ANCHOR`` bytes the one with the least hash, the leftmost
of equals.  Equal strings have equal anchors, so suffixes dealt by anchor meet all suffixes they can share ``LENGTH`` bytes with.
Strings of one document that start side by side and share an anchor are a segment, which is sent instead of its suffixes.

1. Tasks cut segments and collapse equal ones in hand: their strings repeat.  What is left goes, as hashes, to the
   anchor's bucket, which settles equal segments and asks for the text of different ones under one anchor.
2. Documents send these texts to the anchor's bucket.
3. The bucket's text gets a suffix array by two-stage sorting: suffixes smaller than their successor are sorted
   directly, the others are induced by one scan over the array bucket by bucket, each step a numpy pass.  Order holds for ``LENGTH`` bytes, which is
   all that is asked.  Common prefixes of adjacent suffixes, computed to ``LENGTH`` bytes, tell the repeated strings.
4. Repeated strings return to their documents, merge into maximal runs, and the rest is kept.

An anchor under very many different segments (a common passage in ever other surroundings) would fill one bucket.  A pass before counts all
segments in ``2**SLOT_BITS`` slots by their anchor, equal ones of one hand once; a slot is hot if it holds ``HOT_LEAST`` segments (some
half a megabyte of text) more than the median slot.  No anchor with as many escapes, however small its share or however thinly it is spread, since a slot counts at
least what its anchors do.  Strings under hot slots are dealt by their own hash instead, which is right for any anchor and dear only in payload, so
no more than ``HOT_SLOTS`` of the slots, the fullest, are hot.  Counters and the list of hot slots have a fixed size, whatever the corpus.

Defined results: null and empty texts have no bytes; shorter texts lose nothing; rows that repeat a text remove each other's strings, as any
two documents do; rows that repeat a doc_id, or have none, are documents of their own; a null doc_id is kept null; a text of up to 2 GiB, the most
that Spark's strings hold, has to fit a Python worker some five times, as it is cut window by window of ``WINDOW`` bytes; an empty table gives an empty table; extra columns are not read.  Removal may leave bytes that are no UTF-8, so what is kept is binary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.arrow_text import BYTE_CODE, U64, Block, blocks, mix, string_buffers, tidied, tidy
from limes.llm.common import parts, table, text_bytes, texts, written
from limes.llm.packed import group_column, group_of, key_column, pack, runs, steps, unpack

LENGTH, ANCHOR, HELD_SEGMENTS = 200, 120, 400_000
PART_BYTES, GROUPS_IN_PART, BUCKETS_IN_PART = 27 << 20, 8, 8
SLOT_BITS, CHUNK_BITS, HOT_LEAST, HOT_SLOTS = 22, 10, 2_000, 0.01
WINDOW = 2 << 20
_BASE = 0xA24BAED4963EE403  # 3 modulo 8, which keeps powers of two out of differences of its powers
_PLACE = (1 << 31) - 1  # as many bytes as a string of Spark or Arrow can have
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and ``_BASE**-i`` modulo 2**64 for i below ``n`` at least; kept for blocks of common size."""
    if _powers and n <= len(_powers[0][0]):
        return _powers[0]
    size = max(n, (1 << 21) + 4096)
    up, down = np.full(size, _BASE, dtype=U64), np.full(size, pow(_BASE, -1, 1 << 64), dtype=U64)
    up[0] = down[0] = 1
    made = np.multiply.accumulate(up), np.multiply.accumulate(down)
    if size > n:
        _powers[:] = [made]
    return made


def prefix(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + 1, dtype=U64)
    np.cumsum(codes * powers(len(codes) + 1)[0][: len(codes)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of [start, end).  Modulo 2**64 patterns such as abbabaab may cancel, but none of at most 280 bytes does."""
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def text_check(text: bytes | memoryview | np.ndarray) -> int:
    """Tells rows of one doc_id with different texts apart: 64 bits, the lower half being the text's CRC-32."""
    return xxhash.xxh3_64_intdigest(text) >> 32 << 32 | zlib.crc32(text)


def slot_of(name: np.ndarray) -> np.ndarray:
    """By the lower bits, since anchors are chosen for small upper ones."""
    return (name & U64((1 << SLOT_BITS) - 1)).astype(np.int64)


def cuts(block: Block, hot: np.ndarray, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """``cut`` of a block; of a text alone that is longer than ``window``, piece by piece.

    Pieces overlap by ``LENGTH - 1`` bytes, so each string starts in one of them, and a string's anchor is the same in any piece.
    """
    n = len(block.data)
    if block.n > 1 or n <= window:
        yield cut(block, hot)
        return
    for a in range(0, n - LENGTH + 1, window):
        data = block.data[a : a + window + LENGTH - 1]
        begin, *rest = cut(Block(data, np.array([0, len(data)])), hot)
        yield begin + a, *rest


def cut(block: Block, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of a block: first byte, number of strings, anchor hash, hash of the text, row.  ``hot`` flags slots; empty: none."""
    data, n = block.data, len(block.data)
    empty = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return empty, empty, empty.astype(U64), empty.astype(U64), empty
    sums = prefix(BYTE_CODE[data])
    at = np.arange(n - ANCHOR + 1)
    grams = mix(spans(sums, at, at + ANCHOR))
    least = (grams & U64(~_PLACE & (1 << 64) - 1)) | at.astype(U64)
    width, have = LENGTH - ANCHOR + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if width > have:
        least = np.minimum(least[: have - width], least[width - have :])
    anchor = (least & U64(_PLACE)).astype(np.int64)
    edge = np.zeros(n + 1, dtype=np.int64)
    long = np.flatnonzero(np.diff(block.offs) >= LENGTH)
    np.add.at(edge, block.offs[long], 1)
    np.add.at(edge, block.offs[long + 1] - LENGTH + 1, -1)
    start = np.flatnonzero(np.cumsum(edge[: len(anchor)]) > 0)
    if not len(start):
        return empty, empty, empty.astype(U64), empty.astype(U64), empty
    own = anchor[start]
    row = np.searchsorted(block.offs, start, side="right") - 1
    new = np.ones(len(start), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    if len(hot):
        alone = hot[slot_of(grams[own])]
        new |= alone
    first = np.flatnonzero(new)
    begin, many = start[first], np.diff(np.append(first, len(start)))
    text = mix(spans(sums, begin, begin + many + LENGTH - 1)) ^ mix(many.astype(U64))
    name = grams[own[first]]
    if len(hot):
        name = np.where(alone[first], mix(text ^ U64(0x2545F4914F6CDD1D)), name)
    return begin, many, name, text, row[first]


def hot_slots(docs: DataFrame, n: int, held_segments: int = HELD_SEGMENTS) -> np.ndarray:
    """Which slots are hot, as bits; all segments are counted, in ``n`` partitions."""
    none, width = np.zeros(0, dtype=bool), 1 << CHUNK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names, texts_, held = np.zeros(1 << SLOT_BITS, dtype=np.uint32), [], [], 0

        def settle() -> None:
            pairs = np.unique(np.stack([np.concatenate(names), np.concatenate(texts_)], axis=1), axis=0)
            slot, many = np.unique(slot_of(pairs[:, 0]), return_counts=True)
            counts[slot] += many.astype(np.uint32)
            names.clear()
            texts_.clear()

        for batch in batches:
            for _, _, block in blocks(batch.column(1)):
                for _, _, name, text, _ in cuts(block, none):
                    names.append(name)
                    texts_.append(text)
                    held += len(name)
                    if held >= held_segments:
                        settle()
                        held = 0
        if names:
            settle()
        filled = np.flatnonzero(counts.reshape(-1, width).any(axis=1))
        for some in np.split(filled, np.arange(256, len(filled), 256)):
            yield _record([(int(c), pack(counts[c * width : (c + 1) * width])) for c in some], ["chunk", "counts"], [pa.int32(), pa.binary()]) if len(some) else _NO_COUNTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + unpack(data, np.uint32)[0].astype(np.int64)
        if sums:
            yield _record([(c, pack(v)) for c, v in sums.items()], ["chunk", "counts"], [pa.int32(), pa.binary()])

    counted = docs.mapInArrow(tidied(count), "chunk int, counts binary").repartition(min(n, 1 << (SLOT_BITS - CHUNK_BITS)), "chunk")
    total = np.zeros((1 << (SLOT_BITS - CHUNK_BITS), width), dtype=np.int64)
    for chunk, data in counted.mapInArrow(tidied(add), "chunk int, counts binary").toLocalIterator():
        total[chunk] = unpack(bytes(data), np.int64)[0]
    return np.packbits(_hot(total.ravel()))


def _hot(total: np.ndarray) -> np.ndarray:
    most = int(len(total) * HOT_SLOTS)
    bar = np.median(total) + HOT_LEAST
    return (total >= bar) & (total > np.partition(total, len(total) - most - 1)[len(total) - most - 1])


_NO_COUNTS = pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary())], ["chunk", "counts"])


def _reply(ids, checks, begin, many, groups: int) -> Iterator[tuple[int, bytes]]:
    """(group, payload) of strings [begin, begin + many) by document."""
    if not len(ids):
        return
    group = group_of(ids, checks & U64(0xFFFFFFFF), groups)
    order = np.lexsort((begin, checks, ids, group))
    ids, checks, begin, many, group = ids[order], checks[order], begin[order], many[order], group[order]
    for s, n in zip(*runs(group)):
        own = slice(s, s + n)
        new = np.flatnonzero((np.diff(ids[own]) != 0) | (checks[own][1:] != checks[own][:-1])) + 1
        first = np.concatenate([[0], new])
        yield int(group[s]), pack(ids[own][first], checks[own][first], np.diff(np.append(first, n)).astype(np.uint32), steps(begin[own].astype(np.uint32)), many[own].astype(np.uint32))


def _replies(rows: list[bytes]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    found: dict[tuple[int, int], list] = {}
    for data in rows:
        ids, checks, count, begin, many = unpack(data, np.int64, U64, np.uint32, np.uint32, np.uint32)
        begin = np.cumsum(begin, dtype=np.uint32).astype(np.int64)
        ends = np.cumsum(count)
        for i, c, b, m in zip(ids.tolist(), checks.tolist(), np.split(begin, ends[:-1]), np.split(many.astype(np.int64), ends[:-1])):
            found.setdefault((i, c), []).append((b, m))
    return {k: tuple(np.concatenate(x) for x in zip(*v)) for k, v in found.items()}


SEGMENT = (U64, U64, np.uint8, np.int64, np.uint32, U64, np.uint32, np.uint32, np.uint16)


class _Held:
    def __init__(self, buckets: int, groups: int):
        self.buckets, self.groups, self.parts, self.n = buckets, groups, [], 0

    def add(self, ids: np.ndarray, block: Block, hot: np.ndarray) -> Iterator[int]:
        """Tells how many segments are held, piece after piece."""
        checks = np.array([text_check(block.data[block.offs[i] : block.offs[i + 1]]) for i in range(block.n)], dtype=U64)
        for begin, many, name, text, row in cuts(block, hot):
            self.parts.append((name, text, ids[row], checks[row], begin - block.offs[row], many))
            self.n += len(name)
            yield self.n

    def send(self) -> Iterator[tuple[int, bool, bytes]]:
        if self.n:
            name, text, ids, checks, begin, many = (np.concatenate(x) for x in zip(*self.parts))
            order = np.lexsort((text, name))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (name[order][1:] != name[order][:-1]) | (text[order][1:] != text[order][:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(order)))
            again = order[np.repeat(count > 1, count)]
            for group, payload in _reply(ids[again], checks[again], begin[again], many[again], self.groups):
                yield group % self.buckets, True, np.int64(group).tobytes() + payload
            one, twice = order[first], (count > 1).astype(np.uint8)
            bucket = (name[one] % U64(self.buckets)).astype(np.int64)
            by = np.lexsort((one, bucket))
            one, twice, bucket = one[by], twice[by], bucket[by]
            for s, n in zip(*runs(bucket)):
                own = one[s : s + n]
                r, m = runs(ids[own])
                c, k = runs(checks[own])
                yield int(bucket[s]), False, pack(name[own], text[own], twice[s : s + n], steps(ids[own][r]), m.astype(np.uint32), checks[own][c], k.astype(np.uint32), begin[own].astype(np.uint32), many[own].astype(np.uint16))
        self.parts, self.n = [], 0


def _record(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def segments(docs: DataFrame, hot_bits: np.ndarray, buckets: int, groups: int) -> DataFrame:
    def sent(held: _Held) -> Iterator[pa.RecordBatch]:
        rows = list(held.send())
        for k in range(0, len(rows), 256):
            yield _record(rows[k : k + 256], ["bucket", "settled", "payload"], [pa.int32(), pa.bool_(), pa.binary()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = _Held(buckets, groups), np.unpackbits(hot_bits).astype(bool)
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for lo, hi, block in blocks(batch.column(1)):
                for n in held.add(ids[lo:hi], block, hot):
                    if n >= HELD_SEGMENTS:
                        yield from sent(held)
        yield from sent(held)

    return docs.mapInArrow(tidied(run), "bucket int, settled boolean, payload binary")


FOUND = "grp int, asked boolean, payload binary"


def compare(cut_segments: DataFrame, groups: int) -> DataFrame:
    """Settled strings, and requests for the texts of different segments under one anchor, by group of documents."""

    def run(rows: pa.Table) -> pa.Table:
        tidy()
        out, met = [], []
        for done, data in zip(rows.column("settled").to_pylist(), rows.column("payload").to_pylist()):
            if done:
                out.append((int(np.frombuffer(data, dtype=np.int64, count=1)[0]), False, data[8:]))
            else:
                name, text, twice, ids, m, checks, k, begin, many = unpack(data, *SEGMENT)
                met.append((name, text, twice, np.repeat(np.cumsum(ids), m), np.repeat(checks, k), begin, many))
        if met:
            name, text, twice, ids, checks, begin, many = (np.concatenate(c) for c in zip(*met))
            order = np.lexsort((twice, text, name))
            name, text, twice, ids, checks, begin, many = (c[order] for c in (name, text, twice, ids, checks, begin, many))
            anchor_first = np.ones(len(name), dtype=bool)
            anchor_first[1:] = name[1:] != name[:-1]
            new = anchor_first.copy()
            new[1:] |= text[1:] != text[:-1]
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(name)))
            repeated = np.repeat(count > 1, count) & (twice == 0)  # those counted twice were settled where they were found
            out += [(g, False, p) for g, p in _reply(ids[repeated], checks[repeated], begin[repeated], many[repeated], groups)]
            kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(anchor_first))
            kinds = np.repeat(kinds, np.diff(np.append(np.flatnonzero(anchor_first), len(name))))
            ask = first[kinds[first] > 1]
            known = ((count > 1) | (twice[first] > 0))[kinds[first] > 1]
            group = group_of(ids[ask], checks[ask] & U64(0xFFFFFFFF), groups)
            by = np.argsort(group, kind="stable")
            for s, n in zip(*runs(group[by])):
                a = ask[by[s : s + n]]
                out.append((int(group[by[s]]), True, pack(name[a], known[by[s : s + n]].astype(np.uint8), ids[a], checks[a], begin[a], many[a])))
        return pa.table({"grp": pa.array([g for g, _, _ in out], pa.int32()), "asked": pa.array([a for _, a, _ in out], pa.bool_()), "payload": pa.array([p for _, _, p in out], pa.binary())})

    return cut_segments.groupBy("bucket").applyInArrow(run, FOUND)


def fetch(docs: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """The texts asked for, by bucket of their anchor."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        data, offs = string_buffers(left.column("text"))
        place = {}
        for i, key in enumerate(left.column("key").to_pylist() if right.num_rows else []):
            place[key, text_check(data[offs[i] : offs[i + 1]])] = int(offs[i])
        out = []
        for request in right.column("payload").to_pylist():
            name, known, ids, checks, begin, many = unpack(request, U64, np.uint8, np.int64, U64, np.uint32, np.uint16)
            bucket = (name >> U64(20)) % U64(buckets)
            order = np.lexsort((name, bucket))
            for s, n in zip(*runs(bucket[order])):
                a = order[s : s + n]
                pieces = [data[(p := place[i, c] + b) : p + m + LENGTH - 1].tobytes() for i, c, b, m in zip(ids[a].tolist(), checks[a].tolist(), begin[a].tolist(), many[a].tolist())]
                head = pack(known[a], ids[a], checks[a], begin[a], many[a])
                out.append((int(bucket[a[0]]), np.int64(len(head)).tobytes() + head + b"".join(pieces)))
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    return docs.groupBy("grp").cogroup(asked.groupBy("grp")).applyInArrow(run, "bucket int, payload binary")


def two_stage(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``text`` (uint16, ended by 0), in order for ``depth`` places; ``words[i]`` packs eight places from i on."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    rising = np.zeros(n, dtype=bool)
    ends = np.append(change, n - 1)
    up = np.append(text[change + 1] > text[change], True)
    rising[:] = np.repeat(up, np.diff(np.concatenate([[-1], ends])))
    direct = _sorted(np.flatnonzero(rising), words, depth)
    heads = text[direct]
    cuts = np.searchsorted(heads, np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []

    def scan(chunk: np.ndarray) -> None:
        """Hand the predecessors of final suffixes to their buckets, in order."""
        out.append(chunk)
        before = chunk[chunk > 0] - 1
        before = before[~rising[before]]
        if len(before):
            order = before[np.argsort(text[before], kind="stable")]
            for s, k in zip(*runs(text[order])):
                waiting[text[order[s]]].append(order[s : s + k])

    for c in range(257):
        while waiting[c]:  # a run of one character induces within its own bucket, one wave for each place of the run
            wave, waiting[c] = waiting[c], []
            scan(np.concatenate(wave))
        if cuts[c] < cuts[c + 1]:
            scan(direct[cuts[c] : cuts[c + 1]])
    return np.concatenate(out)


def _sorted(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Sort suffixes directly, eight places at a time, going on only where they tie."""
    order = at[np.argsort(words[at], kind="stable")]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = words[order[1:]] == words[order[:-1]]
    deep = 8
    while deep < depth:
        tied = same.copy()
        tied[:-1] |= same[1:]
        spot = np.flatnonzero(tied)
        if not len(spot):
            break
        group = np.cumsum(~same[spot])
        key = words[np.minimum(order[spot] + deep, len(words) - 1)]
        by = np.lexsort((key, group))
        order[spot] = order[spot][by]
        key = key[by]
        still = np.zeros(len(spot), dtype=bool)
        still[1:] = (group[1:] == group[:-1]) & (key[1:] == key[:-1])
        same[spot] = still
        deep += 8
    return order


def repeated_strings(pieces: bytes, many: np.ndarray) -> np.ndarray:
    """For segments side by side, a flag for each string: does another suffix share its first ``LENGTH`` bytes?"""
    size = many.astype(np.int64) + LENGTH - 1
    n = int(size.sum()) + len(many)
    ends = np.cumsum(size + 1) - 1
    text = np.zeros(n, dtype=np.uint16)
    body = np.ones(n, dtype=bool)
    body[ends] = False
    text[body] = np.frombuffer(pieces, dtype=np.uint8).astype(np.uint16) + 1
    low = np.concatenate([np.minimum(text, 255).astype(U64), np.zeros(8, dtype=U64)])  # UTF-8 has no byte above 0xF4
    words = np.zeros(n, dtype=U64)
    for k in range(8):
        words = (words << U64(8)) | low[k : k + n]
    array = two_stage(text, words, LENGTH)
    begin = ends - size
    starts = np.repeat(begin - np.concatenate([[0], np.cumsum(many[:-1])]), many) + np.arange(int(many.sum()))
    number = np.full(n, -1, dtype=np.int64)
    number[starts] = np.arange(len(starts))
    array = array[number[array] >= 0]
    a, b = array[:-1], array[1:]
    alike = np.arange(len(a))
    for k in range(0, LENGTH, 8):  # adjacent common prefixes, to LENGTH bytes
        alike = alike[words[a[alike] + k] == words[b[alike] + k]]
    flags = np.zeros(len(starts), dtype=bool)
    flags[number[a[alike]]] = True
    flags[number[b[alike]]] = True
    return flags


def sort_buckets(fetched: DataFrame, groups: int) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        tidy()
        heads, pieces = [], []
        for data in rows.column("payload").to_pylist():
            size = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
            heads.append(unpack(data[8 : 8 + size], np.uint8, np.int64, U64, np.uint32, np.uint16))
            pieces.append(data[8 + size :])
        known, ids, checks, begin, many = (np.concatenate(c) for c in zip(*heads))
        many = many.astype(np.int64)
        flags = repeated_strings(b"".join(pieces), many)
        segment = np.repeat(np.arange(len(many)), many)
        inside = np.arange(len(flags)) - np.repeat(np.cumsum(many) - many, many)
        flags &= np.repeat(known == 0, many)
        hit = np.flatnonzero(flags)
        cuts = np.ones(len(hit), dtype=bool)
        cuts[1:] = (np.diff(hit) != 1) | (segment[hit[1:]] != segment[hit[:-1]])
        first = np.flatnonzero(cuts)
        length = np.diff(np.append(first, len(hit)))
        own = segment[hit[first]]
        out = list(_reply(ids[own], checks[own], begin[own].astype(np.int64) + inside[hit[first]], length, groups))
        return pa.table({"grp": pa.array([g for g, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    return fetched.groupBy("bucket").applyInArrow(run, "grp int, payload binary")


DEDUPED = "doc_id long, n_bytes long, kept binary, removed array<struct<from_byte:long,to_byte:long>>"
_SPANS = pa.list_(pa.struct([("from_byte", pa.int64()), ("to_byte", pa.int64())]))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Each document's kept bytes and the maximal runs of bytes that were removed."""
    rows = texts(docs)
    n = parts(docs.sparkSession, text_bytes(rows), PART_BYTES)  # exchanges are sized by the input, whatever the session's number of shuffle partitions
    groups, buckets = GROUPS_IN_PART * n, BUCKETS_IN_PART * n
    with_key = rows.select("doc_id", key_column().alias("key"), "text")
    keyed = with_key.select("key", "text")
    grouped = with_key.withColumn("grp", group_column(F.col("key"), F.col("text"), groups)).repartition(n, "grp")
    found = written(compare(segments(keyed, hot_slots(keyed, n), buckets, groups).repartition(n, "bucket"), groups), "segments")
    sorted_ = sort_buckets(fetch(grouped, found.filter("asked").repartition(n, "grp"), buckets).repartition(n, "bucket"), groups)
    replies = found.filter("NOT asked").select("grp", "payload").unionByName(sorted_).repartition(n, "grp")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        told = _replies(right.column("payload").to_pylist())
        data, offs = string_buffers(left.column("text"))
        raw, out = data.tobytes(), []
        for i, (doc, key) in enumerate(zip(left.column("doc_id").to_pylist(), left.column("key").to_pylist())):
            text = raw[offs[i] : offs[i + 1]]
            hit = told.get((key, text_check(text))) if told else None
            spans_ = merged(*hit) if hit else []
            kept, done = [], 0
            for a, b in spans_:
                kept.append(text[done:a])
                done = b
            out.append((doc, len(text), b"".join([*kept, text[done:]]), [{"from_byte": a, "to_byte": b} for a, b in spans_]))
        columns = list(zip(*out)) or [[]] * 4
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("doc_id", "n_bytes", "kept", "removed"), columns, (pa.int64(), pa.int64(), pa.binary(), _SPANS))})

    return grouped.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(run, DEDUPED)


def merged(begin: np.ndarray, many: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes under strings that start in [begin, begin + many)."""
    order = np.argsort(begin, kind="stable")
    a = begin[order]
    b = np.maximum.accumulate(a + many[order] + LENGTH - 1)
    cuts = np.flatnonzero(a[1:] > b[:-1]) + 1
    return list(zip(a[np.concatenate([[0], cuts])].tolist(), b[np.append(cuts, len(a)) - 1].tolist()))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    rows = deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["to_byte"] - s["from_byte"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

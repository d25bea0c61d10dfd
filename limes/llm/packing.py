"""Sum-of-squares online packing of token ids into windows of 2048.

Each task tokenises its documents and packs them as they come.  Full windows of a long document stand alone; its rest goes to
the fill level that makes the sum over all levels of (number of windows filled so far) squared smallest, by an array of counts
per level.  While ``MOST_OPEN`` windows are open, a document first fills up a window of the most crowded level, which lowers the sum of
squares most.  When a task ends, the fullest open windows stay as they were placed and are filled up with what the emptiest ones hold; the last
rest is cut at powers of two, which need no padding.  Nothing is shuffled, and a rerun task makes the same windows.

Words repeat, and neither normaliser nor pre-tokeniser of the vocabulary joins across white space or between a letter and the stops
after it, nor tells A-Z from a-z.  So a Python worker encodes each distinct word once, without the stops at its end, and copies its ids.
The vocabulary's added tokens are matched as they are written, so words that hold one are known by their exact bytes.

Defined results: null and empty texts are the end id alone; null ids are kept; repeated rows are packed again; of levels with equal sums the fullest
takes the document; a text must fit a Python worker some thirty times; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.arrow_text import U64, Block, blocks, mix, tidied
from limes.llm.common import table, texts

WINDOW, END_ID, MOST_OPEN, MOST_WORDS, BLOCK_BYTES = 2048, 1, 4096, 600_000, 2 << 20
STOP, PLAIN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
STOP[list(b".,;:!?")] = True
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
ADDED = U64(0xA0761D6478BD642F)
_workers: dict[str, WordIds] = {}


def units(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words and of the stops cut off their ends, and each text's first one."""
    starts, ends, first = block.words()
    tail = np.zeros(len(starts), dtype=np.int64)
    going = np.arange(len(starts))
    for n in range(1, 9):
        going = going[(ends[going] - n > starts[going]) & STOP[block.data[ends[going] - n]]]
        tail[going] = n
    tail[~PLAIN[block.data[ends - tail - 1]]] = 0  # stops after a symbol, or very many, belong to it
    cut = tail > 0
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(cut[:-1])]) if len(starts) else starts
    begin, stop = np.empty(len(starts) + int(cut.sum()), dtype=np.int64), np.empty(len(starts) + int(cut.sum()), dtype=np.int64)
    begin[place], stop[place] = starts, ends - tail
    begin[place[cut] + 1], stop[place[cut] + 1] = (ends - tail)[cut], ends[cut]
    return begin, stop, np.append(place, len(begin))[first]


class WordIds:
    """Ids of words by hash, for one Python worker; emptied when it holds ``MOST_WORDS`` words, so its memory is bounded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slot = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.first, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        text = b" ".join(words).decode("utf-8", "replace")
        made = self.tokenizer.encode(text, add_special_tokens=False)
        starts = np.cumsum([0] + [len(w.decode("utf-8", "replace")) + 1 for w in words[:-1]])
        at = np.fromiter((o[0] for o in made.offsets), dtype=np.int64, count=len(made.ids))
        count = np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=len(words)) if len(at) else np.zeros(len(words), dtype=np.int64)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(count)])
        self.ids = np.concatenate([self.ids, np.array(made.ids, dtype=np.uint32)])
        place = np.searchsorted(self.keys, keys)  # both ascend
        self.slot = np.insert(self.slot, place, np.arange(len(self.slot), len(self.slot) + len(keys)))
        self.keys = np.insert(self.keys, place, keys)

    def _with_added(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which units hold an added token."""
        held = set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                unit = int(np.searchsorted(starts, at, side="right")) - 1
                if at + len(token) <= ends[unit]:  # else two texts side by side make it
                    held.add(unit)
                at = raw.find(token, at + 1)
        return np.array(sorted(held), dtype=np.int64)

    def of(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, each text closed by the end id, and the texts' bounds."""
        starts, ends, first = units(block)
        hashes, raw = block.span_hashes(starts, ends, lower=True), block.data.tobytes()
        exact = self._with_added(raw, starts, ends)
        if len(exact):
            hashes[exact] = mix(block.span_hashes(starts[exact], ends[exact]) ^ ADDED)
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > MOST_WORDS:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[at] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(new):
            self._learn(distinct[new], [raw[starts[i] : ends[i]] for i in sample[new]])
        slots = self.slot[np.searchsorted(self.keys, distinct)] if len(distinct) else np.zeros(0, dtype=np.int64)
        begin, size = self.first[slots][which], np.diff(self.first)[slots][which]
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = np.arange(upto[-1]) + np.repeat(begin - upto[:-1], size)
        bounds = upto[first] + np.arange(block.n + 1)
        out = np.full(bounds[-1], END_ID, dtype=np.uint32)
        body = np.ones(len(out), dtype=bool)
        body[bounds[1:] - 1] = False
        out[body] = self.ids[flat]
        return out, bounds


def worker_words(path: str) -> WordIds:
    """The words that this Python worker knows; tasks of one worker share them."""
    if path not in _workers:
        _workers[path] = WordIds(path)
    return _workers[path]


class _Rest:
    """Pieces side by side, from which any number of ids can be cut."""

    def __init__(self, pieces: list[tuple]):
        self.pieces, self.left = pieces[::-1], sum(len(p[2]) for p in pieces)

    def take(self, n: int) -> list[tuple]:
        out, self.left = [], self.left - n
        while n:
            doc, start, ids, total = self.pieces.pop()
            out.append((doc, start, ids[:n], total))
            if len(ids) > n:
                self.pieces.append((doc, start + n, ids[n:], total))
            n -= len(out[-1][2])
        return out


class SumOfSquares:
    """Windows of one task.  A piece is (doc row, start, ids, ids of the document)."""

    def __init__(self, base: int):
        self.next, self.done = base, []
        self.count = np.zeros(WINDOW + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(WINDOW)]
        self.n_open = 0

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, len(ids), total, self.next, offset, ids.tobytes()))
            offset += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= WINDOW:
            self._close([(doc, start, ids[start : start + WINDOW], total)])
            start += WINDOW
        if start < total and self.n_open >= MOST_OPEN:
            level = int(self.count.argmax())
            pieces = self._take(level)
            fill = ids[start : start + WINDOW - level].copy()
            self._put([*pieces, (doc, start, fill, total)], level + len(fill))
            start += len(fill)
        if start < total:
            self._place((doc, start, ids[start:].copy(), total))

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, pieces: list, level: int) -> None:
        if level == WINDOW:
            self._close(pieces)
        else:
            self.open[level].append(pieces)
            self.count[level] += 1
            self.n_open += 1

    def _place(self, piece: tuple) -> None:
        s, n = len(piece[2]), self.count
        room = WINDOW - s
        # change of the sum of squares, halved, for moving a window from level 1..room up by s (a full one leaves the sum)
        change = n[1 + s : WINDOW + 1] - n[1 : room + 1] + 1.0
        if room:
            change[-1] = 0.5 - n[room]
            change[n[1 : room + 1] == 0] = np.inf
        best = room - 1 - int(np.argmin(change[::-1])) if room else -1
        level = best + 1 if best >= 0 and change[best] <= n[s] + 0.5 else 0
        self._put([*(self._take(level) if level else []), piece], level + s)

    def settle(self) -> None:
        """Close all windows: the fullest are filled up from the emptiest, and the last rest is cut at powers of two."""
        windows = [(fill, w) for fill in range(WINDOW - 1, 0, -1) for w in self.open[fill]]
        full = sum(fill for fill, _ in windows) // WINDOW
        self.open, self.n_open = [[] for _ in range(WINDOW)], 0
        self.count[:] = 0
        rest = _Rest([p for _, w in windows[full:] for p in w])
        for fill, pieces in windows[:full]:
            self._close(pieces + rest.take(WINDOW - fill))
        while rest.left:
            self._close(rest.take(1 << (rest.left.bit_length() - 1)))

    def rows(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_TYPES = [pa.int64()] * 6 + [pa.binary()]


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces of documents in windows; ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        known = worker_words(path)
        windows = SumOfSquares(TaskContext.get().partitionId() << 36)
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for lo, _, block in blocks(batch.column(1), BLOCK_BYTES):
                flat, bounds = known.of(block)
                for i in range(block.n):
                    windows.add(ids_of[lo + i], flat[bounds[i] : bounds[i + 1]])
                yield from _batches(windows.rows())
        windows.settle()
        yield from _batches(windows.rows())

    return texts(docs).mapInArrow(tidied(run), PACKED)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], [f.split()[0] for f in PACKED.split(", ")])


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )

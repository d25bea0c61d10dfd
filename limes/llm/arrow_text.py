"""Words of Arrow string columns as numpy arrays: no Python object per word.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 is the same as runs of such
code points.  A word's hash weighs each byte's code with a random factor of its place (modulo 2**64), so no pattern of
letters cancels.  Windows of words have Rabin-Karp hashes modulo the prime 2**61 - 1, for which the chance that two different
windows of ``w`` words agree is ``w / 2**61`` at most, whatever they hold.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_STEP = 0x9E3779B97F4A7C15
_BASE = 0x0B2A5C6E9D31F47B  # of the windows' polynomials; below the prime
PRIME_BITS = 61
PRIME = U64((1 << PRIME_BITS) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix64's finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(_STEP))
LOWER_CODE = BYTE_CODE[LOWER]


def _random(place: np.ndarray) -> np.ndarray:
    return mix((place.astype(U64) + U64(1)) * U64(_STEP) ^ U64(0xD6E8FEB86659FD93)) | U64(1)


_FACTORS = _random(np.arange(1 << 12))


def factors(place: np.ndarray) -> np.ndarray:
    """The random odd factor of each place in a word."""
    if not len(place) or place.max() < len(_FACTORS):
        return _FACTORS[place]
    return _random(place)


def times(x: np.ndarray, by: int) -> np.ndarray:
    """``x * by`` modulo the prime, by halves of 31 bits; both are below 2**61."""
    low, high = U64(by & 0x7FFFFFFF), U64(by >> 31)
    x_low, x_high = x & U64(0x7FFFFFFF), x >> U64(31)
    middle = x_low * high + x_high * low
    return reduced(x_high * high * U64(2) + (middle >> U64(30)) + ((middle & U64(0x3FFFFFFF)) << U64(31)) + x_low * low)


def reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> U64(PRIME_BITS))
    return np.where(x >= PRIME, x - PRIME, x)


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of ``values[i : i + width]`` for every i, put together from widths that are powers of two."""
    part, size, whole, have = reduced(values), 1, None, 0
    while True:
        if width & size:
            if whole is None:
                whole = part
            else:
                n = len(values) - have - size + 1
                whole = reduced(times(whole[:n], pow(_BASE, size, int(PRIME))) + part[have : have + n])
            have += size
        if have == width:
            return whole
        n = len(values) - 2 * size + 1
        part = reduced(times(part[:n], pow(_BASE, size, int(PRIME))) + part[size : size + n])
        size *= 2


class Block:
    """Some texts side by side: ``data`` their bytes, ``offs`` the bounds of each."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs, self.n = data, offs, len(offs) - 1
        self._words: tuple | None = None

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the index of its first word (n + 1 entries)."""
        if self._words is None:
            inside = ~SPACE[self.data]
            before = np.empty_like(inside)
            before[1:] = inside[:-1]
            filled = self.offs[:-1][self.offs[:-1] < self.offs[1:]]
            before[filled] = False
            starts = np.flatnonzero(inside & ~before)
            after = np.zeros_like(inside)
            after[:-1] = inside[1:]
            after[filled[1:] - 1] = False
            ends = np.flatnonzero(inside & ~after) + 1
            self._words = starts, ends, np.searchsorted(starts, self.offs)
        return self._words

    def text_of_word(self) -> np.ndarray:
        first = self.words()[2]
        return np.repeat(np.arange(self.n), np.diff(first))

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        starts, ends, _ = self.words()
        return self.span_hashes(starts, ends, lower)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """Hashes of spans that are not empty, ascend and do not overlap."""
        if not len(starts):
            return np.zeros(0, dtype=U64)
        size = ends - starts
        first = np.cumsum(size) - size
        place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
        codes = (LOWER_CODE if lower else BYTE_CODE)[self.data[place + np.repeat(starts, size)]]
        return mix(np.add.reduceat(codes * factors(place), first) + size.astype(U64) * U64(_STEP))

    def windows(self, width: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rabin-Karp hash of every ``width`` consecutive words of one text, and the window's first word."""
        n = len(hashes)
        if n < width:
            return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
        own = self.text_of_word()
        at = np.flatnonzero(own[: n - width + 1] == own[width - 1 :])
        return mix(rolling(hashes & PRIME, width)[at]), at


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column (nulls: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, bounds, data = column.buffers()
    offs = np.frombuffer(bounds, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(column: pa.Array, most_bytes: int = 2 << 20) -> Iterator[tuple[int, int, Block]]:
    """Cut a column into runs of rows [lo, hi) of about ``most_bytes``; a longer text stands alone and whole."""
    data, offs = string_buffers(column)
    lo = 0
    while lo < len(offs) - 1:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most_bytes, side="right")) - 1)
        yield lo, hi, Block(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def tidy() -> None:
    """Give freed memory back: a Python worker lives for many tasks, and an executor holds several."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, which tidies when a partition ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        tidy()

    return whole


def binaries(chunks: list) -> pa.Array:
    return pa.array(chunks, type=pa.binary())

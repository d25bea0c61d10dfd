"""Runs of texts of bounded bytes: short texts together, a long one in slices that are cut between its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from limes.llm.arrow_text import Block, string_buffers


def slices(column: pa.Array, most_bytes: int, gap: np.ndarray) -> Iterator[tuple[np.ndarray, Block]]:
    """Blocks of about ``most_bytes`` with the row of each of their texts; ``gap`` tells which bytes a long text may be cut at.

    A slice ends at the first gap from ``most_bytes`` on, so no word is cut and one word is the only thing that makes it longer.
    """
    data, offs = string_buffers(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most_bytes, side="right")) - 1)
        if hi > lo + 1 or offs[hi] - offs[lo] <= most_bytes:
            yield np.arange(lo, hi), Block(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        else:
            at, end = int(offs[lo]), int(offs[hi])
            while at < end:
                to = min(at + most_bytes, end)
                while to < end:
                    found = np.flatnonzero(gap[data[to : min(end, to + 4096)]])
                    if len(found):
                        to += int(found[0])
                        break
                    to = min(end, to + 4096)
                yield np.array([lo]), Block(data[at:to], np.array([0, to - at]))
                at = to
        lo = hi

"""Many small records in one binary value: columns stored by byte planes, which the shuffle's codec squeezes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME, FACTOR = 2_147_483_647, 48_271
#: what rows without a doc_id are compared as: after all others
NO_ID = (1 << 63) - 1


def pack(*columns: np.ndarray) -> bytes:
    """Columns of any lengths; integers of 1 to 8 bytes."""
    head = np.array([len(columns), *(len(c) for c in columns), *(c.dtype.itemsize for c in columns)], dtype=np.int64)
    body = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns]
    return head.tobytes() + b"".join(body)


def unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    head = np.frombuffer(data, dtype=np.int64, count=1 + 2 * n)
    at, out = len(head) * 8, []
    for length, width, kind in zip(head[1 : 1 + n].tolist(), head[1 + n :].tolist(), kinds):
        planes = np.frombuffer(data, dtype=np.uint8, count=length * width, offset=at).reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(length))
        at += length * width
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """Differences, so that ascending numbers become small ones; ``np.cumsum`` undoes it."""
    out = values.copy()
    out[1:] -= values[:-1]
    return out


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    start = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return start, np.diff(np.append(start, len(values)))


def group_of(ids: np.ndarray, checks: np.ndarray, groups: int) -> np.ndarray:
    """The group of a document by its id and the CRC-32 of its text; the same as ``group_column``.

    Rows without an id, rows that repeat one and copies of one text are spread alike.
    """
    folded = (ids ^ (ids.view(np.uint64) >> np.uint64(32)).view(np.int64) ^ checks.astype(np.int64)) & 0x7FFFFFFF
    return folded * FACTOR % PRIME % groups


def group_column(key: Column, text: Column, groups: int) -> Column:
    folded = key.bitwiseXOR(F.shiftrightunsigned(key, 32)).bitwiseXOR(F.crc32(text)).bitwiseAND(F.lit(0x7FFFFFFF))
    return (folded * F.lit(FACTOR) % F.lit(PRIME) % F.lit(groups)).cast("int")


def key_column() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(NO_ID))

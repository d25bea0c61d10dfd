"""MPEG audio columns: write payloads as a VBR Layer III stream, and read any such stream back.

``encode`` stores every document's UTF-8 bytes (padded with spaces to a positive multiple of 192) as the
ancillary bytes of silent MPEG-1 Layer III frames: mono, 48 kHz, each frame protected by its CRC-16.  A frame
carries one, two or three units of 192 bytes at 80, 160 or 224 kbit/s, so the stream is of variable bitrate; a
Xing frame in front holds frame count, byte count and a 100-point seek table, an ID3v2.4 tag holds the
unpadded length, and an ID3v1 tag ends the file.

``decode`` reads Layer III streams of MPEG-1, 2 and 2.5, mono or stereo, with a bitrate in each header (free format is not read).  It skips
tags, resynchronises on frame headers (after lost bytes a header counts only if another one, a tag or the end follows it), verifies the checksums
of protected frames, reads Xing, Info and VBRI tables by their flags and holds counts and seek points against the frames, and returns exact durations
(``ticks`` of 1 / ``TICKS`` second, whatever sampling rates occur) and the byte offset of every frame.

Defined results: null and empty texts are one unit of spaces; null ids are kept; equal texts give equal streams; rows are independent,
so repeated rows repeat; a text must fit a Python worker some ten times; an empty table gives an empty table; other columns are not read.  Bytes
that are no stream give no frames, an empty payload and ``resync_bytes`` equal to their number; a stream without this module's tag has no payload.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.arrow_text import Block, blocks, tidied
from limes.llm.common import table, texts

UNIT = 192
RATE, SAMPLES = 48_000, 1152
# Fixed values of Layer III (ISO/IEC 11172-3 and 13818-3, and the 2.5 extension): kbit/s by index, Hz by index.
KBPS = np.array([0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 0])
KBPS_LOW = np.array([0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160, 0])
HZ = np.array([44_100, 48_000, 32_000, 0])
#: by version bits: 0 is MPEG-2.5, 1 reserved, 2 MPEG-2, 3 MPEG-1
DIVIDED, VERSIONS = np.array([4, 1, 2, 1]), ("2.5", "-", "2", "1")
TICKS = 14_112_000  # a multiple of all sampling rates
#: bitrate index of a frame that carries so many units
INDEX_OF_UNITS = {1: 6, 2: 10, 3: 12}
UNITS_OF_INDEX = {v: k for k, v in INDEX_OF_UNITS.items()}
SIDE_MONO = 17
BODY = 4 + 2 + SIDE_MONO


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32) << 8
    for _ in range(8):
        t = np.where(t & 0x8000, (t << 1) ^ 0x8005, t << 1) & 0xFFFF
    return t


CRC = _crc_table()


def crc16(rows: np.ndarray) -> np.ndarray:
    """MPEG's CRC-16 of each row of bytes."""
    c = np.full(len(rows), 0xFFFF, dtype=np.uint32)
    for column in rows.T:
        c = ((c << 8) & 0xFFFF) ^ CRC[(c >> 8) ^ column]
    return c


def frame_lengths(b1: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """Bytes of the Layer III frames with these second and third header bytes; 0: no such header."""
    version = (b1 >> 3) & 3
    kbps, hz = np.where(version == 3, KBPS[b2 >> 4], KBPS_LOW[b2 >> 4]), HZ[(b2 >> 2) & 3] // DIVIDED[version]
    good = ((b1 & 0xE6) == 0xE2) & (version != 1) & (kbps > 0) & (hz > 0)
    return np.where(good, np.where(version == 3, 144_000, 72_000) * kbps // np.maximum(hz, 1) + ((b2 >> 1) & 1), 0)


def side_bytes(version: np.ndarray, mono: np.ndarray) -> np.ndarray:
    """Bytes of side information."""
    return np.where(version == 3, np.where(mono, 17, 32), np.where(mono, 9, 17))


def _frames_of(units: int) -> np.ndarray:
    """A silent frame without its payload: header, checksum, empty side information, filler."""
    i = INDEX_OF_UNITS[units]
    head = [0xFF, 0xFA, i << 4 | 1 << 2, 3 << 6]
    row = np.zeros(int(144_000 * KBPS[i] // RATE), dtype=np.uint8)
    row[:4] = head
    check = int(crc16(np.array([head[2:] + [0] * SIDE_MONO], dtype=np.uint8))[0])
    row[4], row[5] = check >> 8, check & 0xFF
    return row


EMPTY_FRAMES = {k: _frames_of(k) for k in INDEX_OF_UNITS}


def _syncsafe(n: int) -> bytes:
    return bytes((n >> s) & 0x7F for s in (21, 14, 7, 0))


def _tag(n_bytes: int) -> bytes:
    body = b"\x03payload bytes\x00" + str(n_bytes).encode()
    frame = b"TXXX" + _syncsafe(len(body)) + b"\x00\x00" + body
    return b"ID3\x04\x00\x00" + _syncsafe(len(frame)) + frame


def _xing(sizes: np.ndarray) -> bytes:
    """The frame in front: counts and, for each hundredth of the duration, the place in 256ths of the bytes."""
    total = int(sizes.sum()) + UNIT
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = ends[(np.arange(100) * len(sizes)) // 100] + UNIT
    toc = np.minimum(255, at * 256 // total).astype(np.uint8)
    head = bytes([0xFF, 0xFB, 5 << 4 | 1 << 2, 3 << 6]) + bytes(SIDE_MONO)
    info = b"Xing" + struct.pack(">III", 7, len(sizes), total) + toc.tobytes()
    return (head + info).ljust(UNIT, b"\x00")


END_TAG = b"TAG" + b"limes payload".ljust(30, b"\x00") + bytes(94) + b"\xff"


def encode_bytes(raw: bytes) -> bytes:
    padded = raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b" ")
    data = np.frombuffer(padded, dtype=np.uint8)
    units = len(data) // UNIT
    triples, rest = divmod(units, 3)
    sizes, parts = [], []
    if triples:
        bulk = np.tile(EMPTY_FRAMES[3], (triples, 1))
        bulk[:, BODY : BODY + 3 * UNIT] = data[: triples * 3 * UNIT].reshape(triples, -1)
        parts.append(bulk.tobytes())
        sizes += [bulk.shape[1]] * triples
    if rest:
        last = EMPTY_FRAMES[rest].copy()
        last[BODY : BODY + rest * UNIT] = data[triples * 3 * UNIT :]
        parts.append(last.tobytes())
        sizes.append(len(last))
    return b"".join([_tag(len(raw)), _xing(np.array(sizes)), *parts, END_TAG])


def _read_tag(media: bytes) -> tuple[int, int | None]:
    """Bytes that the ID3v2 tag takes, and the payload length it tells."""
    if media[:3] != b"ID3" or len(media) < 10:
        return 0, None
    size = sum((b & 0x7F) << s for b, s in zip(media[6:10], (21, 14, 7, 0)))
    body = media[10 : 10 + size]
    key = body.find(b"payload bytes\x00")
    told = body[key + 14 :].split(b"\x00")[0] if key >= 0 else b""
    return 10 + size, int(told) if told.isdigit() else None


def decode_block(block: Block, media: list[bytes]) -> list[tuple]:
    b = block.data
    length = np.zeros(len(b) + 1, dtype=np.int64)
    at = np.flatnonzero(b[:-3] == 0xFF) if len(b) > 3 else np.zeros(0, dtype=np.int64)
    length[at] = frame_lengths(b[at + 1], b[at + 2])
    heads = at[length[at] > 0]
    out = []
    for d in range(block.n):
        lo, hi = int(block.offs[d]), int(block.offs[d + 1])
        skip, told = _read_tag(media[d])
        end = hi - 128 if hi - lo >= 128 and media[d][-128:-125] == b"TAG" else hi
        pos, lost, places, synced = lo + skip, 0, [], True
        while pos < end:
            n = int(length[pos])
            if n and pos + n <= end and (synced or pos + n == end or length[pos + n]):
                places.append(pos)
                pos += n
                synced = True
            else:
                synced = False
                k = int(np.searchsorted(heads, pos, side="right"))
                to = min(end, int(heads[k])) if k < len(heads) else end
                lost += to - pos
                pos = to
        out.append(_describe(b, lo, np.array(places, dtype=np.int64), length, lost, told))
    return out


def _table(frame: bytes) -> tuple[int | None, int | None, list[int], str] | None:
    """Frame count, byte count, seek points and kind of the table that a stream's first frame holds."""
    version, mono, guarded = (frame[1] >> 3) & 3, frame[3] >> 6 == 3, not frame[1] & 1
    side = 4 + 2 * guarded + int(side_bytes(np.array(version), np.array(mono)))
    if frame[side : side + 4] in (b"Xing", b"Info") and len(frame) >= side + 8:
        flags, at = int.from_bytes(frame[side + 4 : side + 8], "big"), side + 8
        counts: list[int | None] = []
        for bit in (1, 2):
            counts.append(int.from_bytes(frame[at : at + 4], "big") if flags & bit else None)
            at += 4 if flags & bit else 0
        return counts[0], counts[1], list(frame[at : at + 100]) if flags & 4 else [], "xing"
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        total, frames, entries, scale, width, _ = struct.unpack(">IIHHHH", frame[46:62])
        points = [scale * int.from_bytes(frame[62 + i * width : 62 + (i + 1) * width], "big") for i in range(entries)]
        return frames, total, points, "vbri"
    return None


def _table_holds(found: tuple, places: np.ndarray, ends: int, head: int) -> bool:
    """Do counts and seek points of a table agree with the frames at ``places``, up to ``ends``, after the one at ``head``?"""
    frames, total, points, kind = found
    whole = ends - head
    good = frames in (None, len(places)) and total in (None, whole)
    if kind == "xing" and points and len(places):
        true = (places[np.arange(100) * len(places) // 100] - head) * 256 / max(1, whole)
        slack = 1 + 256 * int(np.diff(np.append(places, ends)).max()) / max(1, whole)
        good &= len(points) == 100 and points == sorted(points) and bool((np.abs(np.array(points) - np.minimum(true, 255)) <= slack).all())
    if kind == "vbri":
        good &= sum(points) <= whole
    return good


def _describe(b, lo, places, length, lost, told) -> tuple:
    table_found, head = None, 0
    if len(places):
        head = int(places[0])
        table_found = _table(b[head : head + int(length[head])].tobytes())
        places = places[1:] if table_found else places
    if not len(places):
        return b"", told or 0, 0, 0, 0, 0, 0, 0, lost, 0, [], "none"
    second, third, fourth = b[places + 1], b[places + 2], b[places + 3]
    version, mono, guarded = (second >> 3) & 3, (fourth >> 6) == 3, (second & 1) == 0
    side, bad = side_bytes(version, mono), 0
    for n in np.unique(side[guarded]).tolist():
        p = places[guarded & (side == n)]
        p = p[p + 6 + n <= len(b)]
        rows = np.concatenate([b[p[:, None] + np.array([2, 3])], b[p[:, None] + np.arange(6, 6 + n)]], axis=1)
        bad += int((crc16(rows) != b[p + 4].astype(np.uint32) * 256 + b[p + 5]).sum())
    index, sizes = third >> 4, length[places]
    payload = _payload(b, places, np.where((version == 3) & mono & guarded, index, 0)) if told is not None else b""
    hz = HZ[(third >> 2) & 3] // DIVIDED[version]
    count = np.where(version == 3, SAMPLES, SAMPLES // 2)
    ticks = int((count * (TICKS // hz)).sum())
    vbr_ok = table_found is not None and _table_holds(table_found, places, int(places[-1] + sizes[-1]), head)
    values = np.frombuffer(payload, dtype=np.uint8)
    level = int(values.sum(dtype=np.int64)) * 1000 // max(1, len(values))
    kbps = ",".join(f"{k}x{n}" for k, n in zip(*np.unique(np.where(version == 3, KBPS[index], KBPS_LOW[index]), return_counts=True)))
    feature = (
        f"mpeg{VERSIONS[version[0]]}-l3 {hz[0]}Hz ch={2 - int(mono[0])} frames={len(places)} samples={int(count.sum())} kbps={kbps} "
        f"vbr={'ok' if vbr_ok else 'none' if table_found is None else 'bad'} crc_bad={bad} resync={lost} level={level}"
    )
    return payload, told if told is not None else 0, int(hz[0]), int(count.sum()), ticks, len(places), int(guarded.sum()), bad, lost, int(vbr_ok), [int(x) - lo for x in places], feature


def _payload(b: np.ndarray, places: np.ndarray, index: np.ndarray) -> bytes:
    """The units that frames of these bitrate indices carry."""
    pieces = []
    edges = np.concatenate([[0], np.flatnonzero(np.diff(index)) + 1, [len(index)]])
    for s, e in zip(edges[:-1], edges[1:]):
        units = UNITS_OF_INDEX.get(int(index[s]), 0)
        if units:
            pieces.append(b[places[s:e][:, None] + np.arange(BODY, BODY + units * UNIT)].tobytes())
    return b"".join(pieces)


def encode(docs: DataFrame) -> DataFrame:
    """``doc_id, media``: one stream for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                raw = block.data.tobytes()
                media = [encode_bytes(raw[block.offs[i] : block.offs[i + 1]]) for i in range(block.n)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(media, pa.binary())], ["doc_id", "media"])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, media binary")


DECODED = (
    "doc_id long, media binary, payload binary, n_bytes long, sample_rate int, samples long, ticks long, frames long, "
    "protected_frames long, bad_checksums long, resync_bytes long, vbr_table_ok int, frame_offsets array<long>, feature string"
)
_FIELDS = [pa.binary(), pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.int32(), pa.list_(pa.int64()), pa.string()]


def decode(streams: DataFrame) -> DataFrame:
    """Read ``doc_id, media`` back; the duration is exactly ``ticks / TICKS`` seconds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                raw = block.data.tobytes()
                media = [raw[block.offs[i] : block.offs[i + 1]] for i in range(block.n)]
                rows = list(zip(*decode_block(block, media)))
                columns = [pa.array(c, t) for c, t in zip(rows, _FIELDS)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], *columns], [f.split()[0] for f in DECODED.split(", ")])

    return streams.select("doc_id", "media").mapInArrow(tidied(run), DECODED)


def op2_media_columns(spark, sf_dir: str) -> DataFrame:
    back = decode(encode(table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, length(payload) - 15, 16)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "samples",
        "sample_rate",
        "ticks",
        "frames",
        "frame_offsets",
        "bad_checksums",
        "vbr_table_ok",
    )

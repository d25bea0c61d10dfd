"""Cases that docstrings state: nulls, ties, repeated rows, very long texts, foreign streams, words that cancel in hashes."""

import itertools
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from limes.llm import licenses, media, near_dup, packing, pii, quality, substring_dedup, suffix_dedup, url_filters
from limes.llm.arrow_text import BYTE_CODE, PRIME, Block, blocks, rolling
from limes.llm.suffix_dedup import _BASE


def block_of(*texts):
    return next(blocks(pa.array(list(texts), pa.string())))[2]


def test_window_hashes_are_polynomials_modulo_the_prime():
    rng = np.random.default_rng(1)
    values = rng.integers(0, int(PRIME), 80).astype(np.uint64)
    from limes.llm.arrow_text import _BASE as base

    for width in (1, 2, 3, 5, 7, 50, 80):
        want = [sum(int(values[i + k]) * pow(base, width - 1 - k, int(PRIME)) for k in range(width)) % int(PRIME) for i in range(81 - width)]
        assert rolling(values, width).tolist() == want


def test_words_of_cancelling_letters_differ():
    flip, word = str.maketrans("ab", "ba"), "a"
    for _ in range(13):
        word += word.translate(flip)
        b = block_of(word, word.translate(flip))
        assert len(set(b.word_hashes().tolist())) == 2
        b = block_of(" ".join(word), " ".join(word.translate(flip)))
        if len(word) >= 50:
            h, at = b.windows(50, b.word_hashes())
            w = " ".join(word).split() + " ".join(word.translate(flip)).split()
            assert len(set(h.tolist())) == len({tuple(w[i : i + 50]) for i in at})


def test_byte_patterns_cannot_cancel_in_segments():
    twos = lambda x: (x & -x).bit_length() - 1
    codes = max(twos((int(a) - int(b)) % (1 << 64)) for a, b in itertools.combinations(BYTE_CODE, 2))
    assert codes + sum(twos(pow(_BASE, 1 << j, 1 << 64) - 1) for j in range(8)) < 64


def test_very_long_texts(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = prose(60)
    long_text = prose(300_000) + " " + passage
    df = spark.createDataFrame([(1, long_text), (2, f"{prose(20)} {passage} {prose(20)}"), (3, "y" * 1_000_000), (None, None)], "doc_id long, text string")
    lost = {r.doc_id: sum(s.to_word - s.from_word for s in r.removed) for r in substring_dedup.deduplicated(df).collect()}
    assert lost == {1: 0, 2: 60, 3: 0, None: 0}
    gone = {r.doc_id: sum(s.to_byte - s.from_byte for s in r.removed) for r in suffix_dedup.deduplicated(df).collect()}
    assert len(passage) <= gone[1] <= len(passage) + 2 and gone[3] == 1_000_000 and gone[None] == 0
    assert {r.doc_id: r.component_id for r in near_dup.classes(df).collect()} == {1: 1, 2: 2, 3: 3, None: None}
    assert sum(r.length for r in packing.pack(df).collect() if r.doc_id is None) == 1
    assert {r.doc_id: r.n_words for r in quality.judged(df, None).collect()} == {1: 300_060, 2: 100, 3: 1, None: 0}
    assert all(bytes(r.payload).decode().rstrip(" ") == (r.text or "") for r in media.decode(media.encode(df)).join(df, "doc_id").collect())
    assert all(not r.spans for r in pii.found(df, None).collect())


def test_null_ids_and_repeated_rows_repeat(spark):
    rows = [(None, "mail a.b@c.example.com"), (None, "mail a.b@c.example.com"), (1, licenses.MIT), (1, licenses.MIT), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    assert sorted(((r.doc_id, len(r.spans)) for r in pii.found(df, None).collect()), key=key) == [(1, 0), (1, 0), (None, 0), (None, 1), (None, 1)]
    assert sorted(((r.doc_id, r.license_id) for r in licenses.scan(df, licenses.known_digests(spark)).filter("line_no = 0").collect()), key=key) == [(1, "MIT"), (1, "MIT"), (None, None), (None, None), (None, None)]
    assert sorted(((r.doc_id, r.n_words) for r in quality.judged(df, None).collect()), key=key) == sorted([(i, len((t or "").split())) for i, t in rows], key=key)
    assert sorted(((r.doc_id, r.n_bytes) for r in media.decode(media.encode(df)).collect()), key=key) == sorted([(i, len(t or "")) for i, t in rows], key=key)


def frame(version, mode, index, guarded, body=b""):
    """A Layer III frame at 48, 24 or 12 kHz."""
    bits = {"1": 3, "2": 2, "2.5": 0}[version]
    head = bytes([0xFF, 0xE2 | bits << 3 | (0 if guarded else 1), index << 4 | 1 << 2, mode << 6])
    kbps = (media.KBPS if version == "1" else media.KBPS_LOW)[index]
    size = int((144_000 if version == "1" else 72_000) * kbps // {"1": 48_000, "2": 24_000, "2.5": 12_000}[version])
    n = int(media.side_bytes(np.array(bits), np.array(mode == 3)))
    check = b""
    if guarded:
        check = struct.pack(">H", int(media.crc16(np.frombuffer(head[2:] + bytes(n), dtype=np.uint8).reshape(1, -1))[0]))
    return (head + check + bytes(n) + body).ljust(size, b"\x55")


@pytest.mark.parametrize("version,mode", [("1", 0), ("1", 3), ("2", 0), ("2", 3), ("2.5", 1)])
def test_foreign_streams(spark, version, mode):
    frames = [frame(version, mode, 8, True) for _ in range(20)]
    hurt = [*frames[:7], frames[7][:12] + b"\xaa" + frames[7][13:], *frames[8:]]
    plain = frame(version, mode, 8, False)
    size = len(plain)
    points = bytes(min(255, (k * 20 // 100 + 1) * 256 // 21) for k in range(100))
    xing = lambda flags, frames_, total, toc: frame(version, mode, 8, False, b"Xing" + struct.pack(">I", flags) + (struct.pack(">I", frames_) if flags & 1 else b"") + (struct.pack(">I", total) if flags & 2 else b"") + (toc if flags & 4 else b""))
    streams = [
        b"".join(frames),
        b"".join(hurt),
        xing(7, 20, 21 * size, points) + plain * 20,
        xing(1, 20, 0, b"") + plain * 20,
        xing(6, 0, 21 * size, points) + plain * 20,
        xing(1, 19, 0, b"") + plain * 20,
        xing(4, 0, 0, points[::-1]) + plain * 20,
        plain * 3 + b"\x00\x01junk" + plain * 2,
        frame(version, mode, 8, False)[:36].ljust(36, b"\x00") + b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 0, 21 * size, 20, 4, 1, 2, 5) + struct.pack(">HHHH", *[5 * size] * 4) + bytes(size - 36 - 4 - 6 - 16 - 8) + plain * 20,
    ]
    df = spark.createDataFrame(list(enumerate(streams)), "doc_id long, media binary")
    got = {r.doc_id: r for r in media.decode(df).collect()}
    per = 1152 if version == "1" else 576
    assert [got[k].frames for k in range(9)] == [20, 20, 20, 20, 20, 20, 20, 5, 20]
    assert got[0].bad_checksums == 0 and got[0].protected_frames == 20 and got[1].bad_checksums == 1
    assert got[0].ticks == 20 * per * media.TICKS // {"1": 48_000, "2": 24_000, "2.5": 12_000}[version] and bytes(got[0].payload) == b""
    assert [got[k].vbr_table_ok for k in range(9)] == [0, 0, 1, 1, 1, 0, 0, 0, 1]
    assert got[7].resync_bytes == 6


def test_disguised_forms_are_found_and_plain_text_is_left(spark):
    train, test = (spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("text").toArrow().column(0).combine_chunks() for sf in ("sf0.01", "sf0.001"))
    field = pii.fit(pii.training_nodes(train))
    hidden, regions = pii.disguises([t or "" for t in test.to_pylist()])
    found = total = false = 0
    for lo, _, block in blocks(pa.array(hidden, pa.string())):
        for d, spans in pii.all_spans(pii.Nodes(block), field).items():
            there = regions.get(lo + d, [])
            total += len(there)
            found += sum(s in spans for s in there)
            false += sum(not any(a < y and b > x for _, x, y in there) for _, a, b in spans)
    assert total > 10 and found >= 0.9 * total and false <= 0.02 * total
    for _, _, block in blocks(test):
        nodes = pii.Nodes(block)
        assert pii.all_spans(nodes, field) == {d: sorted(s) for d, s in nodes.spans.items()}  # the patterns find all there is


def test_forms_are_not_matched_by_patterns():
    for kind, text in enumerate(["ann.lee@mail.example.com", "10.20.30.40", "4111 1111 1111 1111", "+1 (555) 555-1234"]):
        for form in range(5):
            new = pii.disguised(kind, text, form)
            assert (kind, 0, len(new)) not in pii.base_spans(new) and not [s for s in pii.base_spans(new) if s[0] == kind and kind != 0]


def test_random_texts_near_the_patterns_limits():
    rng = random.Random(4)
    from tests.llm.test_operators import brute_spans

    for _ in range(3000):
        parts = [rng.choice([str(rng.randrange(300)) + "." , "".join(rng.choice("0123456789") for _ in range(rng.randint(12, 21))), "@", "a.b", "+", " ", "-", "é", ". ", "255.255.255.255", "4111111111111111", "(", ")"]) for _ in range(rng.randint(1, 14))]
        t = "".join(parts)
        assert pii.base_spans(t) == brute_spans(t), t


def test_few_windows_are_cut_when_a_task_ends():
    rng = np.random.default_rng(5)
    sizes = np.minimum(rng.lognormal(5.5, 1.0, 5000).astype(int) + 1, 6000)
    packer = packing.SumOfSquares(0)
    for i, n in enumerate(sizes.tolist()):
        packer.add(i, np.full(n, i, dtype=np.uint32))
    packer.settle()
    done = packer.rows()
    by_window = {}
    for doc, start, length, total, window, offset, ids in done:
        assert length == len(ids) // 4 and total == sizes[doc] and offset == by_window.get(window, 0)
        by_window[window] = offset + length
    assert sum(by_window.values()) == sizes.sum() and all(n == 2048 or n & (n - 1) == 0 for n in by_window.values())
    assert sum(n < 2048 for n in by_window.values()) <= 11
    assert len(done) < 1.25 * sum(-(-sizes // 2048))


def test_full_hands_fill_the_most_crowded_level(monkeypatch):
    monkeypatch.setattr(packing, "MOST_OPEN", 3)
    packer = packing.SumOfSquares(0)
    for i in range(50):
        packer.add(i, np.full(1100 + i, i, dtype=np.uint32))
        assert packer.n_open <= 4
    packer.settle()
    assert sum(r[2] for r in packer.rows()) == sum(1100 + i for i in range(50))


def test_a_hot_host_is_spread_and_empty_tables_pass(spark):
    entries = url_filters.list_entries(spark, [("a.com", "2024-01-01", "block")])
    captures = spark.range(5000).select(F.col("id").alias("capture_id"), F.lit("http://x.a.com/").alias("url"), F.to_date(F.lit("2024-02-02")).alias("fetched"))
    assert url_filters.judged(captures, entries).filter("verdict = 'block' AND matched_domain = 'a.com'").count() == 5000
    assert url_filters.judged(captures.filter("false"), entries).count() == 0
    none = url_filters.judged(captures.limit(3), url_filters.list_entries(spark).filter("false")).collect()
    assert {r.verdict for r in none} == {"unlisted"}
    clash = captures.limit(2).withColumns({"salt": F.lit(1), "best": F.lit(2), "entries": F.lit(3), "host": F.lit("h")})
    assert url_filters.judged(clash, entries).count() == 2


def test_known_texts_may_be_any_table(spark):
    known = spark.createDataFrame([("X-1", "text", "Do  as you like."), ("A-1", "text", "do as you like"), (None, "text", None)], "license_id string, kind string, text string")
    docs = spark.createDataFrame([(1, "DO AS YOU LIKE!"), (2, "do not")], "doc_id long, text string")
    assert {r.doc_id: r.license_id for r in licenses.scan(docs, licenses.digests(known)).collect()} == {1: "A-1", 2: None}


def test_big_buckets_go_by_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BIG", 4)
    monkeypatch.setattr(near_dup, "SALTS", 3)
    rng = random.Random(6)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.choice([0, 2, 6, 7, 8, 40])):
            words[rng.randrange(120)] = f"x{rng.randrange(50)}"
        texts.append((i, " ".join(words)))
    sets = {i: {tuple(w[k : k + 3]) for k in range(118)} for i, t in texts for w in [t.split()]}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.component_id for r in near_dup.classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {i: find(i) for i in sets} and 1 < len(set(got.values())) < 60

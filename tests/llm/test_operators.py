"""Every operator against brute force on a small corpus that holds nulls, empty and long texts, copies and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from limes.llm import licenses, media, mixing, near_dup, packing, pii, quality, substring_dedup, suffix_dedup, url_filters
from limes.llm.queries import ORACLES, QUERIES
from tests.oracle import duck, spark_rows

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, size long, kept boolean, component_id long, grp int, payload string, bucket int"


def corpus():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = prose(80), prose(150)
    texts = [None, "", " \n\t", "one", "two words", "Two Words", prose(49), prose(50), "x" * 5000, "\n".join(["same line here now"] * 30)]
    texts += [prose(rng.randint(5, 200)) for _ in range(25)]
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(6)]
    texts += [base] * 4
    for _ in range(8):
        words = base.split()
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [prose(6000) + " " + passage, "mail a.b@c.example.com, +1 (555) 555-1234 and 10.0.0.1 or 4111 1111 1111 1111"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [(i, t, "en", rng.choice(["s1", "s2", None, "", "s0"]), None if t is None else len(t), 7, 7, False, -1, 3, "p", 1) for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def texts(rows):
    return {r[0]: r[1] or "" for r in rows}


def words(text):
    return text.encode().split()


def test_substring_dedup(docs, texts):
    got = {r.doc_id: r for r in substring_dedup.deduplicated(docs).collect()}
    seen = set()
    for i in sorted(texts):
        w = words(texts[i])
        keys = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        gone = {k + j for k, key in enumerate(keys) if key in seen for j in range(50)}
        seen.update(keys)
        assert got[i].n_words == len(w)
        assert got[i].kept.encode() == b" ".join(x for j, x in enumerate(w) if j not in gone)
        assert sum(s.to_word - s.from_word for s in got[i].removed) == len(gone)


def suffix_expected(texts, length=200):
    raw = {i: t.encode() for i, t in texts.items()}
    count = collections.Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, dtype=int)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        flags = np.cumsum(gone[:-1]) > 0
        out[i] = bytes(x for x, f in zip(b, flags) if not f), int((np.diff(np.concatenate([[0], flags.astype(int), [0]])) == 1).sum())
    return out


def test_suffix_dedup(docs, texts):
    want = suffix_expected(texts)
    for r in suffix_dedup.deduplicated(docs).collect():
        assert (bytes(r.kept), len(r.removed)) == want[r.doc_id]
        assert r.n_bytes == len(texts[r.doc_id].encode())


def test_suffix_dedup_with_hot_anchors(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 2)
    want = suffix_expected(texts)
    assert {r.doc_id: (bytes(r.kept), len(r.removed)) for r in suffix_dedup.deduplicated(docs).collect()} == want


def test_two_stage_sorting_is_a_suffix_array():
    rng = np.random.default_rng(3)
    for alphabet in (2, 3, 20):
        text = np.append(rng.integers(1, alphabet + 1, 300), 0).astype(np.uint16)
        low = np.concatenate([text.astype(np.uint64), np.zeros(8, dtype=np.uint64)])
        packed = np.zeros(len(text), dtype=np.uint64)
        for k in range(8):
            packed = (packed << np.uint64(8)) | low[k : k + len(text)]
        got = suffix_dedup.two_stage(text, packed, 200).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_near_duplicates(docs, texts):
    def shingles(t):
        w = re.sub("[A-Z]", lambda m: m.group().lower(), t).encode().split()
        return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])

    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.classes(docs).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}
    assert {r.doc_id for r in near_dup.kept_documents(docs).collect()} == {i for i in sets if find(i) == i}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.v: r.root for r in near_dup.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_set_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 2**63, 500).astype(np.uint64), rng.integers(0, 2**63, 60).astype(np.uint64)
    one, two = np.unique(a), np.unique(np.concatenate([a[40:], b]))
    s = near_dup.set_sketches(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)])).view(np.uint64)
    bits = sum(int(x).bit_count() for x in s[0] ^ s[1])
    assert bits <= 100 and bits > 80


def test_quality_counts_and_rules(docs, texts):
    got = {r.doc_id: r for r in quality.judged(docs, None).collect()}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        repeat = {k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat))
        assert r.base_failed == (len(w) < 10 or 100 * len(repeat) > 20 * len(w)) and r.kept == (not r.base_failed)
    kept = quality.kept_documents(docs, None)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_trees_are_monotone_and_accurate():
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(quality.FEATURES)))
    bad = ((x[:, 2] > 0.7) | (x[:, 0] > 0.9)).astype(int)
    trees = quality.fit(x[:2000], bad[:2000])
    assert ((trees.probability(x[2000:]) > 0.5) == bad[2000:]).mean() > 0.97
    line = np.repeat(x[:1], 50, axis=0)
    for name in quality.MONOTONE:
        j = quality.FEATURES.index(name)
        probe = line.copy()
        probe[:, j] = np.linspace(0, 1, 50)
        assert (np.diff(trees.probability(probe)) >= -1e-12).all()
    assert quality.fit(x[:100], np.zeros(100, dtype=int)) is None


def test_quality_learns_from_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.train(docs, labels)
    rows = quality.judged(docs, trees).join(labels, "doc_id").collect()
    assert np.mean([(r.p_bad > 0.5) == (r.quality == 0) for r in rows]) > 0.95


def brute_spans(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_against_plain_patterns():
    rng = random.Random(9)
    for _ in range(20_000):
        t = "".join(rng.choice("a1@.+- ()%4é") for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(t) == brute_spans(t)


def test_pii_query(spark, docs, texts):
    got = {r.doc_id: r for r in pii.found(docs, pii.train(docs)).collect()}
    for i, t in texts.items():
        base = [(pii.KINDS[k], a, b) for k, a, b in brute_spans(t)]
        assert [tuple(s) for s in got[i].base] == base and set(base) <= {tuple(s) for s in got[i].spans}
    hidden = {r.doc_id: r for r in pii.redacted(docs, None).collect()}
    assert all(not brute_spans(r.text or "") and (r.n_chars == len(r.text) if r.text else True) for r in hidden.values())


def test_field_finds_repeated_forms_and_hidden_labels(spark):
    from limes.llm.arrow_text import blocks
    import pyarrow as pa

    column = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").toArrow().column(0).combine_chunks()
    nodes = [pii.Nodes(b) for _, _, b in blocks(column)]
    field = pii.fit(nodes[:1])
    test = nodes[1]
    assert (field.marginals(test, clamp=False).argmax(1) == np.maximum(test.label, 0)).mean() > 0.9
    odd = pii.Nodes(next(blocks(pa.array(["call +1 (988) 555-2485 170.106.47.218 now"])))[2])
    assert (3, 5, 22) in pii.all_spans(odd, field)[0]


def test_mixing(docs, texts, rows):
    sizes = mixing.word_counts(docs)
    placed = mixing.layout(sizes).cache()
    got = placed.collect()
    assert len(got) == len(texts) and all(r["size"] == len(words(texts[r.doc_id])) and 0 <= r.taken <= 3 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source is None, r.source or ""), []).append(r)
    order = sorted(by)
    size = np.array([by[s][0].source_size for s in order])
    want = mixing.shares(size, np.array([i % 3 + 1 for i in range(len(order))], dtype=float))
    assert [by[s][0].target for s in order] == pytest.approx(want.tolist()) and want.sum() == pytest.approx(size.sum())
    for s in order:
        assert abs(sum(r.taken for r in by[s]) - by[s][0].target) <= max(2, 0.01 * by[s][0].target)
    pieces = mixing.draws(placed).collect()
    taken = collections.Counter()
    for p in pieces:
        taken[p.doc_id] += p.to_word - p.from_word
    assert {r.doc_id: r.taken for r in got if r.taken} == dict(taken)
    assert len({(p.shard, p.source, p.draw) for p in pieces}) == len({(p.source, p.draw) for p in pieces})  # shards are disjoint
    assert sorted(map(tuple, mixing.layout(sizes).select("doc_id", "taken").collect())) == sorted((r.doc_id, r.taken) for r in got)
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_packing(docs, texts):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for i, t in texts.items()}
    rows = packing.pack(docs).collect()
    by = collections.defaultdict(list)
    windows = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
        assert bytes(r.ids) == ids[r.doc_id][r.start : r.start + r.length].tobytes() and r.doc_tokens == len(ids[r.doc_id])
    for i, pieces in by.items():
        assert sorted(x for p in pieces for x in range(p.start, p.start + p.length)) == list(range(len(ids[i])))
    assert set(by) == set(texts)
    for pieces in windows.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at & (at - 1) == 0


def test_media_round_trip(docs, texts):
    for r in media.decode(media.encode(docs)).collect():
        raw = texts[r.doc_id].encode()
        want = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
        assert bytes(r.payload) == want and r.n_bytes == len(raw) and r.bad_checksums == 0 and r.resync_bytes == 0 and r.vbr_table_ok == 1
        assert r.samples == 1152 * r.frames and len(r.frame_offsets) == r.frames
        assert all(bytes(r.media)[o] == 0xFF for o in r.frame_offsets)


def test_media_resynchronises_and_sees_damage(spark):
    good = media.encode_bytes(b"hello " * 500)
    at = good.index(b"\xff\xfa")
    noisy = good[:at] + b"\x00\xff\xfa\x00noise" + good[at:]
    hurt = bytearray(good)
    hurt[at + 10] ^= 1
    df = spark.createDataFrame([(1, noisy), (2, bytes(hurt)), (3, b"no stream"), (4, b"")], "doc_id long, media binary")
    got = {r.doc_id: r for r in media.decode(df).collect()}
    assert got[1].resync_bytes == 9 and bytes(got[1].payload).startswith(b"hello ") and got[2].bad_checksums == 1
    assert got[3].frames == 0 and got[3].resync_bytes == 9 and got[4].frames == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_statements(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck(ORACLES[name], SF)


def test_license_texts(spark):
    changed = "The  MIT LICENCE\nCopyright (c) 2020 Somebody\n\n" + licenses.MIT.replace("Software", "SOFTWARE").replace("sublicense", "sub-license").replace('"AS IS"', "'as is'")
    df = spark.createDataFrame([(1, changed), (2, licenses.MIT + " more"), (3, None), (4, "words\nReleased under the MIT licence")], "doc_id long, text string")
    got = {(r.doc_id, r.line_no): r.license_id for r in licenses.scan(df, licenses.known_digests(spark)).collect()}
    assert got == {(1, 0): "MIT", (2, 0): None, (3, 0): None, (4, 0): None, (4, 2): "MIT"}


def test_url_intervals(spark):
    entries = url_filters.list_entries(spark, [("a.com", "2024-01-01", "block"), ("a.com", "2024-02-01", "drop"), ("b.a.com", "2024-01-10", "allow"), ("a.com", "2024-03-01", "block"), ("a.com", "2024-03-01", "allow")])
    rows = [(1, "http://x.a.com/p", "2024-01-05"), (2, "http://x.a.com", "2024-02-05"), (3, "https://u@B.A.com:80/", "2024-01-15"), (4, None, "2024-01-15"), (5, "junk", "2024-01-15"), (6, "http://a.com", None), (7, "http://a.com", "2024-03-01"), (8, "http://ba.com", "2024-01-15")]
    captures = spark.createDataFrame(rows, "capture_id long, url string, f string").withColumn("fetched", F.to_date("f"))
    got = {r.capture_id: r.verdict for r in url_filters.judged(captures, entries).collect()}
    assert got == {1: "block", 2: "unlisted", 3: "allow", 4: "unlisted", 5: "unlisted", 6: "unlisted", 7: "block", 8: "unlisted"}


def empty_cases(docs):
    return docs.filter("false")


def test_empty_tables(spark, docs):
    none = empty_cases(docs)
    assert substring_dedup.deduplicated(none).count() == 0
    assert suffix_dedup.deduplicated(none).count() == 0
    assert near_dup.classes(none).count() == 0
    assert quality.judged(none, quality.train(none, spark.read.parquet(f"{SF}/labels.parquet"))).count() == 0
    assert pii.found(none, pii.train(none)).count() == 0
    assert mixing.layout(mixing.word_counts(none)).count() == 0
    assert packing.pack(none).count() == 0
    assert media.decode(media.encode(none)).count() == 0
    assert licenses.scan(none, licenses.known_digests(spark)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(120))
    df = spark.createDataFrame([(1, text, "s"), (1, text, "s"), (2, text, "s"), (None, text, "s"), (None, None, None)], "doc_id long, text string, source string")
    sub = sorted(((r.doc_id, len(r.kept)) for r in substring_dedup.deduplicated(df).collect()), key=repr)
    assert sub == sorted([(1, len(text)), (1, len(text)), (2, 0), (None, 0), (None, 0)], key=repr)
    assert sorted(len(r.kept) for r in suffix_dedup.deduplicated(df).collect()) == [0] * 5
    near = sorted(((r.doc_id, r.component_id) for r in near_dup.classes(df).collect()), key=repr)
    assert near == sorted([(1, 1), (1, 1), (2, 1), (None, None), (None, None)], key=repr)
    assert mixing.layout(mixing.word_counts(df)).count() == 5
    assert len({r.sequence_id for r in packing.pack(df).collect()}) >= 1
    assert zlib.crc32(b"") == 0 and hashlib.sha256(b"").hexdigest().startswith("e3b0")

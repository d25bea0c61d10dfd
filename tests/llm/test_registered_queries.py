"""The registered queries' own columns, by brute force over one folder of awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from limes.llm.queries import QUERIES
from tests.llm.test_operators import brute_spans
from limes.llm import pii

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, part int, big boolean, grp int, payload string, bucket int, chunk int, run int, salt int, local long"


def turned(n):
    """A word whose letters cancel in many hashes (Thue and Morse), and its mirror."""
    flip = str.maketrans("ab", "ba")
    word = "a"
    while len(word) < n:
        word += word.translate(flip)
    return word, word.translate(flip)


def corpus():
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdeé9.A") for _ in range(rng.randint(1, 7))) for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = prose(80), prose(120)
    one, two = turned(2048)
    texts = [None, "", " \n\t", "one", "Two words", one, two, f"{one} {prose(60)}", f"{two} {prose(60)}", "x" * 3000, "\n".join(["same line here now"] * 30)]
    texts += ["<|endoftext|>", f"a <|startoftext|>{prose(4)}<|endoftext|>", "It's 2024; don't STOP!!! (really?) naïve Ünïcode 日本語 text 🙂🙂"]
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(5)] + [base] * 3
    texts += [" ".join([*base.split()[:k], "changed", *base.split()[k + 1 :]]) for k in (3, 50, 90)]
    texts += [prose(4000) + " " + passage, "mail a.b@c.example.com, +1 (555) 555-1234 and 10.0.0.1 or 4111 1111 1111 1111 or 5500-0000-0000-0004 or 10.0.0.256"]
    rows = list(enumerate(texts))
    rows += [(5, prose(70)), (5, prose(30) + " " + passage), (7, base), (7, base), (9, passage)]  # ids with several texts
    rows += [(None, f"{prose(3)} {rng.choice([passage, base, prose(8)])} {i}") for i in range(2000)] + [(None, base)] * 3 + [(None, None)]
    rows += [((1 << 63) - 1, passage), (-4, passage)]
    rng.shuffle(rows)
    return [(i, t, "en", "s", None if t is None else len(t), 3, 3, True, 3, "p", 1, 1, 1, 1, 7) for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return [r[:2] for r in corpus()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(str(at / "documents.parquet"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (3, None, 0), (999, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(at / "labels.parquet"))
    return str(at)


def got(spark, folder, name, *columns):
    return collections.Counter(tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect())


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op1(spark, folder, rows):
    order = lambda i: (i is None or i == (1 << 63) - 1, i or 0)  # noqa: E731  (no id counts as the largest one)
    by = collections.defaultdict(list)
    for i, t in rows:
        by[order(i)[0], 0 if order(i)[0] else i].append((i, (t or "").encode().split()))
    seen, want = set(), collections.Counter()
    for key in sorted(by):
        fresh = set()
        for i, w in by[key]:
            windows = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
            gone = {k + j for k, x in enumerate(windows) if x in seen for j in range(50)}
            fresh.update(windows)
            want[i, len(w), len(gone), sha(b" ".join(x for j, x in enumerate(w) if j not in gone))] += 1
        seen |= fresh
    assert sum(n for (_, _, lost, _), n in want.items() if lost) > 500
    assert got(spark, folder, "op1_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_op2(spark, folder, rows):
    want = collections.Counter()
    for i, t in rows:
        raw = (t or "").encode()
        padded = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
        want[i, len(raw), len(padded), sha(padded), zlib.crc32(padded[-16:])] += 1
    assert got(spark, folder, "op2_media_columns", "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == want
    made = QUERIES["op2_media_columns"](spark, folder).collect()
    assert len({r.payload_sha256: (r.media_sha256, r.feature) for r in made}) == len({(r.payload_sha256, r.n_bytes, r.media_sha256, r.feature) for r in made if r.n_bytes}) + (1 if any(not r.n_bytes for r in made) else 0)
    assert all(r.vbr_table_ok == 1 and r.ticks * 48_000 == r.samples * 14_112_000 and len(r.frame_offsets) == r.frames for r in made)


def test_op4(spark, folder, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
    pieces = QUERIES["op4_packing"](spark, folder).collect()
    once = {i for i, n in collections.Counter(i for i, _ in rows).items() if n == 1}
    of = {i: ids(t) for i, t in rows if i in once}
    seen = collections.defaultdict(list)
    for p in pieces:
        if p.doc_id in of:
            assert p.ids_crc32 == zlib.crc32(of[p.doc_id][p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(of[p.doc_id])
            seen[p.doc_id] += range(p.start, p.start + p.length)
    assert {i: sorted(x) for i, x in seen.items()} == {i: list(range(len(x))) for i, x in of.items()}
    assert sum(p.length for p in pieces) == sum(len(ids(t)) for _, t in rows)
    windows = collections.defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
    for w in windows.values():
        w.sort(key=lambda p: p.offset)
        size = w[-1].offset + w[-1].length
        assert [p.offset for p in w] == [sum(p.length for p in w[:k]) for k in range(len(w))] and (size == 2048 or size & (size - 1) == 0)


def test_op5(spark, folder, rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(b[k : k + 200] for _, b in raw for k in range(len(b) - 199))
    want = collections.Counter()
    for i, b in raw:
        edge = np.zeros(len(b) + 1, dtype=int)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                edge[k] += 1
                edge[k + 200] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, dtype=np.uint8)[~gone].tobytes())] += 1
    assert got(spark, folder, "op5_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_op7(spark, folder, rows):
    told = lambda spans: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
    want = collections.Counter()
    for i, t in rows:
        spans = brute_spans(t or "")
        want[(i, *(sum(k == j for j, _, _ in spans) for k in range(4)), sha(told(spans).encode()))] += 1
    assert got(spark, folder, "op7_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
    text = {i: t for i, t in rows}
    for r in QUERIES["op7_pii"](spark, folder).filter("doc_id = 28 OR spans <> ''").collect():
        spans = r.spans.split(",") if r.spans else []
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
        if r.doc_id in text:
            assert set(told([s]) for s in brute_spans(text[r.doc_id] or "")) <= set(spans)


def test_op9(spark, folder, rows):
    want = collections.Counter()
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        grams = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed] += 1
    assert got(spark, folder, "op9_quality", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert QUERIES["op9_quality"](spark, folder).filter("base_failed AND kept").count() == 0


def test_op10(spark, folder, rows):
    def shingles(t):
        w = re.sub("[A-Z]", lambda m: m.group().lower(), t or "").encode().split()
        return frozenset(tuple(w[k : k + 3]) for k in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    want = collections.Counter((i, len(shingles(t)), None if i is None else find(i), i is None or find(i) == i) for i, t in rows)
    assert got(spark, folder, "op10_near_duplicates", "doc_id", "n_shingles", "component_id", "kept") == want


def test_op3(spark, folder, rows):
    made = QUERIES["op3_mixing"](spark, folder).collect()
    assert collections.Counter((r.doc_id, r["size"]) for r in made) == collections.Counter((i, len((t or "").encode().split())) for i, t in rows)
    total = sum(r["size"] for r in made)
    assert all(r.source_size == total and 0 <= r.taken <= 3 * r["size"] for r in made) and sum(r.taken for r in made) == total

"""The trie by brute force: heads of other conversations, nulls, ties, one long conversation, one that very many share, segments of any depth."""

import collections
import hashlib
import random
import zlib

import pytest

from limes.llm import prefix_trie
from limes.llm.queries import ORACLES, QUERIES
from tests.oracle import duck, spark_rows

SCHEMA = "conv_id long, turn long, role string, text string, k long, pos int, part string, x1 long, head int, depth long, own string"


def brute(rows):
    lists = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            lists[c].append((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [x[2:] for x in sorted(x, key=lambda t: t[:3])] for c, x in lists.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(lists):
        h = zlib.crc32(str(c).encode()) % 6
        path = lists.get(c - c % 100, [])[:h] + lists[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    sha = lambda x: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    return collections.Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], sha(ends[p])) for p, m in members.items())


def conversations():
    rng = random.Random(41)
    lines = ["", "hello", "naïve 日本語 🙂", "how are you", "x" * 500, None] + [f"line {i}" for i in range(20)]
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 240), 900, 1000, 5_000_000_000]:
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(lines[:8])) for t in range(rng.randint(1, 9))]
    shared = [(t, "user", f"shared {t}") for t in range(7)]
    rows += [(c, *t) for c in range(2000, 3000, 3) for t in shared]  # many that are all alike but for their heads
    rows += [(c, *t) for c in range(10_000, 60_000, 100) for t in shared[: rng.randint(1, 7)]]
    rows += [(70_000, t, "user", f"long {t % 50}") for t in range(400)] + [(70_001, t, "user", f"long {t % 50}") for t in range(390)] + [(70_002, t, "user", f"long {t % 50}") for t in range(401)]
    rows += [(80_000, None, "b", "null turn"), (80_000, None, "a", "null turn too"), (80_000, 3, "x", "q"), (80_000, 3, "a", "tie")]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = conversations()
    return rows, spark.createDataFrame([(*r, 1, 2, "p", 3, 4, 5, "o") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("depths", [64, 3, 1])
def test_against_brute_force(tables, monkeypatch, depths):
    rows, df = tables
    monkeypatch.setattr(prefix_trie, "SHARD_BYTES", 40_000)  # many shards, and places in many partitions
    if depths == 1:
        rows = [r for r in rows if r[0] is None or r[0] < 70_000]
        df = df.filter("conv_id IS NULL OR conv_id < 70000")
    assert collections.Counter(map(tuple, prefix_trie.trie(df, depths).collect())) == brute(rows)


def test_turnless_conversations_and_no_rows(spark, tables):
    _, df = tables
    c = next(c for c in range(301, 400) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "only turn, lost to an absent base")]
    got = prefix_trie.trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert list(map(tuple, got)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert prefix_trie.trie(df.filter("false")).count() == 0


def test_statement(spark):
    sf = "/root/testdata/sf0.01"
    assert spark_rows(QUERIES["op12_prefix_trie"](spark, sf)) == duck(ORACLES["op12_prefix_trie"], sf)

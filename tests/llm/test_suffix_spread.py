"""Crowded anchors however thin they are spread, and texts longer than a window."""

import numpy as np

from limes.llm import suffix_dedup
from limes.llm.arrow_text import Block


def letters(seed, n):
    return np.random.default_rng(seed).integers(97, 123, n).astype(np.uint8)


def test_pieces_of_a_long_text_hold_each_string_once():
    data = letters(1, 5_000)
    block, none = Block(data, np.array([0, len(data)])), np.zeros(0, dtype=bool)

    def strings(parts):
        return sorted((int(b) + k, int(name)) for begin, many, name, _, _ in parts for b, m, name in zip(begin, many, name) for k in range(m))

    whole = strings([suffix_dedup.cut(block, none)])
    assert len(whole) == 5_000 - 199
    for window in (200, 777, 4_800, 4_801, 4_802):
        assert strings(suffix_dedup.cuts(block, none, window)) == whole


def test_crowded_anchor_is_found_in_small_hands(spark, monkeypatch):
    passage = letters(2, 200).tobytes().decode()
    around = [letters(10 + i, 400).tobytes().decode() for i in range(300)]
    rows = [(i, a[:200] + passage + a[200:]) for i, a in enumerate(around)]
    df = spark.createDataFrame(rows, "key long, text string").repartition(8)
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 250)
    hot = np.unpackbits(suffix_dedup.hot_slots(df, 4, held_segments=20)).astype(bool)
    assert 1 <= hot.sum() <= 3
    none = np.zeros(0, dtype=bool)
    for _, text in rows[:20]:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        name = suffix_dedup.cut(Block(data, np.array([0, len(data)])), none)[2]
        assert hot[suffix_dedup.slot_of(name)].any()


def test_hot_slots_are_few():
    counts = np.arange(1 << 12)
    assert suffix_dedup._hot(counts).sum() == 40
    assert not suffix_dedup._hot(np.full(1 << 12, 5_000)).any()
    counts = np.full(1 << 12, 700)
    counts[7] += suffix_dedup.HOT_LEAST
    assert np.flatnonzero(suffix_dedup._hot(counts)).tolist() == [7]


def test_passage_over_a_window_edge(spark):
    edge = suffix_dedup.WINDOW
    long, other = letters(3, edge + 500_000), letters(4, 4_000)
    other[1_000:1_600] = long[edge - 300 : edge + 300]
    other[999] = other[1_600] = ord("#")
    df = spark.createDataFrame([(1, long.tobytes().decode()), (2, other.tobytes().decode())], "doc_id long, text string")
    got = {r.doc_id: [(s.from_byte, s.to_byte) for s in r.removed] for r in suffix_dedup.deduplicated(df).collect()}
    assert got == {1: [(edge - 300, edge + 300)], 2: [(1_000, 1_600)]}

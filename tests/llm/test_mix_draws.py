import collections
import random

from pyspark.sql import functions as F

from limes.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, n_words long, place string, size int"


def long_and_short(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(n)) + rng.choice(["", " \n"])
    rows = [(0, "long", prose(4000))] + [(i, "long", prose(40)) for i in range(1, 100)] + [(i, "short", prose(rng.randint(1, 60))) for i in range(100, 300)]
    rows += [(300, None, prose(3000)), (301, None, prose(9)), (302, "", None), (303, "", " \t"), (304, "", prose(5)), (304, "", prose(5))]
    return spark.createDataFrame([(i, t, s, None if t is None else len(t), None if t is None else len(t.split()), f"p{i}", i) for i, s, t in rows], SCHEMA).repartition(3)


def test_pipeline_mix_takes_each_sources_quota_exactly(spark):
    docs = long_and_short(spark).cache()
    text = collections.defaultdict(list)
    for r in docs.collect():
        text[r.doc_id].append(r.text or "")
    want = {r.source: r.taken for r in mixing.layout(mixing.word_counts(docs)).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    got, by_doc = collections.Counter(), collections.Counter()
    for r in mixing.mixed_documents(docs).collect():
        n = len(r.text.encode().split())
        assert n > 0 and any(r.text in t for t in text[r.doc_id]) and r.n_chars == len(r.text) and r.n_words == n and r.place == f"p{r.doc_id}" and r["size"] == r.doc_id
        got[r.source] += n
        by_doc[r.doc_id] += n
    assert dict(got) == {s: n for s, n in want.items() if n}
    taken = {r.doc_id: r.taken for r in mixing.layout(mixing.word_counts(docs)).groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()}
    assert dict(by_doc) == {i: n for i, n in taken.items() if n}


def test_one_pass_of_pieces_is_the_text(spark):
    docs = spark.createDataFrame([(i, f" {'a b  c ' * 50}\n", "s") for i in range(20)], "doc_id long, text string, source string")
    pieces = collections.Counter()
    for r in mixing.mixed_documents(docs).collect():
        pieces[r.doc_id] += len(r.text)
    assert pieces == {i: len(f" {'a b  c ' * 50}\n") for i in range(20)}  # a single source's target is all of it, once


def test_taken_is_the_sum_of_draws(spark, monkeypatch):
    sizes = mixing.word_counts(long_and_short(spark))
    total = lambda: mixing.layout(sizes).agg(F.sum("taken")).first()[0]
    everything, draws = total(), mixing.draws
    monkeypatch.setattr(mixing, "draws", lambda placed, seed=mixing.SEED: draws(placed, seed).filter("shard < 8"))
    assert 0 < total() < everything

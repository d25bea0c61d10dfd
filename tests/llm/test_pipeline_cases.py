"""The stages on nulls, repeated rows, clashing columns, copies of copies, shares against targets, and nothing at all."""

import collections
import random

import numpy as np
import pytest

import corpus_pipeline
from limes.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, part int, parts int, chunk int, run int, size int, kept boolean, root long, rep long, b long, place string, shard int, payload string"
EXTRA = (1, 2, 3, 4, 5, 6, False, 8, 9, 10, "p", 11, "q")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randint(30, 300)), rng.choice(["s1", "s2", "s3", None])) for i in range(60)]
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(10)]  # copies
    rows += [(200 + i, rows[i][1] + " one more", rows[i][2]) for i in range(10, 20)]  # near copies
    rows += [(300, None, "s1"), (301, "", "s1"), (302, "too short", "s2"), (None, prose(rng, 50), "s1"), (None, rows[0][1], "s2"), (0, rows[0][1], rows[0][2])]
    rows += [(400, prose(rng, 40) + " write to ann.lee@mail.example.com or +1 (555) 555-1234 now", "s3"), (401, prose(rng, 20_000), "s3")]
    at = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *EXTRA) for i, t, s in rows], SCHEMA).repartition(3).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame([(None, None, 0)], "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    return str(at)


def test_every_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stage = {}
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = stage[name] = spark.read.parquet(str(tmp_path / name))
    ids = lambda name: collections.Counter(r.doc_id for r in stage[name].select("doc_id").collect())
    assert not set(ids("quality")) & {300, 301, 302} and ids("quality")[None] == 2
    kept = ids("near_duplicates")
    assert set(kept) == {*range(60), None, 400, 401} and kept[None] == 2 and kept[0] == 2
    hidden = {r.doc_id: r for r in stage["personal_data"].collect()}
    assert hidden[400].text.endswith(" write to <email> or <phone> now") and hidden[400].n_chars == len(hidden[400].text)
    for name in ("quality", "near_duplicates", "personal_data", "mixing"):
        assert stage[name].columns == spark.read.parquet(f"{folder}/documents.parquet").columns
        assert {tuple(r)[5:] for r in stage[name].collect()} == {EXTRA}
    before, after = collections.Counter(), collections.Counter()
    for name, total in (("personal_data", before), ("mixing", after)):
        for r in stage[name].select("source", "text").collect():
            total[r.source] += len(r.text.encode().split())
    order = sorted(before, key=lambda s: (s is None, s or ""))
    want = mixing.shares(np.array([before[s] for s in order]), np.array([i % 3 + 1.0 for i in range(len(order))]))
    for s, target in zip(order, want.tolist()):
        assert abs(after[s] - target) <= max(before[s] / mixing.BLOCKS + 1, 0.01 * target)
    assert stage["packing"].groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").count() == 0


def test_an_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

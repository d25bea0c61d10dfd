"""Multiple-instance quality: held-out accuracy, gradients by differences, attention over slices, awkward rows, what a score may depend on."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from limes.llm import mil_quality as mil
from limes.llm.arrow_text import SPACE
from limes.llm.queries import QUERIES
from limes.llm.slices import slices

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = QUERIES["op13_mil_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality IS NOT NULL")
    got = rows.join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert len(bad) > 50 and (good.predicted == 1).mean() > 0.99 and (bad.predicted == 0).mean() > 0.9
    order = np.argsort(got.score.to_numpy(), kind="stable")
    rank = np.empty(len(got))
    rank[order] = np.arange(len(got))
    assert (rank[got.quality == 1].sum() - len(good) * (len(good) - 1) / 2) / len(good) / len(bad) > 0.99
    everything = rows.collect()
    assert len(everything) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in everything)


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    x, own, good = rng.normal(size=(30, mil.N_FEATURES)), np.repeat(np.arange(6), 5), np.array([1.0, 0, 1, 1, 0, 1])
    model = mil.Model(rng, x, 0.6)
    model.p = {k: v + rng.normal(0, 0.2, v.shape) for k, v in model.p.items()}

    def loss():
        p = model.scores(*model.partial(x, own, 6), np.arange(6), 6)
        return -np.mean(good * np.log(p) + (1 - good) * np.log(1 - p)) + mil.DECAY / 2 * sum((model.p[k] ** 2).sum() for k in "wvuc")

    found = model.gradient(x, own, good)
    for k, v in model.p.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        kept = np.array(model.p[k])
        ends = []
        for step in (1e-6, -1e-6):
            model.p[k] = np.array(kept, dtype=float)
            model.p[k][at] += step
            ends.append(loss())
        model.p[k] = kept
        assert abs((ends[0] - ends[1]) / 2e-6 - found[k][at]) < 1e-6, k


def test_parts_of_a_text_make_one_attention():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, mil.N_FEATURES))
    model = mil.Model(rng, x, 0.5)
    model.p["c"] = rng.normal(size=mil.HIDDEN)
    whole = model.scores(*model.partial(x, np.zeros(40, dtype=int), 1), np.array([0]), 1)
    parts = [model.partial(x[a:b], np.zeros(b - a, dtype=int), 1) for a, b in ((0, 7), (7, 30), (30, 40))]
    assert np.allclose(whole, model.scores(*(np.concatenate(c) for c in zip(*parts)), np.zeros(3, dtype=int), 1))


def test_every_word_lies_in_one_passage():
    texts = ["", None, " \n", "word", " ".join(["a1"] * 129), "x" * 5000, "日本 語"]
    for rows, block in slices(pa.array(texts), 1 << 20, SPACE):
        x, own = mil.encoded(block)
        assert np.bincount(own).tolist() == [1, 1, 1, 1, 3, 1, 1] and np.isfinite(x).all()
        assert not x[own == 0].any() and not x[own == 2].any()


def test_awkward_rows_and_scores_by_text_alone(spark):
    rng = np.random.default_rng(5)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))
    docs = [(i, prose(80) if i % 3 else "%%% $$$ | " * 60) for i in range(90)] + [(None, None), (None, prose(5)), (200, ""), (201, prose(200_000)), (3, prose(9)), (4, "%%% $$$ | " * 60)]
    schema = "doc_id long, text string, lang string, source string, quality int, score string, features int"
    df = spark.createDataFrame([(*d, "en", "s", 0, "s", 1) for d in docs], schema).repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(90)] + [(None, 1, 0), (5, None, 0), (999, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    model = mil.train(df, labels)
    got = mil.scored(df, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    other = mil.scored(df.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string"), "doc_id": F.lit(1).cast("long")}), model).collect()
    assert sorted(r.score for r in got) == sorted(r.score for r in other)
    assert len({r.score for r in got if r.doc_id in range(0, 90, 3) and r.doc_id != 3}) == 1
    assert {r.score for r in mil.scored(df, mil.train(df, labels.filter("quality = 1"))).collect()} == {1.0}
    assert {r.score for r in mil.scored(df, mil.train(df, labels.filter("false"))).collect()} == {1.0}
    assert mil.scored(df.filter("false"), model).count() == 0 and mil.train(df.filter("false"), labels) == 1.0

"""Quality by attention-based multiple-instance learning: a document is a bag of passages, and only the bag has a label.

Every passage of ``WORDS`` words is encoded (character classes, word shapes, repeats and hashed word shares, then a learned layer), a learned
gate weighs the passages of a document against each other (``exp(w · (tanh(V h) * sigmoid(U h)))``, normalised over the document), and the weighted
mean of the encodings is scored by a logistic layer.  Encoder, gate and score are fitted together, by Adam on the log loss of documents' labels.

The model is fitted on at most ``TRAIN_ROWS`` labelled documents, the first by a hash of their id among those whose ``crc32(doc_id) % 5`` is not 0, and on
``TRAIN_PASSAGES`` evenly spaced passages at most of each of them.  Scoring takes every passage of every document, without a shuffle; a
text over ``SLICE`` bytes goes slice by slice and keeps only the running sums of its attention.

Defined results: null and empty texts are one passage without words and have a score as well; repeated rows are scored alike (scores are rounded
to nine places, past which sums depend on what shares a batch); a null doc_id counts as held out; a label given twice counts twice, one without
document or value not at all; without labels of both kinds every score is the share of good ones (1 without any); an empty table gives an empty table;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.llm.arrow_text import SPACE, Block, mix, tidied
from limes.llm.common import first_by_hash, table, texts
from limes.llm.slices import slices

WORDS, BUCKETS, HIDDEN, GATE, SLICE = 64, 32, 24, 12, 1 << 20
TRAIN_ROWS, TRAIN_PASSAGES, EPOCHS, BATCH, RATE, DECAY, SEED = 8_000, 256, 40, 64, 4e-3, 1e-3, 11
FOLDS, GOOD_AT = 5, 0.3


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


#: byte classes counted for each passage, as shares of its bytes
CLASSES = [_flags(c) for c in (b"#*$%&|<>", b"|", b"{}[]()=/\\_~^@", bytes(range(65, 91)), b"0123456789", b".,;:!?", b"\n", bytes(range(0x80, 256)))]
N_FEATURES = 8 + len(CLASSES) + BUCKETS


def encoded(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The features of each passage, and the text each belongs to; a text without words has one passage of zeros."""
    starts, ends, first = block.words()
    n_words = np.diff(first)
    n_passages = np.maximum(1, -(-n_words // WORDS))
    own = np.repeat(np.arange(block.n), n_passages)
    out = np.zeros((len(own), N_FEATURES), dtype=np.float32)
    place = np.arange(len(own)) - np.repeat(np.cumsum(n_passages) - n_passages, n_passages)
    lo = first[own] + place * WORDS
    hi = np.minimum(lo + WORDS, first[own + 1])
    full = hi > lo
    if not full.any():
        return out, own
    lo, hi = lo[full], hi[full]
    words = (hi - lo).astype(np.float64)
    sums = lambda x: np.add.reduceat(x.astype(np.float64), lo)  # noqa: E731  (passages with words tile the words)
    a, b = starts[lo], ends[hi - 1]
    size = np.maximum(b - a, 1)
    length = ends - starts
    hashes = block.word_hashes()
    passage = np.repeat(np.arange(len(lo)), hi - lo)
    _, new = np.unique(hashes ^ mix(passage.astype(np.uint64) + np.uint64(1)), return_index=True)
    text = block.text_of_word()
    _, new_in_text = np.unique(hashes ^ mix(text.astype(np.uint64) + np.uint64(1)), return_index=True)
    windows, at = block.windows(5, hashes)
    seen = np.zeros(len(hashes))
    if len(windows):
        _, one = np.unique(windows ^ mix(text[at].astype(np.uint64) + np.uint64(1)), return_index=True)
        seen[at] = 1
        seen[at[one]] = 0
    columns = [
        np.log1p(words) / 4,
        sums(length) / words / 10,
        np.log1p(np.maximum.reduceat(length, lo)) / 4,
        np.bincount(passage[new], minlength=len(lo)) / words,
        np.bincount(passage[new_in_text], minlength=len(lo)) / words,
        sums(seen) / words,
        sums(length <= 2) / words,
        sums(length > 12) / words,
    ]
    for table_of in CLASSES:
        count = np.concatenate([[0], np.cumsum(table_of[block.data])])
        columns.append((count[b] - count[a]) / size)
    buckets = np.bincount(passage * BUCKETS + (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=len(lo) * BUCKETS).reshape(-1, BUCKETS)
    out[full] = np.concatenate([np.stack(columns, axis=1), buckets / words[:, None]], axis=1)
    return out, own


class Model:
    """Weights of encoder, gate and score; ``gradient`` and ``partial`` share one forward pass."""

    SHAPES = {"w": (N_FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "d": ()}

    def __init__(self, rng: np.random.Generator, x: np.ndarray, share: float):
        self.mean, self.scale = x.mean(axis=0), 1 / (x.std(axis=0) + 1e-3)
        self.p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) == 2 else np.zeros(s) for k, s in self.SHAPES.items()}
        self.p["a"] = rng.normal(0, 0.1, GATE)
        self.p["d"] = np.array(np.log(share / (1 - share)))

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        p = self.p
        z = np.clip((x - self.mean) * self.scale, -6, 6)
        h = np.tanh(z @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        return z, h, t, s, (t * s) @ p["a"]

    def partial(self, x: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of ``n`` texts: the highest gate, and against it the sums of weights and of weighted encodings."""
        _, h, _, _, e = self.forward(x)
        start = np.searchsorted(own, np.arange(n))
        top = np.maximum.reduceat(e, start)
        weight = np.exp(e - top[own])
        return top, np.add.reduceat(weight, start), np.add.reduceat(weight[:, None] * h, start)

    def scores(self, top: np.ndarray, weight: np.ndarray, total: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Puts the parts of each row's text together; ``row`` ascends and has every row."""
        start = np.searchsorted(row, np.arange(n))
        best = np.maximum.reduceat(top, start)
        factor = np.exp(top - best[row])
        mean = np.add.reduceat(total * factor[:, None], start) / np.add.reduceat(weight * factor, start)[:, None]
        return 1 / (1 + np.exp(-(mean @ self.p["c"] + self.p["d"])))

    def gradient(self, x: np.ndarray, own: np.ndarray, good: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(good)
        z, h, t, s, e = self.forward(x)
        start = np.searchsorted(own, np.arange(n))
        weight = np.exp(e - np.maximum.reduceat(e, start)[own])
        weight /= np.add.reduceat(weight, start)[own]
        mean = np.add.reduceat(weight[:, None] * h, start)
        miss = (1 / (1 + np.exp(-(mean @ p["c"] + p["d"]))) - good) / n
        of_mean = miss[:, None] * p["c"]
        of_e = weight * ((h - mean[own]) * of_mean[own]).sum(axis=1)
        of_t, of_s = of_e[:, None] * p["a"] * s * (1 - t * t), of_e[:, None] * p["a"] * t * s * (1 - s)
        of_h = weight[:, None] * of_mean[own] + of_t @ p["v"].T + of_s @ p["u"].T
        of_h *= 1 - h * h
        found = {"w": z.T @ of_h, "b": of_h.sum(axis=0), "v": h.T @ of_t, "u": h.T @ of_s, "a": (t * s).T @ of_e, "c": mean.T @ miss, "d": miss.sum()}
        return {k: g + (DECAY * p[k] if k in "wvuc" else 0) for k, g in found.items()}


def fit(bags: list[np.ndarray], good: np.ndarray, epochs: int = EPOCHS) -> Model | float:
    """A model from passages of each document, or the share of good ones where there are not both kinds."""
    if len(good) == 0 or good.min() == good.max():
        return float(good.mean()) if len(good) else 1.0
    rng = np.random.default_rng(SEED)
    model = Model(rng, np.concatenate(bags).astype(float), float(good.mean()))
    first = {k: np.zeros_like(x) for k, x in model.p.items()}
    second = {k: np.zeros_like(x) for k, x in model.p.items()}
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(good))
        for lo in range(0, len(order), BATCH):
            chosen = order[lo : lo + BATCH]
            own = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
            found, step = model.gradient(np.concatenate([bags[i] for i in chosen]).astype(float), own, good[chosen]), step + 1
            for k, g in found.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.p[k] = model.p[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def passages(docs: DataFrame, most: int) -> DataFrame:
    """``doc_id`` and the ``features`` of at most ``most`` evenly spaced passages, as 32-bit floats in one value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, list[np.ndarray]] = {}
            for rows, block in slices(batch.column(1), SLICE, SPACE):
                x, own = encoded(block)
                cut = np.searchsorted(own, np.arange(len(rows) + 1))
                for i, row in enumerate(rows.tolist()):
                    held.setdefault(row, []).append(x[cut[i] : cut[i + 1]])
            out = []
            for row in range(batch.num_rows):
                x = np.concatenate(held[row])
                out.append(x[:: max(1, -(-len(x) // most))].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "features"])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, features binary")


def train(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS, most_passages: int = TRAIN_PASSAGES) -> Model | float:
    """Learns from ``labels(doc_id, quality)`` outside the held-out fold; the sample has ``most_rows`` rows at most."""
    given = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out(F.col("doc_id"))).select("doc_id", "quality")
    sample = first_by_hash(given, most_rows, "doc_id", "quality")
    chosen = docs.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    rows = passages(chosen, most_passages).join(F.broadcast(sample), "doc_id").orderBy("doc_id", "quality", "features").limit(most_rows).toPandas()
    bags = [np.frombuffer(f, dtype="<f4").reshape(-1, N_FEATURES) for f in rows["features"]]
    return fit(bags, rows["quality"].to_numpy(np.float64))


def scored(docs: DataFrame, model: Model | float) -> DataFrame:
    """``doc_id``, ``score`` and the number of ``passages`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found, count = batch.num_rows, [], np.zeros(batch.num_rows, dtype=np.int64)
            for rows, block in slices(batch.column(1), SLICE, SPACE):
                x, own = encoded(block)
                np.add.at(count, rows[own], 1)
                if isinstance(model, Model):
                    found.append((*model.partial(x.astype(float), own, len(rows)), rows))
            score = model.scores(*(np.concatenate(c) for c in zip(*found)), n) if found else np.full(n, model if isinstance(model, float) else 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(score, 9)), pa.array(count)], ["doc_id", "score", "passages"])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, score double, passages long")


def op13_mil_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD_AT).cast("int").alias("predicted"), "passages")

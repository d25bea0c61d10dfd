"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints, beside fixed base rules.

Statistics come from the whole text, by prefix sums over Arrow buffers.  The trees are fitted by numpy on at most ``TRAIN_ROWS``
labelled documents (the first by a hash of their id; the only bounded sample here), and flattened into node arrays that score a
batch level by level.  The score cannot fall when the share of symbols, of repeated words or of repeated lines grows.

A document is rejected if a base rule fails (fewer than 10 words, or more than a fifth of its words stand in five-word windows
found twice or more), or if the trees find it bad with probability ``REJECT_AT`` at least; the high threshold keeps clean text.

Defined results: null and empty texts have no words and fail; repeated rows are judged alike; a label given twice counts twice, a label
without document or with a null is not used; without usable labels of both kinds only the base rules judge; an empty table gives
an empty table; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.arrow_text import SPACE, U64, Block, blocks, mix, tidied
from limes.llm.common import first_by_hash, table, texts

TRAIN_ROWS, TREES, DEPTH, RATE, BINS, L2, REJECT_AT = 20_000, 60, 3, 0.15, 32, 1.0, 0.8
MIN_WORDS, MOST_REPEAT_PERCENT, WINDOW = 10, 20, 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct", "longest"]
FEATURES = ["words", "word_length", "symbols", "dup_lines", "repeats", "line_words", "upper", "digits", "marks", "distinct", "longest"]
#: +1: the probability of being bad may only grow with the feature
MONOTONE = {"symbols": 1, "dup_lines": 1, "repeats": 1}


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


SYMBOL, UPPER, DIGIT, MARK = _table(b"#*$%&|<>"), _table(bytes(range(65, 91))), _table(b"0123456789"), _table(b".,;:!?")


def _per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


def statistics(block: Block) -> np.ndarray:
    """A row of ``COUNTS`` for each text."""
    data, offs = block.data, block.offs
    starts, ends, first = block.words()
    n = block.n
    own = block.text_of_word()
    n_words = np.diff(first)
    inside = ~SPACE[data]
    points = _per_text(inside & ((data & 0xC0) != 0x80), offs)
    hashes = block.word_hashes()
    at_text = mix(own.astype(U64) + U64(1))
    distinct = np.zeros(n, dtype=np.int64)
    if len(hashes):
        _, one = np.unique(hashes ^ at_text, return_index=True)
        distinct = np.bincount(own[one], minlength=n)
    windows, at = block.windows(WINDOW, hashes)
    repeat = np.zeros(n, dtype=np.int64)
    if len(windows):
        _, which, count = np.unique(windows ^ at_text[at], return_inverse=True, return_counts=True)
        hit = at[count[which] > 1]
        edge = np.bincount(hit, minlength=len(hashes) + 1) - np.bincount(hit + WINDOW, minlength=len(hashes) + 1)
        covered = np.cumsum(edge[:-1]) > 0
        repeat = np.bincount(own[covered], minlength=n)
    lines, dup = _lines(block, inside)
    longest = np.zeros(n, dtype=np.int64)
    if len(starts):
        np.maximum.at(longest, own, ends - starts)
    columns = [n_words, points, _per_text(SYMBOL[data], offs), dup, repeat, lines, _per_text(UPPER[data], offs), _per_text(DIGIT[data], offs), _per_text(MARK[data], offs), distinct, longest]
    return np.stack([np.asarray(c, dtype=np.int64) for c in columns], axis=1)


def _lines(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and of these the ones equal to an earlier line, for each text."""
    breaks = np.flatnonzero(block.data == 10)
    filled = np.flatnonzero(block.offs[:-1] < block.offs[1:])
    begin = np.concatenate([block.offs[filled], breaks + 1])
    end = np.concatenate([breaks, block.offs[filled + 1]])
    begin.sort()
    end.sort()
    if not len(begin):
        return np.zeros(block.n, dtype=np.int64), np.zeros(block.n, dtype=np.int64)
    words = np.concatenate([[0], np.cumsum(inside)])
    some = words[end] > words[begin]
    begin, end = begin[some], end[some]
    own = np.searchsorted(block.offs, begin, side="right") - 1
    key = block.span_hashes(begin, end) + mix((end - begin).astype(U64)) ^ mix(own.astype(U64) + U64(1))
    _, one = np.unique(key, return_index=True)
    total = np.bincount(own, minlength=block.n)
    return total, total - np.bincount(own[one], minlength=block.n)


def features(counts: np.ndarray) -> np.ndarray:
    c = {k: counts[:, i].astype(float) for i, k in enumerate(COUNTS)}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack(
        [c["n_words"], c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words, words / np.maximum(c["n_lines"], 1), c["n_upper"] / chars, c["n_digits"] / chars, c["n_marks"] / words, c["n_distinct"] / words, c["longest"]],
        axis=1,
    )


@dataclass
class Trees:
    """Nodes of all trees in arrays; a leaf points at itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int = DEPTH

    def probability(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


@dataclass
class _Growing:
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def leaf(self, value: float) -> int:
        k = len(self.value)
        for column, v in zip((self.feature, self.threshold, self.left, self.right, self.value), (0, 0.0, k, k, value)):
            column.append(v)
        return k


def fit(x: np.ndarray, bad: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees | None:
    """Boosted trees for P(bad) under log loss, by histograms of quantile bins; None without both kinds of labels."""
    if len(bad) < 20 or bad.min() == bad.max():
        return None
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    signs = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    base = float(np.log(bad.mean() / (1 - bad.mean())))
    score, nodes, roots = np.full(len(bad), base), _Growing(), []

    def weight(g: np.ndarray, h: np.ndarray, lo: float, hi: float) -> np.ndarray:
        return np.clip(-g / (h + L2), lo, hi)

    def grow(rows: np.ndarray, level: int, lo: float, hi: float, g: np.ndarray, h: np.ndarray) -> int:
        gs, hs = g[rows].sum(), h[rows].sum()
        own = float(weight(gs, hs, lo, hi))
        me = nodes.leaf(rate * own)
        best = (1e-3, -1, 0, 0.0, 0.0)
        if level < depth and len(rows) >= 20:
            loss = gs * own + 0.5 * (hs + L2) * own * own
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(codes[rows, j], g[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(codes[rows, j], h[rows], len(c) + 1))[:-1]
                wl, wr = weight(gl, hl, lo, hi), weight(gs - gl, hs - hl, lo, hi)
                gain = loss - (gl * wl + 0.5 * (hl + L2) * wl**2 + (gs - gl) * wr + 0.5 * (hs - hl + L2) * wr**2)
                gain[(hl < 1) | (hs - hl < 1) | ((wr - wl) * signs[j] < 0)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k, float(wl[k]), float(wr[k]))
        _, j, k, wl, wr = best
        if j >= 0:
            mid, goes = (wl + wr) / 2, codes[rows, j] <= k
            left_hi, right_lo = (min(hi, mid), max(lo, mid)) if signs[j] > 0 else (hi, lo)
            nodes.feature[me], nodes.threshold[me] = j, float(cuts[j][k])
            nodes.left[me] = grow(rows[goes], level + 1, lo, left_hi, g, h)
            nodes.right[me] = grow(rows[~goes], level + 1, right_lo, hi, g, h)
        return me

    everything = np.arange(len(bad))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(everything, 0, -np.inf, np.inf, p - bad, p * (1 - p)))
        made = Trees(np.array(roots[-1:]), *(np.array(getattr(nodes, k)) for k in ("feature", "threshold", "left", "right", "value")), 0.0, depth)
        at = made.probability(x)
        score += np.log(at / (1 - at))
    return Trees(np.array(roots), *(np.array(getattr(nodes, k)) for k in ("feature", "threshold", "left", "right", "value")), base, depth)


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``COUNTS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                rows = statistics(block)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *(pa.array(c) for c in rows.T)], ["doc_id", *COUNTS])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS) -> Trees | None:
    """Trees from ``labels(doc_id, quality)``; the sample, and with it the broadcast, has ``most_rows`` rows at most."""
    given = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", "quality")
    sample = first_by_hash(given, most_rows, "doc_id", "quality")
    chosen = docs.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    rows = counted(chosen).join(F.broadcast(sample), "doc_id").orderBy("doc_id", "quality", *COUNTS).limit(most_rows).toPandas()
    return fit(features(rows[COUNTS].to_numpy()), 1 - rows["quality"].to_numpy(np.int64)) if len(rows) else None


def verdict(counts: np.ndarray, trees: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, P(bad), kept."""
    n_words, repeats = counts[:, 0], counts[:, 4]
    failed = (n_words < MIN_WORDS) | (100 * repeats > MOST_REPEAT_PERCENT * n_words)
    p = trees.probability(features(counts)) if trees is not None else np.zeros(len(counts))
    return failed, p, ~failed & (p < REJECT_AT)


def judged(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``p_bad`` and ``kept`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                rows = statistics(block)
                failed, p, kept = verdict(rows, trees)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *(pa.array(c) for c in rows.T), pa.array(failed), pa.array(p), pa.array(kept)], ["doc_id", *COUNTS, "base_failed", "p_bad", "kept"])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, p_bad double, kept boolean")


def kept_documents(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and without a shuffle."""
    names = docs.columns
    at = next(i for i, c in enumerate(names) if c.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [verdict(statistics(block), trees)[2] for _, _, block in blocks(batch.column(at))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(tidied(run), docs.schema)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = judged(docs, train(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_bad")

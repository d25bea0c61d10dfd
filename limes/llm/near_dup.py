"""MinHash near-duplicates, candidates verified by odd sketches and then on full shingle sets.

A document's set holds its distinct shingles of some words (A-Z lower-cased).  Documents whose sets agree in a percentage of their union
are linked; a component takes the smallest ``doc_id`` that links reach.  A ``Rule`` names both: three words and 85 per cent for ``op10``
(``DIGESTS``), five words and 80 per cent for the pipeline (``WORDS``).

1. One pass over the texts gives set size, a 128-bit fingerprint of the set, MinHash samples folded into band keys (25 keys of five
   samples, or 28 of four at 80 per cent), and an odd sketch: a 256-bit map in which every (sample number, value) flips one bit.
2. Equal sets become one representative (partial aggregation first), so copies never meet again.
3. Band buckets link their representatives in two stars: within each of ``SALTS`` hash parts of a big bucket to the part's smallest
   one, and these (or all members of a small one) to the bucket's smallest one.  That is linear in the bucket, and no centre has more than a part of a hot bucket.  Sizes and
   population counts of XORs of two sketches drop pairs below the threshold; all others are compared on their full sets.
4. Connected components of the confirmed links, by large-star and small-star rounds.
5. What stars can miss: pairs that share a bucket but not a component.  In each bucket with several components, those members that are outside
   its largest component meet all members under the same sketch tests, part by part.  First only the closest pair of any
   two components is compared, in few bands, then in all; components grow together, and at last all pairs still open are compared.
   Members of the largest component never meet each other, which is what keeps big groups near linear.

There are two odd sketches.  One folds the MinHash samples (256 bits); it serves sets of any size.  The other folds the whole set
(1024 bits), which is precise for sets up to a few thousand shingles.

A pair at the threshold misses all bands with probability (1 - 0.85**5)**25 = 4e-7, or (1 - 0.8**4)**28 = 4e-7.  The samples' sketch
then drops it with a probability below ``LOST`` (``most_bits`` computes the exact distribution); the whole set's sketch never differs in more bits
than the sets do in shingles, so it loses nothing.  Nothing is capped.

Defined results: null and empty texts have an empty set, are linked with nothing and are their own component; texts of fewer words
than a shingle have their word sequence as one shingle; repeated rows of one ``doc_id`` with equal texts give one row each, with the same
class; a ``doc_id`` that stands on different texts joins their classes; a null ``doc_id`` is a component of its own with a null id;
an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.llm.arrow_text import U64, Block, binaries, blocks, mix, tidied
from limes.llm.common import table, texts, written

SKETCH_BITS, SET_BITS, LOST, SALTS, BIG = 256, 1024, 1e-9, 64, 512


class Rule(NamedTuple):
    """Words of a shingle, the threshold, and the bands (of ``rows`` samples) that find pairs at the threshold."""

    width: int
    percent: int
    bands: int
    rows: int

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def missed(self) -> float:
        """Probability that a pair at the threshold shares no band."""
        return (1 - (self.percent / 100) ** self.rows) ** self.bands

    @property
    def most_bits(self) -> int:
        """Bits in which sketches of sets at the threshold differ at most, but for a share ``LOST`` of such pairs."""
        return _most_bits(self.samples, self.percent)


@functools.cache
def _most_bits(samples: int, percent: int) -> int:
    similarity, bits = percent / 100, np.arange(SKETCH_BITS + 1)
    differing = np.zeros(SKETCH_BITS + 1)  # chances of so many different bits after 2 * m flips of random bits
    differing[0] = 1
    total = np.zeros(SKETCH_BITS + 1)
    for m in range(samples + 1):  # m samples disagree, and each of them flips a bit in either sketch
        total += math.comb(samples, m) * (1 - similarity) ** m * similarity ** (samples - m) * differing
        for _ in range(2):
            up, down = differing * (1 - bits / SKETCH_BITS), differing * bits / SKETCH_BITS
            differing = np.concatenate([[0], up[:-1]]) + np.concatenate([down[1:], [0]])
    above = 1 - np.cumsum(total)
    return int(np.flatnonzero(above < LOST)[0])


DIGESTS, WORDS = Rule(3, 85, 25, 5), Rule(5, 80, 28, 4)
_MULTIPLY = mix(np.arange(1, max(DIGESTS.samples, WORDS.samples) + 1, dtype=U64)) | U64(1)


def shingle_sets(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, side by side, and their bounds."""
    hashes = block.word_hashes(lower=True)
    first = block.words()[2]
    count = np.diff(first)
    values, at = block.windows(width, hashes)
    own = block.text_of_word()[at] if len(at) else np.zeros(0, dtype=np.int64)
    for d in np.flatnonzero((count > 0) & (count < width)):
        h = U64(count[d])
        for k in range(first[d], first[d + 1]):
            h = mix(np.array([h ^ hashes[k]]))[0]
        values, own = np.append(values, h), np.append(own, d)
    if not len(values):
        return np.zeros(0, dtype=U64), np.zeros(block.n + 1, dtype=np.int64)
    order = np.lexsort((values, own))
    values, own = values[order], own[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    values, own = values[new], own[new]
    return values, np.searchsorted(own, np.arange(block.n + 1))


def signatures(values: np.ndarray, bounds: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints (n, 2), band keys (n, bands) and odd sketches (n, 4) of non-empty sets."""
    begin = bounds[:-1]
    n = len(begin)
    fingerprint = np.stack([np.add.reduceat(values, begin), np.add.reduceat(mix(values ^ U64(0x5851F42D4C957F2D)), begin)], axis=1)
    keys, sketch = np.zeros((n, rule.bands), dtype=U64), np.zeros((n, SKETCH_BITS // 64), dtype=U64)
    rows = np.arange(n)
    spread = values ^ (values >> U64(29))
    for i in range(rule.samples):
        mixed = spread * _MULTIPLY[i]
        mixed ^= mixed >> U64(32)
        least = np.minimum.reduceat(mixed, begin)
        keys[:, i // rule.rows] = mix(keys[:, i // rule.rows] ^ least ^ U64(i // rule.rows + 1))
        bit = mix(least ^ (U64(i) << U64(48))) % U64(SKETCH_BITS)
        sketch[rows, (bit >> U64(6)).astype(np.int64)] ^= U64(1) << (bit & U64(63))
    return fingerprint, keys, sketch


SAMPLE_WORDS = [f"s{i}" for i in range(SKETCH_BITS // 64)]
SET_WORDS = [f"p{i}" for i in range(SET_BITS // 64)]
SKETCH = ["n_shingles", *SAMPLE_WORDS, *SET_WORDS]
PROFILE = "doc_id long, n_shingles long, f1 long, f2 long, bands binary, " + ", ".join(f"{c} long" for c in SAMPLE_WORDS + SET_WORDS)


def set_sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Parity of the whole sets, ``SET_BITS`` each, as words."""
    n = len(bounds) - 1
    own = np.repeat(np.arange(n), np.diff(bounds))
    bit = (mix(values ^ U64(0x1B873593CC9E2D51)) % U64(SET_BITS)).astype(np.int64)
    odd = np.bincount(own * SET_BITS + bit, minlength=n * SET_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, SET_BITS), axis=1).view(np.int64)


def profiles(docs: DataFrame, rule: Rule = DIGESTS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                values, bounds = shingle_sets(block, rule.width)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                f, s = np.zeros((block.n, 2), dtype=U64), np.zeros((block.n, 4), dtype=U64)
                bands: list = [None] * block.n
                if len(full):
                    f[full], keys, s[full] = signatures(values, np.append(bounds[full], bounds[-1]), rule)
                    for d, row in zip(full, keys):
                        bands[d] = row.tobytes()
                whole = set_sketches(values, bounds)
                as_long = [pa.array(c.view(np.int64)) for c in (*np.ascontiguousarray(f.T), *np.ascontiguousarray(s.T), *np.ascontiguousarray(whole.T))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(size.astype(np.int64)), *as_long[:2], binaries(bands), *as_long[2:]], [c.split()[0] for c in PROFILE.split(", ")])

    return texts(docs).mapInArrow(tidied(run), PROFILE)


def similar(pairs: DataFrame, needed: DataFrame, rule: Rule = DIGESTS) -> DataFrame:
    """The pairs ``a, b`` whose full sets agree, by ``needed(doc_id, text)``.

    Each pair streams past with both texts, so the partners of a text are never gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for lo, hi, block in blocks(batch.column(2)):
                va, ba = shingle_sets(block, rule.width)
                other = batch.column(3)[lo:hi]
                vb, bb = (np.concatenate(p) for p in zip(*_sets(other, rule.width)))
                for i in range(hi - lo):
                    a, b = va[ba[i] : ba[i + 1]], vb[bb[2 * i] : bb[2 * i + 1]]
                    same = len(a) + len(b) - len(np.union1d(a, b))
                    keep.append(len(a) > 0 and 100 * same >= rule.percent * (len(a) + len(b) - same))
            if keep:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    first = pairs.join(needed.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    both = first.join(needed.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(tidied(run), "a long, b long")


def _sets(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sets of a column with bounds as (begin, end) pairs into the concatenation."""
    shift = 0
    for _, _, block in blocks(column):
        v, b = shingle_sets(block, width)
        yield v, np.stack([b[:-1], b[1:]], axis=1).ravel() + shift
        shift += len(v)


def components(links: DataFrame) -> DataFrame:
    """``v, root`` for each end of ``links(a, b)``: alternating large-star and small-star until stars are all that is left."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    edges, before = written(edges, "links"), None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select("v", F.col("m").alias("u")).filter("u <> v").distinct()
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v").select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u")))).alias("e"))
        edges = written(small.select("e.v", "e.u").filter("u <> v").distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select("v", F.col("u").alias("root")).union(edges.select(F.col("u").alias("v"), F.col("u").alias("root")).distinct())


def _bands(representatives: DataFrame, rule: Rule) -> DataFrame:
    keys = F.transform(F.sequence(F.lit(0), F.lit(rule.bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("bands"), i * 8 + 1, F.lit(8))))
    return representatives.select("rep", F.posexplode(keys).alias("band", "key"))


def _may_be_similar(a: str, b: str, rule: Rule) -> str:
    """The test of two sides with these suffixes: sizes, the whole sets' sketches, the samples' sketches."""
    bits = lambda words: " + ".join(f"bit_count({w}{a} ^ {w}{b})" for w in words)
    sizes = f"least(n_shingles{a}, n_shingles{b}) * 100 >= greatest(n_shingles{a}, n_shingles{b}) * {rule.percent}"
    whole = f"({bits(SET_WORDS)}) * {100 + rule.percent} <= (n_shingles{a} + n_shingles{b}) * {100 - rule.percent}"
    return f"{sizes} AND {whole} AND {bits(SAMPLE_WORDS)} <= {rule.most_bits}"


def _close(pairs: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose sizes and sketches allow the threshold."""
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("rep").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in SKETCH)), side)
    return pairs.filter(_may_be_similar("_a", "_b", rule)).select("a", "b")


def _stars(banded: DataFrame) -> DataFrame:
    """``band, key, part, parts, rep, b``: members of shared buckets, each with the member it is tried with (null for the bucket's centre).

    For all later steps a bucket falls into as many parts as ``BIG`` members each ask for.
    """
    parted = banded.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
    whole = Window.partitionBy("key")  # at most SALTS rows
    local = parted.groupBy("key", "part").agg(F.min("rep").alias("local"), F.count("*").alias("n"))
    local = local.select("key", "part", "local", F.min("local").over(whole).alias("centre"), F.sum("n").over(whole).alias("n")).filter("n > 1")
    shared = parted.join(local, ["key", "part"])
    parts = F.ceil(F.col("n") / BIG).cast("int")
    nearest = F.when((parts == 1) | (F.col("rep") == F.col("local")), F.col("centre")).otherwise(F.col("local"))
    return shared.select("band", "key", F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part"), parts.alias("parts"), "rep", F.when(F.col("rep") != nearest, nearest).alias("b"))


def classes(docs: DataFrame, rule: Rule = DIGESTS) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row for each row of ``docs``."""
    seen = written(profiles(docs, rule), "profiles")
    filled = seen.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    representatives = written(
        filled.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"), *(F.any_value(c).alias(c) for c in ("bands", *SAMPLE_WORDS, *SET_WORDS))), "representatives"
    )
    # A doc_id on several texts is a link between their sets; within one text it is the set's own copies.
    copies = filled.join(representatives.select("f1", "f2", "n_shingles", "rep"), ["f1", "f2", "n_shingles"]).select("doc_id", "rep")
    sketches = representatives.select("rep", *SKETCH)
    shared = written(_stars(_bands(representatives, rule)), "buckets")
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct().hint("shuffle_hash")
    needed = written(texts(docs).join(wanted, "doc_id", "left_semi"), "candidate-texts")
    tried = shared.filter("b IS NOT NULL").select(F.col("rep").alias("a"), "b").distinct()
    links = similar(_close(tried, sketches, rule), needed, rule)
    several = copies.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).filter("b <> most").select("doc_id", "b")
    same_id = copies.join(several, "doc_id").select(F.col("rep").alias("a"), "b")
    rooted = written(components(links.union(same_id)), "rooted")
    for bands, closest in (*OPEN_ROUNDS, (rule.bands, True), (rule.bands, False)):
        rest = written(_crossing(shared.filter(F.col("band") < bands), rooted, sketches, closest, rule), "crossing")
        if rest.isEmpty():
            continue
        more = written(similar(rest, needed, rule), "links")
        if not more.isEmpty():
            rooted = written(components(more.unionByName(rooted.select(F.col("v").alias("a"), F.col("root").alias("b")))), "rooted")
    of_set = copies.join(rooted.select(F.col("v").alias("rep"), "root"), "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("root"))
    of_doc = of_set.groupBy("doc_id").agg(F.min("root").alias("root"))
    return seen.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


#: bands that the first rounds look at, and whether they take only the closest pair of any two components; two rounds over all bands follow
OPEN_ROUNDS = ((3, True),)


def _crossing(shared: DataFrame, rooted: DataFrame, sketches: DataFrame, closest: bool, rule: Rule) -> DataFrame:
    """Pairs that share a bucket, are in different components and may be similar: what is still open."""
    placed = shared.join(rooted.select(F.col("v").alias("rep"), "root"), "rep", "left").select("key", "part", "parts", "rep", F.coalesce("root", "rep").alias("root"))
    sizes = placed.groupBy("key", "root", "parts").agg(F.count("*").alias("n"))
    homes = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("home"), F.count("*").alias("roots"), F.any_value("parts").alias("parts")).filter("roots > 1").select("key", "home", "parts")
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    inside = written(placed.drop("parts").join(homes.select("key", "home", "parts", every_part), ["key", "part"]), "open")
    inside = inside.join(sketches, "rep")
    side = lambda rows, x, *more: rows.select("key", *more, *(F.col(c).alias(f"{c}_{x}") for c in ("rep", "root", *SKETCH)))
    guests = inside.filter("root <> home").select(every_part, "key", "rep", "root", *SKETCH)
    test = f"root_a <> root_b AND (root_a = home OR rep_a < rep_b) AND {_may_be_similar('_a', '_b', rule)}"
    met = side(inside, "a", "part", "home").join(side(guests, "b", "part"), ["key", "part"]).filter(test)
    if not closest:
        return met.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    apart = F.expr(f"({' + '.join(f'bit_count({w}_a ^ {w}_b)' for w in SET_WORDS)}) / (n_shingles_a + n_shingles_b)")
    pair = F.struct(F.least("root_a", "root_b").alias("x"), F.greatest("root_a", "root_b").alias("y"))
    best = met.groupBy(pair.alias("roots")).agg(F.min(F.struct(apart.alias("apart"), F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))).alias("p"))
    return best.select("p.a", "p.b")


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    rows = classes(table(spark, sf_dir, "documents"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame, rule: Rule = DIGESTS) -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest; of rows repeated under that id all stay."""
    kept = classes(docs, rule).filter("doc_id = component_id OR doc_id IS NULL").select(F.col("doc_id").alias("__id")).distinct().hint("shuffle_hash")
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_semi")

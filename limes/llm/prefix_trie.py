"""The prefix trie of rebuilt conversations, by padded matrices of turn ids in range shards.

Conversations become segments of at most ``DEPTHS`` turns, each turn a 128-bit id of (role, text).  Segments are dealt by range of (segment
number, what stands before it, turn ids, conv_id), so a shard holds a run of the trie's order, and a sequence that a third of all conversations
share spreads over many shards.  A shard pads its segments to a matrix, sorts it by ``numpy.lexsort``, marks at each depth the rows
where any column so far changes (the marks of the depths above are OR-ed in), which are the nodes' first rows, and aggregates all nodes of a depth by
``reduceat``.  Only nodes that hold a shard's first or last row can go on in another shard: at most two for each depth, which recombine by a grouped sum.

Sums over subtrees need no walk from children to parents.  Every node belongs to its smallest member, and so does what it adds; a node's
subtree adds what its members own at its depth and below, which is one more sum over the same matrix.  A node is known by its depth and
the XOR of 128-bit hashes of (turn, place) along its path, which also joins a segment to those before it.  Conversations of any length are so cut
into rows of bounded size, and no step takes one conversation, one turn or one node into one task; only a node's digest over its
members' ids must be one stream, of one piece for each shard.

Defined results: turns that repeat a place of their conversation follow each other by role and a hash; rows without a conv_id belong to no
conversation and are left out; a null role or text is empty, a null turn comes first; ``c - c % 100`` and ``%`` truncate towards zero; an empty
table has no root and gives an empty table; extra columns are not read.  Two different paths agree by chance with probability about n²/2¹²⁹ for n nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.llm.arrow_text import tidied
from limes.llm.common import parts, table, written

DEPTHS, HEADS, BASE, SHARD_BYTES = 64, 6, 100, 16 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()
LOWEST = -(1 << 63)  # pads a matrix; turn ids are larger


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, the turn's place ``pos`` (from 1) in its conversation, its id ``x1, x2`` and its code points ``size``.

    Places are counted in range partitions and shifted by what earlier partitions hold of the same conversation; at most one row for
    each partition has such a shift, so that table's size is bounded by the number of partitions.
    """
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.greatest(F.xxhash64(role, text), F.lit(LOWEST + 1)).alias("x1"), F.xxhash64(text, F.lit(1), role).alias("x2"), F.char_length(text).cast("long").alias("size")
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("x1"), F.asc("x2")]
    n = parts(rows.sparkSession, conversations.count() * 64, SHARD_BYTES)
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv_id", "x1", "x2", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            start = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            base = np.zeros(len(start), dtype=np.int64)
            base[0] = held if conv[0] == last else 0
            pos = np.arange(len(conv)) - np.repeat(start - base, np.diff(np.append(start, len(conv)))) + 1
            last, held = conv[-1], int(pos[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos), pa.array(np.full(len(conv), part, dtype=np.int64))], ["conv_id", "x1", "x2", "size", "pos", "part"])

    local = written(sorted_rows.mapInArrow(run, "conv_id long, x1 long, x2 long, size long, pos long, part long"), "turns")
    runs = local.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.withColumn("shift", F.sum("n").over(earlier)).filter("shift IS NOT NULL").select("conv_id", "part", "shift")
    placed = local.join(F.broadcast(shifts), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "x1", "x2", "size")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation's turns after its head is exchanged, and the conversations that are left without a turn."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    base = F.col("conv_id") - F.col("conv_id") % BASE
    own = own.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS, "base": base})
    first = turns.filter(f"conv_id % {BASE} = 0 AND pos < {HEADS}")
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "x1", "x2", "size"))).alias("head"))
    plan = own.join(heads, "base", "left").select("conv_id", "n_own", "h", F.expr("CASE WHEN h = 0 OR head IS NULL THEN filter(head, t -> false) ELSE slice(head, 1, CAST(h AS INT)) END").alias("head"))
    plan = written(plan.withColumn("n_head", F.coalesce(F.size("head"), F.lit(0)).cast("long")).withColumn("n_head", F.greatest("n_head", F.lit(0))), "heads")
    taken = plan.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("i"), "t.x1", "t.x2", "t.size")
    kept = turns.join(plan.select("conv_id", "h", "n_head"), "conv_id").filter("pos > h").select("conv_id", F.expr("pos - h + n_head").alias("i"), "x1", "x2", "size")
    return taken.unionByName(kept), plan.filter("n_head = 0 AND n_own <= h").select("conv_id")


def segments(turns: DataFrame, turnless: DataFrame, depths: int = DEPTHS) -> DataFrame:
    """``conv_id``, segment number ``k``, hash of all turns before it, whether it is the ``last``, and its turns in order."""
    keyed = turns.withColumns({"k": F.expr(f"(i - 1) div {depths}"), "u1": F.xxhash64("x1", "x2", "i"), "u2": F.xxhash64("i", "x2", "x1")})
    turn = F.struct("i", "x1", "x2", "u1", "u2", "size")
    rows = keyed.groupBy("conv_id", "k").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.expr("bit_xor(u1)").alias("s1"), F.expr("bit_xor(u2)").alias("s2"))
    none = turnless.select("conv_id", F.lit(0).cast("long").alias("k"), F.expr("filter(array(named_struct('i', 0L, 'x1', 0L, 'x2', 0L, 'u1', 0L, 'u2', 0L, 'size', 0L)), t -> false)").alias("turns"), F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"))
    along = Window.partitionBy("conv_id").orderBy("k")
    ahead = along.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.expr(f"bit_xor({c})").over(ahead), F.lit(0))
    return rows.unionByName(none).select("conv_id", "k", before("s1").alias("b1"), before("s2").alias("b2"), F.lead("k").over(along).isNull().alias("last"), "turns")


class Shard:
    """The padded matrix of a shard's segments in lexical order, and its nodes depth by depth."""

    def __init__(self, rows: pa.Table):
        column = lambda name: rows.column(name).combine_chunks()
        lists = column("turns")
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        offs = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.flatten()
        self.size = np.diff(offs)
        n, depth = len(self.size), int(self.size.max(initial=0))
        row, place = np.repeat(np.arange(n), self.size), np.arange(len(flat)) - np.repeat(offs[:-1] - offs[0], self.size)

        def padded(name: str, pad: int) -> np.ndarray:
            out = np.full((depth, n), pad, dtype=np.int64)
            out[place, row] = flat.field(name).to_numpy(zero_copy_only=False)
            return out

        x1, x2 = padded("x1", LOWEST), padded("x2", LOWEST)
        self.conv, self.k, b1, b2 = (column(c).to_numpy() for c in ("conv_id", "k", "b1", "b2"))
        self.order = np.lexsort([self.conv, *(x for d in range(depth - 1, -1, -1) for x in (x2[d], x1[d])), b2, b1, self.k])
        self.size, self.conv, self.k = self.size[self.order], self.conv[self.order], self.k[self.order]
        self.last = column("last").to_numpy(zero_copy_only=False)[self.order]
        begins = lambda *columns: np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])[: len(columns[0])]
        b1, b2 = b1[self.order], b2[self.order]
        self.change, self.key = [begins(self.k, b1, b2)], [(b1, b2)]
        self.text = padded("size", 0)[:, self.order]
        u1, u2 = padded("u1", 0)[:, self.order], padded("u2", 0)[:, self.order]
        for d in range(depth):
            self.change.append(self.change[d] | begins(x1[d][self.order], x2[d][self.order]))
            self.key.append((self.key[d][0] ^ u1[d], self.key[d][1] ^ u2[d]))

    def nodes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth in the segment: its members' rows, where in these each node starts, and whether a node may go on in another shard."""
        for d, change in enumerate(self.change):
            rows = np.flatnonzero(self.size >= d if d else self.k == 0)
            if len(rows):
                start = np.flatnonzero(change[rows])
                end = np.append(start[1:], len(rows)) - 1
                yield d, rows, start, (rows[start] == 0) | (rows[end] == len(self.size) - 1)


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


NODES = "depth long, k1 long, k2 long, p1 long, p2 long, n_convs long, n_ends long, conv_id long, parent long, size long, edge boolean, sha string, first_end long, ends string"


def _counted(depths: int):
    """The shard's nodes; one that may go on elsewhere brings its members' ids as a text in place of their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in NODES.split(", ")]
        rows = _whole(batches)
        if rows is None:
            return
        shard = Shard(rows)
        owner_above = node_above = None
        for d, at, start, edge in shard.nodes():
            head = at[start]
            conv, total = np.minimum.reduceat(shard.conv[at], start), np.diff(np.append(start, len(at)))
            node = np.zeros(len(shard.size), dtype=np.int64)
            node[at] = np.cumsum(np.isin(np.arange(len(at)), start)) - 1
            ended = (shard.size[at] == d) & shard.last[at]
            n_ends = np.add.reduceat(ended.astype(np.int64), start)
            ids, cut = shard.conv[at][ended].tolist(), np.concatenate([[0], np.cumsum(n_ends)]).tolist()
            lists = [",".join(map(str, ids[a:b])) if b > a else None for a, b in zip(cut, cut[1:])]
            sha = [None if t is None or e else hashlib.sha256(t.encode()).hexdigest() for t, e in zip(lists, edge.tolist())]
            ends = [t if e else None for t, e in zip(lists, edge.tolist())]
            first_end = [ids[a] if t is not None else None for a, t in zip(cut, ends)]
            if d and owner_above is not None:
                over = node_above[head]
                # a segment's root lies in the segment before, and a parent that may go on elsewhere may have a smaller member there
                unknown = edge_above[over] | ((shard.k[head] > 0) & (d == 1))
                parent = pa.array(np.where(unknown, 0, owner_above[over]), mask=unknown)
            else:
                parent = pa.nulls(len(head), pa.int64())
            above = shard.key[max(0, d - 1)]
            columns = [shard.k[head] * depths + d, *(x[head] for x in shard.key[d]), *(x[head] for x in above), total, n_ends, conv]
            text = shard.text[d - 1][head] if d else np.zeros(len(head), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), parent, pa.array(text), pa.array(edge), pa.array(sha, pa.string()), pa.array(first_end, pa.int64()), pa.array(ends, pa.string())], names)
            # rows without a node at this depth have none below, but for the roots of later segments
            owner_above, node_above, edge_above = conv, node, edge

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each node over its pieces, which come sorted; only the open node's state is held."""
    key, state, done = None, None, []
    for batch in batches:
        for *now, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if now != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        if len(done) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["depth", "k1", "k2", "sha"])
            done = []
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["depth", "k1", "k2", "sha"])


NODE = ["depth", "k1", "k2"]


def counted_nodes(cut: DataFrame, depths: int = DEPTHS) -> DataFrame:
    """Every node once, with its members, its ends, its smallest member and their digest; ``parent`` where the shard knows it."""
    found = written(cut.mapInArrow(tidied(_counted(depths)), NODES), "trie-shards")
    edge = found.filter("edge")
    pieces = edge.filter("ends IS NOT NULL").repartition(*NODE).sortWithinPartitions(*NODE, "first_end").select(*NODE, "ends")
    digests = pieces.mapInArrow(_digested, "depth long, k1 long, k2 long, sha string")
    merged = edge.groupBy(*NODE, "p1", "p2", "size").agg(F.sum("n_convs").alias("n_convs"), F.sum("n_ends").alias("n_ends"), F.min("conv_id").alias("conv_id"), F.min("parent").alias("parent"))
    merged = merged.join(digests, NODE, "left").withColumn("edge", F.lit(True))
    return found.filter("NOT edge").drop("first_end", "ends").unionByName(merged)


def owned(nodes: DataFrame, depths: int = DEPTHS) -> DataFrame:
    """What each conversation's own nodes add to sums over subtrees, by segment: saved tokens, and one leaf at most."""
    saved = nodes.select("conv_id", F.expr(f"greatest(0, depth - 1) div {depths}").alias("k"), "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("value"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))
    return saved.filter("value > 0 OR leaf > 0").groupBy("conv_id", "k").agg(F.expr("collect_list(CASE WHEN value > 0 THEN struct(depth, value) END)").alias("own"), F.sum("value").alias("total"), F.sum("leaf").alias("leaf"))


def _summed(depths: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _whole(batches)
        if rows is None:
            return
        shard = Shard(rows)
        n = len(shard.size)
        row_of = np.empty(n, dtype=np.int64)
        row_of[shard.order] = np.arange(n)
        value = np.zeros((len(shard.change), n), dtype=np.int64)
        lists = rows.column("own").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
        row = row_of[np.repeat(np.arange(n), counts)]
        flat = lists.flatten()
        value[flat.field("depth").to_numpy(zero_copy_only=False) - shard.k[row] * depths, row] = flat.field("value").to_numpy(zero_copy_only=False)
        rest, leaves = (rows.column(c).combine_chunks().to_numpy()[shard.order] for c in ("rest", "leaves"))
        below = np.cumsum(value[::-1], axis=0)[::-1] + rest
        for d, at, start, edge in shard.nodes():
            head = at[start]
            sums = [np.add.reduceat(x[at], start) for x in (below[d], leaves)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard.k[head] * depths + d, *(x[head] for x in shard.key[d]), *sums, edge)], ["depth", "k1", "k2", "saved_tokens", "n_leaves", "edge"])

    return run


def subtree_sums(cut: DataFrame, nodes: DataFrame, n_shards: int, depths: int = DEPTHS) -> DataFrame:
    """``saved_tokens`` and ``n_leaves`` of every node: what its members own at its depth and below."""
    down = Window.partitionBy("conv_id").orderBy(F.desc("k"))
    over = lambda c, to: F.coalesce(F.sum(c).over(down.rowsBetween(Window.unboundedPreceding, to)), F.lit(0))
    rows = cut.join(owned(nodes, depths), ["conv_id", "k"], "left").withColumns({"rest": over("total", -1), "leaves": over("leaf", 0)})
    sums = written(dealt(rows, n_shards).mapInArrow(tidied(_summed(depths)), "depth long, k1 long, k2 long, saved_tokens long, n_leaves long, edge boolean"), "trie-sums")
    merged = sums.filter("edge").groupBy(*NODE).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    return sums.filter("NOT edge").drop("edge").unionByName(merged)


def dealt(cut: DataFrame, n_shards: int) -> DataFrame:
    """Segments by range in the trie's order; conv_id last, so equal conversations spread as well."""
    return cut.repartitionByRange(n_shards, "k", "b1", "b2", F.expr("transform(turns, t -> struct(t.x1, t.x2))"), "conv_id")


def trie(conversations: DataFrame, depths: int = DEPTHS) -> DataFrame:
    """All nodes of the trie of ``conversations(conv_id, turn, role, text)`` with rebuilt heads, from segments of ``depths`` turns."""
    turns = ordered_turns(conversations)
    cut = written(segments(*rebuilt_turns(turns), depths), "segments")
    n_shards = parts(cut.sparkSession, cut.agg(F.sum(F.size("turns") + 1)).first()[0] or 0, SHARD_BYTES // 100)
    nodes = written(counted_nodes(dealt(cut, n_shards), depths), "trie-nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    known = nodes.filter("depth = 0 OR (parent IS NOT NULL AND NOT edge)")
    parents = nodes.filter(f"edge OR depth % {depths} = 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    joined = nodes.filter("depth > 0 AND (parent IS NULL OR edge)").drop("parent").join(parents, ["depth", "p1", "p2"])
    full = known.unionByName(joined).join(children, NODE, "left").join(subtree_sums(cut, nodes, n_shards, depths), NODE)
    return full.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


_STEP = "xor(x >> 1, (x & 1) * 3988292384::UBIGINT)"
ORACLE = f"""
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said
    FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (SELECT conv_id, list(said ORDER BY pos) AS turns FROM own GROUP BY conv_id),
crc AS (
    SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::UBIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, y: {_STEP})), 4294967295::UBIGINT) % 6 AS h
    FROM lists
),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h::BIGINT], []), c.turns[c.h::BIGINT + 1:]) AS path
    FROM crc c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100
),
steps AS (SELECT conv_id, len(path) AS size, path[1:d] AS prefix, d FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CASE WHEN size = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends,
        CASE WHEN d > 0 THEN (count(*) - 1) * length(prefix[d].t) ELSE 0 END AS saved
    FROM steps GROUP BY prefix, d
),
children AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (
    SELECT n.prefix, n.d, n.conv_id, n.n_convs, n.ends, n.saved, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN children c ON c.d = n.d AND c.prefix = n.prefix LEFT JOIN nodes p ON p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1]
),
above AS (
    SELECT prefix[1:a] AS prefix, a AS d, sum(saved)::BIGINT AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves
    FROM (SELECT prefix, saved, n_children, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY ALL
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM full_nodes JOIN above USING (prefix, d)
"""

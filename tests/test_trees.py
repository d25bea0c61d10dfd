"""Listings and paths against a plain depth-first walk, on graphs with shared children, cycles and depth."""

import random

import pytest

from limes.operators import hierarchy


def walk(nodes, edges):
    name, children = {i: n or "" for i, n, _ in nodes}, {}
    for p, c in set(edges):
        children.setdefault(p, []).append(c)
    below = {c for _, c in edges}
    out = {}
    for root in (i for i, _, _ in nodes if i not in below):
        seen, lines = set(), []

        def visit(i, depth):
            if i in seen:
                return
            seen.add(i)
            lines.append((i, depth))
            for c in sorted((c for c in children.get(i, []) if c in name), key=lambda c: (name[c], c)):
                visit(c, depth + 1)

        visit(root, 0)
        out[root] = lines
    return out


def listed(spark, nodes, edges):
    df = spark.createDataFrame(nodes, "id string, name string, level int")
    rows = hierarchy.tree_listing(df, spark.createDataFrame(edges, "parent string, child string")).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.root, r.sort_path)):
        out.setdefault(r.root, []).append((r.id, r.depth))
    return out


def test_a_shared_child_is_listed_once(spark):
    nodes = [(i, i.upper(), 2) for i in "abcd"]
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")]
    assert listed(spark, nodes, edges) == {"a": [("a", 0), ("b", 1), ("d", 2), ("c", 1)]}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graphs_with_cycles(spark, seed):
    rng = random.Random(seed)
    nodes = [(f"n{i}", rng.choice([None, "", "x", "y", f"z{i}"]), 2) for i in range(14)]
    edges = [(f"n{rng.randrange(14)}", f"n{rng.randrange(2, 15)}") for _ in range(24)]
    assert listed(spark, nodes, edges) == walk(nodes, edges)


def test_diamonds_do_not_multiply_and_depth_has_no_limit(spark):
    nodes = [(f"{d:02}{s}", None, d) for d in range(25) for s in "ab"]
    edges = [(f"{d:02}{s}", f"{d + 1:02}{t}") for d in range(24) for s in "ab" for t in "ab"]
    assert listed(spark, nodes, edges) == walk(nodes, edges)


def test_paths_of_any_depth_without_cycles_and_orphans(spark):
    rows = [(0, None)] + [(i, i - 1) for i in range(1, 70)] + [(100, 101), (101, 102), (102, 101), (103, 103), (200, 999), (201, 200), (300, 5)]
    got = {r.id: r.path_ids for r in hierarchy.paths(spark.createDataFrame(rows, "id long, parent_id long")).collect()}
    assert got == {i: list(range(i + 1)) for i in range(70)} | {300: [0, 1, 2, 3, 4, 5, 300]}
    assert hierarchy.paths(spark.createDataFrame([], "id long, parent_id long")).count() == 0

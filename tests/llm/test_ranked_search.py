"""Ranked search by brute force: awkward rows, one class of many members, many blocks of items, slices of long texts."""

import collections
import math
import random
import re

import pyarrow as pa
import pytest

from limes.llm import ranked_search
from limes.llm.queries import ORACLES, QUERIES
from tests.oracle import duck, spark_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n int, m long, bag string, h1 long, first long, item long, score long"
ITEMS = "item_id long, text string, n int, block long"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x.group().lower(), text or ""))


def brute(docs, items):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, collections.Counter(w), len(w)) for i, w in bags if w]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, bag, n in bags:
            m = 25 + 75 * n * n_docs // n_terms
            score = 0
            for t in terms(text):
                if t in bag:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score:
                found.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(found)[:10])]
    return collections.Counter(out)


def corpus():
    rng = random.Random(31)
    vocabulary = ["".join(rng.choice("abcDeé9日") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    prose = lambda n: rng.choice([" ", ", ", "_-"]).join(rng.choice(vocabulary) for _ in range(n))
    same = prose(40)
    docs = [(i, prose(rng.randint(1, 90))) for i in range(300)] + [(1000 + i, same) for i in range(60)]
    docs += [(5, prose(20)), (5, prose(20)), (7, same), (None, same), (None, same), (None, prose(9)), (None, None), (400, None), (401, ""), (402, " \x00\x7f~."), (403, prose(20_000))]
    items = [(i, prose(rng.randint(1, 30))) for i in range(25)] + [(100, same), (100, prose(3)), (None, prose(4)), (None, None), (101, ""), (102, "..."), (103, "nowhereatall"), (104, "x x x " + same)]
    rng.shuffle(docs)
    return docs, items


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = corpus()
    return docs, items, spark.createDataFrame([(*r, 1, 2, "b", 3, 4, 5, 6) for r in docs], DOCS).repartition(3), spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)


def test_against_brute_force_in_one_block_and_in_many(tables):
    docs, items, d, q = tables
    want = brute(docs, items)
    assert collections.Counter(map(tuple, ranked_search.search(d, q).collect())) == want
    assert collections.Counter(map(tuple, ranked_search.search(d, q, block_bytes=900).collect())) == want
    assert max(n for (i, *_), n in want.items() if i == 100) == 1 and sum(n for (i, *_), n in want.items() if i == 100) == 20


def test_members_of_the_winning_class_by_ascending_id(tables):
    _, _, d, q = tables
    rows = [r.doc_id for r in ranked_search.search(d, q.filter("item_id = 104")).orderBy("rank").collect()]
    assert rows == [7, *range(1000, 1009)]


def test_slices_keep_terms_whole():
    texts = ["", None, "ab cd " * 500, "é" * 300 + " " + "x" * 900 + " y", "short"]
    seen = collections.defaultdict(list)
    for rows, block in ranked_search.term_blocks(pa.array(texts), 64):
        starts, ends, _ = block.words()
        own = rows[block.text_of_word()].tolist()
        for r, a, b in zip(own, starts.tolist(), ends.tolist()):
            seen[r].append(block.data[a:b].tobytes().decode())
    assert {k: seen[k] for k in range(5)} == {k: terms(t) for k, t in enumerate(texts)}


def test_empty_tables(tables):
    _, _, d, q = tables
    assert ranked_search.search(d.filter("false"), q).count() == 0 and ranked_search.search(d, q.filter("false")).count() == 0
    assert ranked_search.search(d.filter("doc_id IN (401, 402)"), q).columns == ["item_id", "rank", "doc_id", "score"]


def test_statement(spark):
    sf = "/root/testdata/sf0.01"
    assert spark_rows(QUERIES["op11_ranked_search"](spark, sf)) == duck(ORACLES["op11_ranked_search"], sf)

import itertools
import random

import corpus_pipeline
from limes.llm import near_dup


def similarity(a, b, width):
    x, y = ({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_bands_miss_few_pairs_at_the_threshold():
    assert near_dup.DIGESTS.missed < 1e-6 and near_dup.WORDS.missed < 1e-6


def test_pipeline_takes_five_words_and_eighty_percent(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    base = prose(400)
    added = base[:200] + prose(86) + base[200:]  # one block
    other = prose(400)
    edited = list(other)
    for i in range(20, 400, 40):  # scattered words
        edited[i] = f"x{i}"
    texts = {1: " ".join(base), 2: " ".join(added), 3: " ".join(other), 4: " ".join(edited), 5: "three short words", 6: "Three Short words"}
    assert 0.80 < similarity(texts[1], texts[2], 5) < 0.83 and similarity(texts[1], texts[2], 3) < 0.85
    assert similarity(texts[3], texts[4], 5) < 0.8 and similarity(texts[3], texts[4], 3) > 0.85
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = lambda rows: {r.doc_id for r in rows.collect()}
    assert kept(corpus_pipeline.drop_near_copies(spark, docs, None)) == {1, 3, 4, 5}
    assert kept(near_dup.kept_documents(docs)) == {1, 2, 3, 5}


def test_word_rule_against_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = {}
    for k in range(8):
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        for j in range(5):
            at = rng.randrange(len(base))
            texts[10 * k + j] = " ".join(base[:at] + [rng.choice(words) for _ in range(rng.randint(0, 60) * min(j, 1))] + base[at:])
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(texts, 2):
        if similarity(texts[a], texts[b], 5) >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.classes(docs, near_dup.WORDS).collect()} == {i: find(i) for i in texts}

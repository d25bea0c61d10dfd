import collections

import numpy as np

from limes.llm import packing


def test_added_tokens_in_texts_are_one_id_each(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, end = "<|startoftext|>", "<|endoftext|>"
    texts = [f"one {end} two", f"one{end}two. {end}.", end.upper(), f"{end.upper()} {end}", f"{end} {end.upper()}", f"{start}{end}{start}", f"E{end}e", f"e{end}E", f"É{start}é!!", "<|endof", "text|> x", f"A.{end}", "plain words."]
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert 49407 in want[0] and 49406 in want[5] and 49407 not in want[2]
    got = collections.defaultdict(dict)
    for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect():
        got[r.doc_id][r.start] = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert r.doc_tokens == len(want[r.doc_id])
    assert {i: [x for k in sorted(p) for x in p[k]] for i, p in got.items()} == want

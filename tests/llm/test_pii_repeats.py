import numpy as np
import pyarrow as pa
import pytest

from limes.llm import pii
from limes.llm.arrow_text import blocks


def nodes_of(*texts):
    return pii.Nodes(next(blocks(pa.array(texts)))[2])


def field():
    unary = np.zeros((pii.N_FEATURES, len(pii.KINDS) + 1))
    unary[0, 0] = 1.5
    return pii.Field(unary, np.zeros((5, 5)), 5.0 * np.eye(5))


def repeats(match, form, n=30):
    return f"write to {match} " + "and then some more words " + " or ".join(f"see {form} here" for _ in range(n))


def test_every_repeat_hears_of_the_match():
    text = repeats("ann.lee@mail.example.com", "ann.lee@mailexamplecom")
    nodes = nodes_of(text, "nothing 12345 here")
    assert len(nodes.spans[0]) == 1
    found = pii.all_spans(nodes, field())[0]
    assert [k for k, _, _ in found] == [0] * 31
    assert "mailexamplecom" not in pii.redact(text, found)


def test_match_after_its_repeats_is_the_hub():
    nodes = nodes_of(" or ".join(["see ann.lee@mailexamplecom here"] * 30) + " write to ann.lee@mail.example.com")
    assert len(pii.all_spans(nodes, field())[0]) == 31


def test_a_document_is_judged_alike_whatever_stands_beside_it():
    text, chain = repeats("ann.lee@mail.example.com", "ann.lee@mailexamplecom", 5), " ".join(str(i) for i in range(200))
    f = field()
    f.chain = 3.0 * np.eye(5)
    alone, beside = nodes_of(text), nodes_of(chain, text)
    assert f.marginals(alone) == pytest.approx(f.marginals(beside)[beside.doc == 1], abs=1e-9)


def test_messages_settle_on_a_long_chain():
    nodes = nodes_of("ann.lee@mail.example.com " + " ".join(str(i % 7) for i in range(150)))
    f = field()
    f.unary[:] = 0
    f.chain = 6.0 * np.eye(5)
    p = f.marginals(nodes)  # exact on a chain: each edge keeps (e**6 - 1) / (e**6 + 4) of the label's surplus
    keep = (np.exp(6) - 1) / (np.exp(6) + 4)
    free = np.flatnonzero(nodes.label <= 0)
    assert len(free) == 150 and p[free, 1] == pytest.approx([0.2 + 0.8 * keep ** (k + 1) for k in range(len(free))], abs=0.02)


def test_swinging_messages_end():
    nodes = nodes_of(" ".join(["abc12345"] * 12))
    p = pii.Field(np.zeros((pii.N_FEATURES, 5)), -9.0 * np.eye(5), -9.0 * np.eye(5)).marginals(nodes)
    assert np.isfinite(p).all()

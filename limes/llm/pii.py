"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans.  The field then labels the nodes, which are tokens that hold a digit, ``@``, ``+`` or a bracketed "at" or
"dot", and the words around a written-out "at" or "dot", as none, email, ip, card or phone; all other tokens are fixed to "none", which
splits the chain exactly.  Nodes next to each other share a chain
potential; nodes of one document whose tokens repeat each other (same digits, or same letters but for case and punctuation) share
a skip potential, each with the next one of its kind and with the kind's first one in a base span (else its first one), however far
apart, so evidence reaches every repeat in one step.  Loopy message passing in log space runs over all documents of a batch at
once, in each until its messages settle.  Nodes in base spans are fixed to their label, so the field only adds spans: where a token looks
like personal data, or repeats some, in a form that the patterns do not match.

Weights are fitted by pseudo-likelihood on at most ``TRAIN_DOCS`` documents with nodes (the first by a hash of their id) of at most
``TRAIN_CHARS`` characters; these two parameters bound the only sample here.  Labels come from the patterns, whose own feature is hidden
from the fit, and from disguise: each pattern match of the sample is also written in forms that no pattern matches ("ann [at] mail
dot com", "10[.]0[.]0[.]1", "4111/1111/1111/1111", "001/555/555/1234"), under the label that it had.

Card and phone numbers are labelled as whole runs of digits: if any token of a run (separators between, at most 19 digits, none like an address) is surely
some number and more likely one of these than an address, the run is a span, a card with more than 15 digits, else a phone; under seven digits it is neither.  Redaction so leaves no part of a number.

All pattern searches take linear time in the text.  Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans; null ids are kept; repeated rows are judged alike; matches that fail a test are
dropped, not retried; of labels with equal chances the first is taken; a text must fit a Python worker some thirty times; an empty table gives an
empty table; without any node to fit on only base spans are given; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.arrow_text import Block, blocks, tidied
from limes.llm.common import first_by_hash, table, texts

KINDS = ["email", "ip", "card", "phone"]
TRAIN_DOCS, TRAIN_CHARS, STEPS, RATE, SURE = 2_000, 50_000, 600, 4.0, 0.9
#: a run of digits is a phone number from as many digits (a short one's) to as many, and a card from there on
LEAST_DIGITS, MOST_PHONE = 7, 15
#: messages are settled if no score changes by more; after as many rounds, and four more for each node of the longest run, the step
#: halves, so that messages that swing settle too
SETTLED, PATIENCE = 1e-4, 100
#: prior mean of the skip potential of equal labels
AGREE = 1.5
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPECIAL = np.zeros(256, dtype=bool)
_SPECIAL[list(b"0123456789@+")] = True
_BRACKET = np.zeros(256, dtype=bool)
_BRACKET[list(b"([{<")] = True
_WRITTEN = re.compile(r"[(\[{<](?:at|dot|\.)[)\]}>]", re.I)
_JOINERS = frozenset(["at", "dot", *(f"{a}{w}{b}" for w in ("at", "dot") for a, b in ("()", "[]", "{}", "<>"))])
# Words that stand before personal data, by kind.
_CUES = [frozenset(x.split()) for x in ("mail email e-mail contact write", "ip host server address", "card visa pay credit", "call phone tel telephone mobile fax")]
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part runs back from each ``@`` to the last match or a foreign character."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all pattern matches that pass their tests, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((3, m.start(), m.end()))
    return out


N_FEATURES = 38


def _digits(token: str) -> int:
    return sum("0" <= c <= "9" for c in token)


def _shape(token: str) -> tuple[list[int], str]:
    """Indices of the token's features, and the key that repeated or similar tokens share."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    on = [0]
    if "@" in token:
        on.append(1)
        if "." in token.split("@", 1)[1][1:]:
            on.append(2)
        if token.split("@", 1)[0][-1:].isalnum():
            on.append(3)
    if token[:1] in "+(":
        on.append(4 if token[0] == "+" else 5)
    on.append(6 + min(len(digits), 20) // 4)  # 6..11
    groups = [g for g in re.split("[^0-9]+", token) if g]
    if token.count(".") >= 3 and len(groups) == 4:
        on.append(12)
        if all(len(g) <= 3 for g in groups):
            on.append(13)
    if 16 <= len(digits) <= 19 and len(digits) >= len(token) - 4:
        on.append(14)
        if luhn(digits):
            on.append(15)
    letters = sum(c.isalpha() for c in token)
    on.append(16 if letters == 0 else 17 if letters < len(digits) else 18)
    if re.fullmatch(r"\(?[0-9]{2,4}\)?|[0-9]{2,4}-[0-9]{2,4}[.,;]?", token):
        on.append(19)
    if _WRITTEN.search(token):
        on.append(20)
    if token.lower() in _JOINERS:
        on.append(21)
    elif letters and re.fullmatch(r"[A-Za-z0-9._%+-]+", token):
        on.append(22)
    if re.search(r"[A-Za-z0-9](?:\.|[(\[{<]dot[)\]}>])[A-Za-z]{2,}\W*$", token):
        on.append(23)
    if len(groups) == 4 and all(len(g) == 4 for g in groups):
        on.append(24)
    if digits and not letters and "/" in token:
        on.append(25)
    if token.startswith("00") and len(digits) >= 8:
        on.append(26)
    plain = token.lower().replace("(at)", "@").replace("[at]", "@").replace("{at}", "@").replace("<at>", "@") if 20 in on else token.lower()
    key = digits if len(digits) >= 7 and letters == 0 else "".join(c for c in plain if c.isalnum() or c == "@")
    return on, key


def _words(block: Block, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words are nodes."""
    data = block.data
    special, bracket = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_SPECIAL, _BRACKET))
    node = special[ends] > special[starts]
    spoken = lambda word: np.flatnonzero((ends - starts == len(word)) & np.logical_and.reduce([data[np.minimum(starts + i, len(data) - 1)] | 32 == c for i, c in enumerate(word)]))
    own = np.searchsorted(first, np.arange(len(starts)), side="right")
    near = lambda i, k: 0 <= i + k < len(own) and own[i + k] == own[i]
    token = lambda i: data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace").lower()
    for i in np.flatnonzero(bracket[ends] > bracket[starts]).tolist():
        if _WRITTEN.search(t := token(i)):
            around = (-1, 0, 1) if t in _JOINERS else (0,)
            node[[i + k for k in around if near(i, k)]] = True
    for i in spoken(b"dot").tolist():  # name at host dot name
        joined = [k for k in range(-6, 0, 2) if all(near(i, j) for j in (k, k - 1)) and token(i + k) == "at"]
        if joined:
            node[[i + k for k in range(max(joined) - 1, 2) if near(i, k)]] = True
    return node


class Nodes:
    """All nodes of a block: code-point spans, features, base labels (-1: none known), and edges."""

    def __init__(self, block: Block):
        starts, ends, first = block.words()
        hit = np.flatnonzero(_words(block, starts, ends, first))
        points = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
        own = np.searchsorted(first, hit, side="right") - 1
        self.doc, self.n = own, len(hit)
        self.start = points[starts[hit]] - points[block.offs[own]]
        self.end = points[ends[hit]] - points[block.offs[own]]
        raw = block.data.tobytes()
        tokens = [raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in hit]
        self.docs = np.unique(own)
        self.text = {int(d): raw[block.offs[d] : block.offs[d + 1]].decode("utf-8", "replace") for d in self.docs}
        self.spans = {d: base_spans(t) for d, t in self.text.items()}
        self.x = np.zeros((self.n, N_FEATURES))
        word = lambda i: raw[starts[i] : ends[i]].decode("utf-8", "replace").lower().strip(".,:;()")
        chain_i = np.flatnonzero((np.diff(hit) == 1) & (np.diff(own) == 0)) if self.n > 1 else np.zeros(0, dtype=np.int64)
        kinds: dict[tuple[int, str], list[int]] = {}
        for i, token in enumerate(tokens):
            on, key = _shape(token)
            self.x[i, on] = 1
            if len(key) >= 5:
                kinds.setdefault((int(own[i]), key), []).append(i)
            if hit[i] > first[own[i]]:
                before = word(hit[i] - 1)
                for kind, cues in enumerate(_CUES):
                    self.x[i, 29 + kind] = before in cues
        self.joiner = self.x[:, 21] > 0
        self.x[chain_i + 1, 27] = self.joiner[chain_i]
        self.x[chain_i, 28] = self.joiner[chain_i + 1]
        self.tokens = tokens
        self.numeric = ~self.joiner & ~self.x[:, [13, 20]].any(axis=1) & np.array([(k := _digits(t)) > 0 and k >= sum(map(str.isalpha, t)) for t in tokens], dtype=bool)
        for run in numbers(self, np.ones(self.n, dtype=bool)):
            digits = "".join(c for i in run for c in tokens[i] if "0" <= c <= "9")
            if len(digits) >= LEAST_DIGITS:
                self.x[run, 34 if len(digits) <= MOST_PHONE else 35] = 1
                self.x[run, 36] = len(digits) > MOST_PHONE and luhn(digits)
                self.x[run, 37] = tokens[run[0]].lstrip("(")[:1] == "+" or digits.startswith("00")
        self.chain = np.stack([chain_i, chain_i + 1], axis=1)
        self.label = np.full(self.n, -1, dtype=np.int64)
        bounds = np.searchsorted(own, np.arange(block.n + 1))
        for d, spans in self.spans.items():
            lo, hi = bounds[d], bounds[d + 1]
            for kind, a, b in reversed(spans):
                s, e = lo + np.searchsorted(self.end[lo:hi], a, side="right"), lo + np.searchsorted(self.start[lo:hi], b, side="left")
                self.label[s:e] = kind + 1
        skip = set()
        for same in kinds.values():
            hub = next((i for i in same if self.label[i] > 0), same[0])
            skip.update(zip(same, same[1:]))
            skip.update((min(i, hub), max(i, hub)) for i in same if i != hub)
        self.skip = np.array(sorted(skip), dtype=np.int64).reshape(-1, 2)


    def told(self, regions: dict[int, list[tuple[int, int, int]]]) -> Nodes:
        """The same nodes, those in ``regions`` (kind, start, end by document) labelled for the fit."""
        bounds = np.searchsorted(self.doc, np.arange(max(regions, default=0) + 2))
        for d, spans in regions.items():
            lo, hi = bounds[d], bounds[d + 1]
            for kind, a, b in spans:
                self.label[lo:hi][(self.start[lo:hi] < b) & (self.end[lo:hi] > a)] = kind + 1
        return self


def disguised(kind: int, found: str, form: int) -> str:
    """A pattern match, written so that no pattern matches it."""
    if kind == 0:
        name, host = found.split("@", 1)
        return (f"{name}(at){host}", f"{name} [at] {host}", f"{name} at {host.replace('.', ' dot ')}", f"{name}[at]{host.replace('.', '[dot]')}", f"{name} (at) {host.replace('.', ' (dot) ')}")[form % 5]
    if kind == 1:
        return found.replace(".", ("[.]", "(.)", "[dot]")[form % 3])
    groups = re.findall("[0-9]+", found)
    if kind == 2:
        digits = "".join(groups)
        return "/._"[form % 3].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return (f"00{'/'.join(groups)}", f"+{'/'.join(groups)}", f"00{groups[0]}-{'-'.join(groups[1:])}" if len(groups) > 1 else f"00{groups[0]}")[form % 3]


#: forms of ``disguised`` by kind
FORMS = (5, 3, 3, 3)


def disguises(texts_: list[str], choose: Callable[[int, int], int] = lambda kind, k: k) -> tuple[list[str], dict[int, list[tuple[int, int, int]]]]:
    """Texts that have matches, with all of them disguised, and where these stand; ``choose(kind, k)`` is the form of the k-th match."""
    out, regions, form = [], {}, 0
    for text in texts_:
        spans = sorted((a, b, k) for k, a, b in base_spans(text))
        if not spans:
            continue
        pieces, done, size, own = [], 0, 0, []
        for a, b, kind in spans:
            if a < done:
                continue
            new = disguised(kind, text[a:b], choose(kind, form))
            form += 1
            pieces += [text[done:a], new]
            size += a - done
            own.append((kind, size, size + len(new)))
            size, done = size + len(new), b
        regions[len(out)] = own
        out.append("".join(pieces) + text[done:])
    return out, regions


class Field:
    """Weights: features by label, chain and skip potentials by pair of labels."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, nodes: Nodes, clamp: bool = True) -> np.ndarray:
        local = nodes.x @ self.unary
        if clamp:
            fixed = nodes.label > 0
            local[fixed] = -1e3
            local[fixed, nodes.label[fixed]] = 0
        edges = np.concatenate([nodes.chain, nodes.skip])
        skips = np.arange(len(edges)) >= len(nodes.chain)
        order = np.argsort(nodes.doc[edges[:, 0]], kind="stable")  # a document's edges stand together and go when they are settled
        edges, skips = edges[order], skips[order]
        first = np.ones(nodes.n, dtype=bool)
        first[nodes.chain[:, 1]] = False
        run = np.cumsum(first) - 1
        longest = np.zeros(int(nodes.doc[-1]) + 1 if nodes.n else 0, dtype=np.int64)
        np.maximum.at(longest, nodes.doc, np.bincount(run)[run])
        patience = (PATIENCE + 4 * longest)[nodes.doc[edges[:, 0]]]
        into, rounds = local.copy(), 0
        message = np.zeros((2, len(edges), local.shape[1]))  # to the second, to the first end
        while len(edges):
            fresh = []
            for source, target, back, turn in ((0, 1, 1, False), (1, 0, 0, True)):
                out = into[edges[:, source]] - message[back]
                chain, skip = (self.chain.T, self.skip.T) if turn else (self.chain, self.skip)
                score = np.empty_like(out)
                score[~skips], score[skips] = _passed(out[~skips], chain), _passed(out[skips], skip)
                fresh.append(score - score.max(axis=1, keepdims=True))
            step = 0.5 ** (1 + rounds // patience)
            change = step[:, None] * (np.stack(fresh) - message)
            message = message + change
            begin = np.flatnonzero(np.diff(nodes.doc[edges[:, 0]], prepend=-1))
            worst = np.maximum.reduceat(np.abs(change).max(axis=(0, 2)), begin)
            open_ = np.repeat(worst > SETTLED, np.diff(np.append(begin, len(edges))))
            np.add.at(into, edges[:, 1], change[0])
            np.add.at(into, edges[:, 0], change[1])
            edges, skips, patience, message = edges[open_], skips[open_], patience[open_], message[:, open_]
            rounds += 1
        into -= into.max(axis=1, keepdims=True)
        p = np.exp(into)
        return p / p.sum(axis=1, keepdims=True)


def _passed(out: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """log of the sums over the sender's labels."""
    if not len(out):
        return out
    top = out.max(axis=1, keepdims=True)
    most = potential.max()
    return np.log(np.maximum(np.exp(out - top) @ np.exp(potential - most), 1e-300)) + top + most


def fit(nodes: list[Nodes], steps: int = STEPS) -> Field | None:
    """Piecewise pseudo-likelihood: each node given its features, then also its neighbours' labels, by gradient ascent."""
    if not sum(n.n for n in nodes):
        return None
    k = len(KINDS) + 1
    x = np.concatenate([n.x for n in nodes])
    y = np.concatenate([np.maximum(n.label, 0) for n in nodes])
    shift = np.cumsum([0] + [n.n for n in nodes[:-1]])
    around = []
    for name in ("chain", "skip"):
        e = np.concatenate([getattr(n, name) + s for n, s in zip(nodes, shift)]).astype(np.int64)
        seen = np.zeros((2, len(x), k))
        np.add.at(seen[0], (e[:, 1], y[e[:, 0]]), 1)
        np.add.at(seen[1], (e[:, 0], y[e[:, 1]]), 1)
        around.append(seen)
    onehot = np.eye(k)[y]
    unary, chain, skip = np.zeros((N_FEATURES, k)), np.zeros((k, k)), AGREE * np.eye(k)

    def rest(score: np.ndarray) -> np.ndarray:
        p = np.exp(score - score.max(axis=1, keepdims=True))
        return (onehot - p / p.sum(axis=1, keepdims=True)) / len(x)

    for _ in range(steps):  # the pieces are fitted in turn, so that no neighbour explains away what a token shows itself
        unary += RATE * (x.T @ rest(x @ unary) - 1e-4 * unary)
    alone = x @ unary
    for _ in range(steps):
        left = rest(alone + around[0][0] @ chain + around[0][1] @ chain.T + around[1][0] @ skip + around[1][1] @ skip.T)
        chain += RATE / 2 * (around[0][0].T @ left + left.T @ around[0][1] - 1e-3 * chain)
        skip += RATE / 2 * (around[1][0].T @ left + left.T @ around[1][1] - 1e-3 * (skip - AGREE * np.eye(k)))
    return Field(unary, chain, (skip + skip.T) / 2)


_BETWEEN = re.compile(r"[ \t/.()_-]{1,3}")


def numbers(nodes: Nodes, part: np.ndarray) -> list[list[int]]:
    """Maximal runs of nodes in ``part`` that look like one number: no more letters than digits, no address, only separators between, at most 19 digits.

    Runs with more digits are several numbers, which looks cannot part.
    """
    out: list[list[int]] = []
    for i in np.flatnonzero(part & nodes.numeric).tolist():
        d = int(nodes.doc[i])
        if out and out[-1][-1] == i - 1 and nodes.doc[i - 1] == d and _BETWEEN.fullmatch(nodes.text[d], int(nodes.end[i - 1]), int(nodes.start[i])):
            out[-1].append(i)
        else:
            out.append([i])
    return [run for run in out if sum(_digits(nodes.tokens[i]) for i in run) <= 19]


def all_spans(nodes: Nodes, fitted: Field | None, sure: float = SURE) -> dict[int, list[tuple[int, int, int]]]:
    """Base spans and the field's, by document, kind and start; none of one kind overlap."""
    out = {d: list(s) for d, s in nodes.spans.items()}
    if fitted is None or not nodes.n:
        return out
    p = fitted.marginals(nodes)
    best = p.argmax(axis=1)
    new = np.flatnonzero((best > 0) & (p.max(axis=1) >= sure) & (nodes.label <= 0))
    following = {int(a): int(b) for a, b in nodes.chain}
    taken = set()
    wanted = set(new.tolist())
    whole = {}
    for run in numbers(nodes, nodes.label <= 0):  # a card or phone number is labelled as a whole, so that no part of it is left over
        number = p[run, 3:].sum(axis=1)
        if ((p[run, 2] < number) & (p[run, 2] + number >= sure)).any():  # of which kind, the digits tell; what looks like an address is in no run
            digits = sum(_digits(nodes.tokens[i]) for i in run)
            if digits < LEAST_DIGITS:
                wanted.difference_update(run)
                continue
            best[run] = 4 if digits <= MOST_PHONE else 3
            wanted.update(run)
            whole.update((i, run) for i in run)
    new = np.array(sorted(wanted), dtype=np.int64)
    for i in new.tolist():
        if i in taken:
            continue
        run = list(whole.get(i, [i]))
        # a number may be written in several tokens, but two whole card numbers side by side are two
        while best[i] == 1 and (j := following.get(run[-1])) in wanted and best[j] == 1 and (nodes.joiner[j] or nodes.joiner[run[-1]]):
            run.append(j)
        while i not in whole and best[i] >= 3 and (j := following.get(run[-1])) in wanted and j not in whole and best[j] == best[i] and sum(map(_digits, nodes.tokens[i : j + 1])) <= 19:
            run.append(j)
        taken.update(run)
        d, kind = int(nodes.doc[i]), int(best[i]) - 1
        text = nodes.text[d]
        a, b = int(nodes.start[run[0]]), int(nodes.end[run[-1]])
        if nodes.joiner[run].all():
            continue  # the word alone is nothing
        while a < b and not (text[a].isalnum() or text[a] == "+"):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        if a < b and not any(k == kind and s < b and a < e for k, s, e in out[d]):
            out[d].append((kind, a, b))
    return {d: sorted(s) for d, s in out.items()}


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def train(docs: DataFrame, most_docs: int = TRAIN_DOCS) -> Field | None:
    """Fit on at most ``most_docs`` documents that hold a digit or ``@``."""
    some = texts(docs).filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= TRAIN_CHARS))
    rows = first_by_hash(some, most_docs, "doc_id", "text", of=docs.count(), spare=20).select("text").toArrow()
    return fit(training_nodes(rows.column(0).combine_chunks())) if rows.num_rows else None


def training_nodes(column: pa.Array, choose: Callable[[int, int], int] = lambda kind, k: k) -> list[Nodes]:
    hidden, regions = disguises(column.to_pylist(), choose)
    nodes = [Nodes(b) for _, _, b in blocks(column)]
    for lo, hi, block in blocks(pa.array(hidden, pa.string())):
        nodes.append(Nodes(block).told({d - lo: s for d, s in regions.items() if lo <= d < hi}))
    return nodes


FOUND = "doc_id long, base array<struct<kind:string,start:long,end:long>>, spans array<struct<kind:string,start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _structs(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]


def found(docs: DataFrame, fitted: Field | None) -> DataFrame:
    """``doc_id, base, spans``: the pattern matches, and these with the field's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                nodes = Nodes(block)
                spans = all_spans(nodes, fitted)
                base = [_structs(nodes.spans.get(i, [])) for i in range(block.n)]
                more = [_structs(spans.get(i, [])) for i in range(block.n)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(base, _SPANS), pa.array(more, _SPANS)], ["doc_id", "base", "spans"])

    return texts(docs).mapInArrow(tidied(run), FOUND)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span's place holds its kind; of overlapping spans the earlier, then the longer one is named."""
    out, done = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= done:
            out += [text[done:a], f"<{KINDS[kind]}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redacted(docs: DataFrame, fitted: Field | None) -> DataFrame:
    """``docs`` with all found spans replaced in ``text``, and ``n_chars`` (if there is one) counted again where text changed."""
    names = [c.lower() for c in docs.columns]
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(at)):
                piece = batch.slice(lo, hi - lo)
                nodes = Nodes(block)
                changed = {d: redact(nodes.text[d], s) for d, s in all_spans(nodes, fitted).items() if s}
                if changed:
                    text = piece.column(at).to_pylist()
                    for d, t in changed.items():
                        text[d] = t
                    piece = piece.set_column(at, piece.schema.field(at), pa.array(text, piece.schema.field(at).type))
                    if chars is not None:
                        count = piece.column(chars).to_pylist()
                        for d, t in changed.items():
                            count[d] = len(t)
                        piece = piece.set_column(chars, piece.schema.field(chars), pa.array(count, piece.schema.field(chars).type))
                yield piece

    return docs.mapInArrow(tidied(run), docs.schema)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = found(docs, train(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))

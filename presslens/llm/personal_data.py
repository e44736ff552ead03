"""Personal data: fixed patterns, and a skip-chain conditional random field over tokens.

Tokens with a digit or an at sign, and copies of tokens inside a pattern's span, are the nodes
of a document; all others are taken as outside. Neighbours in the text share transition
potentials, and all occurrences of a token with the same letters and digits share a skip
potential with one hub node of the document, so n copies cost n edges and any two of them
are two steps apart, however far away. Nodes inside a span of a fixed pattern are held at its
kind. Loopy sum-product message passing runs over all documents of a slice at once, each
until its messages move less than `TOLERANCE`. A document whose messages still swing after
`STEADY` rounds takes steps smaller by `SHRINK` a round and keeps the messages that these lead
to, so it ends within some 750 rounds of time in proportion to its edges. Nodes outside the spans whose
best label has a belief of `belief` or more are added as `crf_` spans, neighbours of one label joined.

Factors are learnt piecewise from the fixed patterns in at most `max_rows` documents, chosen by
a hash: node weights by multinomial regression, transitions and skip weights by counts.
Positions are code points, ends exclusive. A null text is empty and has no span. Rows
repeat as they come, null ids are carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslens.llm import textkit

MAX_ROWS = 2000
BELIEF = 0.9
TOLERANCE = 1e-4  # of a message, in logarithms
STEADY = 200  # rounds with half steps
SHRINK = 0.98  # of a step per round after these
BASE = ("email", "ip", "card", "phone")
LABELS = ("", *BASE)  # the first is "outside"
KINDS = (*BASE, *(f"crf_{k}" for k in BASE))

# The patterns of the base kinds.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its start only; from inside it the outcome is the same.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TOKEN = re.compile(r"\S+")
_ANY = re.compile(r"[0-9@]")
_CORE = re.compile(r"[\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one at sign, so matches are found from these in time of their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and non-overlapping within a kind."""
    found = [("email", *s) for s in _emails(text)]
    if not _ANY.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


def _shape(token: str, before: str, after: str) -> list[int]:
    """Numbers of the features that hold for a token."""
    digits = sum(c.isdigit() for c in token)
    dots = token.strip(".,;:").count(".")
    core = token.strip(".,;:\"'()[]")
    tests = (
        True,
        "@" in token,
        "@" in token and "." in token.split("@", 1)[1],
        token.startswith("+"),
        before.startswith("+") and before[1:2].isdigit(),
        token.startswith("("),
        "-" in core,
        core.isdigit(),
        any(c.isalpha() for c in token),
        bool(before) and sum(c.isdigit() for c in before) * 2 > len(before),
        bool(after) and sum(c.isdigit() for c in after) * 2 > len(after),
        core.replace(".", "").isdigit() and dots == 3,
        dots == 0,
    )
    bucket = next(i for i, most in enumerate((0, 2, 4, 8, 12, 16, 1 << 30)) if digits <= most)
    return [i for i, holds in enumerate(tests) if holds] + [len(tests) + bucket]


N_FEATURES = 13 + 7


class _Nodes:
    """Nodes and edges of many documents."""

    def __init__(self):
        self.doc, self.spans, self.held, self.shape = [], [], [], []
        self.chain, self.skip = [], []  # skip: an occurrence and the next one, to count by
        self.hub_doc, self.hub = [], []  # document of each hub; (node, hub) of each occurrence

    def add(self, number: int, text: str, base: list[tuple[str, int, int]]) -> None:
        if not base and not _ANY.search(text):
            return
        tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
        label_of: dict[int, int] = {}
        starts = np.array([t[0] for t in tokens])
        ends = np.array([t[1] for t in tokens])
        for kind, s, e in sorted(base, key=lambda b: BASE.index(b[0]), reverse=True):
            inside = range(np.searchsorted(ends, s, "right"), np.searchsorted(starts, e, "left"))
            label_of.update(dict.fromkeys(inside, LABELS.index(kind)))
        core = lambda t: _CORE.sub("", t).lower()
        held_cores = {core(tokens[i][2]) for i in label_of} - {""}
        seen: dict[str, list[int]] = {}
        previous = None
        for i, (s, e, token) in enumerate(tokens):
            marked = i in label_of
            if not marked and not _ANY.search(token) and not (held_cores and core(token) in held_cores):
                continue
            node = len(self.doc)
            self.doc.append(number)
            self.spans.append((s, e))
            self.held.append(label_of.get(i, -1))
            before = tokens[i - 1][2] if i else ""
            after = tokens[i + 1][2] if i + 1 < len(tokens) else ""
            self.shape.append(_shape(token, before, after))
            if previous == i - 1:
                self.chain.append((node - 1, node))
            previous = i
            name = core(token)
            if name:
                seen.setdefault(name, []).append(node)
        for copies in seen.values():
            if len(copies) > 1:
                self.skip += zip(copies, copies[1:])
                self.hub += [(node, len(self.hub_doc)) for node in copies]
                self.hub_doc.append(number)

    def matrix(self) -> np.ndarray:
        x = np.zeros((len(self.doc), N_FEATURES))
        for row, shape in zip(x, self.shape):
            row[shape] = 1.0
        return x


def fit_factors(nodes: _Nodes, steps: int = 300) -> dict:
    """Node weights, transition and skip potentials, each fitted on its own."""
    k = len(LABELS)
    if not nodes.doc:
        return {"node": np.zeros((N_FEATURES, k)), "chain": np.zeros((k, k)), "skip": np.zeros((k, k))}
    x, y = nodes.matrix(), np.maximum(0, nodes.held)
    # Equal shapes with equal labels are one row with a weight.
    rows, weight = np.unique(np.column_stack((x, y)), axis=0, return_counts=True)
    x, y = rows[:, :-1], rows[:, -1].astype(int)
    share = weight / weight.sum()
    target = np.eye(k)[y]
    node, momentum = np.zeros((N_FEATURES, k)), 0.0
    for _ in range(steps):
        z = x @ node
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        momentum = 0.9 * momentum + x.T @ ((target - p) * share[:, None]) - 1e-4 * node
        node = node + momentum

    def pair(edges: list[tuple[int, int]]) -> np.ndarray:
        """Logarithm of how much more often two labels meet than by chance, kept in +-3."""
        labels = np.maximum(0, np.array(nodes.held))
        counts = np.full((k, k), 0.5)
        if edges:
            a, b = np.array(edges).T
            np.add.at(counts, (labels[a], labels[b]), 1)
        chance = counts.sum(1, keepdims=True) * counts.sum(0, keepdims=True) / counts.sum()
        return np.clip(np.log(counts / chance), -3, 3)

    skip = pair(nodes.skip)
    return {"node": node, "chain": pair(nodes.chain), "skip": (skip + skip.T) / 2}


def beliefs(factors: dict, nodes: _Nodes) -> np.ndarray:
    """Marginals of every node by damped loopy message passing, in logarithms."""
    k, n = len(LABELS), len(nodes.doc)
    own = nodes.matrix() @ factors["node"]
    for i, label in enumerate(nodes.held):
        if label >= 0:
            own[i] = -30.0
            own[i, label] = 0.0
    own = np.concatenate((own, np.zeros((len(nodes.hub_doc), k))))
    edges = [(a, b, factors["chain"]) for a, b in nodes.chain] + [(a, n + h, factors["skip"]) for a, h in nodes.hub]

    def norm(m: np.ndarray) -> np.ndarray:
        m = m - m.max(axis=1, keepdims=True)
        return m - np.log(np.exp(m).sum(axis=1, keepdims=True))

    def received(target: np.ndarray, messages: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(target, m, size) for m in messages.T], axis=1)

    if edges:
        a, b = (np.array([e[i] for e in edges]) for i in (0, 1))
        potential = np.stack([e[2] for e in edges])
        doc = np.array(nodes.doc)[a]
        messages = np.zeros((2, len(a), k))  # from a to b, from b to a
        live, rounds, used = np.arange(len(a)), 0, None
        while len(live):  # a document stops by its own messages, whatever else is in the slice
            rounds += 1
            step = 0.5 * SHRINK ** max(0, rounds - STEADY)
            if used is None:  # nodes and documents that the live edges touch, numbered anew
                used, ends = np.unique(np.concatenate((a[live], b[live])), return_inverse=True)
                a_, b_ = ends[: len(live)], ends[len(live) :]
                _, doc_ = np.unique(doc[live], return_inverse=True)
                ab = potential[live]
            old = messages[:, live]
            total = own[used] + received(b_, old[0], len(used)) + received(a_, old[1], len(used))
            fresh = []
            for source, back, p in ((a_, old[1], ab), (b_, old[0], ab.transpose(0, 2, 1))):
                out = (total[source] - back)[:, :, None] + p
                top = out.max(axis=1)
                fresh.append(norm(top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))))
            change = step * (np.stack(fresh) - old)
            messages[:, live] = old + change
            moved = np.zeros(doc_.max() + 1)
            np.maximum.at(moved, doc_, np.abs(change).max(axis=(0, 2)))
            going = moved[doc_] >= TOLERANCE
            if not going.all():
                live, used = live[going], None
        own = own + received(b, messages[0], len(own)) + received(a, messages[1], len(own))
    return np.exp(norm(own[:n])) if n else own[:n]


def added_spans(factors: dict, nodes: _Nodes, belief: float) -> dict[int, list[tuple[str, int, int]]]:
    """Spans beyond the fixed patterns by document number; neighbours of one label joined."""
    out: dict[int, list[tuple[str, int, int]]] = {}
    if not nodes.doc:
        return out
    marginals = beliefs(factors, nodes)
    best = marginals.argmax(axis=1)
    joined = {b: a for a, b in nodes.chain}
    taken: dict[int, int] = {}
    for i in range(len(best)):
        if nodes.held[i] >= 0 or best[i] == 0 or marginals[i, best[i]] < belief:
            continue
        spans = out.setdefault(nodes.doc[i], [])
        kind = f"crf_{LABELS[best[i]]}"
        before = joined.get(i)
        if before in taken and best[before] == best[i]:
            spans[-1] = (kind, spans[-1][1], nodes.spans[i][1])
        else:
            spans.append((kind, *nodes.spans[i]))
        taken[i] = 1
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then by the order of kinds."""
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nodes, number = _Nodes(), 0
    for batch in batches:
        for raw in textkit.as_bytes(batch.column(0)):
            text = raw.decode("utf-8", "replace")
            nodes.add(number, text, base_spans(text))
            number += 1
    factors = fit_factors(nodes)
    yield pa.RecordBatch.from_arrays(
        [pa.array([factors[n].tobytes()], pa.binary()) for n in ("node", "chain", "skip")],
        names=["node", "chain", "skip"],
    )


def train(docs: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    """Factors from the fixed patterns in a bounded sample of documents with digits or at signs."""
    order = F.xxhash64("doc_id", "text")
    known = docs.filter(F.col("text").rlike("[0-9@]")).select("text", order.alias("_order"))
    # Only hashes meet to be ranked; at most max_rows of them are broadcast to find the texts.
    drawn = known.select("_order").distinct().orderBy("_order").limit(max_rows)
    sample = known.join(F.broadcast(drawn), "_order", "left_semi").select("text").distinct()
    row = sample.repartition(1).sortWithinPartitions("text").mapInArrow(_learn, "node binary, chain binary, skip binary").first()
    if row is None:
        return fit_factors(_Nodes())
    k = len(LABELS)
    shapes = {"node": (N_FEATURES, k), "chain": (k, k), "skip": (k, k)}
    return {n: np.frombuffer(row[n]).reshape(s) for n, s in shapes.items()}


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_added long"
)


def _scanner(factors: dict, belief: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FOUND.split(", ")]
        for batch in batches:
            for part, texts in textkit.slices(batch, "text"):
                nodes, bases = _Nodes(), []
                for number, raw in enumerate(texts):
                    text = raw.decode("utf-8", "replace")
                    bases.append(base_spans(text))
                    nodes.add(number, text, bases[-1])
                more = added_spans(factors, nodes, belief)
                rows = []
                for number, base in enumerate(bases):
                    added = more.get(number, [])
                    counts = [sum(s[0] == k for s in base) for k in BASE]
                    digest = hashlib.sha256(written(base).encode()).hexdigest()
                    rows.append((*counts, digest, written(base + added), len(added)))
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    return run


def personal_data(docs: DataFrame, belief: float = BELIEF, max_rows: int = MAX_ROWS) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return thin.mapInArrow(_scanner(train(thin, max_rows), belief), FOUND)

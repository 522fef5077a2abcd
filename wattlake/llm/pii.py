"""Personal data: base patterns and a skip-chain conditional random field.

One pass over the texts finds the base spans and the field's nodes: tokens with
a digit or ``@`` and the tokens beside them. Labels are the four kinds and
"none". Node potentials are a softmax over token shapes, chain potentials tie
neighbouring nodes, and skip potentials tie each node to the next one of the
same text, or the same long digit string, however far away. Weights are fitted
piece by piece on base-labelled nodes of a bounded sample of rows; loopy belief
propagation then runs over every row that has nodes. A token (or neighbouring
tokens) whose belief in a kind reaches ``BELIEF`` and that meets no base span
becomes a further span of that kind.

Defined results: null text counts as empty; without any base span the field
adds nothing; repeated rows each get a row; only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, sample_of, text_bytes

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Rows of the training sample, and the most nodes a training row may have.
SAMPLE_ROWS, SAMPLE_NODES = 2000, 2000
BELIEF = 0.95
ROUNDS, DAMPING = 12, 0.3

_DIGIT_OR_AT = re.compile(rb"[0-9@]")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a start inside a run of digits could only match what the run's start matches
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", re.ASCII)
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+", re.ASCII)
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]", re.ASCII)
_TOKEN = re.compile(r"\S+")
_NODE = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str):
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and _LOCAL_END.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at += 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, stop)`` of the base patterns, by kind, then start; code points."""
    out = [("email", *s) for s in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def nodes(text: str) -> list[tuple[int, int, str, int]]:
    """``(start, stop, token, place)`` of tokens with a digit or @ and of their neighbours; place counts tokens."""
    tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
    wanted = set()
    for i, t in enumerate(tokens):
        if _NODE.search(t[2]):
            wanted.update((i - 1, i, i + 1))
    return [(*tokens[i], i) for i in sorted(wanted) if 0 <= i < len(tokens)]


def shape(token: str) -> np.ndarray:
    """Binary features of a token's shape."""
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    core = token.strip(".,;:!?()[]{}<>\"'#$%&*")
    dots, dashes = core.count("."), core.count("-")
    at = token.find("@")
    return np.array([
        1, digits > 0, letters > 0, digits >= 3, digits >= 7, digits >= 13, digits > 19, digits == len(core) > 0,
        at > 0, at > 0 and "." in token[at:], at > 0 and token[at + 1:at + 2].isalnum(),
        dots == 1, dots == 3 and letters == 0, dots == 3 and digits >= 4 and letters == 0, dots > 3,
        token[:1] == "+", token[:1] == "(" and token[-1:] == ")", dashes == 1 and letters == 0 and digits > 0,
        dashes >= 2 and letters == 0, 3 <= digits <= 4 and letters == 0, len(core) == 16 and digits == 16,
        letters > digits, len(token) > 24,
    ], np.float32)


def features(tokens: list[str]) -> np.ndarray:
    """A node's own shape and those of the nodes before and after it."""
    own = np.stack([shape(t) for t in tokens])
    before = np.vstack([np.zeros((1, own.shape[1]), np.float32), own[:-1]])
    after = np.vstack([own[1:], np.zeros((1, own.shape[1]), np.float32)])
    return np.hstack([own, before, after])


def edges(tokens: list[str], places: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Chain links between neighbouring tokens, and skip links to the next node of the same text or long digit string."""
    chain = [(i, i + 1) for i in range(len(places) - 1) if places[i + 1] == places[i] + 1]
    skip, last = [], {}
    for i, t in enumerate(tokens):
        if not _NODE.search(t):
            continue
        core = t.lower().strip(".,;:!?()[]{}<>\"'#$%&*")
        digits = "".join(c for c in t if "0" <= c <= "9")
        for key in {("text", core)} | ({("digits", digits)} if len(digits) >= 7 else set()):
            if key in last:
                skip.append((last[key], i))
            last[key] = i
    skip = sorted(set(skip) - set(chain))
    return np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2)


def node_labels(spans: list[dict], starts: list[int], stops: list[int]) -> np.ndarray:
    """Label of each node: the kind of a base span it meets (the first kind listed), else none."""
    out = np.zeros(len(starts), np.int64)
    starts, stops = np.array(starts), np.array(stops)
    for s in reversed(spans):
        first, last = np.searchsorted(stops, s["start"], "right"), np.searchsorted(starts, s["stop"], "left")
        out[first:last] = LABELS.index(s["kind"])
    return out


class Field:
    """Weights of the field, fitted piecewise: node softmax, chain and skip log-odds of label pairs."""

    def __init__(self, rows: list[tuple[list[str], list[int], np.ndarray]], steps: int = 300, ridge: float = 1e-3):
        k = len(LABELS)
        self.weights = None
        chain, skip = np.ones((k, k)), np.ones((k, k))
        if not rows or not any(y.any() for _, _, y in rows):
            return
        x = np.vstack([features(t) for t, _, _ in rows])
        y = np.concatenate([lab for _, _, lab in rows])
        for tokens, places, lab in rows:
            c, s = edges(tokens, places)
            for table, pairs in ((chain, c), (skip, s)):
                np.add.at(table, (lab[pairs[:, 0]], lab[pairs[:, 1]]), 1)
        # every kind weighs as much as it would with equally many nodes, up to tenfold
        seen = np.bincount(y, minlength=k)
        weight = np.minimum(len(y) / k / np.maximum(seen, 1), 10.0)[y][:, None]
        target = np.eye(k)[y]
        w, velocity = np.zeros((x.shape[1], k)), np.zeros((x.shape[1], k))
        for _ in range(steps):
            p = _softmax(x @ w)
            grad = x.T @ ((p - target) * weight) / weight.sum() + ridge * w
            velocity = 0.9 * velocity - 0.5 * grad
            w = w + velocity
        self.weights = w
        # pointwise mutual information: what a pair says beyond its two nodes
        self.chain, self.skip = (_pmi(t) for t in (chain, skip))

    def beliefs(self, tokens: list[str], places: list[int]) -> np.ndarray:
        """Marginals of every node by loopy message passing."""
        unary = features(tokens) @ self.weights
        chain, skip = edges(tokens, places)
        pairs = np.vstack([chain, skip])
        if not len(pairs):
            return _softmax(unary)
        pair = np.concatenate([np.broadcast_to(self.chain, (len(chain), *self.chain.shape)),
                               np.broadcast_to(self.skip, (len(skip), *self.skip.shape))])
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        potential = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        msg = np.zeros((len(source), unary.shape[1]))
        for _ in range(ROUNDS):
            into = unary.copy()
            np.add.at(into, target, msg)
            out = into[source] - msg[back]
            new = _logsumexp(out[:, :, None] + potential)
            new -= new.max(axis=1, keepdims=True)
            msg = DAMPING * msg + (1 - DAMPING) * new
        into = unary.copy()
        np.add.at(into, target, msg)
        return _softmax(into)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logsumexp(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))


def _pmi(table: np.ndarray) -> np.ndarray:
    p = table / table.sum()
    return np.clip(np.log(p / p.sum(1, keepdims=True) / p.sum(0, keepdims=True)), -4, 4)


_BASE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
_NODES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("token", pa.string()), ("place", pa.int64())]))


def _find(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            spans, found = [], []
            for raw in text_bytes(b.column(1)):
                text = raw.decode() if raw and _DIGIT_OR_AT.search(raw) else ""
                spans.append([dict(zip(("kind", "start", "stop"), s)) for s in base_spans(text)])
                found.append([dict(zip(("start", "stop", "token", "place"), n)) for n in nodes(text)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(spans, _BASE), pa.array(found, _NODES)], ["doc_id", "base", "nodes"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "doc_id long, base array<struct<kind:string,start:long,stop:long>>, "
        "nodes array<struct<start:long,stop:long,token:string,place:long>>",
    )


def _columns(row_nodes) -> tuple[list[str], list[int], list[int], list[int]]:
    return tuple([n[k] for n in row_nodes] for k in ("token", "place", "start", "stop"))


def learn(found: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_nodes: int = SAMPLE_NODES) -> Field:
    """Fit the field on at most ``sample_rows`` rows, smallest hashes first, half of them with base spans."""
    usable = found.where(F.size("nodes").between(1, sample_nodes))
    parts = []
    for chosen in (F.size("base") > 0, F.size("base") == 0):
        own = usable.where(chosen)
        parts.append(sample_of(own, sample_rows // 2, own.count(), "doc_id").collect())
    rows = []
    for r in (r for part in parts for r in part):
        tokens, places, starts, stops = _columns(r.nodes)
        rows.append((tokens, places, node_labels(r.base, starts, stops)))
    return Field(rows)


def scan(docs: DataFrame, belief: float = BELIEF) -> DataFrame:
    """``(doc_id, base, added)`` of every row: base spans by kind and start, and the field's further spans."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.table(_find(docs))
    shared = docs.sparkSession.sparkContext.broadcast(learn(found))

    def further(field, base, row_nodes):
        if field.weights is None or not row_nodes:
            return []
        tokens, places, starts, stops = _columns(row_nodes)
        b = field.beliefs(tokens, places)
        best = b.argmax(axis=1)
        free = node_labels(base, starts, stops) == 0
        ok = (best > 0) & (b.max(axis=1) >= belief) & free
        out = []
        for i in np.flatnonzero(ok):
            kind = LABELS[best[i]]
            if out and out[-1]["place"] + 1 == places[i] and out[-1]["kind"] == kind:
                out[-1].update(stop=stops[i], place=places[i])
            else:
                out.append({"kind": kind, "start": starts[i], "stop": stops[i], "place": places[i]})
        return [{k: s[k] for k in ("kind", "start", "stop")} for s in out]

    def run(batches):
        for b in batches:
            field = shared.value
            added = [further(field, base, n) for base, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(added, _BASE)], ["doc_id", "base", "added"])

    spans = "array<struct<kind:string,start:long,stop:long>>"
    return found.mapInArrow(run, f"doc_id long, base {spans}, added {spans}")

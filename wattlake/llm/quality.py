"""Quality classifier by weak labels.

Overlapping heuristic labellers, two or three for each way of being bad, vote
yes, no or not at all on every document. Expectation-maximisation over the
counts of all vote patterns estimates each labeller's accuracy (how often it
says yes to its class and to others) and so a posterior class of every
pattern. Posteriors of a bounded sample of documents
train a linear scorer over hashed word and vote features, which scores every
document; those below ``KEEP`` are rejected.

The words of the ``insults`` labellers come from labelled rows, at most
``LABELLED`` of them: words that occur in toxic documents far more often than
chance allows and in almost no other. Without labelled rows the fixed list
stands alone. The scorer trains on at most ``SAMPLE`` documents; votes, pattern
counts and scores cover all documents.

Defined results: null or blank text gets no votes, score 0 and is rejected;
repeated rows each get a row; an empty table gives no rows; columns other than
``doc_id`` and ``text`` pass untouched through ``keep_good``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import filterfalse
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import phrase_words, pieces, sample_of, Scratch, text_bytes

#: Class that each labeller accuses a text of; ``good`` is the class of texts that are none of these.
LABELLERS = {
    "symbols": "symbols", "symbol_words": "symbols",
    "shouting": "shouting", "exclaiming": "shouting",
    "repeats": "repetition", "top_word": "repetition", "lines": "repetition",
    "cells": "table", "bare_marks": "table",
    "insult": "toxic", "insults": "toxic", "insulting": "toxic",
}
CLASSES = ("good", *dict.fromkeys(LABELLERS.values()))
SAMPLE = 8000
LABELLED = 20_000
KEEP = 0.4
BITS = 18
#: Fewest words for the labellers of word statistics.
ENOUGH = 12

# fixed values: words that label a text toxic wherever they occur
INSULTS = frozenset(b"stupid disgusting clown trash moron worthless scum pathetic idiot loser imbecile dumbass scumbag".split())

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_SYMBOLS = b"#$%&*<>{}[]~^=\\@_"
_ENDS = tuple(bytes([c]) for c in _SYMBOLS)
_NO, _YES, _NONE = 0, 1, 2


def _vote(value: float, low: float, high: float) -> int:
    return _YES if value > high else _NO if value <= low else _NONE


def votes(raw: bytes, insults: frozenset[bytes]) -> tuple[list[int], set[bytes]]:
    """Vote of every labeller (yes, no or none), and the distinct words."""
    words = raw.split()
    n, size = len(words), len(raw)
    distinct = set(phrase_words(raw))
    out = dict.fromkeys(LABELLERS, _NONE)
    if not n:
        return list(out.values()), distinct
    out["symbols"] = _vote((size - len(raw.translate(None, _SYMBOLS))) / n, 0.1, 0.5)
    out["symbol_words"] = _vote(sum(w.endswith(_ENDS) for w in words) / n, 0.05, 0.3)
    upper, lower = size - len(raw.translate(None, _UPPER)), size - len(raw.translate(None, _LOWER))
    if upper + lower >= 10:
        out["shouting"] = _vote(upper / (upper + lower), 0.25, 0.5)
    out["exclaiming"] = _vote(raw.count(b"!") / n, 0.2, 0.8)
    out["cells"] = _vote(raw.count(b"|") / n, 0.02, 0.15)
    out["bare_marks"] = _vote(sum(map(_is_mark, words)) / n, 0.02, 0.15)
    if n >= ENOUGH:
        out["repeats"] = _vote(sum(map(eq, words, words[1:])) / n, 0.05, 0.2)
        out["top_word"] = _vote(max(Counter(filterfalse(_is_mark, words)).values(), default=0) / n, 0.15, 0.3)
        lines = [x for x in raw.split(b"\n") if x]
        if len(lines) >= 4:
            out["lines"] = _vote(1 - len(set(lines)) / len(lines), 0.1, 0.5)
    hits = len(distinct & insults)
    out["insult"] = _YES if hits else _NO
    out["insults"] = _YES if hits > 1 else _NONE if hits else _NO
    out["insulting"] = _vote(hits / max(len(distinct), 1), 0, 0.01)
    return list(out.values()), distinct


def _is_mark(word: bytes) -> bool:
    return len(word) == 1 and not word.isalnum() and word < b"\x80"


def features(vote: list[int], distinct: set[bytes]) -> np.ndarray:
    """Hashed features: the distinct words, then one of each labeller's vote."""
    mask = (1 << BITS) - 1
    crc = zlib.crc32
    idx = [crc(w) & mask for w in distinct]
    idx += [crc(b"\0%d=%d" % (i, v)) & mask for i, v in enumerate(vote)]
    return np.array(idx, np.int32)


def _values(size: int) -> np.ndarray:
    """A vote weighs one; the words of a text share a weight of length one."""
    words = size - len(LABELLERS)
    out = np.ones(size, np.float32)
    out[:words] = 1 / math.sqrt(max(words, 1))
    return out


class Model:
    """What decides: the labellers' accuracies and class shares, and the scorer's weights."""

    def __init__(self, insults: frozenset[bytes]):
        self.insults = insults
        self.prior = np.full(len(CLASSES), 1 / len(CLASSES))
        self.accused = np.array([CLASSES.index(c) for c in LABELLERS.values()])
        # P(yes | the accused class) and P(yes | any other) of each labeller
        self.right = np.full(len(LABELLERS), 0.9)
        self.wrong = np.full(len(LABELLERS), 0.01)
        self.weights = np.zeros(1 << BITS, np.float32)
        self.bias = 0.0

    def fit_labellers(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> None:
        """EM over vote patterns (rows of votes) and how many documents have each; no vote says nothing."""
        yes, no = (patterns == v for v in (_YES, _NO))
        for _ in range(rounds if len(counts) else 0):
            post = self.posterior(patterns) * counts[:, None]
            self.prior = (post.sum(axis=0) + 1) / (counts.sum() + len(CLASSES))
            is_class = post[:, self.accused]  # pattern, labeller
            other = counts[:, None] - is_class
            # as if each rate had first been seen in ten texts
            self.right = ((is_class * yes).sum(0) + 9) / ((is_class * (yes | no)).sum(0) + 10)
            self.wrong = ((other * yes).sum(0) + 0.1) / ((other * (yes | no)).sum(0) + 10)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Class probabilities of each vote pattern."""
        k = len(CLASSES)
        rate = np.where(self.accused[:, None] == np.arange(k), self.right[:, None], self.wrong[:, None])  # labeller, class
        rate = np.clip(rate, 1e-6, 1 - 1e-6)
        logp = (patterns == _YES) @ np.log(rate) + (patterns == _NO) @ np.log(1 - rate) + np.log(self.prior)
        p = np.exp(logp - logp.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def fit_scorer(self, rows: list[np.ndarray], good: np.ndarray, rounds: int = 120, ridge: float = 1e-4) -> None:
        """Logistic regression of the posterior on hashed features, by full-gradient steps with per-weight rates."""
        if not rows:
            return
        index = np.concatenate(rows)
        start = np.concatenate([[0], np.cumsum([len(r) for r in rows])])[:-1]
        row_of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        value = np.concatenate([_values(len(r)) for r in rows])
        w, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
        bias, bias_seen = 0.0, 1e-8
        # both sides weigh the same
        share = np.clip(good.mean(), 0.01, 0.99)
        weight = good / (2 * share) + (1 - good) / (2 * (1 - share))
        for _ in range(rounds):
            z = np.add.reduceat(w[index] * value, start) + bias
            err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good) / len(rows)
            grad = np.bincount(index, err[row_of] * value, 1 << BITS) + ridge * w
            seen += grad * grad
            w -= 0.1 * grad / np.sqrt(seen)
            bias_seen += err.sum() ** 2
            bias -= 0.1 * err.sum() / math.sqrt(bias_seen)
        self.weights, self.bias = w.astype(np.float32), bias

    def score(self, raw: bytes | None) -> tuple[list[int], float]:
        """Votes, and the scorer's probability that a text is good (0 without words)."""
        vote, distinct = votes(raw or b"", self.insults)
        if not raw or not raw.strip():
            return vote, 0.0
        index = features(vote, distinct)
        z = float(self.weights[index] @ _values(len(index))) + self.bias
        return vote, 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _toxic_words(docs: DataFrame, labels: DataFrame | None, labelled: int) -> frozenset[bytes]:
    """The fixed insults and the words that mark toxic documents in a bounded sample of labelled rows."""
    if labels is None:
        return INSULTS
    rows = labels.where("doc_id is not null and toxic is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")
    )
    sample = sample_of(rows, labelled, rows.count(), "doc_id")

    def run(batches):
        for b in batches:
            found = [(w, t) for t, raw in zip(b.column(0).to_pylist(), text_bytes(b.column(1))) for w in set(phrase_words(raw))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.binary()), pa.array([t for _, t in found], pa.int32())], ["word", "toxic"]
            )

    # the sample has at most ``labelled`` rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(sample), "doc_id").select("toxic", "text")
    by_word = texts.mapInArrow(run, "word binary, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    size = sample.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    if not size.n or not size.t or size.t == size.n:
        return INSULTS
    # a word of k documents is toxic in all of them by chance with probability (t/n)^k; allow 1 in 100 over 1e6 words
    least = math.log(1e8) / math.log(size.n / size.t)
    marked = by_word.where((F.col("toxic") >= least) & (F.col("clean") <= 0.02 * F.col("toxic")))
    # the labelled rows bound these words: one that marks toxic texts stands in several of them
    words = marked.orderBy(F.desc("toxic"), "word").limit(labelled).collect()
    return INSULTS | {bytes(r.word) for r in words}


def learn(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE, labelled: int = LABELLED) -> Model:
    """Fit labellers on all documents' vote patterns and the scorer on a bounded sample of documents."""
    spark = docs.sparkSession
    model = Model(_toxic_words(docs, labels, labelled))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = spark.sparkContext.broadcast(model.insults)

    def vote(batches):
        for b in pieces(batches):
            codes = [bytes(votes(raw or b"", words.value)[0]) for raw in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes, pa.binary())], ["doc_id", "votes"])

    cast = Scratch(spark).table(texts.mapInArrow(vote, "doc_id long, votes binary"))
    # as many rows as vote patterns, which the labellers bound
    counted = cast.groupBy("votes").count().collect()
    patterns = np.array([list(r.votes) for r in counted], np.int64).reshape(-1, len(LABELLERS))
    model.fit_labellers(patterns, np.array([r["count"] for r in counted], np.float64))

    total = int(sum(r["count"] for r in counted))
    ids = sample_of(cast.where("doc_id is not null").select("doc_id"), sample, total, "doc_id").distinct()

    def featured(batches):
        for b in pieces(batches):
            got = [votes(raw or b"", words.value) for raw in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([bytes(v) for v, _ in got], pa.binary()),
                 pa.array([features(v, d) for v, d in got], pa.list_(pa.int32()))],
                ["doc_id", "votes", "features"],
            )

    # at most ``sample`` numbers
    chosen = texts.join(F.broadcast(ids), "doc_id").mapInArrow(featured, "doc_id long, votes binary, features array<int>")
    rows = chosen.orderBy("doc_id").limit(2 * sample).toArrow()
    if rows.num_rows:
        coded = np.array([list(v) for v in rows["votes"].to_pylist()], np.int64)
        good = model.posterior(coded)[:, 0]
        model.fit_scorer([np.asarray(f.values) for f in rows["features"]], good)
    return model


def classify(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """``(doc_id, posterior, score, kept, votes)`` of every row; ``votes`` lists the labellers that voted yes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in pieces(batches):
            got = [m.score(raw) for raw in text_bytes(b.column(1))]
            post = m.posterior(np.array([v for v, _ in got], np.int64).reshape(-1, len(LABELLERS)))[:, 0]
            said = [",".join(name for name, v in zip(LABELLERS, vote) if v == _YES) for vote, _ in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(post), pa.array([s for _, s in got], pa.float64()),
                 pa.array([s >= keep for _, s in got], pa.bool_()), pa.array(said, pa.string())],
                ["doc_id", "posterior", "score", "kept", "votes"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, posterior double, score double, kept boolean, votes string")


def keep_good(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for b in pieces(batches):
            yield b.filter(pa.array([m.score(raw)[1] >= keep for raw in text_bytes(b.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

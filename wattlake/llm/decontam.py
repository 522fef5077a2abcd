"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every substring of the normalised test items. Training
words stream through it; the state and the longest matching length after each
word tell whether the last ``window`` words occur in some item. Items shorter
than a window count when they occur whole. Items are taken in shards of at most
about ``SHARD_WORDS`` words, so an automaton has a bounded size however long
the benchmark is; documents stream through one shard after another.

A document's tokens are scanned in time proportional to their number: every state
knows the state of its last ``window`` words and the nearest one that ends a whole
short item.

Defined results: null text or an empty benchmark gives zero words or no hits;
items without words never hit; equal items all count; item ids of any type are
told as strings; an item with a null id hits and is told as null; repeated rows
each get a row; only ``doc_id``/``item_id`` and ``text`` are read.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wattlake.llm.common import phrase_words, text_bytes

WINDOW = 10
SHARD_WORDS = 200_000
# the words of phrase_words, on text
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


class SuffixAutomaton:
    """Minimal automaton of all substrings of several word sequences."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = []
        for item, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            coded.append((item, ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self._mark(coded)

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _up_to(self, state: int, depth: int) -> int:
        """The state of the last ``depth`` words of a string at ``state``, for fewer words than ``window``."""
        state = self.whole[state]
        while self.length[self.link[state]] >= depth:
            state = self.link[state]
        return state

    def _mark(self, coded) -> None:
        """Items of each window state, and whole short items by the state that holds them."""
        w = self.window
        self.items: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        # shorter strings first: a state's link is always done before it
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        #: The state of the last ``window`` words (of all words, if a state's strings have fewer).
        self.whole = [0] * len(self.length)
        for s in order:
            self.whole[s] = self.whole[self.link[s]] if self.length[self.link[s]] >= w else s
        for item, ids in coded:
            state = 0
            for j, c in enumerate(ids):
                state = self.next[state][c]
                if j + 1 >= w:
                    self.items.setdefault(self.whole[state], set()).add(item)
            if 0 < len(ids) < w:
                at = self._up_to(state, len(ids))
                self.short.setdefault(at, {}).setdefault(len(ids), set()).add(item)
        #: The nearest state, the state itself or one behind its links, that ends a whole short item.
        self.ends = [0] * len(self.length)
        for s in order:
            self.ends[s] = s if s in self.short else self.ends[self.link[s]]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set]:
        """Hit spans ``(start, stop, longest match)``, merged where they meet, and the items that hit."""
        nxt, link, length, w = self.next, self.link, self.length, self.window
        short, whole, ends = self.short, self.whole, self.ends
        spans: list[tuple[int, int, int]] = []
        found: set = set()
        state = matched = 0
        for i, c in enumerate(map(self.vocab.get, words)):
            if c is None:
                state = matched = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c not in nxt[state]:
                continue
            state = nxt[state][c]
            matched += 1
            reach = 0
            if matched >= w:
                reach = w
                found |= self.items[whole[state]]
            u = ends[state]
            while u:  # short items are shorter than a window, and so is this chain
                for size, who in short[u].items():
                    if size <= matched:
                        reach = max(reach, size)
                        found |= who
                u = ends[link[u]]
            if reach:
                start, longest = i + 1 - reach, matched
                while spans and spans[-1][1] >= start:
                    before = spans.pop()
                    start, longest = min(start, before[0]), max(longest, before[2])
                spans.append((start, i + 1, longest))
        return spans, found


def _merge(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[list[int]] = []
    for s, e, m in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
            out[-1][2] = max(out[-1][2], m)
        else:
            out.append([s, e, m])
    return [tuple(x) for x in out]


def _shards(benchmark: DataFrame, window: int, shard_words: int):
    """Automata over bounded shards of the items, one after another."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null")
    # a word takes two characters with its separator, so this overestimates the words
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // (2 * shard_words) + 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield SuffixAutomaton([(r.item_id, phrase_words(r.text.encode())) for r in rows], window)


_SPANS = "array<struct<start:long,stop:long,longest:long>>"


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``docs`` columns with ``n_words``, ``spans`` (hit word ranges with their longest match) and ``items``.

    Columns of ``docs`` with these names are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    out = docs.select(
        *kept,
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = out.schema
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("longest", pa.int64())]))
    at = kept.index("text")
    for automaton in _shards(benchmark, window, shard_words):
        shared = spark.sparkContext.broadcast(automaton)

        def run(batches, shared=shared):
            scan = shared.value.scan
            for b in batches:
                n = b.num_columns
                old_spans, old_items = b.column(n - 2).to_pylist(), b.column(n - 1).to_pylist()
                counts, spans, items = [], [], []
                for text, was, who in zip(text_bytes(b.column(at)), old_spans, old_items):
                    words = phrase_words(text)
                    got, found = scan(words)
                    counts.append(len(words))
                    if was and got:
                        got = _merge([(s["start"], s["stop"], s["longest"]) for s in was] + got)
                    spans.append([dict(zip(("start", "stop", "longest"), s)) for s in got] or was)
                    items.append(sorted(found | set(who), key=lambda x: (x is None, x or "")))
                cols = [b.column(i) for i in range(n - 3)]
                cols += [pa.array(counts, pa.int64()), pa.array(spans, span_type), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

        out = out.mapInArrow(run, schema)
    return out


@F.pandas_udf(StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, found in zip(texts, spans):
        if text and len(found):
            words = list(_WORD.finditer(text))
            parts, at = [], 0
            for s in found:
                parts.append(text[at:words[s["start"]].start()])
                at = words[s["stop"] - 1].end()
            text = "".join([*parts, text[at:]])
        out.append(text)
    return pd.Series(out, dtype="object")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Cut hit spans out of ``text``; drop documents with more than ``max_coverage`` of their words hit.

    A span is hit when its match reaches ``window`` words (or a whole shorter
    item). Other documents come back unchanged, with the columns of ``docs``.
    """
    others = [c for c in docs.columns if c != "text"]
    # the other columns travel as one struct, so that none can clash with the results
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col("text").cast("string").alias("text"))
    leaks = find_leaks(rows, benchmark, window, shard_words)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    kept = leaks.where((F.size("spans") == 0) | (hit <= F.col("n_words") * max_coverage))
    ranges = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    text = F.when(F.size("spans") > 0, _cut(F.col("text"), ranges)).otherwise(F.col("text"))
    return kept.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])

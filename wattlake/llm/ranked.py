"""Ranked lexical search by a dual-tree over items and documents.

A document's score for an item sums, over the item's terms, a weight of the term
(rare terms weigh more) times the term's impact in the document (frequent in a
short document is more). Weights and impacts are integers, so sums of them in
double precision are exact up to 2**53, in any order.

Documents and items are rows over the items' terms. A tree over the items of a
block halves them by shared terms; in every task a tree over a batch of documents
stands on documents sorted by their weightiest terms. A node of either holds the
maximum of each coordinate, so the product of two nodes bounds every score below
them. A node pair whose bound is below the weakest k-th score among its items is
dropped with all its pairs, which loses nothing; what is left is scored exactly.

K-th scores start from a pilot, a share of all documents by hash that grows with
the input; they are valid for the rest, where most pairs fall at the first
levels. A task returns at most ``k`` documents an item and only those at or above
the pilot's k-th score.

Items come in blocks of about ``BLOCK_WORDS`` words; a block's terms and tree are what
tasks are sent, so their size does not grow with the input. A block takes
one pass over the texts; counts of documents and terms cover all documents.

Defined results: null texts have no terms and rank nowhere; a null ``doc_id``
ranks behind others of equal score; repeated rows are documents of their own;
rows of one ``item_id`` (a null one too) are one item with the terms of all;
an item without terms or without documents above 0 has no rows; empty tables give
no rows; only ``doc_id``, ``item_id`` and ``text`` are read, so further columns
may have any name.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, phrase_words, text_bytes

TOP = 50
BLOCK_WORDS = 16_384
#: Share of the documents that give the first k-th scores.
PILOT = 1 / 16
#: Items and documents of a leaf, and children of a document node.
ITEM_LEAF, DOC_LEAF, FAN = 8, 16, 8
#: Numbers in the dense rows of one document batch.
_CELLS = 1 << 22
_EXACT = 1 << 53


def _item_terms(benchmark: DataFrame) -> DataFrame:
    """``(item_id, terms)`` of every item: its distinct terms."""

    def run(batches):
        for b in batches:
            terms = [sorted(set(phrase_words(t))) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["item_id"]
    return (
        rows.mapInArrow(run, f"item_id {kind}, terms array<binary>").select("item_id", F.explode("terms").alias("term"))
        .groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    )


def _term_counts(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """``(key, doc_id, n, terms, counts)`` of documents with terms; only the block's terms, by number."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches):
        known = shared.value
        for b in batches:
            n, terms, counts = [], [], []
            for text in text_bytes(b.column(2)):
                words = phrase_words(text)
                n.append(len(words))
                found = Counter(map(known.get, words))
                found.pop(None, None)
                at = sorted(found)
                terms.append(at)
                counts.append([found[t] for t in at])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["key", "doc_id", "n", "terms", "counts"],
            ).filter(pc.greater(pa.array(n, pa.int64()), 0))

    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "key long, doc_id long, n long, terms array<int>, counts array<long>")


class ItemTree:
    """Items as weights over term numbers, in an order that a halving by shared terms gives, with node maxima by level."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        self.weights = weights
        rows = np.zeros((len(terms), len(weights)), np.float32)
        for i, t in enumerate(terms):
            rows[i, t] = np.sqrt(weights[t])
        self.order = self._halved(rows, np.arange(len(terms)))
        self.terms = [terms[i] for i in self.order]
        # nodes of a level: (first item, end); the first level is the root, the last the leaves
        self.levels = [[(0, len(terms))]]
        while any(e - s > ITEM_LEAF for s, e in self.levels[-1]):
            nxt = []
            for s, e in self.levels[-1]:
                mid = (s + e + 1) // 2
                nxt += [(s, e)] if e - s <= ITEM_LEAF else [(s, mid), (mid, e)]
            self.levels.append(nxt)
        # a node is the set of its items' terms: the maximum of a coordinate is the term's weight
        self.sets = [[np.unique(np.concatenate(self.terms[s:e])) for s, e in level] for level in self.levels]
        self.exact = all(float(weights[t].sum()) * 1e6 < _EXACT for level in self.sets for t in level)

    @staticmethod
    def _halved(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Items in the order of repeated halving: nearer to the item least like the first, or to the one least like that."""
        done, todo = [], [at]
        while todo:
            part = todo.pop()
            if len(part) <= ITEM_LEAF:
                done.append(part)
                continue
            sub = rows[part]
            one = sub[np.argmin(sub @ sub[0])]
            two = sub[np.argmin(sub @ one)]
            ranked = part[np.argsort(sub @ (two - one), kind="stable")]
            mid = (len(part) + 1) // 2
            todo += [ranked[mid:], ranked[:mid]]
        return np.concatenate(done)

    def children(self, level: int, node: int) -> list[int]:
        s, e = self.levels[level][node]
        return [i for i, (a, b) in enumerate(self.levels[level + 1]) if s <= a and b <= e]


def _impacts(counts: np.ndarray, lengths: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Impact of a term that stands ``counts`` times in a document of ``lengths`` terms."""
    m = 100 - 50 + (50 * lengths * docs) // total
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


class _Best:
    """The ``k`` best documents of every item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)
        self.rows: list[list[np.ndarray]] = [[np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)] for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        good = (scores >= self.floor[item]) & (scores > 0)
        if not good.any():
            return
        have = self.rows[item]
        scores, ids, nulls = (np.concatenate((a, b[good])) for a, b in zip(have, (scores, ids, nulls)))
        top = np.lexsort((ids, nulls, -scores))[:self.k]
        self.rows[item] = [scores[top], ids[top], nulls[top]]
        if len(top) == self.k:
            self.floor[item] = max(self.floor[item], scores[top[-1]])


def _search_batch(tree: ItemTree, best: _Best, dense: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
    """Walk the pairs of item nodes and document nodes of one batch, documents given as dense impacts."""
    # documents with the same weightiest terms stand together
    drawn = dense * tree.weights
    first = drawn.argmax(axis=1)
    held = drawn[np.arange(len(drawn)), first]
    order = np.lexsort((-held, first))
    dense, ids, nulls = dense[order], ids[order], nulls[order]
    maxima, width = [], DOC_LEAF
    level = np.maximum.reduceat(dense, np.arange(0, len(dense), DOC_LEAF), axis=0)
    maxima.append(level)
    while len(level) > 1:
        level = np.maximum.reduceat(level, np.arange(0, len(level), FAN), axis=0)
        maxima.append(level)
    maxima.reverse()
    depth = len(maxima)
    # a frontier of document nodes for every item node; both trees go down one level at a time
    frontier = {0: np.arange(len(maxima[0]))}
    item_level = doc_level = 0
    while True:
        kept = {}
        for node, docs in frontier.items():
            s, e = tree.levels[item_level][node]
            terms = tree.sets[item_level][node]
            bound = maxima[doc_level][np.ix_(docs, terms)] @ tree.weights[terms]
            docs = docs[bound >= max(best.floor[s:e].min(), 1.0)]
            if len(docs):
                kept[node] = docs
        last_items, last_docs = item_level == len(tree.levels) - 1, doc_level == depth - 1
        if last_items and last_docs:
            break
        if not last_docs:
            size = len(maxima[doc_level + 1])
            kept = {i: (d[:, None] * FAN + np.arange(FAN)).ravel() for i, d in kept.items()}
            kept = {i: d[d < size] for i, d in kept.items()}
        if not last_items:
            kept = {c: d for i, d in kept.items() for c in tree.children(item_level, i)}
        frontier = kept
        item_level += not last_items
        doc_level += not last_docs
        if not frontier:
            return
    for node, leaves in kept.items():
        s, e = tree.levels[item_level][node]
        rows = (leaves[:, None] * width + np.arange(width)).ravel()
        rows = rows[rows < len(dense)]
        terms = tree.sets[item_level][node]
        part = dense[np.ix_(rows, terms)]
        for i in range(s, e):
            mine = np.searchsorted(terms, tree.terms[i])
            if tree.exact:
                scores = part[:, mine] @ tree.weights[tree.terms[i]]
            else:
                scores = part[:, mine].astype(np.int64) @ tree.weights[tree.terms[i]].astype(np.int64)
            best.add(i, scores, ids[rows], nulls[rows])


def _search(rows: DataFrame, shared, k: int, docs: int, total: int) -> DataFrame:
    """``(item, doc_id, score)``: at most ``k`` a task and item; ``item`` is a place in the tree's order."""

    def run(batches):
        tree, floor = shared.value
        best = _Best(len(tree.terms), k, floor)
        step = max(DOC_LEAF, _CELLS // max(len(tree.weights), 1))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                nulls = b.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                terms, counts = b.column(2), b.column(3)
                width = terms.value_lengths().to_numpy(zero_copy_only=False)
                at_row = np.repeat(np.arange(len(ids)), width)
                length = np.repeat(b.column(1).to_numpy(zero_copy_only=False), width)
                dense = np.zeros((len(ids), len(tree.weights)))
                dense[at_row, terms.flatten().to_numpy(zero_copy_only=False)] = _impacts(
                    counts.flatten().to_numpy(zero_copy_only=False), length, docs, total
                )
                _search_batch(tree, best, dense, ids, nulls)
        item = np.repeat(np.arange(len(best.rows)), [len(r[0]) for r in best.rows])
        scores, ids, nulls = (np.concatenate([r[c] for r in best.rows]) for c in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=nulls.astype(bool)), pa.array(scores.astype(np.int64))],
            ["item", "doc_id", "score"],
        )

    return rows.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item int, doc_id long, score long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(scratch: Scratch, docs: DataFrame, items: list, k: int) -> DataFrame:
    """The ``k`` best documents of every item of one block of rows (item_id, terms)."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted({bytes(t) for r in items for t in r.terms}))}
    counted = scratch.table(_term_counts(docs, number))
    n_docs, total = counted.agg(F.count("*"), F.sum("n")).first()
    kind = dict(scratch.items.dtypes)["item_id"]
    if not n_docs:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    # one number a term of the block
    df = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(number))], np.float64)
    tree = ItemTree([np.array([number[bytes(t)] for t in r.terms]) for r in items], weights)
    held = counted.where(F.size("terms") > 0)
    early = F.xxhash64(F.lit("pilot"), "key") < F.lit(int(PILOT * (1 << 64)) - (1 << 63))
    blank = np.zeros(len(items))
    pilot = scratch.table(_top(_search(held.where(early), spark.sparkContext.broadcast((tree, blank)), k, n_docs, total), k))
    floor = blank.copy()
    for r in pilot.where(F.col("rank") == k).select("item", "score").collect():  # one number an item of the block
        floor[r.item] = r.score
    rest = _search(held.where(~early), spark.sparkContext.broadcast((tree, floor)), k, n_docs, total)
    names = spark.createDataFrame([(i, items[j].item_id) for i, j in enumerate(tree.order.tolist())], f"item int, item_id {kind}")
    found = scratch.table(_top(pilot.drop("rank").unionAll(rest), k))
    scratch.drop(counted)
    scratch.drop(pilot)
    return found.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score above 0 of every item."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    items = scratch.items = scratch.table(_item_terms(benchmark))
    # half a block on average, so that blocks by hash stay near or below the bound
    blocks = 2 * (items.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_words + 1
    out = None
    for i in range(blocks):
        block = items.where(F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks)) == i).collect()
        if block:
            found = _search_block(scratch, docs, block, k)
            out = found if out is None else out.unionAll(found)
    if out is None:
        kind = dict(items.dtypes)["item_id"]
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out

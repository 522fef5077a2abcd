"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts; a small
classifier learns the parts of a vector's neighbours and then places every
vector in its most probable part and routes every query to its several most
probable parts, whose vectors are reranked exactly. How many parts a query
visits is set on held-out sample queries.

Candidates and queries meet per part in blocks of at most about ``BLOCK`` rows
each, so no group grows with a part. Equal vectors beyond the ``k + 1`` smallest
ids of their group can never be among the ``k`` nearest (ties go to smaller
ids), so they are left out before any block is formed; Spark applies that limit
before the shuffle.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do vectors, of rows or queries, of another length
than the rows' most common one (ties: the shorter); repeated rows count once, and
of several vectors under one ``vec_id`` the smallest (component by component); fewer candidates
than ``k`` give them all; an empty table gives no rows; only ``vec_id`` and
``embedding`` are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, sample_of

#: Sample that the graph, the parts and the classifier are made from.
SAMPLE = 8192
#: Parts, as far as the sample gives each of them ``PART`` vectors.
PARTS, PART = 32, 256
GRAPH = 10
HIDDEN = 128
#: Recall on held-out sample queries that fixes how many parts a query visits.
RECALL = 0.93
BLOCK = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)  # deals ids of any pattern over blocks


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Indices of each row's ``degree`` largest inner products among the other rows, in blocks."""
    out = np.empty((len(x), min(degree, len(x) - 1)), np.int64)
    for i in range(0, len(x), 1024):
        s = x[i:i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 10) -> np.ndarray:
    """Part of every row: median splits along leading directions, then swaps that keep more graph edges inside parts."""
    part = np.zeros(len(x), np.int64)
    todo, label = [(np.arange(len(x)), parts)], 0
    while todo:
        rows, k = todo.pop()
        if k == 1 or len(rows) < 2:
            part[rows] = label
            label += 1
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        direction = np.linalg.svd(centred.T @ centred)[0][:, 0]
        order = np.argsort(centred @ direction, kind="stable")
        cut = len(rows) * (k // 2) // k
        todo += [(rows[order[:cut]], k // 2), (rows[order[cut:]], k - k // 2)]
    both = np.concatenate([np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()], 1),
                           np.stack([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])], 1)])
    for _ in range(sweeps):
        ties = np.zeros((len(x), label))
        np.add.at(ties, (both[:, 0], part[both[:, 1]]), 1)
        gain = ties - ties[np.arange(len(x)), part][:, None]
        wish = gain.argmax(axis=1)
        moved = 0
        # swap the rows that gain most by going a -> b with those that gain most by b -> a
        for a in range(label):
            for b in range(a + 1, label):
                there, back = (np.flatnonzero((part == s) & (wish == t)) for s, t in ((a, b), (b, a)))
                there = there[np.argsort(-gain[there, b], kind="stable")]
                back = back[np.argsort(-gain[back, a], kind="stable")]
                n = min(len(there), len(back))
                ok = gain[there[:n], b] + gain[back[:n], a] > 2
                part[there[:n][ok]], part[back[:n][ok]] = b, a
                moved += int(ok.sum())
        if not moved:
            break
    return part


class Router:
    """A classifier of one hidden layer from a vector to the probabilities of the parts."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = HIDDEN, epochs: int = 30, seed: int = 0):
        rng = np.random.default_rng(seed)
        dim, parts = x.shape[1], target.shape[1]
        self.scale = float(np.sqrt(np.mean(x * x))) or 1.0
        shapes = [(dim, hidden), (hidden,), (hidden, parts), (parts,)]
        p = [rng.normal(0, (2 / s[0]) ** 0.5, s) if len(s) == 2 else np.zeros(s) for s in shapes]
        mean, square, t = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 256):
                rows = order[i:i + 256]
                v = x[rows] / self.scale
                h = np.maximum(v @ p[0] + p[1], 0)
                err = (_softmax(h @ p[2] + p[3]) - target[rows]) / len(rows)
                dh = (err @ p[2].T) * (h > 0)
                t += 1
                for j, g in enumerate((v.T @ dh, dh.sum(0), h.T @ err, err.sum(0))):
                    mean[j] = 0.9 * mean[j] + 0.1 * g
                    square[j] = 0.999 * square[j] + 0.001 * g * g
                    p[j] -= 0.002 * (mean[j] / (1 - 0.9**t)) / (np.sqrt(square[j] / (1 - 0.999**t)) + 1e-8)
        self.params = p

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        p = self.params
        return np.argsort(-(np.maximum(x / self.scale @ p[0] + p[1], 0) @ p[2] + p[3]), axis=1, kind="stable")


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, parts: int, k: int, recall: float = RECALL) -> tuple[Router, int]:
    """The router of a sample, and the parts to visit for ``recall`` of the ``k`` nearest on held-out sample queries."""
    if parts < 2 or len(x) < 4 * parts:
        return Router(x, np.ones((len(x), 1)), epochs=0), 1
    held = np.arange(len(x)) % 10 == 0
    graph = neighbour_graph(x[~held], GRAPH)
    part = balanced_parts(x[~held], graph, parts)
    near = np.zeros((len(graph), parts))
    np.add.at(near, (np.repeat(np.arange(len(graph)), graph.shape[1]), part[graph].ravel()), 1)
    near[np.arange(len(near)), part] += 1
    router = Router(x[~held], near / near.sum(axis=1, keepdims=True))
    # held-out rows act as queries against all rows of the sample, placed as the index places them
    home = router.ranked(x)[:, 0]
    found = neighbour_graph(x, k)[held]
    place = np.empty((int(held.sum()), parts), np.int64)
    np.put_along_axis(place, router.ranked(x[held]), np.arange(parts)[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, home[found], axis=1).ravel())
    return router, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def _usable(rows: DataFrame) -> DataFrame:
    """``(vec_id, vec)`` of the rows with an id and a finite vector that is not zero."""
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists("vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(~bad)
        .where(F.exists("vec", lambda c: c != 0))
    )


def common_length(rows: DataFrame) -> int:
    """The most common length of the rows' vectors; 0 without any."""
    size = _usable(rows).groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return size.size if size else 0


def vectors(rows: DataFrame, size: int) -> DataFrame:
    """``(vec_id, vec)`` of the rows that take part, those of length ``size``; of several vectors of one id the smallest."""
    return _usable(rows).where(F.size("vec") == size).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def search(rows: DataFrame, queries: DataFrame, k: int = 20, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every query ``(vec_id, embedding)`` among ``rows``."""
    spark = rows.sparkSession
    scratch = Scratch(spark)
    size = common_length(rows)
    every = scratch.table(vectors(rows, size))
    n = every.count()
    chosen = sample_of(every, sample, n, "vec_id").select("vec").toArrow()["vec"]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    # equal vectors would make parts of their own
    points = np.unique(_matrix(chosen), axis=0)
    parts = max(1, min(PARTS, len(points) // PART))
    router, visits = fit(points[np.random.default_rng(0).permutation(len(points))], parts, k, recall)
    shared = spark.sparkContext.broadcast((router, visits))
    out_schema = "part int, block int, vec_id long, vec array<double>"

    def placed(batches, per_row, other):
        router, visits = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            where = router.ranked(_matrix(b.column(1)))[:, :visits if per_row == "visits" else 1]
            index = pa.array(np.repeat(np.arange(len(where)), where.shape[1]))
            ids = b.column(0).take(index)
            block = (ids.to_numpy(zero_copy_only=False).view(np.uint64) * _MIX >> np.uint64(33)) % np.uint64(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(where.ravel().astype(np.int32)), pa.array(block.astype(np.int32)), ids, b.column(1).take(index)],
                ["part", "block", "vec_id", "vec"],
            )

    same = Window.partitionBy("vec").orderBy("vec_id")
    candidates = every.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).select("vec_id", "vec")
    asked = vectors(queries, size)
    # blocks: as many as the fullest part may need if it holds twice its share; queries likewise
    blocks = int(max(1, -(-2 * n // (parts * BLOCK))))
    query_blocks = int(max(1, -(-2 * asked.count() * visits // (parts * BLOCK))))
    left = candidates.mapInArrow(lambda it: placed(it, "home", blocks), out_schema)
    right = asked.mapInArrow(lambda it: placed(it, "visits", query_blocks), out_schema)
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("other"))
    right = right.select(
        "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "vec", F.col("block").alias("other")
    )

    def rerank(c: pa.Table, q: pa.Table) -> pa.Table:
        ids, asked_ids = (t["vec_id"].to_numpy() for t in (c, q))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and len(asked_ids):
            x = _matrix(c["vec"])
            for query_id, v in zip(asked_ids, _matrix(q["vec"])):
                rough = x @ v
                rough[ids == query_id] = -np.inf
                m = min(k, len(ids))
                least = np.partition(rough, len(ids) - m)[len(ids) - m]
                top = np.flatnonzero((rough >= least - 1e-9 * max(1.0, abs(least))) & (rough > -np.inf))
                # the products of one pair are summed alike wherever it stands, so equal vectors tie
                score = (x[top] * v).sum(axis=1)
                best = np.lexsort((ids[top], -score))[:k]
                found.append((np.full(len(best), query_id), ids[top][best], score[best]))
        cols = [np.concatenate(f) if found else np.empty(0) for f in (zip(*found) if found else ([], [], []))]
        return pa.table({
            "query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64()),
        })

    keys = ["part", "block", "other"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

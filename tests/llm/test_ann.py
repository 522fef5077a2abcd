"""Nearest neighbours against brute force."""

import numpy as np
import pytest

import __spark_entry__ as E
from wattlake.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        s = (x * x[ids == q][0]).sum(axis=1)
        s[ids == q] = -np.inf
        best = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
        out[q] = [(int(ids[i]), s[i]) for i in best]
    return out


def recall(got, want):
    hit = sum(len({v for v, _ in want[q]} & {r.vec_id for r in rows}) for q, rows in got.items())
    return hit / sum(map(len, want.values()))


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append(r)
    return {q: sorted(rows, key=lambda r: r.rank) for q, rows in out.items()}


def test_parts_are_balanced_and_keep_edges():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(8, 16))[rng.integers(0, 8, 800)] + 0.1 * rng.normal(size=(800, 16))
    graph = ann.neighbour_graph(x, 10)
    part = ann.balanced_parts(x, graph, 8)
    assert np.bincount(part).tolist() == [100] * 8
    inside = (part[graph] == part[:, None]).mean()
    assert inside > 0.6 > 3 * (rng.permutation(part)[graph] == part[:, None]).mean()


@pytest.mark.parametrize("clustered", [True, False])
def test_recall_and_order(spark, clustered):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 24))
    if clustered:
        x = rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)] + 0.3 * x
    x = x.astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(6)
    router, visits = ann.fit(x[:4000].astype(np.float64), 15, 20)
    if clustered:
        assert visits <= 8  # a query does not see everything where the data has parts
    got = by_query(ann.search(rows, rows.where("vec_id % 20 = 0"), k=20).collect())
    ids = np.arange(4000)
    want = brute(ids, x.astype(np.float64), ids[::20], 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    for q, found in got.items():
        assert [r.rank for r in found] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        for r in found[:3]:
            assert abs(r.score - float(x[q].astype(np.float64) @ x[r.vec_id].astype(np.float64))) < 1e-9


def test_edges(spark):
    one = [0.6, 0.8]
    rows = [
        (0, one), (1, one), (2, one), (20, one), (3, [0.8, 0.6]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [None, 1.0]),
        (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (1, one), (None, one), (40, None),
    ]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 AS part", "2 AS vec", "3 AS rank")
    got = by_query(ann.search(frame, frame.where("vec_id % 20 = 0"), k=3).collect())
    assert {q: [r.vec_id for r in found] for q, found in got.items()} == {0: [1, 2, 20], 20: [0, 1, 2]}
    got = by_query(ann.search(frame, frame.where("vec_id % 20 = 0"), k=20).collect())
    assert {q: [r.vec_id for r in found] for q, found in got.items()} == {0: [1, 2, 20, 3], 20: [0, 1, 2, 3]}
    assert ann.search(frame.limit(0), frame.limit(0)).count() == 0


def test_queries_of_another_length_and_ids_of_two_vectors(spark):
    rows = spark.createDataFrame([(i, [float(i + 1), 1.0], 0) for i in range(6)] + [(2, [9.0, 9.0], 0)], SCHEMA)
    asked = spark.createDataFrame([(0, [1.0, 2.0, 3.0], 0), (20, [1.0, 0.0, 0.0], 0), (40, [1.0, 0.0], 0), (40, [2.0, 0.0], 0)], SCHEMA)
    got = by_query(ann.search(rows, asked, k=3).collect())
    assert {q: [r.vec_id for r in found] for q, found in got.items()} == {40: [5, 4, 3]}
    assert [r.score for r in got[40]] == [6.0, 5.0, 4.0]


def test_equal_vectors_tie_to_smaller_ids(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[100:400] = x[100]
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(5)
    got = by_query(ann.search(rows, rows.where("vec_id % 20 = 0"), k=20).collect())
    assert [r.vec_id for r in got[200]] == list(range(100, 120))
    assert [r.vec_id for r in got[100]] == list(range(101, 121))


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    got = by_query(E.queries()["op2_nearest_neighbours"](spark, sf).collect())
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids = t.vec_id.to_numpy()
    want = brute(ids, np.array(t.embedding.tolist(), np.float64), ids[ids % 20 == 0], 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9

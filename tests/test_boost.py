"""Histogram boosting against a brute-force tree, and on data with an interaction."""

import datetime as dt

import numpy as np
import pytest

from wattlake.ml import boost

T0 = dt.datetime(2024, 1, 1)
FEATURES, TARGETS = ["a", "b", "c"], ["target_h1", "target_h2"]


def _rows(spark, n=400):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.uniform(-3, 3, n)]).astype(np.float32)
    region = np.array(["NSW1", "SA1"])[np.arange(n) % 2]
    y = np.column_stack([np.where(x[:, 0] > 0, 3, -1) * x[:, 1], np.abs(x[:, 2]) + (region == "SA1")]).astype(np.float32)
    rows = [(T0 + dt.timedelta(hours=i), str(region[i]), *map(float, x[i]), *map(float, y[i])) for i in range(n)]
    rows += [(T0, "QLD1", 1.0, 1.0, 1.0, None, 1.0), (T0, None, 1.0, 1.0, 1.0, 1.0, 1.0)]
    schema = "time timestamp_ntz, region_id string, a double, b double, c double, target_h1 double, target_h2 double"
    return spark.createDataFrame(rows, schema).repartition(5), x, region, y


def slow_tree(bins, g, s, depth=0):
    """The best tree by trying every split: nested (feature, bin, left, right), or a leaf vector."""
    n = len(g)
    soft = lambda v: np.sign(v) * np.maximum(np.abs(v) - s.reg_alpha, 0)
    score = lambda v: (soft(v.sum(axis=0)) ** 2).sum() / (len(v) + s.reg_lambda)
    best = None
    if depth < s.depth:
        for f in range(bins.shape[1]):
            for b in range(s.bins - 1):
                left = bins[:, f] <= b
                if left.sum() < s.min_child or n - left.sum() < s.min_child:
                    continue
                gain = score(g[left]) + score(g[~left]) - score(g)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, f, b, left
    if best is None:
        return -s.rate * soft(g.sum(axis=0)) / (n + s.reg_lambda)
    _, f, b, left = best
    return f, b, slow_tree(bins[left], g[left], s, depth + 1), slow_tree(bins[~left], g[~left], s, depth + 1)


def walk(node, row):
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


@pytest.mark.parametrize("block", [60, boost.BLOCK])
def test_trees_equal_brute_force(spark, monkeypatch, block):
    """Level by level over several blocks, and alone in one."""
    monkeypatch.setattr(boost, "BLOCK", block)
    df, x, region, y = _rows(spark)
    s = boost.Settings(trees=2, depth=3, rate=0.3, subsample=1.0, colsample=1.0, bins=8)
    model = boost.train(df, FEATURES, TARGETS, s)
    assert sorted(model.trees) == ["NSW1", "SA1"]
    for r in model.trees:
        mine = region == r
        bins = boost.to_bins(x[mine], model.edges[r])
        assert len(np.unique(bins[:, 0])) == 8
        p = np.repeat(y[mine].astype(np.float64).mean(axis=0)[None], mine.sum(), axis=0)
        for tree in model.trees[r]:
            want = slow_tree(bins, p - y[mine], s)
            step = np.array([walk(want, row) for row in bins])
            assert np.allclose(tree.leaves[tree.places(bins)], step, atol=1e-4)
            p = p + step
    scored = boost.predict(df, model, FEATURES, TARGETS).where("target_h1 is not null").collect()
    for r in scored:
        if r.region_id in model.trees:
            want = model.predict(r.region_id, np.array([[r.a, r.b, r.c]], np.float32))[0]
            assert np.allclose([r.predicted_target_h1, r.predicted_target_h2], want)
        else:
            assert r.predicted_target_h1 is None


def test_boosting_learns_an_interaction_and_repeats(spark, monkeypatch):
    df, x, region, y = _rows(spark)
    monkeypatch.setattr(boost, "KEEP", 5)
    s = boost.Settings(trees=12, depth=3, rate=0.4)
    model = boost.train(df, FEATURES, TARGETS, s)
    for r in model.trees:
        mine = region == r
        left = np.abs(model.predict(r, x[mine]) - y[mine]).mean(axis=0)
        flat = np.abs(y[mine].mean(axis=0) - y[mine]).mean(axis=0)
        assert (left < 0.4 * flat).all()


def test_empty_and_rowless(spark):
    df, *_ = _rows(spark, 20)
    model = boost.train(df.limit(0), FEATURES, TARGETS, boost.Settings(trees=1))
    assert model.trees == {}
    assert boost.predict(df, model, FEATURES, TARGETS).where("predicted_target_h1 is not null").count() == 0
    assert (boost.to_bins(np.array([[np.nan, 5.0]], np.float32), [np.array([1.0, 2.0], np.float32)] * 2) == 2).all()

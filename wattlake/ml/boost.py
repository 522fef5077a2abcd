"""Histogram boosting with vector leaves: one model per region for all horizons (M1).

Features become quantile bins of one byte. Rows stand in blocks of one region and
at most about ``BLOCK`` rows, written once. A tree is grown level by level: one job adds,
over the blocks of all regions, every node's gradients by feature and bin for all
targets, and finds each node's best split where the sums meet. The driver holds one
split a node and region. A leaf is a vector, one value a target, so a region's 24
horizons share one tree.

A region whose rows are one block has nothing to add up: its task goes through the
same levels by itself, ``KEEP`` trees a job.

Splits maximise ``sum_t soft(GL_t)^2 / (NL + reg_lambda) + soft(GR_t)^2 / (NR + reg_lambda)``
less the same of the parent, where ``soft`` shrinks by ``reg_alpha``; a leaf is
``-rate * soft(G_t) / (N + reg_lambda)``. Rows and features of a tree are drawn by
a generator of (seed, tree, block or region), so a rerun of a lost task
draws the same.

Predictions are kept with the blocks: every ``KEEP`` trees they are brought up to
date in a new table, and in between tasks apply the trees since then.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.session import shared_path

#: Rows of a block, trees between two tables of predictions, features that one group sums.
BLOCK, KEEP, CHUNK = 65_536, 20, 64
#: Relative accuracy of the quantiles.
ACCURACY = 1000


@dataclass(frozen=True)
class Settings:
    """Published settings of the forecaster, and the number of bins."""

    trees: int = 200
    depth: int = 5
    rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.8
    min_child: float = 5.0
    reg_alpha: float = 0.1
    reg_lambda: float = 1.0
    seed: int = 911
    bins: int = 32


@dataclass
class Tree:
    """A full binary tree of ``depth`` levels: node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    feature: np.ndarray
    bin: np.ndarray
    leaves: np.ndarray

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``bins``."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range((len(self.feature) + 1).bit_length() - 1):
            at = 2 * at + 1 + (bins[rows, self.feature[at]] > self.bin[at])
        return at - len(self.feature)


@dataclass
class Model:
    """Edges of the bins, mean of the targets and trees, by region."""

    edges: dict[str, list[np.ndarray]]
    base: dict[str, np.ndarray]
    trees: dict[str, list[Tree]] = field(default_factory=dict)

    def predict(self, region: str, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, self.edges[region])
        out = np.repeat(self.base[region][None, :], len(x), axis=0)
        for tree in self.trees[region]:
            out += tree.leaves[tree.places(bins)]
        return out


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of single precision features: the number of edges below the value (nan is above all)."""
    return np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)]).astype(np.uint8)


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return g - np.clip(g, -alpha, alpha)


def features_of_tree(region: str, tree: int, n: int, s: Settings) -> np.ndarray:
    rng = np.random.default_rng([s.seed, tree, zlib.crc32(region.encode())])
    return np.sort(rng.choice(n, max(1, int(n * s.colsample)), replace=False))


def rows_of_tree(uid: int, tree: int, n: int, s: Settings) -> np.ndarray:
    return np.random.default_rng([s.seed, tree, uid, 1]).random(n) < s.subsample


def _edges(data: DataFrame, n_features: int, bins: int) -> dict[str, list[np.ndarray]]:
    """Quantiles of every region and feature; what reaches the driver is bounded by regions, features and bins."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    long = data.select("region_id", F.posexplode("x").alias("f", "v")).where("v is not null and not isnan(v)")
    found = long.groupBy("region_id", "f").agg(F.percentile_approx("v", at, F.lit(ACCURACY)).alias("q")).collect()
    out: dict[str, list[np.ndarray]] = {}
    for r in found:
        out.setdefault(r.region_id, [np.empty(0, np.float32)] * n_features)[r.f] = np.unique(np.array(r.q, np.float32))
    return out


def _blocks(edges: dict[str, list[np.ndarray]], n_features: int, n_targets: int, base: dict[str, np.ndarray]):
    """Rows (region_id, x, y) to blocks (region_id, n, bins, y, p): ``p`` is the prediction so far."""
    names = _BLOCK_ARROW.names

    def block(region, rows):
        x, y = (np.concatenate(v) for v in zip(*rows))
        p = np.repeat(base[region][None, :], len(x), axis=0).astype(np.float32)
        return region, len(x), x.tobytes(), y.tobytes(), p.tobytes()

    def run(batches):
        held: dict[str, list] = {}
        for b in batches:
            regions = np.array(b.column(0).to_pylist(), dtype=object)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features).astype(np.float32)
            y = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_targets).astype(np.float32)
            for region in set(regions.tolist()):
                mine = regions == region
                held.setdefault(region, []).append((to_bins(x[mine], edges[region]), y[mine]))
                if sum(len(v[0]) for v in held[region]) >= BLOCK:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, block(region, held.pop(region))))], schema=_BLOCK_ARROW)
        for region, rows in held.items():
            yield pa.RecordBatch.from_pylist([dict(zip(names, block(region, rows)))], schema=_BLOCK_ARROW)

    return run


_BLOCK_ARROW = pa.schema([("region_id", pa.string()), ("n", pa.int32()), *((c, pa.binary()) for c in ("bins", "y", "p"))])
_BLOCK_SCHEMA = "region_id string, n int, bins binary, y binary, p binary"


class _Rows:
    """A block as arrays."""

    def __init__(self, r: dict, n_features: int, n_targets: int):
        self.uid, self.region, n = r["uid"], r["region_id"], r["n"]
        self.bins = np.frombuffer(r["bins"], np.uint8).reshape(n, n_features)
        self.y = np.frombuffer(r["y"], np.float32).reshape(n, n_targets)
        self.p = np.frombuffer(r["p"], np.float32).reshape(n, n_targets)

    def add(self, trees: list[Tree]) -> np.ndarray:
        out = self.p
        for tree in trees:
            out = out + tree.leaves[tree.places(self.bins)].astype(np.float32)
        return out


def _node(rows: _Rows, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """Each row's node within ``level`` of a growing tree."""
    node, at = np.zeros(len(rows.bins), np.int64), np.arange(len(rows.bins))
    for _ in range(level):
        node = 2 * node + 1 + (rows.bins[at, feature[node]] > cut[node])
    return node - (1 << level) + 1


def _histogram(rows: _Rows, g: np.ndarray, node: np.ndarray, used: np.ndarray, taken: np.ndarray, level: int, width: int) -> np.ndarray:
    """Sums (targets + 1, features, nodes, bins) of the gradients ``g`` of the taken rows, and their number."""
    nodes = 1 << level
    place = (np.arange(len(used))[None, :] * nodes + node[taken, None]) * width + rows.bins[taken][:, used]
    place, size = place.ravel(), len(used) * nodes * width
    hist = np.empty((g.shape[1] + 1, size))
    for t in range(g.shape[1]):
        hist[t] = np.bincount(place, np.repeat(g[taken, t], len(used)), size)
    hist[-1] = np.bincount(place, minlength=size)
    return hist.reshape(-1, len(used), nodes, width)


def _histograms(shape, at: int, level: int, pending, growing, s: Settings):
    """Blocks to one row a region and chunk of features: sums by (node, feature, bin) of gradients and rows."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for r in b.to_pylist():
                rows = _Rows(r, *shape)
                if rows.region in growing:
                    g = (rows.add(pending.get(rows.region, [])) - rows.y).astype(np.float64)
                    used, taken = features_of_tree(rows.region, at, shape[0], s), rows_of_tree(rows.uid, at, len(rows.y), s)
                    hist = _histogram(rows, g, _node(rows, *growing[rows.region], level), used, taken, level, s.bins)
                    sums[rows.region] = sums[rows.region] + hist if rows.region in sums else hist
        out = [
            {"region_id": region, "chunk": c, "sums": hist[:, c:c + CHUNK].tobytes()}
            for region, hist in sums.items() for c in range(0, hist.shape[1], CHUNK)
        ]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SUMS)

    return run


class _Growing:
    """A tree on its way: splits so far, and the sums of every node that holds rows."""

    def __init__(self, s: Settings):
        self.s, inner = s, (1 << s.depth) - 1
        self.feature, self.cut = np.zeros(inner, np.int64), np.full(inner, 255, np.int64)
        self.sums: dict[int, np.ndarray] = {}

    def live(self, level: int) -> bool:
        return level == 0 or any(n in self.sums for n in range((1 << level) - 1, (2 << level) - 1))

    def split(self, level: int, node: int, gain: float, feature: int, cut: int, left, whole) -> None:
        """Take the best split of ``node`` of ``level``; without a gain it stays whole."""
        here, whole = (1 << level) - 1 + node, np.asarray(whole)
        if level == 0:
            self.sums[0] = whole
        if gain > 0 and here in self.sums:
            self.feature[here], self.cut[here] = feature, cut
            self.sums[2 * here + 1], self.sums[2 * here + 2] = np.asarray(left), whole - np.asarray(left)

    def tree(self, n_targets: int) -> Tree:
        return Tree(self.feature, self.cut, _leaves(self.sums, n_targets, self.s))


def _alone(shape, first: int, last: int, s: Settings):
    """Blocks that are a region's only one to its trees ``first`` to ``last`` and the predictions with them."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                rows = _Rows(r, *shape)
                p, trees = rows.p, []
                for at in range(first, last):
                    growing, g = _Growing(s), (p - rows.y).astype(np.float64)
                    used, taken = features_of_tree(rows.region, at, shape[0], s), rows_of_tree(rows.uid, at, len(rows.y), s)
                    for level in range(s.depth):
                        if not growing.live(level):
                            break
                        hist = _histogram(rows, g, _node(rows, growing.feature, growing.cut, level), used, taken, level, s.bins)
                        for node, gain, f, cut, left, whole in best_splits(hist, s):
                            growing.split(level, node, gain, used[f], cut, left, whole)
                    trees.append(growing.tree(shape[1]))
                    p = p + trees[-1].leaves[trees[-1].places(rows.bins)].astype(np.float32)
                out = r | {"p": p.tobytes(), "trees": [
                    {"feature": t.feature.tolist(), "bin": t.bin.tolist(), "leaves": t.leaves.ravel().tolist()} for t in trees]}
                yield pa.RecordBatch.from_pylist([out], schema=pa.schema([("uid", pa.int64()), *_BLOCK_ARROW, ("trees", _TREES)]))

    return run


_TREES = pa.list_(pa.struct([("feature", pa.list_(pa.int64())), ("bin", pa.list_(pa.int64())), ("leaves", pa.list_(pa.float64()))]))
_TREES_SCHEMA = "array<struct<feature:array<long>,bin:array<long>,leaves:array<double>>>"


_SUMS = pa.schema([("region_id", pa.string()), ("chunk", pa.int32()), ("sums", pa.binary())])
_SPLIT = pa.schema([
    ("region_id", pa.string()), ("node", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()),
    ("left", pa.list_(pa.float64())), ("whole", pa.list_(pa.float64())),
])


def best_splits(hist: np.ndarray, s: Settings) -> list[tuple]:
    """``(node, gain, feature, bin, left sums, all sums)`` of each node; ``hist`` is (targets + 1, features, nodes, bins).

    Ties go to the first feature, then the first bin; without a split the gain is 0.
    """
    def score(sums):
        g = soft(sums[:-1], s.reg_alpha)
        return np.einsum("t...,t...->...", g, g) / (sums[-1] + s.reg_lambda)

    parts = []
    for c in range(0, hist.shape[1], 8):  # few features at a time stay in the processor's cache
        left = np.cumsum(hist[:, c:c + 8], axis=3)
        whole = left[..., -1:]
        right = whole - left
        gain = score(left) + score(right) - score(whole)
        fits = (left[-1] >= s.min_child) & (right[-1] >= s.min_child)
        parts.append(np.where(fits & (gain > 0), gain, 0.0))
    gain = np.concatenate(parts)
    out = []
    for node in range(hist.shape[2]):
        k = int(np.argmax(gain[:, node]))
        f, b = divmod(k, hist.shape[3])
        sums = np.cumsum(hist[:, f, node], axis=1)
        out.append((node, float(gain[f, node, b]), f, b, sums[:, b].tolist(), sums[:, -1].tolist()))
    return out


def _choose(shape, level: int, s: Settings):
    """The histogram rows of one region and chunk to the best split of every node within the chunk."""

    def run(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
        hist = total.reshape(shape[1] + 1, -1, 1 << level, s.bins)
        region, chunk = table.column("region_id")[0].as_py(), table.column("chunk")[0].as_py()
        names = _SPLIT.names
        rows = [dict(zip(names, (region, node, gain, chunk + f, b, left, whole))) for node, gain, f, b, left, whole in best_splits(hist, s)]
        return pa.Table.from_pylist(rows, schema=_SPLIT)

    return run


_SPLIT_SCHEMA = "region_id string, node int, gain double, feature int, bin int, left array<double>, whole array<double>"


def _updated(shape, pending):
    """Blocks with the predictions of the pending trees added."""

    def run(batches):
        for b in batches:
            p = [_Rows(r, *shape).add(pending.get(r["region_id"], [])).tobytes() for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p, pa.binary())], names=b.schema.names)

    return run


def train(rows: DataFrame, features: Sequence[str], targets: Sequence[str], settings: Settings = Settings()) -> Model:
    """Fit ``settings.trees`` trees to every region's rows; rows without a target or region are left out."""
    s, spark = settings, rows.sparkSession
    shape = len(features), len(targets)
    folder = shared_path(spark, f"boost-{zlib.crc32(repr(rows._jdf.hashCode()).encode()):08x}-{np.random.default_rng().integers(1 << 62):x}")
    data = rows.where("region_id is not null").na.drop(subset=list(targets)).select(
        "region_id", F.array(*[F.coalesce(F.col(c).cast("float"), F.lit(float("nan"))) for c in features]).alias("x"),
        F.array(*[F.col(c).cast("float") for c in targets]).alias("y"),
    )
    # three passes follow: the wide rows are packed once
    data.write.parquet(f"{folder}/rows")
    data = spark.read.schema(data.schema).parquet(f"{folder}/rows")
    means = data.groupBy("region_id").agg(F.count("*").alias("n"), *[F.avg(F.col("y")[i]) for i in range(shape[1])]).collect()
    base = {r.region_id: np.array(r[2:], np.float64) for r in means}
    if not base:
        return Model({}, {})
    edges = _edges(data, shape[0], s.bins)
    for region in base:  # a region whose features are all null has no edges
        edges.setdefault(region, [np.empty(0, np.float32)] * shape[0])
    model = Model(edges, base, {r: [] for r in base})
    salts = max(1, -(-max(r.n for r in means) // BLOCK))
    # by range, so that regions don't meet in one task
    dealt = data.repartitionByRange(len(base) * salts, "region_id", F.pmod(F.xxhash64("x"), F.lit(salts)))
    blocks = dealt.mapInArrow(_blocks(edges, *shape, base), _BLOCK_SCHEMA)
    blocks.select(F.monotonically_increasing_id().alias("uid"), "*").write.parquet(f"{folder}/blocks")
    state = spark.read.schema(_STATE).parquet(f"{folder}/blocks")
    counts = dict(state.groupBy("region_id").count().collect())
    single = [r for r, n in counts.items() if n == 1]
    several = [r for r, n in counts.items() if n > 1]
    if single:
        _train_alone(state.where(F.col("region_id").isin(single)), f"{folder}/alone", shape, model, s)
    if several:
        _train_by_levels(state.where(F.col("region_id").isin(several)), f"{folder}/levels", shape, model, several, s)
    return model


_STATE = f"uid long, {_BLOCK_SCHEMA}"


def _train_alone(state: DataFrame, folder: str, shape: tuple[int, int], model: Model, s: Settings) -> None:
    """``KEEP`` trees a job for regions of one block each."""
    for first in range(0, s.trees, KEEP):
        path = f"{folder}/t{first}"
        state.mapInArrow(_alone(shape, first, min(first + KEEP, s.trees), s), f"{_STATE}, trees {_TREES_SCHEMA}").write.parquet(path)
        state = state.sparkSession.read.schema(f"{_STATE}, trees {_TREES_SCHEMA}").parquet(path)
        for r in state.select("region_id", "trees").collect():
            model.trees[r.region_id] += [
                Tree(np.array(t.feature), np.array(t.bin), np.array(t.leaves).reshape(-1, shape[1])) for t in r.trees]
        state = state.drop("trees")


def _train_by_levels(state: DataFrame, folder: str, shape: tuple[int, int], model: Model, regions: list[str], s: Settings) -> None:
    """One job a level: sums of all blocks by region and chunk of features, and the best splits."""
    kept = 0
    for at in range(s.trees):
        pending = {r: model.trees[r][kept:] for r in regions}
        if at - kept >= KEEP:
            state.mapInArrow(_updated(shape, pending), _STATE).write.parquet(f"{folder}/t{at}")
            state, kept = state.sparkSession.read.schema(_STATE).parquet(f"{folder}/t{at}"), at
            pending = {}
        growing = {r: _Growing(s) for r in regions}
        used = {r: features_of_tree(r, at, shape[0], s) for r in regions}
        for level in range(s.depth):
            live = {r: (g.feature, g.cut) for r, g in growing.items() if g.live(level)}
            hist = state.mapInArrow(_histograms(shape, at, level, pending, live, s), "region_id string, chunk int, sums binary")
            best: dict[tuple[str, int], tuple] = {}
            for r in hist.groupBy("region_id", "chunk").applyInArrow(_choose(shape, level, s), _SPLIT_SCHEMA).collect():
                rank = (-r.gain, r.feature)
                if (r.region_id, r.node) not in best or rank < best[r.region_id, r.node][0]:
                    best[r.region_id, r.node] = rank, r
            for (region, node), (_, r) in best.items():
                growing[region].split(level, node, r.gain, used[region][r.feature], r.bin, r.left, r.whole)
        for region in regions:
            model.trees[region].append(growing[region].tree(shape[1]))


def _leaves(sums: dict[int, np.ndarray], n_targets: int, s: Settings) -> np.ndarray:
    """Leaf vectors; a node that is not split hands its sums to the left, where its rows go."""
    inner = (1 << s.depth) - 1
    sums = dict(sums)
    for node in range(inner):
        if node in sums and 2 * node + 1 not in sums:
            sums[2 * node + 1] = sums[node]
    out = np.zeros((inner + 1, n_targets))
    for i in range(inner + 1):
        if inner + i in sums:
            total = sums[inner + i]
            out[i] = -s.rate * soft(total[:-1], s.reg_alpha) / (total[-1] + s.reg_lambda)
    return out


def predict(rows: DataFrame, model: Model, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """``rows`` with one ``predicted_<target>`` per target; null for a region without a model."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"predicted_{t}" for t in targets]
    plain = rows.columns
    at = plain.index("region_id")
    data = rows.select(*plain, F.array(*[F.coalesce(F.col(c).cast("float"), F.lit(float("nan"))) for c in features]).alias("_x"))
    schema = rows.select(*plain, *[F.lit(None).cast("double").alias(c) for c in names]).schema

    def run(batches):
        model = shared.value
        for b in batches:
            regions = np.array(b.column(at).to_pylist(), dtype=object)
            x = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            out = np.full((b.num_rows, len(names)), np.nan)
            for r in set(regions.tolist()) & set(model.trees):
                out[regions == r] = model.predict(r, x[regions == r])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *[pa.array(c, pa.float64(), mask=np.isnan(c)) for c in out.T]], names=[*plain, *names]
            )

    return data.mapInArrow(run, schema)

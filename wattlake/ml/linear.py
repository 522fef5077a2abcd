"""Multi-output ridge regression per region, trained in one pass (M1, M2).

All horizons of a region share one Gram matrix of the features, so one
aggregation of per-task partial sums trains every (region, horizon) model: the
rows are read once, however many targets there are, and what is shuffled and
solved has the size of the model, not of the data. Results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Penalty on standardised features, as a share of the rows.
RIDGE = 1e-3


def _sums(n_features: int, n_targets: int):
    """Partial sums of each region over a task: counts, and products of (1, x, y) with (1, x)."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            regions = np.array(b.column(0).to_pylist(), dtype=object)
            m = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]]).astype(np.float64)
            m = np.hstack([np.ones((len(m), 1)), m])
            for r in set(regions):
                rows = m[regions == r]
                sums[r] = sums.get(r, 0) + np.vstack([rows.T @ rows[:, :n_features + 1], np.zeros((1, n_features + 1))])
                sums[r][-1, 0] += (rows[:, n_features + 1:] ** 2).sum()
        for r, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([r] * len(s)), pa.array(range(len(s)), pa.int32()), pa.array(s.tolist(), pa.list_(pa.float64()))],
                ["region_id", "line", "sums"],
            )

    return run


def train(rows: DataFrame, features: Sequence[str], targets: Sequence[str], ridge: float = RIDGE) -> dict[str, np.ndarray]:
    """Coefficients ``(1 + features) x targets`` of every region, from complete rows.

    One row per region and matrix line reaches the driver: bounded by regions
    times features squared.
    """
    n, t = len(features), len(targets)
    data = rows.select("region_id", *[F.col(c).cast("double").alias(c) for c in [*features, *targets]]).na.drop()
    parts = data.mapInArrow(_sums(n, t), "region_id string, line int, sums array<double>")
    width = range(n + 1)
    total = parts.groupBy("region_id", "line").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in width])
    table = total.orderBy("region_id", "line").toPandas()
    out = {}
    for region, part in table.groupby("region_id"):
        s = part[[f"s{i}" for i in width]].to_numpy()
        gram, cross = s[:n + 1], s[n + 1:n + 1 + t].T
        count, mean = gram[0, 0], gram[0, 1:] / gram[0, 0]
        spread = np.sqrt(np.maximum(np.diag(gram)[1:] / count - mean**2, 0))
        scale = np.where(spread > 1e-9 * np.maximum(np.abs(mean), 1), spread, np.inf)
        centred = gram[1:, 1:] / count - np.outer(mean, mean)
        goal = cross[1:] / count - np.outer(mean, cross[0] / count)
        standard = centred / scale[:, None] / scale[None, :] + ridge * np.eye(n)
        w = np.linalg.solve(standard, goal / scale[:, None]) / scale[:, None]
        out[region] = np.vstack([cross[0] / count - mean @ w, w])
    return out


def predict(rows: DataFrame, coef: dict[str, np.ndarray], features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """``rows`` with one ``predicted_<target>`` per target, all in one pass; null for a region without a model."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(coef)
    names = [f"predicted_{t}" for t in targets]
    plain = rows.columns
    data = rows.select(*plain, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
    schema = rows.select(*plain, *[F.lit(None).cast("double").alias(c) for c in names]).schema
    at = plain.index("region_id")

    def run(batches):
        for b in batches:
            regions = np.array(b.column(at).to_pylist(), dtype=object)
            x = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            x = np.hstack([np.ones((len(x), 1)), x])
            out = np.full((len(x), len(names)), np.nan)
            for r, w in shared.value.items():
                out[regions == r] = x[regions == r] @ w
            cols = [pa.array(c, pa.float64(), mask=np.isnan(c)) for c in out.T]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=[*plain, *names])

    return data.mapInArrow(run, schema)


def predicted_long(scored: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """``(region_id, time, horizon, actual, predicted)`` by unpivoting the same rows: no second scan."""
    pairs = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"target_h{h}").cast("double").alias("actual"),
                 F.col(f"predicted_target_h{h}").alias("predicted")) for h in horizons
    ])
    return scored.select("region_id", "time", F.inline(pairs))

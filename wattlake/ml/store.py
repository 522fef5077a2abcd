"""Model table and scoring in the JVM (M3, M5).

Models are rows. A version's rows are written first, then one mark a region that
says how many there must be; a version counts for a region when its mark is there
and the rows are all there, and the newest such version is the model. Writing a
version again replaces it, so a save that broke off is simply repeated.

Linear models score as a join on the region and a dot product, trees as a walk
with ``aggregate``: both are column expressions inside code generation, with no
Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.ml.boost import Model
from wattlake.schemas import HORIZON_COLS, MAX_HORIZON
from wattlake.sources.sinks import open_folder, overwrite_parts

#: Rows of linear models: one a region and horizon. Rows of trees: one a region and tree.
LINEAR = "region_id string, horizon int, intercept double, weights array<double>"
TREES = "region_id string, tree int, feature array<int>, threshold array<float>, leaves array<array<double>>"
_MARK = "region_id string, n_rows bigint, features array<string>, version bigint"


def publish(rows: DataFrame, base: str, version: int, features: Sequence[str], finish: bool = True) -> None:
    """Write the rows of ``version``; with ``finish`` mark it for its regions."""
    overwrite_parts(rows.withColumn("version", F.lit(version).cast("bigint")), f"{base}/models", "version")
    if finish:
        stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{base}/models/version={version}")
        marks = stored.groupBy("region_id").agg(F.count("*").alias("n_rows")).select(
            "region_id", "n_rows", F.array(*[F.lit(f) for f in features]).alias("features"),
            F.lit(version).cast("bigint").alias("version"),
        )
        overwrite_parts(marks, f"{base}/finished", "version")


def latest(spark: SparkSession, base: str, schema: str = LINEAR) -> DataFrame:
    """The model rows of every region's newest finished version, with ``version`` and ``features``."""
    rows = open_folder(spark, f"{base}/models", _struct(f"{schema}, version bigint"))
    marks = open_folder(spark, f"{base}/finished", _struct(_MARK))
    if rows is None or marks is None:
        return spark.createDataFrame([], _struct(f"{schema}, version bigint, features array<string>"))
    held = rows.groupBy("region_id", "version").agg(F.count("*").alias("n_rows"))
    whole = held.join(marks, ["region_id", "version", "n_rows"])
    newest = whole.groupBy("region_id").agg(
        F.max("version").alias("version"), F.max_by("features", "version").alias("features")
    )
    return rows.join(newest, ["region_id", "version"])


def _struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _dot(weights: Column, x: Column) -> Column:
    return F.aggregate(F.zip_with(weights, x, lambda w, v: w * v), F.lit(0.0), lambda total, p: total + p)


def score(rows: DataFrame, models: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(created_at, region_id, horizon_h01..)`` of rows ``(created_at, region_id, features)`` whose region has a model.

    A horizon without a row in the model is null, and so is all with a null feature.
    """
    per_region = models.groupBy("region_id").agg(
        F.map_from_entries(F.collect_list(F.struct("horizon", F.struct("intercept", "weights").alias("m")))).alias("m")
    )
    x = F.array(*[F.col(f).cast("double") for f in features])
    joined = rows.select("created_at", "region_id", x.alias("x")).join(per_region, "region_id")

    def horizon(h: int) -> Column:
        one = F.try_element_at("m", F.lit(h))
        return (one["intercept"] + _dot(one["weights"], F.col("x"))).alias(HORIZON_COLS[h - 1])

    return joined.select("created_at", "region_id", *[horizon(h) for h in range(1, MAX_HORIZON + 1)])


def cycle(
    wanted: DataFrame, history: DataFrame, forecast: DataFrame, models: DataFrame, features: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """One inference cycle for every ``wanted(created_at, region_id)``: forecasts, and ``(reason, region_id, n)`` of what got none.

    ``history`` and ``forecast`` hold the features by ``(time, region_id)``. Reasons in
    order: no history, no forecast, no model.
    """
    at = F.col("time").alias("created_at")
    seen = wanted.join(history.withColumn("_history", F.lit(True)).withColumnRenamed("time", "created_at"), ["created_at", "region_id"], "left")
    seen = seen.join(forecast.select(at, *[c for c in forecast.columns if c != "time"], F.lit(True).alias("_forecast")), ["created_at", "region_id"], "left")
    known = models.select("region_id").distinct().withColumn("_model", F.lit(True))
    seen = seen.join(known, "region_id", "left").withColumn(
        "reason",
        F.when(F.col("_history").isNull(), "no_history").when(F.col("_forecast").isNull(), "no_forecast")
        .when(F.col("_model").isNull(), "no_model"),
    )
    skipped = seen.where("reason is not null").groupBy("reason", "region_id").agg(F.count("*").alias("n"))
    return score(seen.where("reason is null"), models, features), skipped


def tree_rows(spark: SparkSession, model: Model) -> DataFrame:
    """Rows ``TREES`` of boosted trees, cuts as values; tree -1 holds the mean as its only leaf."""
    out = []
    for region, trees in model.trees.items():
        out.append((region, -1, [], [], [model.base[region].tolist()]))
        for i, t in enumerate(trees):
            edges = model.edges[region]
            # a node that is not split has no threshold: all go left
            cuts = [float(edges[f][b]) if b < len(edges[f]) else None for f, b in zip(t.feature.tolist(), t.bin.tolist())]
            out.append((region, i, t.feature.tolist(), cuts, t.leaves.tolist()))
    return spark.createDataFrame(out, _struct(TREES))


def score_trees(rows: DataFrame, models: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(created_at, region_id, predicted)`` with one value a target, by walking every tree in column expressions."""
    per_region = models.groupBy("region_id").agg(F.sort_array(F.collect_list(F.struct("tree", "feature", "threshold", "leaves"))).alias("t"))
    x = F.array(*[F.coalesce(F.col(f).cast("float"), F.lit(np.nan).cast("float")) for f in features])
    joined = rows.select("created_at", "region_id", x.alias("x")).join(per_region, "region_id")
    return joined.select("created_at", "region_id", F.expr("""
        aggregate(slice(t, 2, size(t)), t[0].leaves[0], (sum, tree) -> zip_with(sum, tree.leaves[
            aggregate(sequence(1, CAST(log2(size(tree.leaves)) AS INT)), 0,
                (n, _) -> 2 * n + 1 + IF(coalesce(x[tree.feature[n]] > tree.threshold[n], false), 1, 0)) - size(tree.feature)
        ], (a, b) -> a + b))""").alias("predicted"))

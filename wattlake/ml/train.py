"""Model training, evaluation, persistence and scoring (M1-M3, M5).

``pyspark.ml`` has no multi-output booster, so each horizon gets one
gradient-boosted tree model; the region enters as a one-hot feature, so a
model sees every region's rows and training is distributed over the data,
not looped per region on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.operators.forecast import r2_mae
from wattlake.schemas import GBT_PARAMS, HORIZON_COLS, MAX_HORIZON
from wattlake.sources import sinks

def _pipeline(features: Sequence[str], target: str, max_iter: int) -> Pipeline:
    idx = StringIndexer(inputCol="region_id", outputCol="_region_idx", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=["_region_idx"], outputCols=["_region_vec"], dropLast=False)
    vec = VectorAssembler(inputCols=[*features, "_region_vec"], outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=target, predictionCol="prediction", maxIter=max_iter, **GBT_PARAMS)
    return Pipeline(stages=[idx, ohe, vec, gbt])


def train_horizons(train: DataFrame, features: Sequence[str], horizons: Sequence[int], max_iter: int = 200) -> dict[int, PipelineModel]:
    """M1: one model per horizon; features are cast to float like the upstream matrix."""
    data = train.select("region_id", *[F.col(c).cast("float").cast("double").alias(c) for c in features],
                        *[F.col(f"target_h{h}").cast("double") for h in horizons])
    return {h: _pipeline(features, f"target_h{h}", max_iter).fit(data) for h in horizons}


def _with_predictions(models: dict[int, PipelineModel], rows: DataFrame) -> DataFrame:
    """``rows`` with ``_p<h>`` of every model, one transform after another on the same rows (no shuffle)."""
    keep = rows.columns
    for h, m in models.items():
        keep = [*keep, f"_p{h}"]
        rows = m.transform(rows).withColumnRenamed("prediction", f"_p{h}").select(*keep)
    return rows


def predict_long(models: dict[int, PipelineModel], test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long predictions ``(region_id, time, horizon, actual, predicted)``."""
    pairs = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"target_h{h}").alias("actual"), F.col(f"_p{h}").alias("predicted")) for h in models
    ])
    return _with_predictions(models, test).select("region_id", "time", F.inline(pairs))


METRICS_SCHEMA = "region_id string, horizon int, r2 double, mae double, n bigint"


def evaluate(long_pred: DataFrame) -> DataFrame:
    """M2: R^2 and MAE per (region, horizon)."""
    return r2_mae(long_pred)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def save_models(models: dict[int, PipelineModel], base: str, version: int) -> None:
    """M3: ``<base>/version=<v>/horizon=<h>``; the marker ``_COMPLETE`` is written when all are saved."""
    spark = SparkSession.active()
    for h, m in models.items():
        m.write().overwrite().save(f"{base}/version={version}/horizon={h}")
    fs, marker = _path(spark, f"{base}/version={version}/_COMPLETE")
    out = fs.create(marker, True)
    out.write(bytearray(",".join(map(str, sorted(models))).encode()))
    out.close()


def load_latest(spark: SparkSession, base: str, horizons: Sequence[int]) -> dict[int, PipelineModel]:
    """M3: the models of the newest version whose save finished (a horizon it lacks is left out)."""
    fs, root = _path(spark, base)
    if not fs.exists(root):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    versions = sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True)
    for v in versions:
        if fs.exists(_path(spark, f"{base}/version={v}/_COMPLETE")[1]):
            here = {h: f"{base}/version={v}/horizon={h}" for h in horizons}
            return {h: PipelineModel.load(p) for h, p in here.items() if fs.exists(_path(spark, p)[1])}
    return {}


def score(models: dict[int, PipelineModel], feature_rows: DataFrame, created_at_col: str = "time") -> DataFrame:
    """M5: one forecast row per (created_at, region) with ``horizon_hNN``, null for a horizon without a model."""
    rows = _with_predictions(models, feature_rows)
    null = F.lit(None).cast("double")
    cols = [(F.col(f"_p{h}") if h in models else null).alias(HORIZON_COLS[h - 1]) for h in range(1, MAX_HORIZON + 1)]
    return rows.select(F.col(created_at_col).alias("created_at"), "region_id", *cols)


def store_forecasts(forecasts: DataFrame, base: str) -> int:
    """M5 -> S9: complete rows only, first write wins."""
    from wattlake.operators.incremental import complete_forecasts

    return sinks.insert_absent_table(complete_forecasts(forecasts), base, ["created_at", "region_id"])

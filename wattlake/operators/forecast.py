"""Forecast tables and their evaluation.

Forecast rows are wide (``horizon_h01..h24``) at the edges and long
``(created_at, region_id, horizon, predicted, target_time)`` inside, so the
24 point lookups upstream become one equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.timecols import add_hours
from wattlake.operators.series import row_window
from wattlake.schemas import HORIZON_COLS, MAX_HORIZON


def seasonal_naive(hourly: DataFrame, key: str = "region_id", order: str = "time", value: str = "demand_mw") -> DataFrame:
    """Deterministic forecast: ``horizon_hNN`` = value ``24 - NN`` rows earlier."""

    def build(w: Window):
        return {
            HORIZON_COLS[h - 1]: F.lag(F.col(value), MAX_HORIZON - h).over(w) if h < MAX_HORIZON else F.col(value)
            for h in range(1, MAX_HORIZON + 1)
        }

    lagged = row_window(hourly.select(key, order, value), key, order, build, lookback=MAX_HORIZON - 1)
    return lagged.select(F.col(order).alias("created_at"), F.col(key).alias("region_id"), *HORIZON_COLS)


def forecast_long(pred: DataFrame) -> DataFrame:
    """One row per (created_at, region, horizon) with its target time."""
    pairs = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(c).alias("predicted")) for h, c in enumerate(HORIZON_COLS, 1)])
    return pred.select("created_at", "region_id", F.inline(pairs)).withColumn(
        "target_time", add_hours("created_at", F.col("horizon"))
    )


def forecast_to_wide(df: DataFrame, array_col: str = "pred") -> DataFrame:
    """``ARRAY<DOUBLE>`` of 24 values -> ``horizon_h01..h24`` columns."""
    return df.select(
        "created_at", "region_id", *[F.element_at(F.col(array_col), h).alias(c) for h, c in enumerate(HORIZON_COLS, 1)]
    )


def latest_forecast(pred: DataFrame) -> DataFrame:
    """L2 for every region at once: the newest forecast row per region."""
    s = F.max_by(F.struct("created_at", *HORIZON_COLS), F.col("created_at")).alias("_l")
    return pred.groupBy("region_id").agg(s).select("region_id", "_l.*")


def forecast_accuracy(pred: DataFrame, actual: DataFrame) -> DataFrame:
    """J5 + A11: MAPE of every forecast and horizon; null without a forecast or a positive actual value."""
    act = actual.select("region_id", F.col("time").alias("target_time"), F.col("demand_mw").alias("actual"))
    j = forecast_long(pred).join(act, ["region_id", "target_time"], "left")
    error = F.abs((F.col("actual") - F.col("predicted")) / F.nullif(F.col("actual"), F.lit(0.0)))
    mape = F.when(F.col("actual") > 0, F.round(error * 100, 2))
    return j.select("region_id", "created_at", "horizon", mape.alias("mape"), (F.lit(100.0) - mape).alias("accuracy"))


def latest_forecast_accuracy(pred: DataFrame, actual: DataFrame) -> DataFrame:
    """L2 + J5 + A11: the newest forecast of every region, 24 rows each."""
    return forecast_accuracy(latest_forecast(pred), actual)


def r2_mae(long_pred: DataFrame, keys=("region_id", "horizon"), y: str = "actual", p: str = "predicted") -> DataFrame:
    """A8 + A9: R^2 and MAE per group in one aggregate (one shuffle).

    The total sum of squares is ``var_pop(y) * n``: Spark's central-moment
    aggregate merges partial (n, mean, M2) buffers, so it is numerically
    stable without joining the group mean back. Zero variance follows the
    usual metric convention: 1.0 for a perfect fit, else 0.0.
    """
    keys = list(keys)
    agg = long_pred.groupBy(*keys).agg(
        F.sum((F.col(y) - F.col(p)) ** 2).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"),
        F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )
    r2 = (
        F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst"))
    )
    return agg.select(*keys, r2.alias("r2"), "mae", "n")


def macro_average(metrics: DataFrame) -> DataFrame:
    """A10: mean over horizons per region, then mean over regions (mean of means)."""
    per_region = metrics.groupBy("region_id").agg(F.avg("r2").alias("avg_r2"), F.avg("mae").alias("avg_mae"))
    overall = per_region.agg(F.lit("ALL").alias("region_id"), F.avg("avg_r2").alias("avg_r2"), F.avg("avg_mae").alias("avg_mae"))
    return per_region.unionByName(overall)

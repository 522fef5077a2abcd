"""Serving-time features.

Serving looks values up by *time offset* (value at ``t - k hours``, missing
-> 0) and uses time-range windows with an open left edge (``t-23h..t-1h``),
unlike training's row offsets (D5, D6). The batch form computes the serving
feature row for every hour of the history at once:

* lags and trailing statistics: ``range_window`` (partitioned by region and
  time block, 744 h overlap); an exact-offset lookup is a frame
  ``rangeBetween(-k h, -k h)``;
* forecast weather at ``t + h``: horizons exploded, then one left equi-join
  on ``(region_id, target_time)`` (D7: both sides in UTC).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from wattlake.functions.timecols import add_hours, cyclic, ml_day_of_week
from wattlake.operators.series import range_window
from wattlake.schemas import DEMAND_LAGS, MAX_HORIZON, SERVING_LOOKBACK_HOURS, TEMP_LAGS, WEATHER_COLS

H = 3600
SERVING_STATIC = [
    *[f"demand_lag_{k}h" for k in DEMAND_LAGS],
    *[f"temp_lag_{k}h" for k in TEMP_LAGS],
    "demand_rolling_mean_24h",
    "demand_rolling_std_24h",
    "demand_rolling_mean_168h",
]
SERVING_PER_HORIZON = [
    "temperature_2m",
    "relative_humidity_2m",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "is_weekend",
    "wind_power",
    "solar_potential",
    "temp_change",
    "has_precip",
]


def history_window(df: DataFrame, as_of: dt.datetime, hours: int = SERVING_LOOKBACK_HOURS) -> DataFrame:
    """Rows with ``as_of - hours <= time <= as_of`` (pushed to the scan as literals)."""
    a = F.lit(as_of).cast("timestamp_ntz")
    return df.where((F.col("time") >= add_hours(a, -hours)) & (F.col("time") <= a))


def serving_static(history: DataFrame, missing: str = "zero") -> DataFrame:
    """J7 + W5 for every hour: 10 static serving features per (region, time)."""

    def build(w: WindowSpec):
        d, t = F.col("demand_mw"), F.col("temperature_2m")
        out = {}
        for k in DEMAND_LAGS:
            out[f"demand_lag_{k}h"] = F.first(d).over(w.rangeBetween(-k * H, -k * H))
        for k in TEMP_LAGS:
            out[f"temp_lag_{k}h"] = F.first(t).over(w.rangeBetween(-k * H, -k * H))
        # open at the left edge: times after t - 24 h, also off the hour
        w24 = w.rangeBetween(-24 * H + 1, -H)
        out["demand_rolling_mean_24h"] = F.avg(d).over(w24)
        out["_n24"] = F.count(d).over(w24)
        out["demand_rolling_std_24h"] = F.stddev_samp(d).over(w24)
        out["demand_rolling_mean_168h"] = F.avg(d).over(w.rangeBetween(-168 * H + 1, -H))
        return out

    base = history.select("region_id", "time", "demand_mw", "temperature_2m")
    st = range_window(base, "region_id", "time", build, lookback_seconds=max(DEMAND_LAGS) * H)
    std = F.when(F.col("_n24") > 1, F.col("demand_rolling_std_24h"))
    st = st.withColumn("demand_rolling_std_24h", std).drop("_n24")
    if missing == "zero":
        st = st.select(
            "region_id", "time", "demand_mw", "temperature_2m",
            *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in SERVING_STATIC],
        )
    return st


def serving_per_horizon(history: DataFrame, forecast: DataFrame, horizons: int = MAX_HORIZON) -> DataFrame:
    """J6 + P7 + P8 for every hour and horizon: forecast weather at ``t + h``
    (missing -> 0) and target-time calendar; long ``(region, time, horizon, ...)``."""
    base = history.select(
        "region_id", "time", F.coalesce(F.col("temperature_2m"), F.lit(0.0)).alias("current_temp"),
        F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("horizon"),
    ).withColumn("target_time", add_hours("time", F.col("horizon")))
    fc = forecast.select("region_id", F.col("time").alias("target_time"), *WEATHER_COLS)
    j = base.join(fc, ["region_id", "target_time"], "left")
    w = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in WEATHER_COLS}
    tt = F.col("target_time")
    hour, dow, month = F.hour(tt), ml_day_of_week(tt), F.month(tt)
    hs, hc = cyclic(hour, 24)
    ds, dc = cyclic(dow, 7)
    ms, mc = cyclic(month, 12)
    return j.select(
        "region_id",
        "time",
        "horizon",
        w["temperature_2m"].alias("temperature_2m"),
        w["relative_humidity_2m"].alias("relative_humidity_2m"),
        hs.alias("hour_sin"),
        hc.alias("hour_cos"),
        ds.alias("dow_sin"),
        dc.alias("dow_cos"),
        ms.alias("month_sin"),
        mc.alias("month_cos"),
        F.when(dow.isin(5, 6), 1.0).otherwise(0.0).alias("is_weekend"),
        F.pow(w["wind_speed_10m"], 3).alias("wind_power"),
        (w["shortwave_radiation"] * (F.lit(1.0) - w["cloud_cover"] / F.lit(100.0))).alias("solar_potential"),
        (w["temperature_2m"] - F.col("current_temp")).alias("temp_change"),
        F.when(w["precipitation"] > 0, 1.0).otherwise(0.0).alias("has_precip"),
    )


def serving_features(history: DataFrame, forecast: DataFrame, horizons: int = MAX_HORIZON) -> DataFrame:
    """M4 for every hour: one wide row (10 static + horizons x 13) per (region, time)."""
    return _one_row(serving_static(history), serving_per_horizon(history, forecast, horizons), horizons)


def _one_row(st: DataFrame, ph: DataFrame, horizons: int) -> DataFrame:
    cols = [F.max(F.when(F.col("horizon") == h, F.col(c))).alias(f"{c}_h{h}") for h in range(1, horizons + 1) for c in SERVING_PER_HORIZON]
    wide = ph.groupBy("region_id", "time").agg(*cols)
    return st.join(wide, ["region_id", "time"], "left")


def serving_row(history: DataFrame, forecast: DataFrame, as_of: dt.datetime, horizons: int = MAX_HORIZON) -> DataFrame:
    """M4 at one instant: the feature row per region for ``as_of``."""
    hist = history_window(history, as_of)
    now = F.col("time") == F.lit(as_of).cast("timestamp_ntz")
    # only the row at ``as_of`` is expanded by horizon; the static features need the history
    return _one_row(serving_static(hist).where(now), serving_per_horizon(hist.where(now), forecast, horizons), horizons)

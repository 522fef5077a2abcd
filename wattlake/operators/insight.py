"""Read-side analytics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import nan_to_null, pearson, scale_ceiling
from wattlake.functions.timecols import add_hours
from wattlake.schemas import (
    DAILY_VAR_MAP,
    DEMAND_SCALE_DEFAULT,
    DEMAND_SCALE_STEP,
    WEATHER_COLS,
    WEATHER_LABELS,
)

DAILY_COLUMNS = [
    "date",
    "region_id",
    "region_name",
    "demand_mw_avg",
    "demand_mw_min",
    "demand_mw_max",
    "temperature_2m_avg",
    "relative_humidity_avg",
    "precipitation_sum",
    "cloud_cover_avg",
    "wind_speed_10m_avg",
    "shortwave_radiation_avg",
]
HOURLY_COLUMNS = ["time", "region_id", "region_name", "demand_mw", *WEATHER_COLS]


def latest(df: DataFrame, key: str = "region_id", order: str = "time", cols: Sequence[str] = ("demand_mw",)) -> DataFrame:
    """Newest row per key via ``max_by`` (map-side partial aggregate, so a
    hot key is combined before the shuffle)."""
    s = F.max_by(F.struct(F.col(order), *[F.col(c) for c in cols]), F.col(order)).alias("_l")
    return df.groupBy(key).agg(s).select(key, "_l.*")


def history(df: DataFrame, hours: int, as_of: Column | dt.datetime | None = None, regions: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``time >= as_of - hours``; ``as_of`` defaults to the newest time."""
    if as_of is None:
        # scalar subquery: evaluated once, then a plain filter
        newest = df.select(F.max("time")).scalar()
        d = df.where(F.col("time") >= add_hours(newest, -hours))
    else:
        ref = F.lit(as_of) if not isinstance(as_of, Column) else as_of
        d = df.where(F.col("time") >= add_hours(ref.cast("timestamp_ntz"), -hours))
    if regions is not None:
        d = d.where(F.col("region_id").isin(*regions))
    return d.select("region_id", "time", "demand_mw").orderBy("region_id", "time")


def _range_filter(df: DataFrame, regions: Sequence[str], start, end, granularity: str) -> DataFrame:
    """P11 with typed literals (no SQL text). Hourly end is ``time <= end 00:00``
    (D13: the end day itself is excluded, as upstream)."""
    d = df.where(F.col("region_id").isin(*regions))
    col = "date" if granularity == "daily" else "time"
    if start is not None:
        lit = F.lit(start) if granularity == "daily" else F.lit(dt.datetime.combine(start, dt.time()))
        d = d.where(F.col(col) >= lit.cast("date" if granularity == "daily" else "timestamp_ntz"))
    if end is not None:
        lit = F.lit(end) if granularity == "daily" else F.lit(dt.datetime.combine(end, dt.time()))
        d = d.where(F.col(col) <= lit.cast("date" if granularity == "daily" else "timestamp_ntz"))
    return d


def insight_data(daily: DataFrame, hourly: DataFrame, regions: Sequence[str], start=None, end=None,
                 granularity: str = "daily", ordered: bool = True) -> DataFrame:
    """P11 + P13 + P14 (+ L1): filtered daily or hourly rows, NaN/inf as null,
    ordered by region and time at the edge (the API's result order)."""
    src, cols = (daily, DAILY_COLUMNS) if granularity == "daily" else (hourly, HOURLY_COLUMNS)
    d = _range_filter(src, regions, start, end, granularity).select(*cols)
    dbl = {f.name for f in d.schema.fields if f.dataType.typeName() == "double"}
    out = d.select(*[nan_to_null(F.col(c)).alias(c) if c in dbl else F.col(c) for c in cols])
    return out.orderBy("region_id", cols[0]) if ordered else out


def correlation(daily: DataFrame, regions: Sequence[str], start=None, end=None) -> DataFrame:
    """A5: pooled Pearson r of daily demand against each weather variable.

    Missing covariates count as 0; ``n`` counts rows. Output is long:
    ``(variable, variable_label, r, n)``.
    """
    d = _range_filter(daily, regions, start, end, "daily")
    y = F.col("demand_mw_avg")
    aggs = [F.count(F.lit(1)).alias("n")]
    for v in WEATHER_COLS:
        aggs.append(pearson(y, F.coalesce(F.col(DAILY_VAR_MAP[v]), F.lit(0.0))).alias(v))
    one = d.agg(*aggs)
    rows = [
        F.struct(F.lit(v).alias("variable"), F.lit(WEATHER_LABELS[v]).alias("variable_label"), nan_to_null(F.col(v)).alias("r"))
        for v in WEATHER_COLS
    ]
    return one.select(F.inline(F.array(*rows)), "n")


def cross_region_daily(daily: DataFrame) -> DataFrame:
    """Mean across regions per date (nulls ignored), ordered by date."""
    cols = ["demand_mw_avg", *[DAILY_VAR_MAP[v] for v in WEATHER_COLS]]
    return daily.groupBy("date").agg(*[F.avg(c).alias(c) for c in cols]).orderBy("date")


def demand_scale(df: DataFrame, step: int = DEMAND_SCALE_STEP, default: int = DEMAND_SCALE_DEFAULT) -> DataFrame:
    """Maximum demand and the colour-scale ceiling."""
    m = df.agg(F.max("demand_mw").alias("max_demand"))
    return m.select(
        F.coalesce(F.col("max_demand"), F.lit(0.0)).alias("max_demand"),
        scale_ceiling(F.col("max_demand"), step, default).alias("gradient_max"),
    )


def regions_with_latest(regions: DataFrame, latest_df: DataFrame) -> DataFrame:
    """Every region, with its latest demand or 0."""
    return regions.join(latest_df.select("region_id", "demand_mw"), "region_id", "left").select(
        "region_id", "region_name", F.coalesce(F.col("demand_mw"), F.lit(0.0)).alias("demand_mw")
    )


def observed_predicted(history_df: DataFrame, forecast_long: DataFrame) -> DataFrame:
    """Observed history and forecast points as one ``(time, actual, predicted)`` series."""
    h = history_df.select("region_id", "time", F.col("demand_mw").alias("actual"))
    p = forecast_long.select("region_id", F.col("target_time").alias("time"), F.col("predicted"))
    return h.unionByName(p, allowMissingColumns=True).select("region_id", "time", "actual", "predicted")

"""Gold aggregates: hourly merge with forward fill, complete-day summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.timecols import calendar_columns, hour_floor
from wattlake.operators.series import forward_fill
from wattlake.schemas import WEATHER_COLS


def hourly_mean(demand: DataFrame) -> DataFrame:
    """A1: mean demand per (hour, region); partial + final hash aggregate."""
    return demand.groupBy(hour_floor("time").alias("time"), "region_id").agg(F.avg("demand_mw").alias("demand_mw"))


def with_region_name(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Dimension lookup; unmatched ids keep a null name.

    No broadcast hint: Spark broadcasts the dimension when its measured size
    is below the threshold, and shuffles otherwise.
    """
    return df.join(regions.select("region_id", "region_name"), "region_id", "left")


def hourly_features(demand_5min: DataFrame, weather: DataFrame) -> DataFrame:
    """J1 + P5 + P6: hourly demand left-joined to weather, with calendar columns."""
    d = hourly_mean(demand_5min)
    w = weather.select("time", "region_id", *WEATHER_COLS)
    j = d.join(w, ["time", "region_id"], "left").where(F.col("demand_mw").isNotNull())
    cal = calendar_columns("time")
    return j.select("time", "region_id", "demand_mw", *WEATHER_COLS, *[e.alias(n) for n, e in cal.items()])


def gold_hourly(demand_5min: DataFrame, weather: DataFrame, regions: DataFrame, fill: bool = True) -> DataFrame:
    """A1 -> J3 -> J2 -> W4: hourly demand with weather, gaps forward-filled per region."""
    d = with_region_name(hourly_mean(demand_5min), regions)
    w = weather.select("time", "region_id", *WEATHER_COLS)
    j = d.join(w, ["time", "region_id"], "left").select(
        "time", "region_id", "region_name", "demand_mw", *WEATHER_COLS
    )
    return forward_fill(j, WEATHER_COLS, "region_id", "time") if fill else j


def gold_daily(hourly: DataFrame, min_last_hour: int = 23) -> DataFrame:
    """A2 + A3: per-day summary of days whose latest hour is >= ``min_last_hour``."""
    agg = hourly.groupBy(F.to_date("time").alias("date"), "region_id", "region_name").agg(
        F.avg("demand_mw").alias("demand_mw_avg"),
        F.min("demand_mw").alias("demand_mw_min"),
        F.max("demand_mw").alias("demand_mw_max"),
        F.avg("temperature_2m").alias("temperature_2m_avg"),
        F.min("temperature_2m").alias("temperature_2m_min"),
        F.max("temperature_2m").alias("temperature_2m_max"),
        F.avg("relative_humidity_2m").alias("relative_humidity_avg"),
        F.sum(F.coalesce(F.col("precipitation"), F.lit(0.0))).alias("precipitation_sum"),
        F.avg("cloud_cover").alias("cloud_cover_avg"),
        F.avg("wind_speed_10m").alias("wind_speed_10m_avg"),
        F.avg("shortwave_radiation").alias("shortwave_radiation_avg"),
        F.count(F.lit(1)).cast("int").alias("data_points"),
        F.max(F.hour("time")).alias("_last_hour"),
    )
    return agg.where(F.col("_last_hour") >= min_last_hour).drop("_last_hour")


def _open_hours(df: DataFrame, marks: DataFrame, reopen_last: bool) -> DataFrame:
    """Rows of hours after each region's newest hour in the sink, that hour included with ``reopen_last``.

    A region without a mark is new: all its rows are open. ``marks`` has one
    row per region.
    """
    hour = hour_floor("time")
    after = hour >= F.col("_mark") if reopen_last else hour > F.col("_mark")
    return df.join(marks, "region_id", "left").where(F.col("_mark").isNull() | after).drop("_mark")


def gold_hourly_increment(
    sink: DataFrame,
    demand_5min: DataFrame,
    weather: DataFrame,
    regions: DataFrame,
    seed_fill: bool = True,
    reopen_last: bool = True,
) -> DataFrame:
    """Incremental gold: the hours that are new for their region; write by upsert.

    Every region has its own mark, so one that lags behind loses nothing, and
    its newest hour, which may have been built from part of its rows, is
    computed again (``reopen_last``). With ``seed_fill`` the last sink row
    before the open hours seeds the forward fill, so a gap at the batch start
    is filled as a full rebuild would.
    """
    marks = sink.groupBy("region_id").agg(F.max("time").alias("_mark"))
    d = _open_hours(demand_5min, marks, reopen_last)
    w = _open_hours(weather, marks, reopen_last)
    new = gold_hourly(d, w, regions, fill=False).withColumn("_seed", F.lit(False))
    if not seed_fill:
        return forward_fill(new.drop("_seed"), WEATHER_COLS, "region_id", "time")
    cols = ["time", "region_id", "region_name", "demand_mw", *WEATHER_COLS]
    closed = sink.join(marks, "region_id").where(F.col("time") < F.col("_mark")) if reopen_last else sink
    seed = (
        closed.groupBy("region_id")
        .agg(F.max_by(F.struct(*[c for c in cols if c != "region_id"]), F.col("time")).alias("_s"))
        .select("region_id", "_s.*")
        .select(*cols)
        .withColumn("_seed", F.lit(True))
    )
    filled = forward_fill(new.unionByName(seed), WEATHER_COLS, "region_id", "time")
    return filled.where(~F.col("_seed")).drop("_seed")


def features_increment(sink: DataFrame, demand_5min: DataFrame, weather: DataFrame, reopen_last: bool = True) -> DataFrame:
    """Incremental silver features with a mark per region; write by upsert.

    With ``reopen_last`` a region's newest hour, first seen while partial, is
    computed again (D2).
    """
    marks = sink.groupBy("region_id").agg(F.max("time").alias("_mark"))
    return hourly_features(_open_hours(demand_5min, marks, reopen_last), _open_hours(weather, marks, reopen_last))


def gold_daily_increment(sink_daily: DataFrame, hourly: DataFrame, min_last_hour: int = 23) -> DataFrame:
    """Incremental daily gold: the complete days of a region that the sink does not hold yet.

    The anti join is per (date, region), so a day that was incomplete for one
    region is summarised as soon as it is complete, whatever the others did.
    """
    have = sink_daily.select(F.col("date").alias("_date"), F.col("region_id").alias("_region"))
    missing = hourly.join(have, (F.to_date("time") == F.col("_date")) & (F.col("region_id") == F.col("_region")), "left_anti")
    return gold_daily(missing, min_last_hour)

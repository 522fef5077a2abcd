"""Shared plan fragments: the silver and gold tables built from the stand-ins.

Queries compose these; each is a lazy DataFrame, so Catalyst sees one
plan from the parquet scans to the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from wattlake.operators.clean import clean_demand, clean_weather
from wattlake.schemas import WEATHER_COLS
from wattlake.operators.gold import gold_daily, gold_hourly, hourly_features
from wattlake.sources import standins


ROUND4_SQL = "CAST(round(try_cast(round(CAST({x} AS DOUBLE), 9) AS DECIMAL(38, 9)), 4) AS DOUBLE)"


def round4(c: Column) -> Column:
    """Engine-independent 4-place rounding.

    Snapping to 9 places first removes summation-order noise (engines add in
    different orders); the 4-place step is exact decimal HALF_UP, which Spark
    and DuckDB implement identically. The value is referenced once, so the
    projection stays small.
    """
    d = c.cast("double")
    return F.round(F.round(d, 9).try_cast("decimal(38,9)"), 4).cast("double")


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column (the oracle compares value hashes).

    Built as one ``selectExpr`` so a wide frame costs one plan call.
    """
    exprs = []
    for f in df.schema.fields:
        q = f"`{f.name}`"
        if isinstance(f.dataType, (DoubleType, FloatType)):
            exprs.append(f"{ROUND4_SQL.format(x=q)} AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)


def demand_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_demand(standins.bronze_demand(spark, sf_dir))


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_weather(standins.bronze_weather(spark, sf_dir))


def features_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_features(demand_5min(spark, sf_dir), weather_hourly(spark, sf_dir))


def correlation_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_hourly(demand_5min(spark, sf_dir), weather_hourly(spark, sf_dir), standins.regions(spark))


def correlation_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_daily(correlation_hourly(spark, sf_dir))


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series (orders x lineitem) with calendar columns, like features_ml."""
    return hourly_features_daily(standins.demand_daily(spark, sf_dir), standins.weather_daily(spark, sf_dir))


def hourly_features_daily(demand: DataFrame, weather: DataFrame) -> DataFrame:
    from wattlake.functions.timecols import calendar_columns
    from wattlake.schemas import WEATHER_COLS

    j = demand.join(weather.select("time", "region_id", *WEATHER_COLS), ["time", "region_id"], "left")
    cal = calendar_columns("time")
    return j.select("time", "region_id", "demand_mw", *WEATHER_COLS, *[e.alias(n) for n, e in cal.items()])


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast table: seasonal-naive forecasts over the hourly features."""
    from wattlake.operators.forecast import seasonal_naive

    return seasonal_naive(features_ml(spark, sf_dir))

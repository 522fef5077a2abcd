"""Step 1: bronze -> silver -> gold."""

from __future__ import annotations

from wattlake.plans import oracle_sql as O
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.schemas import WEATHER_COLS

_W4 = ", ".join(O.r4(c) for c in WEATHER_COLS)


@register(
    "demand_clean",
    O.sql(f"SELECT time, region_id, {O.r4('demand_mw')} FROM demand_5min"),
)
def demand_clean(spark, sf_dir):
    return S.rounded(S.demand_5min(spark, sf_dir))


@register("weather_clean", O.sql(f"SELECT time, region_id, {_W4} FROM weather_hourly"))
def weather_clean(spark, sf_dir):
    return S.rounded(S.weather_hourly(spark, sf_dir))


@register(
    "gold_hourly",
    O.sql(f"SELECT time, region_id, region_name, {O.r4('demand_mw')}, {_W4} FROM correlation_hourly"),
)
def gold_hourly(spark, sf_dir):
    return S.rounded(S.correlation_hourly(spark, sf_dir))


_DAILY_COLS = [
    "demand_mw_avg",
    "demand_mw_min",
    "demand_mw_max",
    "temperature_2m_avg",
    "temperature_2m_min",
    "temperature_2m_max",
    "relative_humidity_avg",
    "precipitation_sum",
    "cloud_cover_avg",
    "wind_speed_10m_avg",
    "shortwave_radiation_avg",
]


@register(
    "gold_daily",
    O.sql(
        "SELECT date, region_id, region_name, "
        + ", ".join(O.r4(c) for c in _DAILY_COLS)
        + ", data_points FROM correlation_daily"
    ),
)
def gold_daily(spark, sf_dir):
    return S.rounded(S.correlation_daily(spark, sf_dir))

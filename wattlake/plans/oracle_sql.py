"""DuckDB twins of the registered queries (used only by the oracle check).

All stand-in and silver/gold tables are written as CTEs; ``sql(body)``
prefixes a query body with them (DuckDB inlines the ones it references).
"""

from __future__ import annotations

from wattlake.schemas import VALID_REGIONS, WEATHER_COLS
from wattlake.sources.standins import (
    BRONZE_DEMAND_SQL,
    BRONZE_WEATHER_SQL,
    DEMAND_DAILY_SQL,
    REGIONS_SQL,
    WEATHER_DAILY_SQL,
)

REGION_LIST = ", ".join(f"'{r}'" for r in VALID_REGIONS)
W = ", ".join(WEATHER_COLS)


def wcols(prefix: str) -> str:
    return ", ".join(f"{prefix}.{c}" for c in WEATHER_COLS)


CALENDAR_SQL = """CAST(hour({t}) AS INTEGER) AS hour,
    CAST(dayofweek({t}) AS INTEGER) AS day_of_week,
    dayofweek({t}) IN (0, 6) AS is_weekend,
    CAST(month({t}) AS INTEGER) AS month,
    CAST(CASE WHEN month({t}) IN (12, 1, 2) THEN 1 WHEN month({t}) IN (3, 4, 5) THEN 2
         WHEN month({t}) IN (6, 7, 8) THEN 3 ELSE 4 END AS INTEGER) AS season,
    CASE WHEN month({t}) IN (12, 1, 2) THEN 'summer' WHEN month({t}) IN (3, 4, 5) THEN 'autumn'
         WHEN month({t}) IN (6, 7, 8) THEN 'winter' ELSE 'spring' END AS season_name"""

FFILL = ",\n    ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY region_id ORDER BY time "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in WEATHER_COLS
)

CTES = [
    BRONZE_DEMAND_SQL,
    BRONZE_WEATHER_SQL,
    REGIONS_SQL,
    DEMAND_DAILY_SQL,
    WEATHER_DAILY_SQL,
    f"""
demand_5min AS (
  SELECT time, region_id, CAST(demand_mw AS DOUBLE) AS demand_mw FROM bronze_demand
  WHERE demand_mw IS NOT NULL AND time IS NOT NULL AND region_id IN ({REGION_LIST})
)""",
    f"""
weather_hourly AS (
  SELECT time, region_id, temperature_2m, relative_humidity_2m,
         coalesce(precipitation, 0.0) AS precipitation, coalesce(cloud_cover, 0.0) AS cloud_cover,
         wind_speed_10m, coalesce(shortwave_radiation, 0.0) AS shortwave_radiation
  FROM bronze_weather
  WHERE temperature_2m IS NOT NULL AND time IS NOT NULL AND region_id IN ({REGION_LIST})
)""",
    """
demand_hourly AS (
  SELECT date_trunc('hour', time) AS time, region_id, avg(demand_mw) AS demand_mw
  FROM demand_5min GROUP BY 1, 2
)""",
    f"""
features_ml AS (
  SELECT d.time, d.region_id, d.demand_mw, {wcols('w')},
    {CALENDAR_SQL.format(t='d.time')}
  FROM demand_hourly d LEFT JOIN weather_hourly w ON d.time = w.time AND d.region_id = w.region_id
  WHERE d.demand_mw IS NOT NULL
)""",
    f"""
gold_joined AS (
  SELECT d.time, d.region_id, r.region_name, d.demand_mw, {wcols('w')}
  FROM demand_hourly d
  LEFT JOIN regions_dim r ON d.region_id = r.region_id
  LEFT JOIN weather_hourly w ON d.time = w.time AND d.region_id = w.region_id
)""",
    f"""
correlation_hourly AS (
  SELECT time, region_id, region_name, demand_mw,
    {FFILL}
  FROM gold_joined
)""",
    """
correlation_daily AS (
  SELECT CAST(time AS DATE) AS date, region_id, region_name,
    avg(demand_mw) AS demand_mw_avg, min(demand_mw) AS demand_mw_min, max(demand_mw) AS demand_mw_max,
    avg(temperature_2m) AS temperature_2m_avg, min(temperature_2m) AS temperature_2m_min,
    max(temperature_2m) AS temperature_2m_max, avg(relative_humidity_2m) AS relative_humidity_avg,
    sum(coalesce(precipitation, 0.0)) AS precipitation_sum, avg(cloud_cover) AS cloud_cover_avg,
    avg(wind_speed_10m) AS wind_speed_10m_avg, avg(shortwave_radiation) AS shortwave_radiation_avg,
    CAST(count(*) AS INTEGER) AS data_points
  FROM correlation_hourly
  GROUP BY 1, 2, 3
  HAVING max(hour(time)) >= 23
)""",
    f"""
daily_series AS (
  SELECT d.time, d.region_id, d.demand_mw, {wcols('w')},
    {CALENDAR_SQL.format(t='d.time')}
  FROM demand_daily d LEFT JOIN weather_daily w ON d.time = w.time AND d.region_id = w.region_id
)""",
]

_LAGS = ",\n    ".join(
    (f"lag(demand_mw, {24 - h}) OVER (PARTITION BY region_id ORDER BY time)" if h < 24 else "demand_mw")
    + f" AS horizon_h{h:02d}"
    for h in range(1, 25)
)
CTES.append(
    f"""
predictions AS (
  SELECT time AS created_at, region_id,
    {_LAGS}
  FROM features_ml
)"""
)
CTES.append(
    """
forecast_long AS (
  SELECT p.created_at, p.region_id, h.horizon,
    CASE h.horizon """
    + " ".join(f"WHEN {h} THEN p.horizon_h{h:02d}" for h in range(1, 25))
    + """ END AS predicted,
    p.created_at + to_hours(CAST(h.horizon AS BIGINT)) AS target_time
  FROM predictions p, (SELECT unnest(range(1, 25)) AS horizon) h
)"""
)

EXTRA_CTES: list[str] = []


def sql(body: str) -> str:
    return "WITH " + ",".join(CTES + EXTRA_CTES) + "\n" + body


def r4(expr: str, alias: str | None = None) -> str:
    a = alias or expr.split(".")[-1]
    return f"CAST(round(TRY_CAST(round(CAST({expr} AS DOUBLE), 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS {a}"

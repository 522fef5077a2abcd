"""Table schemas and fixed domain values.

Timestamps are ``timestamp_ntz`` holding UTC wall time, so results do not
depend on the session time zone and compare 1:1 with DuckDB ``TIMESTAMP``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream system's for identical results).
# Region codes and display names, in natural order.
VALID_REGIONS = ["NSW1", "QLD1", "SA1", "TAS1", "VIC1"]
REGION_NAMES = {
    "NSW1": "New South Wales",
    "QLD1": "Queensland",
    "SA1": "South Australia",
    "TAS1": "Tasmania",
    "VIC1": "Victoria",
}
# Full region names used in market dispatch reports.
REGION_FULL_NAME_TO_ID = {
    "NEW SOUTH WALES": "NSW1",
    "QUEENSLAND": "QLD1",
    "SOUTH AUSTRALIA": "SA1",
    "TASMANIA": "TAS1",
    "VICTORIA": "VIC1",
}
# Local time zone of each region's weather station.
REGION_TZ = {
    "NSW1": "Australia/Sydney",
    "QLD1": "Australia/Brisbane",
    "SA1": "Australia/Adelaide",
    "TAS1": "Australia/Hobart",
    "VIC1": "Australia/Melbourne",
}
# Dispatch report times are market time.
MARKET_TZ = "Australia/Sydney"
WEATHER_COLS = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "cloud_cover",
    "wind_speed_10m",
    "shortwave_radiation",
]
# Labels of the weather variables in the insight API.
WEATHER_LABELS = {
    "temperature_2m": "Temperature (°C)",
    "relative_humidity_2m": "Humidity (%)",
    "precipitation": "Precipitation (mm)",
    "cloud_cover": "Cloud Cover (%)",
    "wind_speed_10m": "Wind Speed (km/h)",
    "shortwave_radiation": "Solar Radiation (W/m²)",
}
# Weather variable -> column of the daily gold table.
DAILY_VAR_MAP = {
    "temperature_2m": "temperature_2m_avg",
    "relative_humidity_2m": "relative_humidity_avg",
    "precipitation": "precipitation_sum",
    "cloud_cover": "cloud_cover_avg",
    "wind_speed_10m": "wind_speed_10m_avg",
    "shortwave_radiation": "shortwave_radiation_avg",
    "demand_mw": "demand_mw_avg",
}
# Feature layout of the 24-hour model.
MAX_HORIZON = 24
DEMAND_LAGS = [24, 48, 72, 168, 744]
TEMP_LAGS = [24, 48]
STATIC_FEATS = [
    "demand_lag_24h",
    "demand_lag_48h",
    "demand_lag_72h",
    "demand_lag_168h",
    "demand_lag_744h",
    "temp_lag_24h",
    "temp_lag_48h",
    "demand_rolling_mean_24h",
    "demand_rolling_std_24h",
    "demand_rolling_mean_168h",
]
PER_HORIZON = [
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
# Southern-hemisphere seasons by month.
SEASONS = [
    (1, "summer", [12, 1, 2]),
    (2, "autumn", [3, 4, 5]),
    (3, "winter", [6, 7, 8]),
    (4, "spring", [9, 10, 11]),
]
# Serving history and scale ceiling.
SERVING_LOOKBACK_HOURS = 744
DEMAND_SCALE_STEP = 5000
DEMAND_SCALE_DEFAULT = 20000
# Chronological model split.
TRAIN_END = "2026-03-01"
VAL_END = "2026-05-01"
# Data-quality limits.
ROW_COUNT_MAX = 10_000_000
PREDICTION_ROW_COUNT_MAX = 1_000_000
EPOCH = "1970-01-01 00:00:00"
# ---------------------------------------------------------------------------

TS = T.TimestampNTZType()

BRONZE_DEMAND = T.StructType(
    [
        T.StructField("time", TS, True),
        T.StructField("region_id", T.StringType(), True),
        T.StructField("demand_mw", T.DoubleType(), True),
    ]
)

BRONZE_WEATHER = T.StructType(
    [T.StructField("time", TS, True), T.StructField("region_id", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in WEATHER_COLS]
)

GOLD_HOURLY = T.StructType(
    [
        T.StructField("time", TS, True),
        T.StructField("region_id", T.StringType(), True),
        T.StructField("region_name", T.StringType(), True),
        T.StructField("demand_mw", T.DoubleType(), True),
    ]
    + [T.StructField(c, T.DoubleType(), True) for c in WEATHER_COLS]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("created_at", TS, False),
        T.StructField("region_id", T.StringType(), False),
    ]
    + [T.StructField(f"horizon_h{h:02d}", T.DoubleType(), True) for h in range(1, MAX_HORIZON + 1)]
)

HORIZON_COLS = [f"horizon_h{h:02d}" for h in range(1, MAX_HORIZON + 1)]


# Fixed learner settings of the boosted trees (the tree count is a parameter).
GBT_PARAMS = {
    "maxDepth": 5,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 5,
    "seed": 911,
}

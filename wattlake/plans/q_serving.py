"""Step 8: serving features for every hour (train/serve parity backtest)."""

from __future__ import annotations

from wattlake.operators import serving as SV
from wattlake.plans import oracle_sql as O
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.schemas import DEMAND_LAGS, TEMP_LAGS

_JOIN_LAGS = sorted(set(DEMAND_LAGS) | set(TEMP_LAGS))
_RANGE = "PARTITION BY region_id ORDER BY time RANGE BETWEEN INTERVAL {a} HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING"

_SV_SQL = (
    ", sv AS (SELECT region_id, time, "
    f"avg(demand_mw) OVER ({_RANGE.format(a=23)}) AS m24, "
    f"stddev_samp(demand_mw) OVER ({_RANGE.format(a=23)}) AS s24, "
    f"count(demand_mw) OVER ({_RANGE.format(a=23)}) AS n24, "
    f"avg(demand_mw) OVER ({_RANGE.format(a=167)}) AS m168 FROM features_ml) "
    "SELECT b.region_id, b.time, "
    + ", ".join(O.r4(f"coalesce(l{k}.demand_mw, 0.0)", f"demand_lag_{k}h") for k in DEMAND_LAGS)
    + ", "
    + ", ".join(O.r4(f"coalesce(l{k}.temperature_2m, 0.0)", f"temp_lag_{k}h") for k in TEMP_LAGS)
    + ", "
    + O.r4("coalesce(sv.m24, 0.0)", "demand_rolling_mean_24h")
    + ", "
    + O.r4("CASE WHEN sv.n24 > 1 THEN sv.s24 ELSE 0.0 END", "demand_rolling_std_24h")
    + ", "
    + O.r4("coalesce(sv.m168, 0.0)", "demand_rolling_mean_168h")
    + " FROM features_ml b JOIN sv ON sv.region_id = b.region_id AND sv.time = b.time "
    + " ".join(
        f"LEFT JOIN features_ml l{k} ON l{k}.region_id = b.region_id AND l{k}.time = b.time - INTERVAL {k} HOUR"
        for k in _JOIN_LAGS
    )
)


@register("serving_lags", O.sql(_SV_SQL))
def serving_lags(spark, sf_dir):
    """J7 + W5: time-offset lags (missing -> 0) and open-left-edge range stats."""
    st = SV.serving_static(S.features_ml(spark, sf_dir))
    return S.rounded(st.select("region_id", "time", *SV.SERVING_STATIC))


_TT = "(x.time + to_hours(CAST(x.horizon AS BIGINT)))"
_DOW = f"(isodow({_TT}) - 1)"
_PH = {
    "temperature_2m": "coalesce(w.temperature_2m, 0.0)",
    "relative_humidity_2m": "coalesce(w.relative_humidity_2m, 0.0)",
    "hour_sin": f"sin(2 * pi() * hour({_TT}) / 24.0)",
    "hour_cos": f"cos(2 * pi() * hour({_TT}) / 24.0)",
    "dow_sin": f"sin(2 * pi() * {_DOW} / 7.0)",
    "dow_cos": f"cos(2 * pi() * {_DOW} / 7.0)",
    "month_sin": f"sin(2 * pi() * month({_TT}) / 12.0)",
    "month_cos": f"cos(2 * pi() * month({_TT}) / 12.0)",
    "is_weekend": f"CASE WHEN {_DOW} IN (5, 6) THEN 1.0 ELSE 0.0 END",
    "wind_power": "pow(coalesce(w.wind_speed_10m, 0.0), 3)",
    "solar_potential": "coalesce(w.shortwave_radiation, 0.0) * (1.0 - coalesce(w.cloud_cover, 0.0) / 100.0)",
    "temp_change": "coalesce(w.temperature_2m, 0.0) - x.current_temp",
    "has_precip": "CASE WHEN coalesce(w.precipitation, 0.0) > 0 THEN 1.0 ELSE 0.0 END",
}
_PH_SQL = (
    "SELECT x.region_id, x.time, CAST(x.horizon AS INTEGER) AS horizon, "
    + ", ".join(O.r4(e, c) for c, e in _PH.items())
    + " FROM (SELECT b.region_id, b.time, coalesce(b.temperature_2m, 0.0) AS current_temp, h.horizon "
    "FROM features_ml b CROSS JOIN (SELECT unnest(range(1, 25)) AS horizon) h) x "
    f"LEFT JOIN weather_hourly w ON w.region_id = x.region_id AND w.time = {_TT}"
)


_AS_OF = "2024-01-29 12:00:00"
_PER_HORIZON = ", ".join(
    f"max(CASE WHEN p.horizon = {h} THEN p.{c} END) AS {c}_h{h}" for h in range(1, 25) for c in _PH
)
_ROW_SQL = (
    _SV_SQL.replace(") SELECT b.region_id, b.time,", "), st AS (SELECT b.region_id, b.time,", 1)
    + f" WHERE b.time = TIMESTAMP '{_AS_OF}'), ph AS ({_PH_SQL} WHERE x.time = TIMESTAMP '{_AS_OF}') "
    + f"SELECT st.*, q.* EXCLUDE (region_id) FROM st JOIN (SELECT p.region_id, {_PER_HORIZON} FROM ph p GROUP BY p.region_id) q "
    "ON q.region_id = st.region_id"
)


@register("serving_row", O.sql(_ROW_SQL))
def serving_row(spark, sf_dir):
    """M4 (+ P16): the wide feature row of every region at one instant, 10 static and 24 x 13 horizon features."""
    import datetime as dt

    as_of = dt.datetime.fromisoformat(_AS_OF)
    row = SV.serving_row(S.features_ml(spark, sf_dir), S.weather_hourly(spark, sf_dir), as_of)
    return S.rounded(row.drop("demand_mw", "temperature_2m"))


@register("serving_features", O.sql(_PH_SQL))
def serving_features(spark, sf_dir):
    """J6 + P7 + P8 (+ D6/D7): per-horizon serving features for every hour, long form."""
    ph = SV.serving_per_horizon(S.features_ml(spark, sf_dir), S.weather_hourly(spark, sf_dir))
    return S.rounded(ph)

"""Step 3: silver features and the 24-horizon training tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import features as FT
from wattlake.plans import oracle_sql as O
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.schemas import DEMAND_LAGS, MAX_HORIZON, PER_HORIZON, STATIC_FEATS, TEMP_LAGS, WEATHER_COLS

# Chronological split points inside the daily stand-in series.
TRAIN_END = "1999-06-01 00:00:00"
VAL_END = "2000-06-01 00:00:00"

_CAL = ["hour", "day_of_week", "is_weekend", "month", "season", "season_name"]


@register(
    "features_hourly",
    O.sql(
        f"SELECT time, region_id, {O.r4('demand_mw')}, "
        + ", ".join(O.r4(c) for c in WEATHER_COLS)
        + ", "
        + ", ".join(_CAL)
        + " FROM features_ml"
    ),
)
def features_hourly(spark, sf_dir):
    return S.rounded(S.features_ml(spark, sf_dir))


# ----------------------------- SQL pieces ----------------------------------
_W = "PARTITION BY region_id ORDER BY time"
_STATIC_SQL = (
    [f"lag(demand_mw, {k}) OVER ({_W}) AS demand_lag_{k}h" for k in DEMAND_LAGS]
    + [f"lag(temperature_2m, {k}) OVER ({_W}) AS temp_lag_{k}h" for k in TEMP_LAGS]
    + [
        f"avg(demand_mw) OVER ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS demand_rolling_mean_24h",
        f"stddev_samp(demand_mw) OVER ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS demand_rolling_std_24h",
        f"avg(demand_mw) OVER ({_W} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS demand_rolling_mean_168h",
    ]
)
_LEAD_SQL = [
    f"lead({c}, {h}) OVER ({_W}) AS {c}_l{h}" for h in range(1, MAX_HORIZON + 1) for c in FT.LEAD_COLS
]
O.EXTRA_CTES.append(
    f"""
fbase AS (
  SELECT time, region_id, demand_mw, {', '.join(WEATHER_COLS)}, temperature_2m AS temp_now,
    {', '.join(_STATIC_SQL)},
    {', '.join(_LEAD_SQL)}
  FROM daily_series
)"""
)


def _per_h_sql(h: int) -> dict[str, str]:
    tt = f"(time + INTERVAL {h} HOUR)"
    dow = f"(isodow({tt}) - 1)"
    hr, mo = f"hour({tt})", f"month({tt})"
    return {
        **{c: f"{c}_l{h}" for c in WEATHER_COLS},
        "hour": f"CAST({hr} AS INTEGER)",
        "day_of_week": f"CAST({dow} AS INTEGER)",
        "is_weekend": f"CAST({dow} IN (5, 6) AS INTEGER)",
        "month": f"CAST({mo} AS INTEGER)",
        "target": f"demand_mw_l{h}",
        "wind_power": f"pow(wind_speed_10m_l{h}, 3)",
        "solar_potential": f"shortwave_radiation_l{h} * (1.0 - cloud_cover_l{h} / 100.0)",
        "temp_change": f"temperature_2m_l{h} - temp_now",
        "hour_sin": f"sin(2 * pi() * {hr} / 24.0)",
        "hour_cos": f"cos(2 * pi() * {hr} / 24.0)",
        "dow_sin": f"sin(2 * pi() * {dow} / 7.0)",
        "dow_cos": f"cos(2 * pi() * {dow} / 7.0)",
        "month_sin": f"sin(2 * pi() * {mo} / 12.0)",
        "month_cos": f"cos(2 * pi() * {mo} / 12.0)",
        "has_precip": f"CAST(coalesce(precipitation_l{h}, 0.0) > 0 AS INTEGER)",
    }


_INT_COLS = {"horizon", "hour", "day_of_week", "is_weekend", "month", "has_precip"}
_KEY_COLS = {"time", "region_id"}


def _long_sql() -> str:
    arms = []
    for h in range(1, MAX_HORIZON + 1):
        e = _per_h_sql(h)
        sel = []
        for c in FT.LONG_COLS:
            if c == "horizon":
                sel.append(f"CAST({h} AS INTEGER) AS horizon")
            elif c in e:
                sel.append(f"{e[c]} AS {c}")
            else:
                sel.append(c)
        arms.append("SELECT " + ", ".join(sel) + " FROM fbase")
    body = " UNION ALL ".join(arms)
    outer = ", ".join(c if (c in _INT_COLS or c in _KEY_COLS) else O.r4(c) for c in FT.LONG_COLS)
    cond = " AND ".join(f"{c} IS NOT NULL" for c in FT.LONG_COLS)
    return O.sql(f"SELECT {outer} FROM ({body}) x WHERE {cond}")


def _wide_inner_sql() -> str:
    cols = ["region_id", "time", *STATIC_FEATS]
    for h in range(1, MAX_HORIZON + 1):
        e = _per_h_sql(h)
        cols += [f"{e[c]} AS {c}_h{h}" for c in PER_HORIZON]
        cols.append(f"demand_mw_l{h} AS target_h{h}")
    conds = ["demand_mw IS NOT NULL", "temp_now IS NOT NULL"] + [f"{c} IS NOT NULL" for c in STATIC_FEATS]
    conds += [f"{c}_l{h} IS NOT NULL" for h in range(1, MAX_HORIZON + 1) for c in FT.LEAD_COLS]
    return "SELECT " + ", ".join(cols) + " FROM fbase WHERE " + " AND ".join(conds)


_WIDE_INT = {f"{c}_h{h}" for h in range(1, MAX_HORIZON + 1) for c in ("is_weekend", "has_precip")}


def _wide_sql() -> str:
    targets, feats = FT.wide_columns()
    outer = ["region_id", "time"] + [c if c in _WIDE_INT else O.r4(c) for c in feats + targets]
    return O.sql(f"SELECT {', '.join(outer)} FROM ({_wide_inner_sql()}) x")


@register(
    "lag_features",
    O.sql(
        "SELECT time, region_id, "
        + ", ".join(O.r4(c) for c in ["demand_mw", *STATIC_FEATS[:7]])
        + " FROM fbase"
    ),
)
def lag_features(spark, sf_dir):
    st = FT.static_features(S.daily_series(spark, sf_dir).select("time", "region_id", "demand_mw", "temperature_2m"))
    return S.rounded(st.select("time", "region_id", "demand_mw", *STATIC_FEATS[:7]))


@register(
    "rolling_features",
    O.sql("SELECT time, region_id, " + ", ".join(O.r4(c) for c in STATIC_FEATS[7:]) + " FROM fbase"),
)
def rolling_features(spark, sf_dir):
    st = FT.static_features(S.daily_series(spark, sf_dir).select("time", "region_id", "demand_mw", "temperature_2m"))
    return S.rounded(st.select("time", "region_id", *STATIC_FEATS[7:]))


@register("horizon_long", _long_sql())
def horizon_long(spark, sf_dir):
    return S.rounded(FT.horizon_long(S.daily_series(spark, sf_dir)))


@register("features_wide", _wide_sql())
def features_wide(spark, sf_dir):
    wide, _targets, _feats = FT.features_wide(S.daily_series(spark, sf_dir))
    return S.rounded(wide)


@register(
    "split_profile",
    O.sql(
        f", w AS ({_wide_inner_sql()}), s AS (SELECT CASE WHEN time < TIMESTAMP '{TRAIN_END}' THEN 'train' "
        f"WHEN time < TIMESTAMP '{VAL_END}' THEN 'validation' ELSE 'test' END AS split, time, region_id FROM w) "
        "SELECT split, count(*) AS n_rows, count(DISTINCT region_id) AS n_regions, min(time) AS min_time, "
        "max(time) AS max_time FROM s GROUP BY split"
    ).replace("\n, w AS", ", w AS"),
)
def split_profile(spark, sf_dir):
    from wattlake.operators.profile import profile

    wide, _, _ = FT.features_wide(S.daily_series(spark, sf_dir))
    return profile(wide.select("time", "region_id", FT.split_name("time", TRAIN_END, VAL_END).alias("split")))

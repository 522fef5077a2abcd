"""Step 2: read-side analytics over silver and gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wattlake.operators import forecast as FC
from wattlake.operators import insight as I
from wattlake.plans import oracle_sql as O
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.schemas import DAILY_VAR_MAP, VALID_REGIONS, WEATHER_COLS, WEATHER_LABELS
from wattlake.sources import standins

# Query parameters of the insight API (a date window inside the data).
START = dt.date(2024, 1, 2)
END = dt.date(2024, 1, 29)
HISTORY_HOURS = 24


@register(
    "latest_demand",
    O.sql(
        f"SELECT DISTINCT ON (region_id) region_id, time, {O.r4('demand_mw')} "
        "FROM demand_5min ORDER BY region_id, time DESC"
    ),
)
def latest_demand(spark, sf_dir):
    return S.rounded(I.latest(S.demand_5min(spark, sf_dir)))


@register(
    "demand_history",
    O.sql(
        f"SELECT region_id, time, {O.r4('demand_mw')} FROM demand_5min "
        f"WHERE time >= (SELECT max(time) FROM demand_5min) - INTERVAL {HISTORY_HOURS} HOUR"
    ),
)
def demand_history(spark, sf_dir):
    return S.rounded(I.history(S.demand_5min(spark, sf_dir), HISTORY_HOURS))


_DAILY_SEL = ", ".join(
    c if c in ("date", "region_id", "region_name") else O.r4(c) for c in I.DAILY_COLUMNS
)
_HOURLY_SEL = ", ".join(
    c if c in ("time", "region_id", "region_name") else O.r4(c) for c in I.HOURLY_COLUMNS
)
_REGIONS = ", ".join(f"'{r}'" for r in VALID_REGIONS)


@register(
    "insight_daily",
    O.sql(
        f"SELECT {_DAILY_SEL} FROM correlation_daily WHERE region_id IN ({_REGIONS}) "
        f"AND date >= DATE '{START}' AND date <= DATE '{END}'"
    ),
)
def insight_daily(spark, sf_dir):
    d = I.insight_data(S.correlation_daily(spark, sf_dir), None, VALID_REGIONS, START, END, "daily")
    return S.rounded(d)


@register(
    "insight_hourly",
    O.sql(
        f"SELECT {_HOURLY_SEL} FROM correlation_hourly WHERE region_id IN ({_REGIONS}) "
        f"AND time >= TIMESTAMP '{START} 00:00:00' AND time <= TIMESTAMP '{END} 00:00:00'"
    ),
)
def insight_hourly(spark, sf_dir):
    d = I.insight_data(None, S.correlation_hourly(spark, sf_dir), VALID_REGIONS, START, END, "hourly")
    return S.rounded(d)


def _corr_sql() -> str:
    exprs = ", ".join(
        f"covar_pop(demand_mw_avg, coalesce({DAILY_VAR_MAP[v]}, 0.0)) / "
        f"nullif(stddev_pop(demand_mw_avg) * stddev_pop(coalesce({DAILY_VAR_MAP[v]}, 0.0)), 0) AS {v}"
        for v in WEATHER_COLS
    )
    arms = " UNION ALL ".join(
        f"SELECT '{v}' AS variable, '{WEATHER_LABELS[v]}' AS variable_label, {O.r4(v, 'r')}, n FROM c"
        for v in WEATHER_COLS
    )
    return O.sql(
        f", c AS (SELECT count(*) AS n, {exprs} FROM correlation_daily WHERE region_id IN ({_REGIONS}) "
        f"AND date >= DATE '{START}' AND date <= DATE '{END}') {arms}"
    ).replace("\n, c AS", ", c AS")


@register("correlation", _corr_sql())
def correlation(spark, sf_dir):
    return S.rounded(I.correlation(S.correlation_daily(spark, sf_dir), VALID_REGIONS, START, END))


_XR = ["demand_mw_avg", *[DAILY_VAR_MAP[v] for v in WEATHER_COLS]]


@register(
    "cross_region_daily",
    O.sql("SELECT date, " + ", ".join(f"{O.r4(f'avg({c})', c)}" for c in _XR) + " FROM correlation_daily GROUP BY date"),
)
def cross_region_daily(spark, sf_dir):
    return S.rounded(I.cross_region_daily(S.correlation_daily(spark, sf_dir)))


@register(
    "demand_scale",
    O.sql(
        "SELECT " + O.r4("coalesce(max(demand_mw), 0.0)", "max_demand") + ", "
        "CAST(CASE WHEN max(demand_mw) IS NULL OR ((CAST(max(demand_mw) AS BIGINT) + 4999) // 5000) * 5000 = 0 "
        "THEN 20000 ELSE ((CAST(max(demand_mw) AS BIGINT) + 4999) // 5000) * 5000 END AS BIGINT) AS gradient_max "
        "FROM demand_5min"
    ),
)
def demand_scale(spark, sf_dir):
    return S.rounded(I.demand_scale(S.demand_5min(spark, sf_dir)))


@register(
    "region_latest_filled",
    O.sql(
        "SELECT r.region_id, r.region_name, "
        + O.r4("coalesce(l.demand_mw, 0.0)", "demand_mw")
        + " FROM regions_dim r LEFT JOIN (SELECT DISTINCT ON (region_id) region_id, demand_mw FROM demand_5min "
        "ORDER BY region_id, time DESC) l ON r.region_id = l.region_id"
    ),
)
def region_latest_filled(spark, sf_dir):
    latest = I.latest(S.demand_5min(spark, sf_dir))
    return S.rounded(I.regions_with_latest(standins.regions(spark), latest))


@register(
    "observed_predicted_series",
    O.sql(
        "SELECT region_id, time, " + O.r4("demand_mw", "actual") + ", CAST(NULL AS DOUBLE) AS predicted FROM features_ml "
        "UNION ALL SELECT f.region_id, f.target_time AS time, CAST(NULL AS DOUBLE) AS actual, "
        + O.r4("f.predicted", "predicted")
        + " FROM forecast_long f JOIN (SELECT region_id, max(created_at) AS created_at FROM predictions GROUP BY 1) m "
        "ON f.region_id = m.region_id AND f.created_at = m.created_at"
    ),
)
def observed_predicted_series(spark, sf_dir):
    hist = S.features_ml(spark, sf_dir)
    latest = FC.latest_forecast(S.predictions(spark, sf_dir))
    return S.rounded(I.observed_predicted(hist, FC.forecast_long(latest)))

"""Step 5: forecast tables and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import forecast as FC
from wattlake.plans import oracle_sql as O
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.schemas import HORIZON_COLS

_H = ", ".join(O.r4(c) for c in HORIZON_COLS)


@register("forecast_wide", O.sql(f"SELECT created_at, region_id, {_H} FROM predictions"))
def forecast_wide(spark, sf_dir):
    """R4 round trip: wide forecasts -> ARRAY column -> wide again."""
    pred = S.predictions(spark, sf_dir)
    arr = pred.select("created_at", "region_id", F.array(*HORIZON_COLS).alias("pred"))
    return S.rounded(FC.forecast_to_wide(arr))


@register(
    "latest_forecast",
    O.sql(f"SELECT DISTINCT ON (region_id) region_id, created_at, {_H} FROM predictions ORDER BY region_id, created_at DESC"),
)
def latest_forecast(spark, sf_dir):
    return S.rounded(FC.latest_forecast(S.predictions(spark, sf_dir)))


_ACC = """
, acc AS (
  SELECT f.region_id, f.created_at, f.horizon,
         round(abs((a.demand_mw - f.predicted) / a.demand_mw) * 100, 2) AS mape
  FROM forecast_long f LEFT JOIN (SELECT * FROM features_ml WHERE demand_mw > 0) a
  ON f.region_id = a.region_id AND f.target_time = a.time
)"""


@register(
    "forecast_accuracy",
    O.sql(_ACC + f" SELECT region_id, created_at, CAST(horizon AS INTEGER) AS horizon, {O.r4('mape')}, "
          + O.r4("100.0 - mape", "accuracy") + " FROM acc").replace("\n, acc AS", ", acc AS"),
)
def forecast_accuracy(spark, sf_dir):
    return S.rounded(FC.forecast_accuracy(S.predictions(spark, sf_dir), S.features_ml(spark, sf_dir)))


@register(
    "latest_forecast_accuracy",
    O.sql(_ACC + ", newest AS (SELECT region_id, max(created_at) AS created_at FROM predictions GROUP BY 1)"
          " SELECT region_id, created_at, CAST(horizon AS INTEGER) AS horizon, " + O.r4("mape") + ", "
          + O.r4("100.0 - mape", "accuracy") + " FROM acc JOIN newest USING (region_id, created_at)").replace("\n, acc AS", ", acc AS"),
)
def latest_forecast_accuracy(spark, sf_dir):
    """24 rows per region, null where the target hour has no actual value yet."""
    return S.rounded(FC.latest_forecast_accuracy(S.predictions(spark, sf_dir), S.features_ml(spark, sf_dir)))


_R2 = """
, lp AS (
  SELECT f.region_id, f.horizon, a.demand_mw AS actual, f.predicted
  FROM forecast_long f JOIN features_ml a ON f.region_id = a.region_id AND f.target_time = a.time
  WHERE f.predicted IS NOT NULL
), m AS (
  SELECT region_id, horizon, avg(actual) AS ybar FROM lp GROUP BY 1, 2
), g AS (
  SELECT lp.region_id, lp.horizon, sum(power(actual - predicted, 2)) AS sse, sum(power(actual - ybar, 2)) AS sst,
         avg(abs(actual - predicted)) AS mae, count(*) AS n
  FROM lp JOIN m ON lp.region_id = m.region_id AND lp.horizon = m.horizon GROUP BY 1, 2
)"""


@register(
    "forecast_r2_mae",
    O.sql(
        _R2
        + " SELECT region_id, CAST(horizon AS INTEGER) AS horizon, "
        + O.r4("CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 - sse / sst END", "r2")
        + ", " + O.r4("mae") + ", n FROM g"
    ).replace("\n, lp AS", ", lp AS"),
)
def forecast_r2_mae(spark, sf_dir):
    long = FC.forecast_long(S.predictions(spark, sf_dir)).where(F.col("predicted").isNotNull())
    act = S.features_ml(spark, sf_dir).select("region_id", F.col("time").alias("target_time"), F.col("demand_mw").alias("actual"))
    lp = long.join(act, ["region_id", "target_time"])
    return S.rounded(FC.r2_mae(lp))


@register(
    "forecast_macro_avg",
    O.sql(
        _R2
        + ", mh AS (SELECT region_id, CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) "
        "ELSE 1.0 - sse / sst END AS r2, mae FROM g), pr AS (SELECT region_id, avg(r2) AS avg_r2, avg(mae) AS avg_mae "
        "FROM mh GROUP BY 1) SELECT region_id, " + O.r4("avg_r2") + ", " + O.r4("avg_mae") + " FROM pr UNION ALL "
        "SELECT 'ALL' AS region_id, " + O.r4("avg(avg_r2)", "avg_r2") + ", " + O.r4("avg(avg_mae)", "avg_mae") + " FROM pr"
    ).replace("\n, lp AS", ", lp AS"),
)
def forecast_macro_avg(spark, sf_dir):
    long = FC.forecast_long(S.predictions(spark, sf_dir)).where(F.col("predicted").isNotNull())
    act = S.features_ml(spark, sf_dir).select("region_id", F.col("time").alias("target_time"), F.col("demand_mw").alias("actual"))
    return S.rounded(FC.macro_average(FC.r2_mae(long.join(act, ["region_id", "target_time"]))))

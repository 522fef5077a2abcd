"""Stored models to stored forecasts (M3, M5, S9), and boosted trees at the published settings (M1, M2)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.timecols import add_hours
from wattlake.ml import boost, store
from wattlake.ml import train as TR
from wattlake.operators import features as FT
from wattlake.operators import forecast as FC
from wattlake.plans import oracle_sql as O
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.plans.q_features import VAL_END
from wattlake.schemas import HORIZON_COLS, MAX_HORIZON
from wattlake.session import ensure_checkpoint_dir, shared_path
from wattlake.sources import sinks, standins

#: Versions of the stored model: rows up to the cut train them, some regions are left out, the last save broke off.
VERSIONS = [(1, "2024-01-10", ["SA1"], True), (2, "2024-01-20", ["SA1", "TAS1"], True), (3, "2024-01-25", [], False)]
#: Hours from here on are scored.
SCORED_FROM = "2024-01-20"
FEATURES = ["demand_mw", "temperature_2m"]


def _coefficients(pairs: DataFrame) -> DataFrame:
    """Mean of two simple regressions of the value ``horizon`` hours on: its own value now, the temperature now."""
    slope = lambda x: F.regr_slope("y", x)
    rest = (F.regr_intercept("y", "demand_mw") + F.regr_intercept("y", "temperature_2m")) / 2
    fit = pairs.groupBy("region_id", "horizon").agg(
        rest.alias("intercept"), F.array(slope("demand_mw") / 2, slope("temperature_2m") / 2).alias("weights")
    )
    return fit.where("intercept is not null")


def _stored_models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The newest finished models after three saves, and the hourly features."""
    hourly = S.features_ml(spark, sf_dir).select("time", "region_id", *FEATURES)
    horizons = F.explode(F.sequence(F.lit(1), F.lit(MAX_HORIZON))).alias("horizon")
    ahead = hourly.select("*", horizons).withColumn("target_time", add_hours("time", F.col("horizon")))
    actual = hourly.select(F.col("time").alias("target_time"), "region_id", F.col("demand_mw").alias("y"))
    pairs = ahead.join(actual, ["target_time", "region_id"])
    base = shared_path(spark, f"models-{uuid.uuid4().hex}")
    for version, cut, without, finish in VERSIONS:
        known = pairs.where((F.col("target_time") < F.lit(cut).cast("timestamp_ntz")) & ~F.col("region_id").isin(without))
        store.publish(_coefficients(known), base, version, FEATURES, finish)
    return store.latest(spark, base), hourly


def _cycle(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    models, hourly = _stored_models(spark, sf_dir)
    start = F.lit(SCORED_FROM).cast("timestamp_ntz")
    span = hourly.agg(F.max("time").alias("end")).where(F.col("end") >= start)
    hours = span.select(F.explode(F.sequence(start, F.col("end"), F.expr("INTERVAL 1 HOUR"))).alias("created_at"))
    wanted = hours.join(standins.regions(spark).select("region_id"))
    history = hourly.select("time", "region_id", "demand_mw")
    forecast = S.weather_hourly(spark, sf_dir).select("time", "region_id", "temperature_2m")
    return store.cycle(wanted, history, forecast, models, FEATURES)


_VERSION_ROWS = ", ".join(
    f"({v}, TIMESTAMP '{cut}', [{', '.join(repr(r) for r in without)}]::VARCHAR[], {str(finish).upper()})" for v, cut, without, finish in VERSIONS
)
_MODELS_SQL = f"""
, versions AS (SELECT * FROM (VALUES {_VERSION_ROWS}) AS t(version, cut, without, finished)),
pairs AS (
  SELECT f.region_id, h.h AS horizon, a.time AS target_time, f.demand_mw AS x1, f.temperature_2m AS x2, a.demand_mw AS y
  FROM features_ml f, (SELECT unnest(generate_series(1, {MAX_HORIZON})) AS h) h, features_ml a
  WHERE a.region_id = f.region_id AND a.time = f.time + to_hours(h.h)),
fits AS (
  SELECT version, finished, region_id, horizon, (regr_intercept(y, x1) + regr_intercept(y, x2)) / 2 AS b,
    regr_slope(y, x1) / 2 AS w1, regr_slope(y, x2) / 2 AS w2
  FROM pairs, versions WHERE target_time < cut AND NOT list_contains(without, region_id) GROUP BY ALL),
models AS (
  SELECT * FROM fits f WHERE b IS NOT NULL AND version = (
    SELECT max(version) FROM fits g WHERE g.region_id = f.region_id AND g.finished AND g.b IS NOT NULL)),
wanted AS (
  SELECT created_at, region_id FROM (
    SELECT unnest(generate_series(TIMESTAMP '{SCORED_FROM}', (SELECT max(time) FROM features_ml), INTERVAL 1 HOUR)) AS created_at), regions_dim),
judged AS (
  SELECT w.created_at, w.region_id, f.demand_mw AS x1, wh.temperature_2m AS x2,
    CASE WHEN f.time IS NULL THEN 'no_history' WHEN wh.time IS NULL THEN 'no_forecast'
      WHEN w.region_id NOT IN (SELECT region_id FROM models) THEN 'no_model' END AS reason
  FROM wanted w LEFT JOIN features_ml f ON f.time = w.created_at AND f.region_id = w.region_id
  LEFT JOIN weather_hourly wh ON wh.time = w.created_at AND wh.region_id = w.region_id)"""
_WIDE = ", ".join(O.r4(f"max(b + w1 * x1 + w2 * x2) FILTER (horizon = {h})", c) for h, c in enumerate(HORIZON_COLS, 1))


def _twin(body: str) -> str:
    return O.sql(_MODELS_SQL + body).replace("\n, versions AS", ", versions AS")


@register(
    "stored_scoring",
    _twin(f" SELECT created_at, j.region_id, {_WIDE} FROM judged j JOIN models m ON m.region_id = j.region_id "
          "WHERE reason IS NULL GROUP BY created_at, j.region_id"),
)
def stored_scoring(spark, sf_dir):
    """M3 + M5 + S9: three saves of a model (one unfinished), the newest finished one scored, forecasts stored first write wins."""
    forecasts, _ = _cycle(spark, sf_dir)
    base = shared_path(spark, f"forecasts-{uuid.uuid4().hex}")
    forecasts = forecasts.persist()
    try:
        for epoch in (0, 1):  # the second cycle brings other values for hours that have theirs
            rows = forecasts.select("created_at", "region_id", *[(F.col(c) + epoch).alias(c) for c in HORIZON_COLS])
            sinks.insert_absent_table(rows, base, ["created_at", "region_id"], epoch)
    finally:
        forecasts.unpersist()
    stored = sinks.read_table(spark, base, forecasts.schema)
    return S.rounded(stored if stored is not None else forecasts.limit(0))


@register("inference_skips", _twin(" SELECT reason, region_id, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL"))
def inference_skips(spark, sf_dir):
    """M5 + T7: regions and hours without a forecast, by reason."""
    return _cycle(spark, sf_dir)[1]


def boosted_metrics(spark: SparkSession, sf_dir: str, settings: boost.Settings) -> DataFrame:
    """R2 and MAE per region and horizon of boosted trees on the test rows, beside the seasonal-naive forecast's MAE."""
    series = S.daily_series(spark, sf_dir)
    wide, targets, feats = FT.features_wide(series)
    ensure_checkpoint_dir(spark)
    wide = wide.checkpoint(eager=True)
    end = F.lit(VAL_END).cast("timestamp_ntz")
    model = boost.train(wide.where(F.col("time") < end), feats, targets, settings)
    horizons = range(1, MAX_HORIZON + 1)
    tested = boost.predict(wide.where(F.col("time") >= end), model, feats, targets)
    pairs = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"target_h{h}").alias("actual"), F.col(f"predicted_target_h{h}").alias("predicted"))
        for h in horizons
    ])
    long = tested.select("region_id", "time", F.inline(pairs)).where("predicted is not null")
    naive = FC.forecast_long(FC.seasonal_naive(series)).select(
        "region_id", F.col("created_at").alias("time"), "horizon", F.col("predicted").alias("naive")
    )
    naive = long.join(naive, ["region_id", "time", "horizon"]).groupBy("region_id", "horizon").agg(
        F.avg(F.abs(F.col("actual") - F.col("naive"))).alias("naive_mae")
    )
    return S.rounded(TR.evaluate(long).join(naive, ["region_id", "horizon"], "left"))


@register("boosted_eval")
def boosted_eval(spark, sf_dir):
    """M1 + M2: 24 horizons of every region in vector-leaf trees at the published settings."""
    return boosted_metrics(spark, sf_dir, boost.Settings())

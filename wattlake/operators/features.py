"""Training features.

Upstream builds 24 shifted copies of the table and joins them 23 times.
Here every lag, rolling statistic and lead comes out of one window stage
(``row_window``: partitioned by (region, row block), with a 744-row
look-back and 24-row look-ahead overlap); horizons are then either
exploded (long) or selected as columns (wide).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from wattlake.operators.series import DEFAULT_BLOCK_ROWS, row_window
from wattlake.schemas import DEMAND_LAGS, MAX_HORIZON, PER_HORIZON, STATIC_FEATS, TEMP_LAGS, WEATHER_COLS

BASE_COLS = ["time", "region_id", "demand_mw", *WEATHER_COLS]
LEAD_COLS = [*WEATHER_COLS, "demand_mw"]
LONG_COLS = [
    "time",
    "region_id",
    "horizon",
    "demand_mw",
    *WEATHER_COLS,
    "hour",
    "day_of_week",
    "is_weekend",
    "month",
    *STATIC_FEATS,
    "temp_now",
    "target",
    "wind_power",
    "solar_potential",
    "temp_change",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "has_precip",
]


def _static_exprs(w: WindowSpec) -> dict[str, Column]:
    d, t = F.col("demand_mw"), F.col("temperature_2m")
    out: dict[str, Column] = {}
    for k in DEMAND_LAGS:
        out[f"demand_lag_{k}h"] = F.lag(d, k).over(w)
    for k in TEMP_LAGS:
        out[f"temp_lag_{k}h"] = F.lag(t, k).over(w)
    prev24 = w.rowsBetween(-24, -1)
    out["demand_rolling_mean_24h"] = F.avg(d).over(prev24)
    out["demand_rolling_std_24h"] = F.stddev_samp(d).over(prev24)
    out["demand_rolling_mean_168h"] = F.avg(d).over(w.rowsBetween(-168, -1))
    return out


def static_features(df: DataFrame, key: str = "region_id", order: str = "time", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """W1 + W2: row lags and trailing statistics that exclude the current row."""
    return row_window(df, key, order, _static_exprs, lookback=max(DEMAND_LAGS), block_rows=block_rows)


def horizon_base(df: DataFrame, key: str = "region_id", order: str = "time", horizons: int = MAX_HORIZON,
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Static features plus ``_ahead``: the next ``horizons`` rows as an array of
    structs (W3). One sliding ``collect_list`` replaces 24 x 7 ``lead`` calls;
    element ``h`` is the row ``h`` ahead (the array is shorter at the end)."""

    def build(w: WindowSpec) -> dict[str, Column]:
        out = _static_exprs(w)
        out["_ahead"] = F.collect_list(F.struct(*[F.col(c) for c in LEAD_COLS])).over(w.rowsBetween(1, horizons))
        return out

    base = df.select(*BASE_COLS)
    return row_window(base, key, order, build, lookback=max(DEMAND_LAGS), lookahead=horizons, block_rows=block_rows)


def _per_horizon_sql(h: str, lead: dict[str, str]) -> dict[str, str]:
    """P7-P9 at ``time + h hours`` as SQL expressions (one plan call for all
    horizons); ``h`` is an SQL integer expression, ``lead`` maps a column to
    the SQL reference of its value ``h`` rows ahead."""
    tt = f"(time + make_dt_interval(0, {h}))"
    hr, dow, mo = f"hour({tt})", f"weekday({tt})", f"month({tt})"
    two_pi = "(2D * pi())"
    return {
        **{c: lead[c] for c in WEATHER_COLS},
        "hour": hr,
        "day_of_week": dow,
        "is_weekend": f"CAST({dow} IN (5, 6) AS INT)",
        "month": mo,
        "target": lead["demand_mw"],
        "wind_power": f"pow({lead['wind_speed_10m']}, 3)",
        "solar_potential": f"{lead['shortwave_radiation']} * (1D - {lead['cloud_cover']} / 100D)",
        "temp_change": f"{lead['temperature_2m']} - temp_now",
        "hour_sin": f"sin({two_pi} * {hr} / 24D)",
        "hour_cos": f"cos({two_pi} * {hr} / 24D)",
        "dow_sin": f"sin({two_pi} * {dow} / 7D)",
        "dow_cos": f"cos({two_pi} * {dow} / 7D)",
        "month_sin": f"sin({two_pi} * {mo} / 12D)",
        "month_cos": f"cos({two_pi} * {mo} / 12D)",
        "has_precip": f"CAST(coalesce({lead['precipitation']}, 0D) > 0 AS INT)",
    }


def _ok_sql(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT isnan({c}))"


def horizon_long(df: DataFrame, horizons: int = MAX_HORIZON, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """R1 + P10: one complete row per (region, time, horizon)."""
    base = horizon_base(df, horizons=horizons, block_rows=block_rows).withColumn("temp_now", F.col("temperature_2m"))
    exploded = base.select(
        "time", "region_id", "demand_mw", *STATIC_FEATS, "temp_now",
        F.posexplode("_ahead").alias("_pos", "_lead"),
    ).withColumn("horizon", (F.col("_pos") + 1).cast("int"))
    feats = _per_horizon_sql("horizon", {c: f"_lead.{c}" for c in LEAD_COLS})
    long = exploded.selectExpr(*[f"{feats[c]} AS {c}" if c in feats else c for c in LONG_COLS])
    doubles = {f.name for f in long.schema.fields if f.dataType.typeName() == "double"}
    cond = " AND ".join(_ok_sql(c) if c in doubles else f"{c} IS NOT NULL" for c in LONG_COLS)
    return long.where(cond)


def wide_columns(horizons: int = MAX_HORIZON) -> tuple[list[str], list[str]]:
    targets = [f"target_h{h}" for h in range(1, horizons + 1)]
    feats = list(STATIC_FEATS) + [f"{c}_h{h}" for h in range(1, horizons + 1) for c in PER_HORIZON]
    return targets, feats


def features_wide(df: DataFrame, horizons: int = MAX_HORIZON, block_rows: int = DEFAULT_BLOCK_ROWS) -> tuple[DataFrame, list[str], list[str]]:
    """R2 + J8: one row per (region, time) that has all horizons complete.

    Columns: keys, 10 static, then per horizon the 13 features and the
    target. Equivalent to pivoting ``horizon_long`` and keeping keys with
    every horizon, without the 23 joins.
    """
    base = horizon_base(df, horizons=horizons, block_rows=block_rows).withColumn("temp_now", F.col("temperature_2m"))
    conds = [_ok_sql("demand_mw"), _ok_sql("temp_now"), *[_ok_sql(c) for c in STATIC_FEATS]]
    conds.append(f"size(_ahead) = {horizons}")
    conds += [f"forall(_ahead, x -> x.{c} IS NOT NULL AND NOT isnan(x.{c}))" for c in LEAD_COLS]
    kept = base.where(" AND ".join(conds))
    cols = ["region_id", "time", *STATIC_FEATS]
    for h in range(1, horizons + 1):
        feats = _per_horizon_sql(str(h), {c: f"_ahead[{h - 1}].{c}" for c in LEAD_COLS})
        cols += [f"{feats[c]} AS {c}_h{h}" for c in PER_HORIZON]
        cols.append(f"{feats['target']} AS target_h{h}")
    targets, feature_cols = wide_columns(horizons)
    return kept.selectExpr(*cols), targets, feature_cols


def chrono_split(df: DataFrame, train_end, val_end, col: str = "time") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train < train_end <= validation < val_end <= test."""
    t = F.col(col)
    a, b = F.lit(train_end).cast("timestamp_ntz"), F.lit(val_end).cast("timestamp_ntz")
    return df.where(t < a), df.where((t >= a) & (t < b)), df.where(t >= b)


def split_name(order: str, train_end: str, val_end: str) -> Column:
    """P15 as a column: the part of ``chrono_split`` that a row falls into, for one aggregate over all parts."""
    t = F.col(order)
    a, b = (F.lit(x).cast("timestamp_ntz") for x in (train_end, val_end))
    return F.when(t < a, "train").when(t < b, "validation").otherwise("test")

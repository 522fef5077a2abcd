"""Blocked windows must equal the plain single-partition window (exactness)."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattlake.operators.series import forward_fill, range_window, row_window


def _series(spark, n=300, gaps=True):
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for r, region in enumerate(["NSW1", "QLD1"]):
        k = 0
        for i in range(n):
            if gaps and (i * 7 + r) % 11 == 0:
                continue  # irregular series
            v = None if (i * 3 + r) % 13 == 0 else float(i * (r + 1) % 17)
            rows.append((t0 + dt.timedelta(hours=i), region, v, float(k)))
            k += 1
    return spark.createDataFrame(rows, "time timestamp_ntz, region_id string, x double, y double")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_row_window_equals_plain(spark):
    df = _series(spark)

    def build(w):
        return {
            "lag5": F.lag("y", 5).over(w),
            "lead3": F.lead("y", 3).over(w),
            "m": F.avg("y").over(w.rowsBetween(-7, -1)),
            "s": F.stddev_samp("y").over(w.rowsBetween(-7, -1)),
        }

    blocked = row_window(df, "region_id", "time", build, lookback=7, lookahead=3, block_rows=10,
                         chunk=F.date_trunc("day", "time"))
    plain_w = Window.partitionBy("region_id").orderBy("time")
    plain = df.select("*", *[e.alias(n) for n, e in build(plain_w).items()])
    cols = ["region_id", "time", "lag5", "lead3", "m", "s"]
    assert _rows(blocked, cols) == _rows(plain, cols)


def test_range_window_equals_plain(spark):
    df = _series(spark)
    H = 3600

    def build(w):
        return {"lag24": F.first("y").over(w.rangeBetween(-24 * H, -24 * H)), "m": F.avg("y").over(w.rangeBetween(-23 * H, -H))}

    blocked = range_window(df, "region_id", "time", build, lookback_seconds=24 * H, block_seconds=30 * H)
    w = Window.partitionBy("region_id").orderBy(F.unix_timestamp("time"))
    plain = df.select("*", *[e.alias(n) for n, e in build(w).items()])
    cols = ["region_id", "time", "lag24", "m"]
    assert _rows(blocked, cols) == _rows(plain, cols)


def test_forward_fill_equals_plain(spark):
    df = _series(spark)
    filled = forward_fill(df, ["x"], "region_id", "time", chunk=F.date_trunc("day", "time"))
    w = Window.partitionBy("region_id").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("x", F.last("x", ignorenulls=True).over(w))
    assert _rows(filled, ["region_id", "time", "x"]) == _rows(plain, ["region_id", "time", "x"])


def test_horizon_tables_do_not_depend_on_block_size(spark):
    """Blocks of 1000 rows (>= the 744-row look-back) cut each region's
    daily series into several blocks; results must equal one block."""
    from tests.conftest import SF_CHECK
    from wattlake.operators import features as FT
    from wattlake.plans import silver as S

    ds = S.daily_series(spark, SF_CHECK).persist()
    cols = ["region_id", "time", "horizon", "target", "demand_lag_744h", "temperature_2m", "demand_rolling_std_24h"]
    small = FT.horizon_long(ds, block_rows=1000).select(*cols)
    big = FT.horizon_long(ds).select(*cols)
    assert small.count() > 0
    assert small.exceptAll(big).count() == 0 and big.exceptAll(small).count() == 0
    ds.unpersist()


def test_wide_equals_pivot_of_long(spark):
    """R2: the wide table is the long table pivoted on horizon, keeping only
    keys that have all 24 horizons (the 23 inner joins upstream)."""
    from tests.conftest import SF_CHECK
    from wattlake.operators import features as FT
    from wattlake.plans import silver as S

    ds = S.daily_series(spark, SF_CHECK).persist()
    long = FT.horizon_long(ds)
    full = long.groupBy("region_id", "time").count().where("count = 24").select("region_id", "time")
    piv = (long.join(full, ["region_id", "time"])
           .groupBy("region_id", "time").pivot("horizon", list(range(1, 25)))
           .agg(F.first("target").alias("t"), F.first("temp_change").alias("c")))
    wide, _, _ = FT.features_wide(ds)
    w = wide.select("region_id", "time", *[F.col(f"target_h{h}").alias(f"{h}_t") for h in range(1, 25)],
                    *[F.col(f"temp_change_h{h}").alias(f"{h}_c") for h in range(1, 25)])
    p = piv.select(*w.columns)
    assert w.count() == p.count() > 0
    assert w.exceptAll(p).count() == 0
    ds.unpersist()


def test_summaries_stay_far_smaller_than_the_data(spark):
    """Chunks hold a bounded number of rows at an hourly and at a 5-minute grain."""
    from wattlake.operators.series import CHUNK_ROWS, time_chunk

    start = dt.datetime(2024, 1, 1)
    for grain, n in ((3600, 20_000), (300, 40_000)):
        times = spark.range(n).select((F.lit(start) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * grain)).cast("timestamp_ntz").alias("time"))
        sizes = [r["count"] for r in times.groupBy(time_chunk("time", grain)).count().collect()]
        assert max(sizes) <= CHUNK_ROWS and len(sizes) <= n // CHUNK_ROWS + 2

"""Micro-batch jobs: hour trigger (T4, T5), refresh chain (T13, T14), saved poll position.

Both streams run in ``foreachBatch``. Tables live on shared storage and are
marked with the batch's epoch after its work succeeded, so a replayed batch
repeats only what was not finished. Which hours were fired is state of the query.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.timecols import hour_floor
from wattlake.operators.clean import clean_demand
from wattlake.operators.gold import hourly_features
from wattlake.sources import sinks
from wattlake.streaming.changes import poll_increment
from wattlake.streaming.state import fired_hours, rocksdb

KEYS = ["time", "region_id"]


def hour_trigger(
    stream: DataFrame,
    state_path: str,
    on_hours: Callable[[DataFrame], object] | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    feed: str = "demand",
):
    """Start the trigger query; ``on_hours(hours)`` runs the work of a batch's fired hours.

    Which hours fire is decided by the processor of ``state.fired_hours``, whose
    last hour lives in the checkpoint. ``hours`` is a DataFrame ``(feed, hour)``,
    so the work is a plan over all of them, not a loop on the driver. Hours are
    appended to ``state_path`` under the batch's epoch after the work (T5): if it
    fails, the query stops without committing the batch, and the restarted query
    fires the same hours again and no others.
    """
    spark = stream.sparkSession

    def batch_fn(batch: DataFrame, epoch_id: int) -> None:
        hours = batch.persist()
        try:
            if on_hours is not None and not hours.isEmpty():
                on_hours(hours)
            sinks.append(hours.withColumn("epoch", F.lit(epoch_id).cast("bigint")), state_path, epoch_id, f"hours-{feed}")
        finally:
            hours.unpersist()

    w = fired_hours(stream, feed).writeStream.foreachBatch(batch_fn).outputMode("append")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    with rocksdb(spark):
        return w.trigger(**(trigger or {"availableNow": True})).start()


def refresh_batch(
    batch: DataFrame, base: str, epoch_id: int, weather: DataFrame | None = None, writer: str = "refresh"
) -> int:
    """One step of the chain: bronze demand, then silver demand, then the features of the touched hours.

    ``batch`` is ``(time, region_id, demand_mw, position)``; of several updates
    of a key the greatest position wins, across batches too. Features are
    recomputed only for hours that the batch touches, from silver demand and
    the hourly ``weather`` rows. Returns the bronze rows written.
    """
    spark = batch.sparkSession
    rows = batch.select(*KEYS, "demand_mw", "position").persist()
    try:
        n = sinks.upsert_newest_table(rows, f"{base}/bronze_demand", KEYS, "position", epoch_id, writer)
        days = [r.d for r in rows.select(F.date_format("time", "yyyy-MM-dd").alias("d")).distinct().collect()]
        bronze = sinks.read_table(spark, f"{base}/bronze_demand", days=days)
        if bronze is None:
            return n
        current = bronze.join(rows.select(*KEYS).distinct(), KEYS, "left_semi")
        sinks.delete_insert_table(clean_demand(current), f"{base}/silver_demand", KEYS, epoch_id, writer)
        silver = sinks.read_table(spark, f"{base}/silver_demand", days=days)
        if silver is None or weather is None:
            return n
        hours = rows.select(hour_floor("time").alias("_hour"), F.col("region_id").alias("_region")).distinct()
        touched = silver.join(hours, (hour_floor("time") == F.col("_hour")) & (F.col("region_id") == F.col("_region")), "left_semi")
        sinks.upsert_table(hourly_features(touched, weather), f"{base}/features", KEYS, None, epoch_id, writer)
        return n
    finally:
        rows.unpersist()


def start_refresh(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    weather: Callable[[SparkSession], DataFrame] | None = None,
    trigger: dict | None = None,
    on_rows: Callable[[SparkSession, int], None] | None = None,
    writer: str = "refresh",
):
    """T13 + T14: run ``refresh_batch`` on every micro-batch, then ``on_rows(spark, rows)``.

    Micro-batches never overlap. Each table commits with the batch's epoch, so
    a replay resumes behind the last table that was written. A restart with a
    new checkpoint needs a new ``writer`` name, as its epochs start over.
    """

    def batch_fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        n = refresh_batch(batch, base, epoch_id, weather(spark) if weather else None, writer)
        if on_rows is not None:
            on_rows(spark, n)

    return (
        stream.writeStream.foreachBatch(batch_fn)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def poll(
    rows: DataFrame, base: str, keys: list[str], lookback_minutes: int = 30, as_of: dt.datetime | None = None
) -> int:
    """Write the rows after the saved position to ``<base>/rows`` and save the new position.

    The position is the newest time written; it is saved after the rows, so a
    failure between the two repeats rows that the keyed write then replaces.
    """
    spark = rows.sparkSession
    saved = sinks.read_table(spark, f"{base}/position")
    last = saved.agg(F.max("position")).first()[0] if saved is not None else None
    fresh = poll_increment(rows, last, lookback_minutes, as_of).persist()
    try:
        newest = fresh.agg(F.max("time").alias("position"))
        n = sinks.upsert_table(fresh, f"{base}/rows", keys)
        sinks.append(newest.where("position is not null"), f"{base}/position")
        return n
    finally:
        fresh.unpersist()

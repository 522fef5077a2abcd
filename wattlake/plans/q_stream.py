"""Step 9: Structured Streaming queries run to completion with ``availableNow``.

The driver's ``events`` file is replayed as a change feed: every row becomes
a JSON change envelope, is decoded (T1-T3) and fed to the stateful operator.
Outputs land under the shared checkpoint folder and are read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wattlake.functions.timecols import epoch_seconds, minute_floor
from wattlake.plans import oracle_sql as O
from wattlake.plans.catalog import register
from wattlake.session import shared_path
from wattlake.sources import sinks, standins
from wattlake.streaming import changes as CH
from wattlake.streaming import refresh as RF


def _after(ev: DataFrame, time) -> Column:
    region = standins._map_lookup(standins.DEMAND_REGION_OF_EVENT, F.col("event_type"))
    return F.struct(time.alias("time"), region.alias("region_id"), F.col("value").cast("string").alias("demand_mw"))


def _event_time() -> Column:
    """Times as feeds send them: naive text, epoch micros and text with a zone offset, by the event's minute."""
    text = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    zoned = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 10 HOURS"), text), F.lit("+10:00"))
    fraction = F.date_format("ts", "SSSSSS").cast("bigint")
    micros = (F.floor(epoch_seconds("ts")).cast("bigint") * 1_000_000 + fraction).cast("string")
    kind = F.minute("ts") % 3
    return F.when(kind == 0, F.date_format("ts", text)).when(kind == 1, micros).otherwise(zoned)


def _envelopes(ev: DataFrame, *more: Column) -> DataFrame:
    """Each event row as a JSON change envelope, with ``more`` columns; the events of some minutes bring bad messages along.

    Minute 7: text that is no JSON; 17: a delete; 27: an unknown region; 37: a
    time that cannot be read; 47: a value that is no number; 57: no time.
    """

    def message(after) -> Column:
        return F.to_json(F.struct(F.struct(after.alias("after"), F.lit("c").alias("op")).alias("payload")))

    good = _after(ev, _event_time())
    bad = (
        F.when(F.minute("ts") == 7, F.lit("{not json"))
        .when(F.minute("ts") == 17, F.lit('{"payload": {"before": {}, "after": null, "op": "d"}}'))
        .when(F.minute("ts") == 27, message(good.withField("region_id", F.lit("XX9"))))
        .when(F.minute("ts") == 37, message(good.withField("time", F.lit("yesterday"))))
        .when(F.minute("ts") == 57, message(good.withField("time", F.lit(None).cast("string"))))
        .when(F.minute("ts") == 47, message(good.withField("time", F.lit(None).cast("string")).withField("demand_mw", F.lit("n/a"))))
    )
    return ev.select(F.explode(F.filter(F.array(message(good), bad), lambda m: m.isNotNull())).alias("value"), *more)


def _change_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = 1) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of files."""
    reader = spark.readStream.schema(standins.read(spark, sf_dir, "events").schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a pattern, since the stream reader takes a plain path for a folder
    return CH.decode_changes(_envelopes(reader.parquet(f"{sf_dir}/events.parque[t]")))


def _change_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CH.decode_changes(_envelopes(standins.read(spark, sf_dir, "events")))


def _run_dir(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


_REGION_CASE = standins._sql_case(standins.DEMAND_REGION_OF_EVENT, "event_type")


@register(
    "stream_latest",
    O.sql(
        f"SELECT DISTINCT ON (region_id) {_REGION_CASE} AS region_id, ts AS time, {O.r4('value', 'demand_mw')} "
        "FROM events ORDER BY region_id, ts DESC"
    ),
)
def stream_latest(spark, sf_dir):
    """T9 (+ T1-T3): latest value per region kept as streaming state."""
    base = _run_dir(spark, "latest")
    agg = CH.latest_stream(_change_stream(spark, sf_dir))

    def write(batch: DataFrame, epoch_id: int) -> None:
        # every epoch has its own folder, so a batch that dies half-way leaves the one before it
        sinks.overwrite_parts(batch.withColumn("epoch", F.lit(epoch_id).cast("bigint")), f"{base}/out", "epoch")

    q = (
        agg.writeStream.outputMode("complete").foreachBatch(write)
        .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    from wattlake.plans.silver import rounded

    out = sinks.open_folder(spark, f"{base}/out", StructType([*agg.schema.fields, StructField("epoch", LongType())]))
    if out is None:
        return rounded(spark.createDataFrame([], agg.schema))
    newest = out.where(F.col("epoch") == out.select(F.max("epoch")).scalar())
    return rounded(newest.select("region_id", "time", "demand_mw"))


@register(
    "stream_dedup",
    O.sql(
        f"SELECT DISTINCT {_REGION_CASE} AS region_id, "
        "date_trunc('hour', ts) + to_minutes(CAST((minute(ts) // 5) * 5 AS BIGINT)) AS time FROM events"
    ),
)
def stream_dedup(spark, sf_dir):
    """Duplicate suppression of (region, 5-minute interval); only repeats go, in any file layout."""
    base = _run_dir(spark, "dedup")
    keyed = _change_stream(spark, sf_dir).select("region_id", minute_floor("time", 5).alias("time"))
    q = (
        CH.dedupe_stream(keyed, ["region_id", "time"]).writeStream.format("parquet")
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register(
    "stream_hour_trigger",
    O.sql("SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events WHERE minute(ts) = 0"),
)
def stream_hour_trigger(spark, sf_dir):
    """T4 + T5: hours fired by the hour-boundary trigger, whose last hour is state of the query.

    The whole table is one micro-batch, so that no file order makes an hour late.
    """
    base = _run_dir(spark, "trigger")
    q = RF.hour_trigger(_change_stream(spark, sf_dir, None), f"{base}/state", checkpoint=f"{base}/ckpt")
    q.awaitTermination()
    fired = sinks.read_table(spark, f"{base}/state", "feed string, hour timestamp_ntz, epoch bigint")
    return (fired if fired is not None else spark.createDataFrame([], "hour timestamp_ntz")).select("hour")


_TIME_TEXT = (
    "CASE minute(ts) % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') WHEN 1 THEN CAST(epoch_us(ts) AS VARCHAR) "
    "ELSE strftime(ts + INTERVAL 10 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+10:00' END"
)


@register(
    "live_projection",
    O.sql(
        f", sent AS (SELECT {_TIME_TEXT} AS timestamp, {_REGION_CASE} AS region_id, value, minute(ts) AS m FROM events) "
        f"SELECT 'demand_update' AS type, timestamp, region_id, {O.r4('value', 'demand_mw')} FROM sent "
        f"UNION ALL SELECT 'demand_update', timestamp, 'XX9', {O.r4('value', 'demand_mw')} FROM sent WHERE m = 27 "
        f"UNION ALL SELECT 'demand_update', 'yesterday', region_id, {O.r4('value', 'demand_mw')} FROM sent WHERE m = 37 "
        f"UNION ALL SELECT 'demand_update', NULL, region_id, {O.r4('value', 'demand_mw')} FROM sent WHERE m = 57"
    ).replace("\n, sent AS", ", sent AS"),
)
def live_projection(spark, sf_dir):
    """T8 over the change feed, bad messages included (batch twin of the live fan-out)."""
    from wattlake.plans.silver import rounded

    return rounded(CH.live_updates(_envelopes(standins.read(spark, sf_dir, "events"))))


@register(
    "change_counters",
    "SELECT count(*) + count(*) FILTER (minute(ts) IN (7, 17, 27, 37, 47, 57)) AS received, count(*) AS decoded, "
    "count(*) FILTER (minute(ts) = 7) AS skipped_bad_json, count(*) FILTER (minute(ts) = 17) AS skipped_deleted, "
    "count(*) FILTER (minute(ts) IN (47, 57)) AS skipped_no_time, count(*) FILTER (minute(ts) = 27) AS skipped_unknown_region, "
    "count(*) FILTER (minute(ts) = 37) AS skipped_bad_time FROM events",
)
def change_counters(spark, sf_dir):
    """T7 (+ T1-T3): messages received, decoded and skipped by reason."""
    return CH.change_counters(_envelopes(standins.read(spark, sf_dir, "events")))


@register(
    "stream_refresh",
    O.sql(
        f", b AS (SELECT date_trunc('hour', ts) + to_minutes(CAST((minute(ts) // 5) * 5 AS BIGINT)) AS time, {_REGION_CASE} AS region_id, "
        "arg_max(value, ROW(ts, value)) AS demand_mw FROM events GROUP BY 1, 2), "
        "h AS (SELECT date_trunc('hour', time) AS time, region_id, avg(demand_mw) AS demand_mw FROM b GROUP BY 1, 2) "
        f"SELECT h.time, h.region_id, {O.r4('h.demand_mw', 'demand_mw')}, {O.r4('w.temperature_2m', 'temperature_2m')} "
        "FROM h LEFT JOIN weather_hourly w ON w.time = h.time AND w.region_id = h.region_id"
    ).replace("\n, b AS", ", b AS"),
)
def stream_refresh(spark, sf_dir):
    """T13 + T14 + S7, S8: the feed runs through bronze, silver and features twice; equals a full build.

    Several events of a 5-minute key arrive in one batch and again in the
    second run; the newest event of a key wins (position: its time).
    """
    from wattlake.plans import silver as S

    base = _run_dir(spark, "refresh")
    for run in ("first", "again"):
        changes = _change_stream(spark, sf_dir)
        keyed = changes.select(
            minute_floor("time", 5).alias("time"), "region_id", "demand_mw", F.col("time").alias("position")
        )
        q = RF.start_refresh(keyed, base, f"{base}/ckpt-{run}", lambda s: S.weather_hourly(s, sf_dir), writer=run)
        q.awaitTermination()
    features = sinks.read_table(spark, f"{base}/features")
    return S.rounded(features.select("time", "region_id", "demand_mw", "temperature_2m"))


@register(
    "region_staleness",
    O.sql(
        f", c AS (SELECT {_REGION_CASE} AS region_id, ts FROM events), m AS (SELECT max(ts) AS t FROM c) "
        "SELECT region_id, max(ts) AS last_time, "
        "CAST(floor(epoch(any_value(m.t))) - floor(epoch(max(ts))) AS BIGINT) AS staleness_seconds FROM c, m GROUP BY region_id"
    ).replace("\n, c AS", ", c AS"),
)
def region_staleness(spark, sf_dir):
    """Seconds since each region's last event, as of the newest event."""
    newest = _change_batch(spark, sf_dir).groupBy("region_id").agg(F.max("time").alias("time"))
    # one row per region: the newest time of all is taken from these, not from a second pass
    return CH.staleness(newest, newest.select(F.max("time")).scalar())


@register(
    "retention_prune",
    O.sql(
        f"SELECT time, region_id, {O.r4('demand_mw')} FROM demand_5min "
        "WHERE time >= (SELECT max(time) FROM demand_5min) - INTERVAL 7 DAY"
    ),
)
def retention_prune(spark, sf_dir):
    """Keep the last 7 days relative to the newest row."""
    from wattlake.plans import silver as S

    dm = S.demand_5min(spark, sf_dir)
    return S.rounded(CH.prune(dm, dm.select(F.max("time")).scalar(), 7))

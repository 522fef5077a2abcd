"""Files, polls, backfills and streams that stop and go on; global order."""

from __future__ import annotations

import io
import datetime as dt
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from wattlake.operators import incremental as INC
from wattlake.operators.ordering import with_position
from wattlake.plans import oracle_sql as O
from wattlake.plans import q_stream as QS
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.session import shared_path
from wattlake.sources import ingest, sinks, standins
from wattlake.streaming import changes as CH
from wattlake.streaming.counters import ChangeCounters, counted_changes, metrics_summary
from wattlake.streaming.harness import run_with_stops
from wattlake.streaming.polling import PollSource

KEYS = ["time", "region_id"]
_REGION_CASE = QS._REGION_CASE

# ---- report zips ---------------------------------------------------------
_HEAD = "C,NEMP.WORLD,DISPATCHIS\nI,DISPATCH,REGIONSUM,SETTLEMENTDATE,REGIONID,TOTALDEMAND\n"


def _zipped(table: pa.Table) -> pa.Table:
    """The lines of one report file as a zip; reports of some hours break off or are no text."""
    path = table.column("path")[0].as_py()
    hour = int(path[-8:-6])
    lines = sorted(table.column("line").to_pylist())
    text = (_HEAD + "\n".join(lines) + "\n").encode("utf-8-sig" if hour % 2 else "utf-8")
    if hour % 7 == 5:
        text += b"\xff\xfe\n"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("report.CSV", text)
    content = out.getvalue()
    return pa.table({"path": [path], "content": [content[:len(content) // 2] if hour % 7 == 3 else content]},
                    schema=pa.schema([("path", pa.string()), ("content", pa.binary())]))


@register(
    "zip_ingest",
    "WITH f AS (SELECT 'PUBLIC_DISPATCHIS_' || strftime(ts, '%Y%m%d%H') || '00.zip' AS file, hour(ts) % 7 AS h, value FROM events) "
    "SELECT file, CASE WHEN h = 3 THEN 'BadZipFile' WHEN h = 5 THEN 'UnicodeDecodeError' END AS error, "
    "CAST(CASE WHEN h IN (3, 5) THEN 0 ELSE count(*) END AS BIGINT) AS n_rows, "
    f"{O.r4('CASE WHEN h IN (3, 5) THEN NULL ELSE sum(value) END', 'demand_mw')} FROM f GROUP BY file, h",
)
def zip_ingest(spark, sf_dir):
    """S1 + S2 + error table: hourly report zips made from the events, stored, read back; per file its rows or why it has none."""
    ev = standins.read(spark, sf_dir, "events")
    region = standins._map_lookup(standins.DEMAND_REGION_OF_EVENT, F.col("event_type"))
    path = F.concat(F.lit("PUBLIC_DISPATCHIS_"), F.date_format("ts", "yyyyMMddHH"), F.lit("00.zip"))
    line = F.concat_ws(",", F.lit("D"), F.lit("DISPATCH"), F.lit("REGIONSUM"), F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), region, F.col("value"))
    files = ev.select(path.alias("path"), line.alias("line")).groupBy("path").applyInArrow(_zipped, "path string, content binary")
    base = shared_path(spark, f"zips-{uuid.uuid4().hex}")
    files.write.parquet(base)
    lines = ingest.zip_lines(spark.read.parquet(base))
    lines.write.parquet(f"{base}-lines")
    lines = spark.read.schema(lines.schema).parquet(f"{base}-lines")
    found = ingest.parse_dispatch(lines.where("error is null"))
    value = ingest._field(F.col("header"), F.col("values"), "TOTALDEMAND").try_cast("double")
    read = found.groupBy("file").agg(F.count("*").alias("n_rows"), F.sum(value).alias("demand_mw"))
    failed = ingest.unreadable(lines).select(
        "file", F.substring_index("error", ":", 1).alias("error"), F.lit(0).cast("long").alias("n_rows"), F.lit(None).cast("double").alias("demand_mw")
    )
    return S.rounded(read.select("file", F.lit(None).cast("string").alias("error"), "n_rows", "demand_mw").unionAll(failed))


# ---- backfill ------------------------------------------------------------
@register("backfill_resumed", O.sql(f"SELECT time, region_id, {O.r4('demand_mw')} FROM bronze_demand"))
def backfill_resumed(spark, sf_dir):
    """S14 + S7: a backfill in weekly slices that breaks off in its third slice, then goes on from the ledger; equals a full load."""
    bronze = standins.bronze_demand(spark, sf_dir)
    base = shared_path(spark, f"backfill-{uuid.uuid4().hex}")
    first, last = bronze.agg(F.min("time"), F.max("time")).first()
    if first is None:
        return S.rounded(bronze)
    start = dt.datetime(first.year, first.month, first.day)
    loaded, fail = [], [True]

    def load(a, b):
        loaded.append(a)
        if len(loaded) == 3 and fail[0]:
            fail[0] = False
            raise RuntimeError("the source went away")
        span = (F.col("time") >= F.lit(a).cast("timestamp_ntz")) & (F.col("time") < F.lit(b).cast("timestamp_ntz"))
        return bronze.where(span)

    for _ in range(2):
        try:
            INC.run_backfill(spark, base, KEYS, load, start, last + dt.timedelta(microseconds=1))
            break
        except RuntimeError:
            continue
    return S.rounded(sinks.read_table(spark, f"{base}/rows", bronze.schema).select("time", "region_id", "demand_mw"))


# ---- polling -------------------------------------------------------------
POLL_CUT = "2024-01-12T07:00:00"


@register("poll_stream", O.sql(f"SELECT time, region_id, {O.r4('demand_mw')} FROM bronze_demand"))
def poll_stream(spark, sf_dir):
    """A polling source that stops and is started again; its position is the checkpoint, no row is lost or repeated."""
    base = QS._run_dir(spark, "poll")
    bronze = standins.bronze_demand(spark, sf_dir)
    bronze.write.parquet(f"{base}/service")
    spark.dataSource.register(PollSource)
    newest = bronze.agg(F.max("time")).first()[0]
    for as_of in (POLL_CUT, (newest or dt.datetime(2024, 1, 1)).isoformat()):
        polled = (
            spark.readStream.format("wattlake_poll").schema(bronze.schema).option("path", f"{base}/service")
            .option("lookbackMinutes", 90 * 24 * 60).option("asOf", as_of).load()
        )
        query = polled.writeStream.option("checkpointLocation", f"{base}/ckpt").trigger(processingTime="0 seconds").start(f"{base}/out")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return S.rounded(spark.read.schema(bronze.schema).parquet(f"{base}/out"))


# ---- restart -------------------------------------------------------------
BATCHES = 5


def _feed(events, path: str) -> int:
    """Write the feed in time ranges, so many that a batch has a file for every core; the files of a batch."""
    spark = events.sparkSession
    events.repartitionByRange(BATCHES * spark.sparkContext.defaultParallelism, "ts").write.parquet(path)
    # ranges without rows have no file
    files = len(spark.read.schema(events.schema).parquet(path).inputFiles())
    return max(-(-files // BATCHES), 1)


@register("stream_restart", O.sql(f"SELECT ts AS time, {_REGION_CASE} AS region_id, {O.r4('value', 'demand_mw')} FROM events"))
def stream_restart(spark, sf_dir):
    """T11 + T13: the feed in several files, killed after the work of two batches and started again; equals one run."""
    base = QS._run_dir(spark, "restart")
    events = standins.read(spark, sf_dir, "events")
    files = _feed(events, f"{base}/feed")

    def stream():
        raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/feed")
        return CH.decode_changes(QS._envelopes(raw))

    run_with_stops(stream, lambda batch, epoch: sinks.append(batch, f"{base}/out", epoch, "feed"), f"{base}/ckpt", stop_at=(1, 3))
    return S.rounded(sinks.read_table(spark, f"{base}/out").select("time", "region_id", "demand_mw"))


@register("change_feed", O.sql(f"SELECT ts AS time, {_REGION_CASE} AS region_id, {O.r4('value', 'demand_mw')} FROM events"))
def change_feed(spark, sf_dir):
    """S13 + T11: change messages as text files, read from the earliest; more arrive while the query is down, and only they are read then."""
    base = QS._run_dir(spark, "feed")
    events = standins.read(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(POLL_CUT).cast("timestamp_ntz")
    for part in (early, ~early):
        QS._envelopes(events.where(part)).write.mode("append").text(f"{base}/feed")
        changes = CH.decode_changes(CH.read_changes(spark, f"{base}/feed", start="earliest"))
        query = changes.writeStream.option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start(f"{base}/out")
        query.awaitTermination()
    return S.rounded(spark.read.schema(changes.schema).parquet(f"{base}/out"))


# ---- metrics -------------------------------------------------------------
@register(
    "stream_metrics",
    "SELECT count(*) + count(*) FILTER (minute(ts) IN (7, 17, 27, 37, 47, 57)) AS received, count(*) AS decoded, "
    "count(*) FILTER (minute(ts) = 7) AS skipped_bad_json, count(*) FILTER (minute(ts) = 17) AS skipped_deleted, "
    "count(*) FILTER (minute(ts) IN (47, 57)) AS skipped_no_time, count(*) FILTER (minute(ts) = 27) AS skipped_unknown_region, "
    "count(*) FILTER (minute(ts) = 37) AS skipped_bad_time, CAST(sum(user_id % 97) AS BIGINT) AS latency_sum, "
    "CAST(max(user_id % 97) AS BIGINT) AS latency_max, TRUE AS median_near FROM events",
)
def stream_metrics(spark, sf_dir):
    """Counts and latency of a stream from the metrics table that its listener fills; the sketched median is near the true one."""
    base = QS._run_dir(spark, "metrics")
    events = standins.read(spark, sf_dir, "events")
    raw = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    arrival = (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("user_id") % 97)).alias("arrival")
    counters = ChangeCounters()
    spark.streams.addListener(counters)
    try:
        counted = counted_changes(QS._envelopes(raw, arrival), arrival="arrival")
        counted.writeStream.format("noop").option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start().awaitTermination()
        counters.wait_ended()
    finally:
        spark.streams.removeListener(counters)
    counters.write(spark, f"{base}/metrics")
    totals = metrics_summary(spark.read.parquet(f"{base}/metrics"), (0.5,)).drop("batches")
    below = events.agg(
        F.avg((F.col("user_id") % 97 < totals.select("latency_p50").scalar()).cast("double")).alias("less"),
        F.avg((F.col("user_id") % 97 <= totals.select("latency_p50").scalar()).cast("double")).alias("most"),
    )
    return totals.join(below).select(
        *[c for c in totals.columns if c != "latency_p50"], ((F.col("less") <= 0.52) & (F.col("most") >= 0.48)).alias("median_near")
    )


# ---- order ---------------------------------------------------------------
@register(
    "ordered_history",
    O.sql(f"SELECT row_number() OVER (ORDER BY time, region_id) AS position, time, region_id, {O.r4('demand_mw')} FROM demand_5min"),
)
def ordered_history(spark, sf_dir):
    """L1: every demand row with its place in the order of time and region."""
    placed = with_position(S.demand_5min(spark, sf_dir).select("time", "region_id", "demand_mw"), ["time", "region_id"])
    return S.rounded(placed.select(F.col("position").cast("long").alias("position"), "time", "region_id", "demand_mw"))

"""Change-feed decoding and stream transforms.

Every function takes a DataFrame and works the same on a streaming or a
batch frame, so streams are tested with ``availableNow`` over files and the
batch twin is the oracle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.timecols import add_hours
from wattlake.schemas import VALID_REGIONS

# Change-event envelope: {"payload": {"before": ..., "after": {...}, "op": ...}}
ROW_SCHEMA = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("region_id", T.StringType()),
        T.StructField("demand_mw", T.StringType()),
    ]
)
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("before", ROW_SCHEMA),
                    T.StructField("after", ROW_SCHEMA),
                    T.StructField("op", T.StringType()),
                ]
            ),
        )
    ]
)
_ZONED = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def read_changes(
    spark: SparkSession, path: str | None, fmt: str = "text", options: dict | None = None, start: str = "latest"
) -> DataFrame:
    """S13 + T11: change events as a stream of JSON text, from files or ``kafka``.

    ``start`` is where a query without a checkpoint begins: ``latest`` (only
    new messages) or ``earliest``; files start with all that are there, and
    with ``latest`` take the newest first.
    """
    own = {"startingOffsets": start} if fmt == "kafka" else {"latestFirst": str(start == "latest").lower()}
    r = spark.readStream.format(fmt).options(**(own | (options or {})))
    df = r.load(path) if path is not None else r.load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"), "timestamp")
    return df


def event_time_utc(raw: Column, session_tz: str) -> Column:
    """Epoch micros or ISO text -> UTC wall time (NTZ); naive text is UTC; bad -> null.

    Digits take the micros path (checked by a regex, so ISO text never goes
    through a failing numeric cast); text is parsed once.
    """
    tz, utc = F.lit(session_tz), F.lit("UTC")
    micros = raw.cast("bigint")
    from_micros = F.convert_timezone(tz, utc, F.timestamp_micros(micros).cast("timestamp_ntz"))
    local = F.try_to_timestamp(raw).cast("timestamp_ntz")
    return (
        F.when(raw.rlike(r"^-?[0-9]{1,18}$"), from_micros)
        .when(raw.rlike(_ZONED), F.convert_timezone(tz, utc, local))
        .otherwise(local)
    )


def decode_changes(
    raw: DataFrame, value_col: str = "value", regions: Sequence[str] = VALID_REGIONS, keep: Sequence[str] = ()
) -> DataFrame:
    """Parse envelopes; skip bad JSON, deletes (no ``after``), unknown
    regions and unparsable times. Output ``(time, region_id, demand_mw)`` and
    the columns of ``keep`` (a source position, say)."""
    tz = raw.sparkSession.conf.get("spark.sql.session.timeZone")
    env = F.from_json(F.col(value_col), ENVELOPE_SCHEMA, {"mode": "PERMISSIVE"})
    d = raw.select(env.alias("e"), *keep).select("e.payload.after.*", *keep)
    d = d.where(F.col("time").isNotNull() & F.col("region_id").isin(*regions))
    t = event_time_utc(F.col("time"), tz)
    return d.select(t.alias("time"), "region_id", F.col("demand_mw").try_cast("double").alias("demand_mw"), *keep).where(
        F.col("time").isNotNull()
    )


SKIP_REASONS = ["bad_json", "deleted", "no_time", "unknown_region", "bad_time"]


def classify_changes(
    raw: DataFrame, value_col: str = "value", regions: Sequence[str] = VALID_REGIONS, keep: Sequence[str] = ()
) -> DataFrame:
    """Every envelope with its skip reason (null = decoded). Count with
    ``groupBy('skip_reason')`` in batch, or ``observe`` on a stream; ``keep`` names further columns of ``raw``."""
    tz = raw.sparkSession.conf.get("spark.sql.session.timeZone")
    env = F.from_json(F.col(value_col), ENVELOPE_SCHEMA, {"mode": "PERMISSIVE"})
    d = raw.select(env.alias("e"), F.col(value_col).alias("_raw"), *keep)
    a = F.col("e.payload.after")
    t = event_time_utc(a["time"], tz)
    reason = (
        F.when(F.try_parse_json(F.col("_raw")).isNull(), F.lit("bad_json"))
        .when(a.isNull(), F.lit("deleted"))
        .when(a["time"].isNull(), F.lit("no_time"))
        .when(~F.coalesce(a["region_id"].isin(*regions), F.lit(False)), F.lit("unknown_region"))
        .when(t.isNull(), F.lit("bad_time"))
    )
    value = a["demand_mw"].try_cast("double").alias("demand_mw")
    return d.select(reason.alias("skip_reason"), t.alias("time"), a["region_id"].alias("region_id"), value, *keep)


def change_counters(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """T7 batch form: events received, decoded and skipped by reason, one row."""
    c = classify_changes(raw, value_col)
    return c.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("skip_reason").isNull()).alias("decoded"),
        *[F.count_if(F.col("skip_reason") == r).alias(f"skipped_{r}") for r in SKIP_REASONS],
    )


def live_updates(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The fan-out projection of change envelopes.

    The event's time is passed through as it came and the region is not checked
    against the list; messages without a region or a numeric value are dropped.
    """
    after = F.from_json(F.col(value_col), ENVELOPE_SCHEMA, {"mode": "PERMISSIVE"})["payload"]["after"]
    value = after["demand_mw"].try_cast("double")
    return raw.select(
        F.lit("demand_update").alias("type"), after["time"].alias("timestamp"), after["region_id"].alias("region_id"),
        value.alias("demand_mw"),
    ).where((F.col("region_id") != "") & F.col("demand_mw").isNotNull())


def latest_stream(changes: DataFrame) -> DataFrame:
    """Latest value per region (event time, not arrival order); update mode."""
    s = F.max_by(F.struct("time", "demand_mw"), F.col("time")).alias("_l")
    return changes.groupBy("region_id").agg(s).select("region_id", "_l.time", "_l.demand_mw")


def dedupe_stream(changes: DataFrame, keys: Sequence[str] = ("region_id", "time"), window: str | None = None) -> DataFrame:
    """Drop repeats of a key, and nothing else.

    Without ``window`` every key is remembered, so neither file layout nor
    timing decides the rows. With one (such as ``2 minutes``) a key is
    forgotten that long after it arrived: the watermark is on arrival, so a
    late event is never dropped, and state is bounded by the arrivals of the
    window.
    """
    if window is None:
        return changes.dropDuplicates(list(keys))
    arrived = changes.withColumn("_arrival", F.current_timestamp())
    return arrived.withWatermark("_arrival", window).dropDuplicatesWithinWatermark(list(keys)).drop("_arrival")


def staleness(changes: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Seconds since the last event per region."""
    ref = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    last = changes.groupBy("region_id").agg(F.max("time").alias("last_time"))
    return last.select(
        "region_id", "last_time", (F.unix_timestamp(ref) - F.unix_timestamp("last_time")).alias("staleness_seconds")
    )


def poll_increment(rows: DataFrame, last_time: dt.datetime | None, lookback_minutes: int = 30,
                   as_of: dt.datetime | None = None) -> DataFrame:
    """T12 batch twin: rows of the look-back window newer than the saved position.

    The new position is ``max(time)`` of the result (read it with one aggregate).
    """
    d = rows
    if as_of is not None:
        a = F.lit(as_of).cast("timestamp_ntz")
        d = d.where(F.col("time") >= a - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(lookback_minutes)))
    if last_time is not None:
        d = d.where(F.col("time") > F.lit(last_time).cast("timestamp_ntz"))
    return d


def prune(df: DataFrame, as_of: dt.datetime | Column, days: int = 7) -> DataFrame:
    """Retention, rows from the last ``days`` days."""
    ref = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return df.where(F.col("time") >= add_hours(ref, -24 * days))

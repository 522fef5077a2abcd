"""Incremental loads and keyed merges.

Merges are expressed as joins on the natural key, which is high-cardinality
(``(time, region_id)``), so they hash-partition evenly even when one region
holds most of the rows. In-batch dedupe uses ``max_by`` grouped by the key
(partial aggregation before the shuffle) rather than a window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.timecols import add_hours
from wattlake.schemas import EPOCH, HORIZON_COLS, MAX_HORIZON


def high_water(df: DataFrame, col: str = "time", default: str = EPOCH) -> Column:
    """A4: ``coalesce(max(col), default)`` as a scalar subquery Column (runs once)."""
    return df.select(F.coalesce(F.max(col), F.lit(default).cast("timestamp_ntz"))).scalar()


def newer_than(
    source: DataFrame,
    sink: DataFrame,
    col: str = "time",
    per_key: str | None = None,
    lookback_hours: int = 0,
    default: str = EPOCH,
) -> DataFrame:
    """Rows of ``source`` newer than what ``sink`` already holds.

    Default is the upstream rule (one global mark, ``time > mark``). With
    ``per_key`` each key has its own mark (a late region is not lost); with
    ``lookback_hours`` the mark is moved back so that a partially loaded
    boundary is re-read (pair it with an upsert sink).
    """
    if per_key is None:
        mark = high_water(sink, col, default)
        if lookback_hours:
            mark = add_hours(mark, -lookback_hours)
        return source.where(F.col(col) > mark)
    marks = sink.groupBy(per_key).agg(F.max(col).alias("_mark"))
    j = source.join(marks, per_key, "left")
    m = F.coalesce(F.col("_mark"), F.lit(default).cast("timestamp_ntz"))
    if lookback_hours:
        m = add_hours(m, -lookback_hours)
    return j.where(F.col(col) > m).drop("_mark")


def dedupe_last(df: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """One row per key: the greatest ``order_by``, nulls first, ties by the other columns.

    Without ``order_by`` (a source position) the greatest row by its other
    columns stays, so the result does not depend on the order of arrival.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = F.struct(*([order_by] if order_by else []), *rest)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """Merge on ``keys``, the source wins; the batch is always deduped first, by ``order_by``."""
    keys = list(keys)
    src = dedupe_last(source, keys, order_by)
    cols = target.columns
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src.select(*cols))


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key appears in the batch (J9), then insert the batch."""
    keys = list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is absent from the target (first write wins)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(rows_to_insert(target, source, keys).select(*target.columns))


def complete_forecasts(pred: DataFrame, array_col: str | None = None) -> DataFrame:
    """S9 guard: keep forecast rows that carry exactly 24 non-null values."""
    if array_col is not None:
        arr = F.col(array_col)
        return pred.where((F.size(arr) == MAX_HORIZON) & F.forall(arr, lambda x: x.isNotNull()))
    cond = F.lit(True)
    for c in HORIZON_COLS:
        cond = cond & F.col(c).isNotNull()
    return pred.where(cond)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A12."""
    return df.select(*keys).distinct()


def backfill_slices(spark: SparkSession, start, end, last_time=None, days: int = 7) -> DataFrame:
    """``[slice_start, slice_end)`` windows of ``days`` covering ``start..end``.

    A restart begins at ``last_time - 1 day`` (the slice is re-merged, so
    re-running is idempotent with an upsert sink).
    """
    if last_time is not None:
        start = max(start, last_time - dt.timedelta(days=1))
    s = F.lit(start).cast("timestamp_ntz")
    e = F.lit(end).cast("timestamp_ntz")
    seq = F.sequence(s, e, F.make_dt_interval(F.lit(days)))
    return (
        spark.range(1)
        .select(F.posexplode(seq).alias("slice_id", "slice_start"))
        .select("slice_id", "slice_start", F.least(F.col("slice_start") + F.make_dt_interval(F.lit(days)), e).alias("slice_end"))
        .where(F.col("slice_start") < e)
    )


def assign_slice(df: DataFrame, start, days: int = 7, col: str = "time") -> DataFrame:
    """Slice id of every row by arithmetic (an equi-key, no range join)."""
    s = (start if isinstance(start, Column) else F.lit(start)).cast("timestamp_ntz")
    secs = F.unix_timestamp(F.col(col)) - F.unix_timestamp(s)
    return df.withColumn("slice_id", F.floor(secs / F.lit(days * 86400)).cast("int"))


def run_backfill(
    spark: SparkSession, base: str, keys: Sequence[str], load: Callable[[dt.datetime, dt.datetime], DataFrame],
    start: dt.datetime, end: dt.datetime, days: int = 7,
) -> int:
    """Load the slices of ``start..end`` into ``<base>/rows`` one by one; returns the slices run.

    ``load(slice_start, slice_end)`` gives a slice's rows. Every finished slice is
    a row of the ledger ``<base>/ledger`` (slice, rows, last time); a run that finds
    one begins a day before the last time in it. Rows are written before the
    ledger, and a slice loaded twice replaces its keys, so a run that stopped
    anywhere is resumed to the same table.
    """
    from wattlake.sources import sinks

    ledger = sinks.read_table(spark, f"{base}/ledger", LEDGER)
    known = ledger.agg(F.max("number"), F.max("last_time"), F.max("slice_end")).first() if ledger is not None else (None, None, None)
    if known[2] is not None and known[2] >= end:
        return 0
    # one row a slice: bounded by the span
    slices = backfill_slices(spark, start, end, known[1], days).orderBy("slice_id").collect()
    for i, s in enumerate(slices, 0 if known[0] is None else known[0] + 1):
        rows = load(s.slice_start, s.slice_end)
        n = sinks.upsert_table(rows, f"{base}/rows", keys)
        # only the slice's own days are read back
        span = [(s.slice_start + dt.timedelta(days=k)).strftime("%Y-%m-%d") for k in range((s.slice_end - s.slice_start).days + 2)]
        stored = sinks.read_table(spark, f"{base}/rows", days=span) if n else None
        last = stored.where(F.col(keys[0]) < F.lit(s.slice_end).cast("timestamp_ntz")).agg(F.max(keys[0])).first()[0] if n else None
        done = spark.createDataFrame([(i, s.slice_start, s.slice_end, n, last)], LEDGER)
        sinks.append(done, f"{base}/ledger", i, "ledger")
    return len(slices)


#: A finished slice of a backfill.
LEDGER = "number int, slice_start timestamp_ntz, slice_end timestamp_ntz, n_rows long, last_time timestamp_ntz"

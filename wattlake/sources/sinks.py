"""Keyed tables on shared storage (S5-S10), written by Spark's dynamic partition overwrite.

A table is day-partitioned Parquet under ``<base>/rows``. A keyed write reads the
days that its batch touches, merges, and overwrites those days and no others.
Three steps make it safe against a stop at any point:

1. the merged days are written to ``<base>/pending/writer=<w>`` with the epoch in
   every row;
2. they overwrite their days in ``<base>/rows``;
3. the epoch is written to ``<base>/epochs``, one row a writer.

A replayed epoch that is marked changes nothing. One that is not marked starts
again at step 2 if all its pending rows are there (a finished write of Spark leaves
``_SUCCESS`` last, and its row count is checked), else at step 1, for which the
table is still as it was.

Appended rows stand in a part of their own (writer and epoch), so a replay
overwrites itself. One writer works on a table at a time, as micro-batches do.
The list of days is held by the driver: it is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from wattlake.operators.incremental import dedupe_last, insert_absent, upsert

_DAY, _PART, _EPOCH, _ROWS = "_day", "_part", "_epoch", "_rows"
#: Part of the merged rows of a day; appended rows stand in parts of their own.
_MERGED = "merged"


def open_folder(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The Parquet folder ``path``; None if there is none or no file in it yet."""
    reader = spark.read.option("basePath", path)
    try:
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def overwrite_parts(rows: DataFrame, path: str, *parts: str) -> None:
    """Replace the partitions that ``rows`` has values of."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _as_schema(schema) -> StructType | None:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _in_days(days: Sequence[str | None]) -> Column:
    named = [d for d in days if d is not None]
    inside = F.col(_DAY).isin(named) if named else F.lit(False)
    return inside | F.col(_DAY).isNull() if None in days else inside


def _stored(spark: SparkSession, base: str, schema, days: Sequence[str | None] | None) -> DataFrame | None:
    schema = _as_schema(schema)
    if schema is not None:
        schema = StructType([*schema.fields, StructField(_DAY, StringType()), StructField(_PART, StringType())])
    rows = open_folder(spark, f"{base}/rows", schema)
    if rows is None or days is None:
        return rows
    # a filter on the partition column lists the touched folders only
    return rows.withColumn(_DAY, F.col(_DAY).cast("string")).where(_in_days(days))


def read_table(spark: SparkSession, base: str, schema=None, days: Sequence[str | None] | None = None) -> DataFrame | None:
    """The table (of the given days only); None when there is nothing."""
    rows = _stored(spark, base, schema, days)
    return None if rows is None else rows.drop(_DAY, _PART)


def _day(df: DataFrame, keys: Sequence[str]) -> Column:
    """Day of the first time column, key columns first; one part for a table without any."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for c in [*keys, *df.columns]:
        if isinstance(kinds[c], (TimestampType, TimestampNTZType, DateType)):
            return F.date_format(c, "yyyy-MM-dd")
    return F.lit("all")


def last_epoch(spark: SparkSession, base: str, writer: str) -> int:
    """The newest finished epoch of ``writer``; -1 without one."""
    marks = open_folder(spark, f"{base}/epochs", StructType.fromDDL("epoch bigint, writer string"))
    found = marks.where(F.col("writer") == writer).agg(F.max("epoch")).first()[0] if marks is not None else None
    return -1 if found is None else found


def _mark(spark: SparkSession, base: str, writer: str, epoch: int | None) -> None:
    if epoch is not None:
        overwrite_parts(spark.range(1).select(F.lit(epoch).cast("bigint").alias("epoch"), F.lit(writer).alias("writer")), f"{base}/epochs", "writer")


def _pending(spark: SparkSession, base: str, writer: str, schema: StructType, epoch: int | None) -> DataFrame | None:
    """All rows that an unmarked run of the epoch has left behind at step 1, if it ended that step."""
    if epoch is None:
        return None
    more = [StructField(_DAY, StringType()), StructField(_EPOCH, LongType()), StructField(_ROWS, LongType())]
    found = open_folder(spark, f"{base}/pending/{writer}", StructType([*schema.fields, *more]))
    if found is None:
        return None
    r = found.agg(F.min(_EPOCH), F.max(_EPOCH), F.min(_ROWS), F.count("*")).first()
    return found.drop(_EPOCH, _ROWS) if r[0] == r[1] == epoch and r[2] == r[3] else None


def _merge(
    source: DataFrame, base: str, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame],
    epoch: int | None, writer: str,
) -> int:
    """Write ``merge(old rows of the touched days, source)``; returns the batch's rows."""
    spark = source.sparkSession
    if epoch is not None and epoch <= last_epoch(spark, base, writer):
        return 0
    src = source.withColumn(_DAY, _day(source, keys)).persist()
    try:
        counts = {r[_DAY]: r["count"] for r in src.groupBy(_DAY).count().collect()}
        if not counts:
            _mark(spark, base, writer, epoch)
            return 0
        ready = _pending(spark, base, writer, source.schema, epoch)
        if ready is None:
            new = src.drop(_DAY)
            old = _stored(spark, base, source.schema, list(counts))
            if old is not None:
                if any(f"/{_PART}={_MERGED}/" not in f for f in old.inputFiles()):
                    raise ValueError(f"{base} has appended rows: a table is either appended to or merged into")
                new = merge(old.drop(_DAY, _PART), new)
            new = new.withColumn(_DAY, _day(new, keys)).persist()
            try:
                n = new.count()
                step = new.withColumns({_EPOCH: F.lit(-1 if epoch is None else epoch).cast("bigint"), _ROWS: F.lit(n).cast("bigint")})
                step.write.mode("overwrite").parquet(f"{base}/pending/{writer}")
            finally:
                new.unpersist()
            ready = open_folder(spark, f"{base}/pending/{writer}", step.schema).drop(_EPOCH, _ROWS)
        overwrite_parts(ready.withColumn(_PART, F.lit(_MERGED)), f"{base}/rows", _DAY, _PART)
        _mark(spark, base, writer, epoch)
        return sum(counts.values())
    finally:
        src.unpersist()


def build(df: DataFrame, base: str, keys: Sequence[str] = ()) -> int:
    """Full build (create-table-as); replaces what the table held. Returns rows written."""
    rows = df.withColumns({_DAY: _day(df, keys), _PART: F.lit(_MERGED)}).persist()
    try:
        n = rows.count()
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_DAY, _PART).parquet(f"{base}/rows")
        return n
    finally:
        rows.unpersist()


def append(df: DataFrame, base: str, epoch: int | None = None, writer: str = "append") -> int:
    """Add rows; an empty frame adds none, a finished epoch is skipped. Returns rows written.

    Without an epoch rows are simply added; with one a replay overwrites what it left.
    """
    spark = df.sparkSession
    if epoch is not None and epoch <= last_epoch(spark, base, writer):
        return 0
    part = F.lit("added" if epoch is None else f"{writer}-{epoch}")
    rows = df.withColumns({_DAY: _day(df, ()), _PART: part}).persist()
    try:
        n = rows.count()
        if n and epoch is None:
            rows.write.mode("append").partitionBy(_DAY, _PART).parquet(f"{base}/rows")
        elif n:
            overwrite_parts(rows, f"{base}/rows", _DAY, _PART)
        _mark(spark, base, writer, epoch)
        return n
    finally:
        rows.unpersist()


def upsert_table(
    source: DataFrame, base: str, keys: Sequence[str], order_by: str | None = None, epoch: int | None = None,
    writer: str = "upsert",
) -> int:
    """Last write wins. The batch is always deduped, by ``order_by`` (dropped then) or by its other columns."""
    src = dedupe_last(source, keys, order_by)
    src = src.drop(order_by) if order_by else src
    return _merge(src, base, keys, lambda old, new: upsert(old, new, keys), epoch, writer)


def upsert_newest_table(
    source: DataFrame, base: str, keys: Sequence[str], position: str, epoch: int | None = None, writer: str = "upsert"
) -> int:
    """S7 by source position: of all writes of a key the greatest ``position`` stays, in whatever order they arrive.

    The position is a column of the table, so batches may overlap, repeat or
    come out of order without changing the result.
    """
    newest = lambda old, new: dedupe_last(old.unionByName(new), keys, position)
    return _merge(dedupe_last(source, keys, position), base, keys, newest, epoch, writer)


def delete_insert_table(
    source: DataFrame, base: str, keys: Sequence[str], epoch: int | None = None, writer: str = "delete_insert"
) -> int:
    """The batch's keys are deleted, then its rows (one per key) inserted."""
    return upsert_table(source, base, keys, None, epoch, writer)


def insert_absent_table(
    source: DataFrame, base: str, keys: Sequence[str], epoch: int | None = None, writer: str = "insert_absent"
) -> int:
    """First write wins."""
    src = dedupe_last(source, keys)
    return _merge(src, base, keys, lambda old, new: insert_absent(old, new, keys), epoch, writer)

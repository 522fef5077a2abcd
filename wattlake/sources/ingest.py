"""File ingest into bronze.

Only the unzip step is Python (``mapInArrow``, bounded batches of lines);
header tracking, field lookup, parsing and filtering are Spark expressions.
"""

from __future__ import annotations

import csv
import io
import itertools
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.timecols import parse_local_time
from wattlake.schemas import MARKET_TZ, REGION_FULL_NAME_TO_ID, VALID_REGIONS, WEATHER_COLS

LINE_SCHEMA = "file string, pos int, fields array<string>, error string"


#: Lines of a batch that a task hands on at once.
LINES = 4096


def _csv_lines(content: bytes) -> Iterator[list[str]]:
    """CSV fields of every line of the first member, BOM stripped, read piece by piece."""
    with zipfile.ZipFile(io.BytesIO(content)) as zf, zf.open(zf.namelist()[0]) as member:
        text = io.TextIOWrapper(member, "utf-8-sig", newline="")
        yield from csv.reader(part for line in text for part in line.splitlines())


def _unzip_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path, content) to lines, ``LINES`` at a time however long a file is.

    A file is read once to its end before its first line is handed on, so one
    that breaks off gives no lines, only a row with the reason in ``error``.
    """
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            try:
                for _ in _csv_lines(content or b""):
                    pass
            except (zipfile.BadZipFile, zlib.error, OSError, ValueError, IndexError, NotImplementedError, RuntimeError, EOFError, csv.Error) as ex:
                yield pa.RecordBatch.from_pylist([{"file": path, "pos": -1, "error": f"{type(ex).__name__}: {ex}"}], schema=_LINES)
                continue
            lines = ({"file": path, "pos": i, "fields": row} for i, row in enumerate(_csv_lines(content)) if row)
            while some := list(itertools.islice(lines, LINES)):
                yield pa.RecordBatch.from_pylist(some, schema=_LINES)


_LINES = pa.schema([("file", pa.string()), ("pos", pa.int32()), ("fields", pa.list_(pa.string())), ("error", pa.string())])


def zip_lines(files: DataFrame) -> DataFrame:
    """S1 (decode): ``(file, pos, fields, error)`` for every line of the zips ``files(path, content)``."""
    return files.select("path", "content").mapInArrow(_unzip_lines, LINE_SCHEMA)


def dispatch_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1 (scan + decode): every line of every report zip below ``path``; Spark packs files into input partitions."""
    return zip_lines(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path))


def unreadable(lines: DataFrame) -> DataFrame:
    """S1 (error table): ``(file, error)`` of the files that gave no lines."""
    return lines.where("error is not null").select("file", "error")


def _field(header: Column, values: Column, name: str) -> Column:
    """Value of the LAST header column called ``name`` (dict(zip()) semantics)."""
    rev = F.array_position(F.reverse(header), F.lit(name))
    idx = F.size(header) - rev + 1
    return F.when(rev > 0, F.try_element_at(values, idx.cast("int")))


def parse_dispatch(lines: DataFrame) -> DataFrame:
    """S1 (records): the last ``I`` line before a ``D`` line is its header; ``D``
    lines are kept when their field count matches and the 3rd field is REGIONSUM.
    Output ``(file, pos, header, values)``."""
    kind = F.get(F.col("fields"), 0)
    header = F.when(kind == "I", F.transform(F.slice("fields", 2, F.size("fields")), lambda x: F.upper(F.trim(x))))
    w = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = lines.select("file", "pos", "fields", F.last(header, ignorenulls=True).over(w).alias("header"))
    values = F.slice("fields", 2, F.size("fields"))
    return d.where(
        (kind == "D")
        & F.col("header").isNotNull()
        & (F.size(values) == F.size("header"))
        & (F.trim(F.try_element_at("fields", F.lit(3))) == "REGIONSUM")
    ).select("file", "pos", "header", values.alias("values"))


def extract_demand(records: DataFrame, tz: str = MARKET_TZ, regions: Sequence[str] = VALID_REGIONS) -> DataFrame:
    """``(time, region_id, demand_mw)``; region by code or full name; two time
    formats read in market time; unparsable or negative demand dropped (NaN kept)."""
    h, v = F.col("header"), F.col("values")
    region_raw = F.trim(_field(h, v, "REGIONID"))
    pairs = []
    for k, val in REGION_FULL_NAME_TO_ID.items():
        pairs += [F.lit(k), F.lit(val)]
    region = F.coalesce(F.element_at(F.create_map(*pairs), F.upper(region_raw)), region_raw)
    raw_time = _field(h, v, "SETTLEMENTDATE")
    time = parse_local_time(raw_time, tz, ["yyyy/MM/dd HH:mm:ss"])
    demand = _field(h, v, "TOTALDEMAND").try_cast("double")
    return records.select(time.alias("time"), region.alias("region_id"), demand.alias("demand_mw")).where(
        F.col("region_id").isin(*regions) & F.col("time").isNotNull() & F.col("demand_mw").isNotNull()
        & ~(F.col("demand_mw") < 0)
    )


def read_dispatch(spark: SparkSession, path: str, tz: str = MARKET_TZ) -> DataFrame:
    """S1 + S2 end to end."""
    return extract_demand(parse_dispatch(dispatch_lines(spark, path)), tz)


def select_new_files(files: DataFrame, last_time=None, tz: str = MARKET_TZ, name_col: str = "name") -> DataFrame:
    """S12 + L3: settlement time from ``PUBLIC_DISPATCHIS_<yyyyMMddHHmm>_<n>.zip``;
    files newer than ``last_time`` newest first, or only the newest on an empty sink."""
    stamp = F.get(F.split(F.col(name_col), "_"), 2)
    local = F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmm"))
    t = F.to_utc_timestamp(local, tz).cast("timestamp_ntz")
    d = files.select(F.col(name_col).alias("name"), t.alias("settlement_time")).where(F.col("settlement_time").isNotNull())
    if last_time is None:
        newest = d.select(F.max("settlement_time")).scalar()
        return d.where(F.col("settlement_time") == newest)
    return d.where(F.col("settlement_time") > F.lit(last_time).cast("timestamp_ntz")).orderBy(F.desc("settlement_time"))


# ------------------------------- JSON payloads ------------------------------
MARKET_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "results",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("name", T.StringType()),
                                        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
                                    ]
                                )
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)


def flatten_market(df: DataFrame, tz: str = MARKET_TZ, regions: Sequence[str] = VALID_REGIONS) -> DataFrame:
    """S3: ``{data:[{results:[{name, data:[[ts, value]]}]}]}`` -> rows; region from
    the name suffix (unknown dropped); null values kept."""
    series = df.select(F.explode("data").alias("d")).select(F.explode("d.results").alias("r"))
    pattern = "_(" + "|".join(regions) + ")$"
    pts = series.select(
        F.regexp_extract("r.name", pattern, 1).alias("region_id"), F.explode("r.data").alias("p")
    ).where(F.col("region_id") != "")
    ts = F.get(F.col("p"), 0)
    zoned = F.to_utc_timestamp(F.try_to_timestamp(ts), F.lit("UTC"))
    tz_of = ts.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$")
    session_tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    utc = F.when(tz_of, F.convert_timezone(F.lit(session_tz), F.lit("UTC"), zoned.cast("timestamp_ntz"))).otherwise(
        parse_local_time(ts, tz)
    )
    return pts.select(utc.alias("time"), "region_id", F.get(F.col("p"), 1).try_cast("double").alias("demand_mw"))


def weather_schema(params: Sequence[str] = WEATHER_COLS) -> T.StructType:
    fields = [T.StructField("time", T.ArrayType(T.StringType()))] + [
        T.StructField(p, T.ArrayType(T.DoubleType())) for p in params
    ]
    return T.StructType([T.StructField("hourly", T.StructType(fields))])


def flatten_weather(df: DataFrame, region_id: str | Column, source_tz: str | Column) -> DataFrame:
    """The time array drives the row count; a shorter or missing value array
    gives null. Times are local to ``source_tz`` and stored as UTC (D8)."""
    rid = F.lit(region_id) if isinstance(region_id, str) else region_id
    t = df.select(rid.alias("region_id"), "hourly", F.posexplode("hourly.time").alias("pos", "ts"))
    vals = [F.try_element_at(F.col(f"hourly.{p}"), F.col("pos") + 1).alias(p) for p in WEATHER_COLS]
    return t.select(parse_local_time(F.col("ts"), source_tz).alias("time"), "region_id", *vals)

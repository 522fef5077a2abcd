"""Bronze stand-ins derived from the driver's tables.

The driver ships TPC-H-like tables plus an ``events`` stream, not market
data, so the demand/weather tables are defined over them (every row of the
source tables is used):

* bronze demand  - ``events``: 5-minute bucket of ``ts`` -> time,
  ``event_type`` -> region, mean ``value`` -> demand_mw (one row per key).
* bronze weather - ``events`` by hour with a rotated type -> region map, so
  weather hours do not coincide with demand hours (gaps for the left join
  and the forward fill); ``props.k`` and ``value`` give the six variables.
* daily demand   - ``orders``: order date -> time, priority -> region,
  sum(total price) -> demand_mw (long series for 744-row lags).
* daily weather  - ``lineitem`` by ship date, the same values for each region.

Each builder has a DuckDB twin (``*_SQL``) used by the oracle check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.timecols import hour_floor, minute_floor
from wattlake.schemas import REGION_NAMES, VALID_REGIONS

# ---------------------------------------------------------------------------
# Fixed stand-in mappings (source category -> region code), natural order.
DEMAND_REGION_OF_EVENT = {"click": "NSW1", "error": "QLD1", "purchase": "SA1", "signup": "TAS1", "view": "VIC1"}
WEATHER_REGION_OF_EVENT = {"click": "QLD1", "error": "SA1", "purchase": "TAS1", "signup": "VIC1", "view": "NSW1"}
REGION_OF_PRIORITY = {
    "1-URGENT": "NSW1",
    "2-HIGH": "QLD1",
    "3-MEDIUM": "SA1",
    "4-NOT SPECIFIED": "TAS1",
    "5-LOW": "VIC1",
}
# ---------------------------------------------------------------------------


def _map_lookup(mapping: dict[str, str], c: Column) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), c)


def _sql_case(mapping: dict[str, str], col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def regions(spark: SparkSession) -> DataFrame:
    """Region dimension (five literal rows: a proven size bound)."""
    return spark.createDataFrame(
        [(r, REGION_NAMES[r]) for r in VALID_REGIONS], "region_id string, region_name string"
    )


def bronze_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return (
        e.select(
            minute_floor("ts", 5).alias("time"),
            _map_lookup(DEMAND_REGION_OF_EVENT, F.col("event_type")).alias("region_id"),
            F.col("value"),
        )
        .groupBy("time", "region_id")
        .agg(F.avg("value").alias("demand_mw"))
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return (
        e.select(
            hour_floor("ts").alias("time"),
            _map_lookup(WEATHER_REGION_OF_EVENT, F.col("event_type")).alias("region_id"),
            k.alias("k"),
            F.col("value"),
        )
        .groupBy("time", "region_id")
        .agg(
            F.avg("k").alias("temperature_2m"),
            F.min("k").alias("relative_humidity_2m"),
            F.greatest(F.avg("k") - F.lit(50.0), F.lit(0.0)).alias("precipitation"),
            F.max("k").alias("cloud_cover"),
            F.avg("value").alias("wind_speed_10m"),
            F.sum("value").alias("shortwave_radiation"),
        )
    )


def demand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return (
        o.select(
            F.col("o_orderdate").alias("time"),
            _map_lookup(REGION_OF_PRIORITY, F.col("o_orderpriority")).alias("region_id"),
            F.col("o_totalprice"),
        )
        .groupBy("time", "region_id")
        .agg(F.sum("o_totalprice").alias("demand_mw"))
    )


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    per_day = li.groupBy(F.col("l_shipdate").alias("time")).agg(
        F.avg("l_quantity").alias("temperature_2m"),
        (F.avg("l_tax") * 1000).alias("relative_humidity_2m"),
        F.greatest(F.avg("l_quantity") - F.lit(25.0), F.lit(0.0)).alias("precipitation"),
        (F.avg("l_discount") * 1000).alias("cloud_cover"),
        F.min("l_quantity").alias("wind_speed_10m"),
        (F.avg("l_extendedprice") / 100).alias("shortwave_radiation"),
    )
    # Same weather for every region: a 5-element generator, not a join.
    return per_day.select(
        "time", F.explode(F.array(*[F.lit(r) for r in VALID_REGIONS])).alias("region_id"), *per_day.columns[1:]
    )


# --------------------------- DuckDB twins ----------------------------------

BRONZE_DEMAND_SQL = f"""
bronze_demand AS (
  SELECT date_trunc('hour', ts) + to_minutes(CAST((minute(ts) // 5) * 5 AS BIGINT)) AS time,
         {_sql_case(DEMAND_REGION_OF_EVENT, 'event_type')} AS region_id,
         avg(value) AS demand_mw
  FROM events GROUP BY 1, 2
)"""

BRONZE_WEATHER_SQL = f"""
bronze_weather AS (
  SELECT date_trunc('hour', ts) AS time,
         {_sql_case(WEATHER_REGION_OF_EVENT, 'event_type')} AS region_id,
         avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS temperature_2m,
         min(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS relative_humidity_2m,
         greatest(avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) - 50.0, 0.0) AS precipitation,
         max(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS cloud_cover,
         avg(value) AS wind_speed_10m,
         sum(value) AS shortwave_radiation
  FROM events GROUP BY 1, 2
)"""

REGIONS_SQL = "regions_dim AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{r}', '{REGION_NAMES[r]}')" for r in VALID_REGIONS
) + ") AS t(region_id, region_name))"

DEMAND_DAILY_SQL = f"""
demand_daily AS (
  SELECT o_orderdate AS time, {_sql_case(REGION_OF_PRIORITY, 'o_orderpriority')} AS region_id,
         sum(o_totalprice) AS demand_mw
  FROM orders GROUP BY 1, 2
)"""

WEATHER_DAILY_SQL = """
weather_daily_one AS (
  SELECT l_shipdate AS time,
         avg(l_quantity) AS temperature_2m,
         avg(l_tax) * 1000 AS relative_humidity_2m,
         greatest(avg(l_quantity) - 25.0, 0.0) AS precipitation,
         avg(l_discount) * 1000 AS cloud_cover,
         min(l_quantity) AS wind_speed_10m,
         avg(l_extendedprice) / 100 AS shortwave_radiation
  FROM lineitem GROUP BY 1
),
weather_daily AS (
  SELECT w.time, r.region_id, w.temperature_2m, w.relative_humidity_2m, w.precipitation,
         w.cloud_cover, w.wind_speed_10m, w.shortwave_radiation
  FROM weather_daily_one w, (SELECT unnest(['""" + "', '".join(VALID_REGIONS) + """']) AS region_id) r
)"""

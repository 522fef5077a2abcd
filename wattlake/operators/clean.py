"""Bronze -> silver cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import nan_to_null
from wattlake.schemas import VALID_REGIONS, WEATHER_COLS

# Weather columns whose missing values mean "none observed".
ZERO_WHEN_MISSING = ["precipitation", "cloud_cover", "shortwave_radiation"]


def clean_demand(df: DataFrame, regions: Sequence[str] = VALID_REGIONS) -> DataFrame:
    """Keep rows with a time, a value and a known region."""
    return df.where(
        F.col("demand_mw").isNotNull() & F.col("time").isNotNull() & F.col("region_id").isin(*regions)
    ).select("time", "region_id", F.col("demand_mw").cast("double").alias("demand_mw"))


def clean_weather(df: DataFrame, regions: Sequence[str] = VALID_REGIONS) -> DataFrame:
    """Typed weather; missing rain/cloud/radiation -> 0; temperature required."""
    cols = []
    for c in WEATHER_COLS:
        v = F.col(c).cast("double")
        cols.append((F.coalesce(v, F.lit(0.0)) if c in ZERO_WHEN_MISSING else v).alias(c))
    return df.where(
        F.col("temperature_2m").isNotNull() & F.col("time").isNotNull() & F.col("region_id").isin(*regions)
    ).select("time", F.col("region_id").cast("string").alias("region_id"), *cols)


def weather_from_json(df: DataFrame, doc_col: str, regions: Sequence[str] = VALID_REGIONS) -> DataFrame:
    """The same rule over a JSON document column ``{"temperature_2m": ...}``."""
    fields = [
        F.get_json_object(F.col(doc_col), f"$.{c}").cast("double").alias(c) for c in WEATHER_COLS
    ]
    flat = df.select("time", "region_id", *fields)
    return clean_weather(flat, regions)


def stamp(df: DataFrame, as_of=None) -> DataFrame:
    """``updated_at`` as an explicit parameter (upstream uses NOW());
    ``None`` means the query's current timestamp."""
    ts = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    return df.withColumn("updated_at", ts)


def complete_cases(df: DataFrame) -> DataFrame:
    """P10: drop rows holding any null or NaN (``na.drop`` treats NaN as missing)."""
    return df.na.drop("any")


def nan_inf_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P14 over a whole frame."""
    target = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")
    }
    return df.select(*[nan_to_null(F.col(c)).alias(c) if c in target else F.col(c) for c in df.columns])

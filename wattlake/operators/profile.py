"""Dataset profile and emptiness checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, group: str = "split", key: str = "region_id", order: str = "time") -> DataFrame:
    """Rows, distinct keys and time span per group, in one aggregate."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(key).alias("n_regions"),
        F.min(order).alias("min_time"),
        F.max(order).alias("max_time"),
    )


def is_empty(df: DataFrame) -> bool:
    """True when the frame has no row (reads at most one row)."""
    return df.isEmpty()

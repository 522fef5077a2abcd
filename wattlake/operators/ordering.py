"""Global result order as a column (L1)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import shared_path


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 1, in the order of ``order`` (which must tell rows apart; nulls first).

    Rows are range-partitioned and written, so that a row's partition stays what it
    is; the partitions' row counts give each its offset, and places are counted
    within partitions. No task sees more than its range.
    """
    path = shared_path(df.sparkSession, f"ordered-{uuid.uuid4().hex}")
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = df.repartitionByRange(int(parts), *order).withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = df.sparkSession.read.schema(ranged.schema).parquet(path)
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = rows.withColumn("_own", own).join(offsets, "_part")
    return placed.withColumn(name, F.col("_own") + F.col("_before")).drop("_part", "_own", "_before")

"""Helpers shared by the operators: word splitting, scratch tables, components."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import shared_path

# a word of the phrase operators is a run of digits, a-z and non-ASCII; every
# other byte of the lower-cased UTF-8 text separates
_LOWER_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def phrase_words(text: bytes | None) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z lower-cased; none for null."""
    return text.translate(_LOWER_WORDS).split() if text else []


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def pieces(batches, rows: int = 1000):
    """The batches in slices of at most ``rows`` rows, so that a task's objects stay few however long the texts are."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sample_of(rows: DataFrame, limit: int, total: int, *columns: str) -> DataFrame:
    """At most ``limit`` of about ``total`` rows, by the smallest hashes of ``columns``.

    A bound on the hash leaves little more than ``limit`` rows before the sort,
    so what the sort gathers does not grow with the number of partitions.
    """
    key = F.xxhash64(*columns)
    share = (limit + 8 * limit**0.5 + 64) / max(total, 1)
    if share < 1:
        rows = rows.where(key < F.lit(int(share * (1 << 64)) - (1 << 63)))
    return rows.orderBy(key, *columns).limit(limit)


class Scratch:
    """Tables written to the shared checkpoint folder, so lineage ends in files every executor can read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = shared_path(spark, f"llm-{uuid.uuid4().hex}")
        self._n = 0

    def table(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it read back."""
        self._n += 1
        path = f"{self.base}/t{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table of ``table()`` that nothing reads any more."""
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, root)`` for every node but the roots.

    ``root`` is the smallest node of the component. Alternating large-star and
    small-star rounds; only minima are aggregated, so a node of any degree is
    combined map-side, and each round is a written table. Null ends are ignored.
    """
    hi_lo = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    current, mark = scratch.table(hi_lo), None
    while True:
        new_mark = current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if new_mark == mark or new_mark[0] == 0:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        mark = new_mark
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionAll(least.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        nxt = scratch.table(small)
        scratch.drop(current)
        current = nxt

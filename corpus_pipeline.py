"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps with the
columns of ``documents``; ``run`` writes every stage to the shared folder and
reads it back as the next one's input. Texts that a stage shortens get a new
``n_chars``. Null ids, empty tables, repeated rows and further columns are
handled as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import decontam, lines, mixing, quality, simhash
from wattlake.llm.common import Scratch, read


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"]))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, quality.learn(docs, read(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in an earlier one; wholly redundant documents go."""
    return _recounted(lines.deduplicate(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_first(docs, shingle=3, radius=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; mostly contaminated documents go."""
    return _recounted(decontam.decontaminate(docs, read(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of source, language and topic."""
    return mixing.mix(docs).where("sampled").select("row.*")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
]

#: The classifier and the edit and bit-distance joins have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs

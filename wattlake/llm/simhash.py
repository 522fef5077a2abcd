"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits are the bitwise majority of XXH64 over word shingles.
Two fingerprints link at ``radius`` or fewer differing bits. Every bit position
gets a non-zero vector of ``radius + 1`` bits; table ``v`` keeps the positions
whose vector has odd inner product with ``v``. The vectors of at most ``radius``
differing positions never span the space, so some ``v`` is orthogonal to all of
them and that table's masked fingerprints are equal: no pair within the radius
is missed. A bucket of more than ``BUCKET`` fingerprints is covered a second
time on the positions its mask leaves free, after which a bucket has so few
free bits that its size is bounded by them.

Defined results: null or blank text has fingerprint zero; repeated rows each
get a row; null ``doc_id`` rows get the component of their fingerprint's other
documents (null if there is none); an empty table gives no rows; only
``doc_id`` and ``text`` are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, components, text_bytes

SEED = 42
BUCKET = 4096
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Majority fingerprint (unsigned) of ``shingle``-word shingles, repeats included."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    width = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(width) - 1
    starts = ends - width + 1
    k = min(shingle, len(words))
    n = len(words) - k + 1
    spans = zip(starts[:n].tolist(), ends[k - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        part = hashes[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def masks(positions: list[int], radius: int) -> list[int]:
    """Covering masks over ``positions``: any ``radius`` positions are all absent from some mask."""
    space = (1 << (radius + 1)) - 1
    return [
        sum(1 << p for i, p in enumerate(positions) if ((i % space + 1) & v).bit_count() & 1)
        for v in range(1, space + 1)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_forest(radius: int):
    """Spanning links of each bucket's fingerprints, by breadth-first search over the bit distance."""

    def run(batches):
        for b in batches:
            left, right = [], []
            for bucket in b.column(0):
                x = np.unique(bucket.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                rest = x
                while len(rest) > 1:
                    queue, rest = [rest[0]], rest[1:]
                    while queue and len(rest):
                        at = queue.pop()
                        near = np.bitwise_count(rest ^ at) <= radius
                        if near.any():
                            found = rest[near]
                            queue.extend(found)
                            rest = rest[~near]
                            left.append(np.full(len(found), at, np.uint64))
                            right.append(found)
            a, c = (np.concatenate(v).view(np.int64) if v else np.empty(0, np.int64) for v in (left, right))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` that span every component of the distinct fingerprints ``fps(fp)`` within ``radius``."""
    tables = masks(list(range(64)), radius)
    rows = fps.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in tables])).alias("t", "key"),
    )
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    live = rows.join(sizes, ["t", "key"])
    # second covering of crowded buckets, on the positions the first mask leaves free
    again = F.lit(None)
    for t, m in enumerate(tables):
        free = [p for p in range(64) if not m >> p & 1]
        keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m | s))) for s in masks(free, radius)])
        again = F.when(F.col("t") == t, keys).otherwise(again)
    crowded = live.where(F.col("n") > bucket).select("fp", "t", F.posexplode(again).alias("s", "key"))
    small = live.where(F.col("n") <= bucket).select("fp", "t", F.lit(-1).alias("s"), "key")
    grouped = (
        small.unionAll(crowded).groupBy("t", "s", "key").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    )
    return grouped.select("fps").mapInArrow(_bucket_forest(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row; ``component_id`` is the smallest reachable ``doc_id``."""
    scratch = Scratch(docs.sparkSession)
    prints = scratch.table(fingerprints(docs, shingle))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(scratch, links(first.select("fp"), radius))
    member = first.join(roots, first.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = member.join(smallest, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one document of each group: the one of smallest ``doc_id``; columns unchanged.

    A ``doc_id`` goes if any row of it is near a smaller one; of its rows with
    equal texts one stays. Rows with a null ``doc_id`` stay.
    """
    found = near_duplicates(docs, shingle, radius)
    spare = found.where("doc_id <> component_id").select(F.col("doc_id").alias("spare")).distinct()
    kept = docs.join(spare, docs["doc_id"].cast("long") == spare.spare, "left_anti")
    # null ids are dealt out; equal rows stand together
    own = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    copies = Window.partitionBy("doc_id", own, F.xxhash64("text")).orderBy(F.lit(0))
    at = next(f"copy{i}" for i in range(len(docs.columns) + 1) if f"copy{i}" not in docs.columns)
    return kept.withColumn(at, F.row_number().over(copies)).where(F.col(at) == 1).drop(at)

"""Sharding by balanced label propagation.

Documents that belong together (here: those with equal texts) are linked by a
group, a hyperedge, so that a group of any size costs one row a member. Every
linked document starts in a shard of its own hash. A round counts each group's
members by shard, and every document wishes for the shard that most members of
its groups hold (ties by a hash of group and shard, the same for all members, so
that two halves don't change places for ever). The wishes are counted by
(from, to); quotas admit what changes places both ways and what the capacity of
the target leaves free, and a document moves if its hash lies below its pair's
admitted share. Rounds end when no wish is admitted.

Then every shard keeps linked documents up to its capacity; the others and all
unlinked documents fill what is free in every shard. The law is ``rows``: counts
of shards differ by one at most. Ranks are counted in blocks of rows, whose
numbers alone are summed in one place; no task sees a whole shard.

Defined results: a null text has size 1, checksum 0 and no links; empty texts
are equal texts; rows with a null ``doc_id`` and repeated rows are documents of
their own (repeated rows are linked, as their texts are equal); an empty table
gives no rows; only ``doc_id`` and ``text`` are read, so further columns may
have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch

SHARDS = 8
#: Rows of a block in which ranks are counted.
BLOCK = 8_192
#: Rounds at most; the capacity is kept however many are used.
ROUNDS = 12


def _unit(*columns: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def _ranked(scratch: Scratch, rows: DataFrame, by: str, total: int) -> DataFrame:
    """``rows`` with ``rank``, gapless from 0 for every value of ``by``."""
    blocks = max(1, total // BLOCK)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "key"), F.lit(blocks)))
    counts = scratch.table(rows.groupBy(by, "block").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy(by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(by).alias("of"), F.col("block").alias("at"), F.coalesce(before, F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy(by, "block").orderBy("key")) - 1
    placed = rows.withColumn("own", own)
    joined = placed.join(offsets, (placed[by] == offsets["of"]) & (placed["block"] == offsets["at"]))
    return joined.withColumn("rank", F.col("own") + F.col("offset")).drop("block", "own", "of", "at", "offset")


def _quotas(wishes: list[tuple[int, int, int]], free: list[int]) -> dict[tuple[int, int], float]:
    """Admitted share of the wishes (from, to): exchanges in full, then what the target has free in proportion."""
    asked = {(s, t): n for s, t, n in wishes}
    swapped = {(s, t): min(n, asked.get((t, s), 0)) for (s, t), n in asked.items()}
    out = {}
    for (s, t), n in asked.items():
        rest = sum(m - swapped[pair] for pair, m in asked.items() if pair[1] == t)
        room = min(1.0, max(free[t], 0) / rest) if rest else 0.0
        out[s, t] = (swapped[s, t] + room * (n - swapped[s, t])) / n
    return out


def propagate(scratch: Scratch, members: DataFrame, capacity: list[int], rounds: int = ROUNDS) -> DataFrame:
    """``(key, label)`` of the documents of ``members(key, grp)`` after balanced label propagation."""
    shards = len(capacity)
    labels = scratch.table(
        members.select("key").distinct().withColumn("label", F.pmod(F.xxhash64(F.lit("start"), "key"), F.lit(shards)).cast("int"))
    )
    for at in range(rounds):
        votes = scratch.table(members.join(labels, "key").groupBy("grp", "label").agg(F.count("*").alias("n")))
        # groups whose members agree ask for nothing; a group's votes are an array of the shards
        cast = votes.groupBy("grp").agg(*[F.sum(F.when(F.col("label") == s, F.col("n")).otherwise(0)).alias(f"v{s}") for s in range(shards)])
        cast = scratch.table(cast)
        heard = members.join(cast, "grp").groupBy("key").agg(
            F.min("grp").alias("grp"), *[F.sum(f"v{s}").alias(f"v{s}") for s in range(shards)]
        )
        best = F.array_max(F.array(*[
            F.struct(F.col(f"v{s}").alias("n"), F.xxhash64("grp", F.lit(s)).alias("tie"), F.lit(s).alias("to")) for s in range(shards)
        ]))
        wishes = scratch.table(
            heard.withColumn("to", best["to"]).select("key", "to").join(labels, "key").where("`to` <> label").select("key", "label", "to")
        )
        asked = [tuple(r) for r in wishes.groupBy("label", "to").count().collect()]  # at most shards * shards
        held = dict(labels.groupBy("label").count().collect())
        share = _quotas(asked, [capacity[s] - held.get(s, 0) for s in range(shards)])
        if not any(n * share[s, t] >= 1 for s, t, n in asked):
            break
        table = F.create_map(*[x for (s, t), p in share.items() for x in (F.lit(s * shards + t), F.lit(float(p)))])
        moves = wishes.where(_unit(F.lit(at), F.col("key")) < table[F.col("label") * shards + F.col("to")])
        after = scratch.table(
            labels.join(moves.select("key", "to"), "key", "left").select("key", F.coalesce("to", "label").alias("label"))
        )
        for used in (votes, cast, wishes, labels):
            scratch.drop(used)
        labels = after
    return labels


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard, copies)`` of every row of ``docs``.

    ``slot`` counts a shard's documents from 0; ``copies`` is the number of
    documents with the same text; ``grown_shard`` is null under this law.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.col("text").cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    base = scratch.table(docs.select(
        F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.when(text.isNotNull(), F.unhex(F.md5(raw))).alias("grp"),
    ))
    total = base.count()
    goal = [total // shards + (s < total % shards) for s in range(shards)]
    classes = scratch.table(base.where("grp is not null").groupBy("grp").agg(F.count("*").alias("copies")).where("copies > 1"))
    members = scratch.table(base.select("key", "grp").join(classes, "grp").select("key", "grp", "copies"))
    labels = propagate(scratch, members.select("key", "grp"), goal)

    ranked = scratch.table(_ranked(scratch, labels, "label", total))
    room = F.array(*[F.lit(g) for g in goal])[F.col("label")]
    stay = ranked.where(F.col("rank") < room)
    held = dict(stay.groupBy("label").count().collect())
    placed = stay.select("key", F.col("label").alias("shard"), F.col("rank").alias("slot"))
    others = base.select("key").join(placed.select("key"), "key", "left_anti").withColumn("all", F.lit(0))
    others = scratch.table(_ranked(scratch, others, "all", total))
    # the free places of the shards, one after the other, take the others by rank
    to, slot, first = F.when(F.lit(False), 0), F.when(F.lit(False), F.lit(0).cast("long")), 0
    for s in range(shards):
        end = first + goal[s] - held.get(s, 0)
        to = to.when(F.col("rank") < end, s)
        slot = slot.when(F.col("rank") < end, F.col("rank") - F.lit(first - held.get(s, 0)))
        first = end
    filled = others.select("key", to.alias("shard"), slot.alias("slot"))
    where = placed.unionByName(filled)
    sizes = members.select("key", "copies")
    return base.join(where, "key").join(sizes, "key", "left").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )

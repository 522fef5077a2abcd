"""Balanced label propagation: the law, the slots, and what is cut."""

import random
import zlib
from collections import Counter, defaultdict

from wattlake.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def check(rows, docs):
    """The law holds exactly; returns the shards of every text."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(8)]
    assert sum(sizes) == len(docs) and max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(8))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def run(spark, docs):
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA).selectExpr("*", "1 AS key", "2 AS grp", "3 AS label")
    return sharding.shard(frame).collect()


def test_groups_of_copies_stay_together(spark):
    rng = random.Random(0)
    docs, i = [], 0
    for g in range(150):
        for _ in range(rng.choice([2, 2, 3, 5, 9, 30])):
            docs.append((i, f"copied text {g}"))
            i += 1
    docs += [(i + k, f"own text {k}") for k in range(900)]
    rng.shuffle(docs)
    rows = run(spark, docs)
    check(rows, docs)
    shards = defaultdict(Counter)
    text = dict(docs)
    for r in rows:
        shards[text[r.doc_id]][r.shard] += 1
    copied = [c for t, c in shards.items() if t.startswith("copied")]
    members = sum(sum(c.values()) for c in copied)
    assert sum(max(c.values()) for c in copied) > 0.97 * members


def test_a_group_above_the_capacity_is_split_evenly(spark):
    docs = [(i, "the same") for i in range(400)] + [(1000 + i, f"t{i // 2}") for i in range(500)] + [(5000 + i, f"u{i}") for i in range(101)]
    rows = run(spark, docs)
    check(rows, docs)
    text = dict(docs)
    pairs = defaultdict(set)
    for r in rows:
        if text[r.doc_id].startswith("t") and text[r.doc_id] != "the same":
            pairs[text[r.doc_id]].add(r.shard)
    assert sum(len(s) == 1 for s in pairs.values()) > 0.7 * len(pairs)


def test_edges_of_the_input(spark):
    docs = [(1, "a"), (1, "a"), (None, "a"), (None, None), (2, None), (3, ""), (4, ""), (5, "é" * 50_000), (6, "x")]
    check(run(spark, docs), docs)
    check(run(spark, [(1, "only")]), [(1, "only")])
    assert run(spark, []) == []


def test_quotas_keep_the_capacity():
    rng = random.Random(3)
    for _ in range(200):
        wishes = [(s, t, rng.randrange(1, 100)) for s in range(4) for t in range(4) if s != t and rng.random() < 0.7]
        free = [rng.randrange(0, 80) for _ in range(4)]
        share = sharding._quotas(wishes, free)
        assert all(0 <= p <= 1 for p in share.values())
        for t in range(4):
            into = sum(n * share[s, u] for s, u, n in wishes if u == t)
            out = sum(min(n, next((m for a, b, m in wishes if (a, b) == (u, s)), 0)) for s, u, n in wishes if s == t)
            assert into <= out + free[t] + 1e-6

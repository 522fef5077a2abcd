"""SimHash near-dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wattlake.llm import simhash
from wattlake.llm.common import Scratch, components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_fingerprint(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, radius):
    """Smallest reachable index of each fingerprint."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [root(i) for i in range(len(prints))]


def test_masks_cover_every_pair():
    rng = random.Random(0)
    for radius in (1, 2, 3):
        tables = simhash.masks(list(range(64)), radius)
        assert len(tables) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            differ = sum(1 << p for p in rng.sample(range(64), radius))
            assert any(not differ & m for m in tables)


@pytest.mark.parametrize("text", [
    None, "", " \n\t ", "one", "Two words", "a b c", "A\x0bb c d", "É É É x", "x " * 70000, "the same the same the same",
])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)


@pytest.mark.parametrize("bucket", [4096, 2])
def test_links_equal_brute_force(spark, bucket):
    rng = random.Random(bucket)
    base = [rng.getrandbits(64) for _ in range(15)]
    prints = {0, 1, (1 << 64) - 1}
    for _ in range(400):
        x = rng.choice(base)
        for p in rng.sample(range(64), rng.randrange(0, 6)):
            x ^= 1 << p
        prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in components(Scratch(spark), simhash.links(frame, 3, bucket)).collect()}
    want = groups(prints, 3)
    for i, j in [(i, j) for i in range(len(prints)) for j in range(i)]:
        a, b = (roots.get(signed[k], signed[k]) for k in (i, j))
        assert (a == b) == (want[i] == want[j])


def test_near_duplicates_and_edges(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    base = [[rng.choice(words) for _ in range(60)] for _ in range(10)]
    rows = []
    for d in range(120):
        text = list(rng.choice(base))
        if rng.random() < 0.5:
            text[rng.randrange(60)] = rng.choice(words)
        rows.append((1000 - d, " ".join(text)))
    rows += [(5, ""), (6, None), (7, "   "), (8, "one"), (8, "one"), (9, "x " * 50000), (None, "one")]
    docs = spark.createDataFrame([(d, t, None, "s", 1) for d, t in rows], SCHEMA).withColumn("fp", F.lit(1)).repartition(5)
    got = sorted((r.doc_id is None, r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect())
    known = sorted((d, t or "") for d, t in rows if d is not None)
    prints = [slow_fingerprint(t) for _, t in known]
    first = [known[i][0] for i in groups(prints, 3)]
    want = sorted((False, d, int(np.uint64(p).view(np.int64)), c) for (d, _), p, c in zip(known, prints, first))
    assert got[:-1] == want
    assert got[-1][3] == 8  # a null id is grouped by its text
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(first)) and None in ids
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_first(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    ids = list(range(1, 400))
    rng.shuffle(ids)
    edges = list(zip(ids[:150], ids[1:150])) + [(ids[200], x) for x in ids[201:300]] + [(7, 7), (None, 3), (ids[0], ids[1])]
    got = {r.node: r.root for r in components(Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect()}
    chain, star = ids[:150], ids[200:300]
    want = {x: min(chain) for x in chain if x != min(chain)} | {x: min(star) for x in star if x != min(star)}
    assert got == want

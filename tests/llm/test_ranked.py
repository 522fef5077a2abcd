"""Ranked search against brute force."""

import math
import random
import re

import numpy as np

from wattlake.llm import ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def slow_search(docs, items, k):
    words = [(i, terms(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, mine in wanted.items():
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in w for _, w in words) + 1))) for t in mine}
        scores = []
        for i, w in words:
            m = 100 - 50 + 50 * len(w) * n // total
            score = sum(weight[t] * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in mine if t in w)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def test_search_equals_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(120)] + ["É", "ßx", "9"]
    text = lambda n: " ".join(rng.choice(vocab[:rng.choice([10, 60, 123])]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60)).upper() if i % 7 == 0 else text(rng.randrange(1, 60))) for i in range(700)]
    docs += [docs[3], docs[3], (None, docs[4][1]), (800, None), (801, ""), (802, " ,;- "), (803, "w5 " * 30000), (804, "w5, the\x7fw6")]
    items = [(i, text(rng.randrange(1, 30))) for i in range(45)]
    items += [items[2], (2, "w7 w8"), (None, "w9 w1"), (100, None), (101, "nowhere"), (102, "!!"), (103, "w5"), (104, " ".join(vocab))]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA).selectExpr("*", "1 AS key", "2 AS n", "3 AS terms")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS terms")
    for k, words in ((5, 400), (50, ranked.BLOCK_WORDS)):
        got = [tuple(r) for r in ranked.search(frame, bench, k=k, block_words=words).collect()]
        assert sorted(got, key=repr) == sorted(slow_search(docs, items, k), key=repr)
    assert ranked.search(frame.limit(0), bench).count() == 0 and ranked.search(frame, bench.limit(0)).count() == 0


def test_node_pairs_are_dropped_and_nothing_is_lost():
    """Over clustered rows most exact scores are never computed, and the best are those of the full product."""
    rng = np.random.default_rng(1)
    weights = rng.integers(100, 9000, 400).astype(float)
    items = [np.sort(rng.choice(np.arange(c * 20, c * 20 + 20), 6, replace=False)) for c in range(20) for _ in range(4)]
    tree = ranked.ItemTree(items, weights)
    dense = np.zeros((4000, 400))
    for i in range(4000):
        at = rng.choice(np.arange(i % 20 * 20, i % 20 * 20 + 20), 8, replace=False)
        dense[i, at] = rng.integers(1, 1000, 8) * 1000
    scored = [0]

    class Counted(ranked._Best):
        def add(self, item, scores, ids, nulls):
            scored[0] += len(scores)
            super().add(item, scores, ids, nulls)

    best = Counted(len(items), 10, np.zeros(len(items)))
    for s in range(0, 4000, 1000):
        ids = np.arange(s, s + 1000)
        ranked._search_batch(tree, best, dense[s:s + 1000], ids, np.zeros(1000, np.int64))
    for place, i in enumerate(tree.order):
        full = dense[:, items[i]] @ weights[items[i]]
        want = np.lexsort((np.arange(4000), -full))[:10]
        assert best.rows[place][1].tolist() == want.tolist()
    assert scored[0] < 0.35 * 4000 * len(items)

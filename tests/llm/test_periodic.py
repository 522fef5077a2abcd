"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from wattlake.llm import periodic

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_runs(words):
    """Every maximal stretch with smallest period q and length >= max(6, 4q)."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e - i + q >= max(6, 4 * q):
                found.setdefault((i, e - i + q), q)  # q ascends: the smallest stays
            i = e
    return sorted((s, q, length) for (s, length), q in found.items())


def slow_row(doc_id, text, plant):
    words = text.encode().split() if text else []
    if plant and doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    drop = {i for s, q, length in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    best = min(((-length, s, q) for s, q, length in runs), default=None)
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, q, length in runs).encode()).hexdigest()
    head = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, digest, hashlib.sha256(kept).hexdigest())


def some_texts(rng):
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "x " * 5000, "a b " * 300, "a b c d e f g " * 40]
    for _ in range(60):
        words = [rng.choice("ab") for _ in range(rng.randrange(1, 120))]
        texts.append(" ".join(words))
    for _ in range(60):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 900))]
        for _ in range(rng.randrange(4)):
            q, at = rng.randrange(1, 90), rng.randrange(len(words))
            words[at:at] = (words[at:at + q] or ["z"]) * rng.randrange(2, 8) + words[at:at + rng.randrange(q)]
        texts.append(rng.choice([" ", "\n", "\x0b"]).join(words))
    fib = ["a", "ab"]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    texts.append(" ".join(fib[-1]))
    texts.append(" ".join((["p", "p", "q"] * 30 + ["r"]) * 12))
    return texts


@pytest.mark.parametrize("tile", [64, periodic.TILE])
def test_runs_equal_brute_force(spark, tile):
    rng = random.Random(tile)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(some_texts(rng))]
    rows += [rows[20], (None, "a b " * 10, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS runs", "3 AS tiles")
    for plant in (False, True):
        found = periodic.find_runs(docs, plant=periodic.planted if plant else periodic._as_is, tile=tile)
        got = [tuple(r)[:8] for r in periodic.summary(found).collect()]
        want = [slow_row(r[0], r[1], plant) for r in rows]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic.summary(periodic.find_runs(docs.limit(0))).count() == 0


def test_z_function_and_planting():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(1, 60))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periodic.z_function(s).tolist() == want
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    words = [str(i).encode() for i in range(50)]
    assert all(len(periodic.planted(words, i)) == 50 for i in ids) and periodic.planted(words, None) == words


def test_tiles_show_every_run():
    rng = random.Random(2)
    for n in (65, 700, 5000):
        spans = periodic.tiles(n, 64)
        for _ in range(500):
            q = rng.randrange(1, n // 4 + 1)
            at = rng.randrange(0, n - 4 * q + 1)
            mine = [(s, e) for low, high, s, e in spans if low <= q < high]
            assert mine and mine[0][0] == 0 and mine[-1][1] == n
            # any window of two periods around a place stands whole in a tile
            assert any(s <= at and at + 2 * q <= e for s, e in mine)


def test_one_very_repetitive_long_text_is_linear():
    codes = np.zeros(200_000, np.int64)
    got = periodic._solve_together([(1, 1 << 16, codes)])[0]
    assert (1, 0, 199_999) in got and len(got) < 40

"""Decontamination against brute force over all windows."""

import random
import re

import pytest

from wattlake.llm import decontam

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"


def words(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def brute(text, items, window):
    doc, hit, who = words(text), set(), set()
    for item, t in items:
        ws = words(t)
        n = min(window, len(ws))
        grams = {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1 if n else 0):
            if tuple(doc[i:i + n]) in grams:
                hit.update(range(i, i + n))
                who.add(item)
    return len(doc), hit, sorted((None if i is None else str(i) for i in who), key=lambda x: (x is None, x or ""))


def corpus(seed, n_docs=60):
    rng = random.Random(seed)
    vocab = ["a", "b", "the", "É", "x9"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 4, 6, 9])))) for i in range(12)]
    items += [(20, items[0][1]), (21, ""), (22, "!!")]
    docs = []
    for d in range(n_docs):
        ws = [rng.choice([*vocab, "zz"]) for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.5:
            ws[3:3] = rng.choice(items)[1].split()
        docs.append((d, rng.choice([" ", ", ", "-"]).join(ws).upper() if d % 3 else " ".join(ws)))
    return docs, items


@pytest.mark.parametrize("window,shard_words", [(3, 200_000), (4, 8), (5, 3)])
def test_hits_equal_brute_force(spark, window, shard_words):
    rows, items = corpus(window)
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    bench = spark.createDataFrame([*items, (30, None), (None, "the a")], ITEMS)
    got = {r.doc_id: r for r in decontam.find_leaks(docs, bench, window, shard_words).collect()}
    hits = 0
    for d, t in rows:
        n, hit, who = brute(t, [*items, (None, "the a")], window)
        r = got[d]
        assert (r.n_words, sorted(i for s in r.spans for i in range(s.start, s.stop)), r.items) == (n, sorted(hit), who)
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
        hits += len(hit)
    assert hits


def test_longest_match_is_told():
    automaton = decontam.SuffixAutomaton([("1", [b"a", b"b", b"c", b"d", b"e"])], 3)
    assert automaton.scan([b"x", b"a", b"b", b"c", b"d", b"x", b"b", b"c"]) == ([(1, 5, 4)], {"1"})


def test_decontaminate_cuts_spans_and_drops_documents(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    clean = " ".join(f"c{i}" for i in range(30))
    rows = [
        (1, f"{clean}. {passage.upper()}! End {clean}", "en", "s", 1), (2, passage, "en", "s", 1), (3, clean, None, None, None),
        (4, None, "en", "s", 1), (5, "", "en", "s", 1), (3, clean, None, None, None), (None, passage + " " + clean, "en", "s", 1),
        (6, clean + " " + "w " * 50000 + passage, "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS spans", "2 AS row", "3 AS items", "4 AS n_words")
    bench = spark.createDataFrame([(1, passage), (2, passage)], ITEMS)
    out = decontam.decontaminate(docs, bench)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text) for r in out.collect()), key=str)
    assert got == sorted([
        (1, f"{clean}. ! End {clean}"), (3, clean), (3, clean), (4, None), (5, ""), (0, " " + clean),
        (6, clean + " " + "w " * 50000),
    ], key=str)
    assert decontam.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0


def test_text_ids_and_null_ids(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = spark.createDataFrame([(1, passage + " end"), (2, "other words")], "doc_id long, text string")
    for ids, kind in ((["b-2", "a10"], "string"), ([10, 9], "long")):
        bench = spark.createDataFrame([(ids[0], passage), (ids[1], passage), (None, passage), (None, "end")], f"item_id {kind}, text string")
        got = {r.doc_id: r for r in decontam.find_leaks(docs, bench).collect()}
        assert got[1].items == [*sorted(map(str, ids)), None] and sum(s.stop - s.start for s in got[1].spans) == 13
        assert got[2].items == []
        assert [r.doc_id for r in decontam.decontaminate(docs, bench).collect()] == [2]


def test_equal_words_scan_in_linear_time():
    import time

    words = [b"w"] * 40_000
    times = []
    for n in (500, 4000):
        automaton = decontam.SuffixAutomaton([("1", [b"w"] * n), ("2", [b"w"] * 4), ("3", [b"w", b"x"])], 10)
        begin = time.process_time()
        spans, who = automaton.scan(words)
        times.append(time.process_time() - begin)
        assert who == {"1", "2"} and [(s, e) for s, e, _ in spans] == [(0, 40_000)]
    assert times[1] < 4 * times[0] + 0.5

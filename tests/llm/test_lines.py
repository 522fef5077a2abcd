"""Line dedup against brute force: every pair of distinct lines by dynamic programming."""

import random

import pytest

from wattlake.llm import lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutate(rng, line, n):
    for _ in range(n):
        at = rng.randrange(len(line) + 1)
        line = rng.choice([line[:at] + line[at + 1:], line[:at] + "x" + line[at:], line[:at] + "é" + line[at + 1:]])
    return line


def brute(rows, edits=2, least=20):
    """(doc_id, line) -> first (doc_id, line) of its class, for redundant lines."""
    where = {}
    for doc_id, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            line = lines.normal(line)
            if doc_id is not None and len(line) >= least:
                where.setdefault(line, set()).add((doc_id, i))
    names = sorted(where)
    parent = {x: x for x in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                parent[root(a)] = root(b)
    groups = {}
    for x in names:
        groups.setdefault(root(x), set()).update(where[x])
    return {p: min(g) for g in groups.values() for p in g if p != min(g)}


def corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd ef") for _ in range(rng.randrange(20, 60))).strip().ljust(20, "z") for _ in range(12)]
    # template lines share a long segment
    base += [f"page {i:04d} of the very long report on lines" for i in rng.sample(range(3000), 25)]
    rows = []
    for d in range(60):
        text = "\n".join(mutate(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 6)))
        rows.append((d, rng.choice([text, text + "\nshort", text.upper()])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_edit_distance(seed):
    rng = random.Random(seed)
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 14)))
        b = mutate(rng, a, rng.randrange(4)) if a else "ab"
        for most in (0, 1, 2, 3):
            assert lines.edit_distance(a, b, most) == min(distance(a, b), most + 1), (a, b, most)


def test_every_close_pair_shares_a_signature():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(20, 40)))
        b = mutate(rng, a, rng.randrange(1, 3))
        short, long = sorted((a, b), key=len)
        if distance(a, b) <= 2:
            own = {s[0] for s in lines.signatures(short) if s[1] & 1}
            assert own & {s[0] for s in lines.signatures(long) if s[1] & 2}


@pytest.mark.parametrize("crowd,partitions", [(128, 1), (3, 4), (1, 2)])
def test_repeats_equal_brute_force(spark, crowd, partitions):
    rows = corpus(crowd)
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA).repartition(partitions)
    got = {(r.doc_id, r.line): (r.first_doc, r.first_line) for r in lines.repeats(docs, crowd=crowd).collect()}
    assert got == brute(rows)
    assert got


def test_deduplicate_edges(spark):
    long = "this is a line of more than twenty characters"
    rows = [
        (1, long + "\nanother line that nobody else has written\nx", "en", "s", 0),
        (2, long.upper() + "\nx", None, "s", 0),
        (3, "x\nx", "en", None, None),
        (4, None, "en", "s", 0),
        (5, "", "en", "s", 0),
        (6, ("word " * 30000).strip() + "\n" + long[:-1], "en", "s", 0),
        (7, long, "en", "s", 0),
        (7, long, "en", "s", 0),
        (None, long, "en", "s", 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS spare", "2 AS row", "'k' AS key")
    out = lines.deduplicate(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {
        1: rows[0][1], 3: "x\nx", 4: None, 5: "", 6: rows[5][1].split("\n")[0], None: long,
    }
    assert lines.deduplicate(docs.limit(0)).count() == 0
    told = {r.doc_id: r for r in lines.summary(docs, lines.repeats(docs)).collect()}
    assert told[2].dropped == [0] and told[2].first_docs == [1] and told[6].n_linked == 1 and told[4].n_lines == 0


def replaced(rng, line, n):
    words = line.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = "other"
    return " ".join(words)


def test_banded_columns_equal_dynamic_programming():
    rng = random.Random(9)
    pairs, most, want = [], [], []
    for _ in range(400):
        a = "".join(rng.choice("abc\u00e9") for _ in range(rng.randrange(1, 90)))
        b = mutate(rng, a, rng.randrange(14)) if rng.random() < 0.8 else "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        k = rng.choice([0, 1, 2, 4, 5, 9, 20, 31, 40])
        d = distance(a, b)
        assert lines.edit_distance(a, b, k) == min(d, k + 1), (a, b, k)
        pairs.append((a, b))
        most.append(k)
        want.append(d <= k)
    assert lines.within(pairs, most).tolist() == want
    assert lines.within([], []).tolist() == []


def test_a_pair_of_very_long_lines_takes_little_time():
    import time

    rng = random.Random(1)
    a = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    b = mutate(rng, a, 3)
    begin = time.process_time()
    assert lines.edit_distance(a, b, len(a) // 16) <= 3
    assert time.process_time() - begin < 1


def test_long_lines_link_by_their_share_of_edits(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8)))
    base = [" ".join(word() for _ in range(rng.randrange(25, 120))) for _ in range(60)]
    rows = [(i, x) for i, x in enumerate(base)] + [(100 + i, replaced(rng, x, max(1, len(x) // 150))) for i, x in enumerate(base)]
    rows += [(200 + i, replaced(rng, x, len(x.split()) // 3)) for i, x in enumerate(base)]
    # over CROWD variants of one line
    rows += [(300 + i, replaced(rng, base[0], 1)) for i in range(40)]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA).repartition(3)
    got = {(r.doc_id, r.line): (r.first_doc, r.first_line) for r in lines.repeats(docs).collect()}
    assert all(got[100 + i, 0] == (i, 0) for i in range(60))
    assert all(got[300 + i, 0] == (0, 0) for i in range(40))
    assert not any((200 + i, 0) in got for i in range(60))


def test_short_lines_of_their_own_keep_a_document(spark):
    header = "this is a licence line of more than twenty characters"
    rows = [(1, header + "\na full line that nobody else has written\nx"), (2, header + "\nroses are red\n\nviolets"),
            (3, header + "\n  X \n"), (4, header + "\nroses  are red"), (5, header + "\n \n")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA)
    got = {r.doc_id: r.text for r in lines.deduplicate(docs).collect()}
    assert got == {1: rows[0][1], 2: "roses are red\n\nviolets"}


def test_a_wide_band_does_not_end_before_a_way_within_it():
    """Edits in one half and characters missing in the other: the last diagonal grows by more than twice the limit."""
    rng = random.Random(7)
    for _ in range(40):
        x = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(90, 130)))
        y = mutate(rng, x[rng.randrange(8):-6], rng.randrange(4, 14))
        d = distance(x, y)
        for most in range(max(d - 1, abs(len(x) - len(y))), d + 4):
            for a, b in ((x, y), (y, x), (x[::-1], y[::-1]), (y[::-1], x[::-1])):
                assert lines._banded(a, b, most) == min(d, most + 1)


def test_crowded_lines_of_other_lengths_do_not_meet(spark):
    """A group of one key is dealt by length: its rows grow with its lines, and all links of its pairs are there."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8)))
    passage = " ".join(word() for _ in range(6))
    texts = [passage + " " + " ".join(word() for _ in range(rng.randrange(5, 40))) for _ in range(60)]
    texts = sorted({*texts, *(mutate(rng, x, rng.randrange(1, 9)) for x in texts[:40] for _ in range(2))})
    edges = set()
    for j, y in enumerate(texts):
        for i, x in enumerate(texts[:j]):
            k = lines.allowed(min(len(x), len(y)))
            if abs(len(x) - len(y)) <= k and lines.within([(x, y)], [k])[0]:
                edges.add((i, j))
    text = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    keys = [(k, i) for i in range(len(texts)) for k in (1, 2, 3) if k == 1 or rng.random() < 0.7]
    still = spark.createDataFrame(keys, "key long, id long")
    assert lines._dense_rows(still, text, 2, 20).count() <= 2 * len(keys)
    got = {(min(r), max(r)) for r in lines._dense_links(still, text, 2, 20).collect()}

    def classes(links):
        of = list(range(len(texts)))
        for a, b in links:
            of = [of[a] if x == of[b] else x for x in of]
        return {tuple(i for i, x in enumerate(of) if x == c) for c in of}

    assert got <= edges and classes(got) == classes(edges) and len(edges) > 60


def test_wide_bands_of_many_pairs_equal_dynamic_programming():
    """Limits above 31 edits take bands of several words, many pairs at once."""
    rng = random.Random(11)
    pairs, most, want = [], [], []
    for _ in range(300):
        a = "".join(rng.choice("abcd é") for _ in range(rng.randrange(130, 330)))
        b = mutate(rng, a[rng.randrange(9):], rng.randrange(20, 150))
        d = distance(a, b)
        k = max(32, min(150, d + rng.randrange(-2, 3)))
        pairs.append((a, b))
        most.append(k)
        want.append(d <= k)
    assert lines.within(pairs, most).tolist() == want and 50 < sum(want) < 250


def test_a_very_common_hash_goes_to_no_bucket(spark):
    """Lines with one long start in common: their crowded hashes' rows are spread, and still known as crowded."""
    import numpy as np
    import pyarrow as pa

    texts = [f"a start that all of these lines have {i:05d} {i * i % 97:05d}" for i in range(400)]
    other = "another line that nobody else has written"
    parts = [pa.record_batch([texts[:300] + [other]], ["text"]), pa.record_batch([[*texts[300:], other]], ["text"])]
    sent = [pa.Table.from_batches(lines._sent(20, 2, 16, 4)([b])) for b in parts]
    table = pa.concat_tables(sent)
    own = table.filter(pa.compute.invert(table["crowded"]))
    # per key and part at most 16 rows and the mark stay
    for t in sent:
        mine = t.filter(pa.compute.invert(t["crowded"]))
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in mine["keys"].to_pylist()]) >> np.uint64(2)
        assert np.unique(keys, return_counts=True)[1].max() <= 17
    assert own.num_rows < table.num_rows
    found = pa.concat_tables([lines._meet(16)(table.filter(pa.compute.equal(table["bucket"], i))) for i in range(4)])
    crowded = found.filter(pa.compute.is_valid(found["crowd"]))
    first = [(c, a) for c, a in zip(crowded["crowd"].to_pylist(), crowded["a"].to_pylist())]
    most = max(sum(c == k for c, _ in set(first)) for k in {c for c, _ in first})
    assert most == 400


def test_crowded_lines_give_a_row_for_each_key_and_linked_ones_none(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefghijklm ") for _ in range(200))
    texts = sorted({mutate(rng, base, rng.randrange(1, 5)) for _ in range(50)})
    text = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    keys = [(k, i) for i in range(len(texts)) for k in range(5)]
    still = spark.createDataFrame(keys, "key long, id long")
    assert lines._dense_rows(still, text, 2, 20).count() == len(keys)
    roots = spark.createDataFrame([(i, 0) for i in range(1, len(texts))], "node long, root long")
    assert lines._dense_rows(still, text, 2, 20, roots).count() == 0
    # one line that the known links leave out is compared with all
    roots = roots.where("node <> 7")
    got = lines._dense_links(still, text, 2, 20, roots).collect()
    assert len(got) == 1 and 7 in tuple(got[0])


def test_many_pairs_of_other_lengths_equal_full_dynamic_programming():
    """Pairs whose second line ends before the first does, on wide bands: cells below the end of a line are no part of the distance."""
    rng = random.Random(13)
    pairs, want = [], []
    for _ in range(400):
        a = "".join(rng.choice("ab c") for _ in range(rng.randrange(40, 90)))
        b = mutate(rng, a, rng.randrange(1, 12))[rng.randrange(6):][:rng.randrange(40, 90)]
        pairs.append((a, b) if rng.random() < 0.5 else (b, a))
        want.append(distance(a, b))
    for most in (6, 10, 16, 31, 33, 63, 64, 100):
        some = sorted(((a, b, d) for (a, b), d in zip(pairs, want) if abs(len(a) - len(b)) <= most), key=lambda x: -len(x[1]))
        got = lines._banded_many(*map(list, zip(*(x[:2] for x in some))), most)
        assert [min(int(x), most + 1) for x in got] == [min(d, most + 1) for *_, d in some], most


def test_keys_with_few_lines_are_compared_together(spark):
    """Many crowded hashes of few lines: their pairs are verified in a few calls of many pairs, and all links are found."""
    import pyarrow as pa

    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8)))
    rows, edges, k = [], set(), 0
    for key in range(40):
        base = " ".join(word() for _ in range(20))
        texts = sorted({base, *(replaced(rng, base, rng.randrange(1, 4)) for _ in range(16))})
        for i, x in enumerate(texts):
            edges |= {(k + j, k + i) for j in range(i) if lines.within([(x, texts[j])], [lines.allowed(min(len(x), len(texts[j])))])[0]}
            rows.append((key, k + i, k + i, x, [], 2))
        k += len(texts)
    table = pa.table(dict(zip(("key", "id", "label", "text", "before", "side"), map(list, zip(*rows)))))
    calls, within = [], lines.within
    lines.within = lambda pairs, most: calls.append(len(pairs)) or within(pairs, most)
    try:
        got = lines._block_links(2, 20)(table).to_pylist()
    finally:
        lines.within = within
    assert len(calls) <= 2 and sum(calls) > 1000

    def classes(links):
        of = list(range(k))
        for a, b in links:
            of = [of[a] if x == of[b] else x for x in of]
        return of

    got = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in got}
    same = lambda of: {tuple(i for i, x in enumerate(of) if x == c) for c in set(of)}
    assert got <= edges and same(classes(got)) == same(classes(edges)) and len(edges) > 100

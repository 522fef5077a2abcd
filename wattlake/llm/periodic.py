"""Periodic runs of words by scale-tiled distribution.

A run is a maximal stretch of words with smallest period q that is at least
``LEAST`` words and ``REPEATS`` periods long. In terms of matches (word i equals
word i + q) it is a maximal stretch of at least ``(REPEATS - 1) * q`` matches.

Periods are taken by octaves [P, 2P). A document's words are exploded into
overlapping tiles: one tile for all octaves that are small beside it, and for
every further octave tiles of ``SCALE`` times its P with margins, so that no task
holds more than a constant number of periods. A tile is solved alone: on a grid
of P words, rolling hashes of P words tell which q of the octave may match at
all; there the Z-functions of the words behind and before the grid point give
how far the matches of every period reach. Periods that a shorter one explains
are dropped (a window of two periods has that period only if the run has). Every
stretch of three periods holds three grid points, whose windows overlap and reach
both ends. Periods below ``DIRECT`` are compared word by word instead. The
fragments go by (document, period) to a shuffle that stitches them.

A document shorter than ``TILE`` words is one tile and is solved where it is
read; longer ones send their tiles to other tasks. Only texts with a fragment are
kept for the collapsed text.

Defined results: null text has no words; a null ``doc_id`` has no planted period
(``planted`` of the query); repeated rows each get their result; an empty table
gives no rows; only ``doc_id`` and ``text`` are read, so further columns may have
any name.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, text_bytes

LEAST, REPEATS = 6, 4
#: Words of a document's first tile, and of a tile of a further octave in units of its smallest period.
TILE, SCALE = 8192, 32
#: Periods below this power of two are compared directly.
DIRECT = 32
#: Words that are solved together.
_TOGETHER = 1 << 19
_B = 0x9E3779B97F4A7C15
_B_INVERSE = pow(_B, -1, 1 << 64)


def words_of(text: bytes | None) -> list[bytes]:
    """Words between blanks (space and the five ASCII control blanks)."""
    return text.split() if text else []


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One document in ten gets a periodic tail; which one and how is fixed by its id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def z_function(s: list[int]) -> np.ndarray:
    """Length of the longest common prefix of ``s`` and each of its suffixes."""
    n, left, right = len(s), 0, 0
    z = [0] * n
    z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return np.array(z)


def _at_boundary(codes: np.ndarray, b: int, p: int) -> list[tuple[int, int, int]]:
    """Fragments ``(period, start, stop)`` of matches around word ``b`` for the periods of octave ``p``."""
    ahead = codes[b:b + 4 * p]
    reach = z_function(ahead.tolist())
    behind = codes[max(0, b - 2 * p):b][::-1]
    # a text of the behind-words, a mark and the same read back from 2p words further on
    mirrored = codes[max(0, b - 2 * p):b + 2 * p][::-1]
    back = z_function([*behind.tolist(), -1, *mirrored.tolist()])[len(behind) + 1:]
    top = min(2 * p, len(ahead), len(mirrored) - len(behind))
    q = np.arange(top)
    f, g = np.zeros(top, np.int64), np.zeros(top, np.int64)
    f[1:] = reach[1:top]
    # the word before b + q stands at place (mirrored end - q)
    at = len(mirrored) - len(behind) - q
    g[1:] = back[at[1:]]
    near = np.minimum(f, 2 * p)
    alive = near + g >= q
    alive[0] = False
    out = []
    for d in np.flatnonzero(alive).tolist():
        if not alive[d]:
            continue
        more = np.arange(2 * d, top, d)
        alive[more[(g[d] >= g[more]) & (f[d] >= near[more] + more - d)]] = False
        if d >= p and f[d] >= p:
            out.append((d, b - int(g[d]), b + int(near[d])))
    return out


def solve(codes: np.ndarray, low: int, high: int, edges: np.ndarray) -> list[tuple[int, int, int]]:
    """Match fragments ``(period, start, stop)`` of the periods in [low, high) in a row of tiles.

    ``codes`` are word numbers, tiles parted by numbers that stand once; ``edges`` are
    the places of these. Direct comparison keeps what is long enough or touches an edge.
    """
    n = len(codes)
    out = []
    inner = np.zeros(n + 1, bool)
    inner[edges] = True
    for q in range(low, min(high, DIRECT, n)):
        same = codes[:-q] == codes[q:]
        turn = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
        start, stop = turn[::2], turn[1::2]
        long = stop - start >= max((REPEATS - 1) * q, LEAST - q)
        # a tile's first word, or the last one that has a partner in the tile
        clipped = inner[start - 1] | inner[np.minimum(stop + q, n)]
        for i in np.flatnonzero(long | clipped).tolist():
            out.append((q, int(start[i]), int(stop[i])))
    p = max(low, DIRECT)
    if p >= high or 4 * p > n:
        return out
    with np.errstate(over="ignore"):
        power = np.full(n, _B, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        inverse = np.full(n, _B_INVERSE, np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * power, dtype=np.uint64)))
        while p < high and 4 * p <= n:
            grams = (total[p:] - total[:-p]) * inverse[:n - p + 1]
            rows = (len(grams) - 1) // p
            if rows >= 1:
                later = np.zeros(rows * p, np.uint64)
                found = grams[p:p + rows * p]
                later[:len(found)] = found
                meets = (later.reshape(rows, p) == grams[:rows * p:p, None]).any(axis=1)
                for j in np.flatnonzero(meets).tolist():
                    out.extend(_at_boundary(codes, j * p, p))
            p *= 2
    return out


def _stitched(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of one tile, those of a period that touch made one."""
    out: list[list[int]] = []
    for q, a, e in sorted(fragments):
        if out and out[-1][0] == q and a <= out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([q, a, e])
    return [tuple(x) for x in out]


def tiles(n: int, tile: int = TILE) -> list[tuple[int, int, int, int]]:
    """``(low, high, start, stop)``: period ranges and word ranges that together show every run of ``n`` words."""
    if n <= tile:
        return [(1, 1 << (n // REPEATS).bit_length(), 0, n)]
    first = max(DIRECT, tile // SCALE)  # the first tiles serve the octaves below this power of two
    out = [(1, first, max(0, s - 3 * first), min(n, s + tile + 5 * first)) for s in range(0, n, tile)]
    p = first
    while 4 * p <= n:
        size = SCALE * p
        out += [(p, 2 * p, max(0, s - 3 * p), min(n, s + size + 5 * p)) for s in range(0, n, size)]
        p *= 2
    return out


def _solve_together(parts: list[tuple[int, int, np.ndarray]]) -> list[list[tuple[int, int, int]]]:
    """Fragments of every ``(low, high, codes)``, in places of its own; parts of equal periods are solved as one row."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    ranges: dict[int, list[int]] = {}
    for i, (low, _, _) in enumerate(parts):
        ranges.setdefault(low, []).append(i)
    for low, members in ranges.items():
        # short rows first, so that large periods are sought only where they fit
        members.sort(key=lambda i: (parts[i][1], i))
        while members:
            take, size = [], 0
            high = parts[members[0]][1]
            while members and (not take or (size < _TOGETHER and parts[members[0]][1] == high)):
                take.append(members.pop(0))
                size += len(parts[take[-1]][2]) + 1
            row = np.empty(size + 1, np.int64)
            row[0] = -2
            starts, at = [], 1
            for k, i in enumerate(take):
                codes = parts[i][2]
                starts.append(at)
                row[at:at + len(codes)] = codes
                at += len(codes) + 1
                row[at - 1] = -3 - k
            edges = np.array([0, *(s + len(parts[i][2]) for s, i in zip(starts, take))])
            for q, a, e in solve(row, low, high, edges):
                k = int(np.searchsorted(starts, a, "right")) - 1
                if k >= 0 and e + q <= starts[k] + len(parts[take[k]][2]):
                    out[take[k]].append((q, a - starts[k], e - starts[k]))
    return [_stitched(x) for x in out]


_FRAGMENT = pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
_FRAGMENTS = "array<struct<period:long,start:long,stop:long>>"


def _worth(fragments, n, low_edge, high_edge):
    """Fragments that are long enough or may go on in the next tile."""
    keep = []
    for q, a, e in fragments:
        if e - a >= max((REPEATS - 1) * q, LEAST - q) or (a <= 0 and low_edge) or (e + q >= n and high_edge):
            keep.append({"period": q, "start": a, "stop": e})
    return keep


def _read(tile: int, plant):
    """Rows (key, doc_id, text) to words, plain digest, fragments of short documents and tiles of long ones."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                counts, digests, frags, sent, parts, who = [], [], [], [], [], []
                ids = b.column(1).to_pylist()
                for i, (doc_id, text) in enumerate(zip(ids, text_bytes(b.column(2)))):
                    words = plant(words_of(text), doc_id)
                    counts.append(len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    seen: dict[bytes, int] = {}
                    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
                    frags.append([])
                    if len(words) > tile:
                        sent.append([
                            {"low": low, "high": high, "start": s, "stop": e, "codes": codes[s:e].astype("<i4").tobytes()}
                            for low, high, s, e in tiles(len(words), tile)
                        ])
                    else:
                        sent.append([])
                        low, high, _, _ = tiles(len(words), tile)[0]
                        parts.append((low, high, codes))
                        who.append(i)
                for i, found in zip(who, _solve_together(parts)):
                    frags[i] = _worth(found, counts[i], False, False)
                texts = [t if f or s else None for t, f, s in zip(b.column(2).to_pylist(), frags, sent)]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()), pa.array(frags, pa.list_(_FRAGMENT)), pa.array(sent, pa.list_(_TILE)),
                ], ["key", "doc_id", "text", "n_words", "plain", "fragments", "tiles"])

    return run


_TILE = pa.struct([(c, pa.int64()) for c in ("low", "high", "start", "stop")] + [("codes", pa.binary())])


def _solve_tiles(batches):
    """Exploded tiles (key, n_words, tile) to their fragments in the document's places."""
    for b in batches:
        rows = b.column(2).to_pylist()
        parts = [(t["low"], t["high"], np.frombuffer(t["codes"], "<i4").astype(np.int64)) for t in rows]
        frags = []
        for t, n, found in zip(rows, b.column(1).to_pylist(), _solve_together(parts)):
            kept = _worth(found, len(t["codes"]) // 4, t["start"] > 0, t["stop"] < n)
            frags.append([{"period": f["period"], "start": f["start"] + t["start"], "stop": f["stop"] + t["start"]} for f in kept])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(frags, pa.list_(_FRAGMENT))], ["key", "fragments"])


def stitch(fragments: DataFrame) -> DataFrame:
    """``(key, start, length, period)`` of every run, from match fragments ``(key, period, start, stop)``."""
    order = Window.partitionBy("key", "period").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = fragments.withColumn("opens", (reached.isNull() | (F.col("start") > reached)).cast("int"))
    islands = islands.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("key", "period", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start") + F.col("period")
    runs = whole.withColumn("length", length).where((F.col("length") >= LEAST) & (F.col("length") >= REPEATS * F.col("period")))
    # a stretch with a smaller period shows at its multiples too
    return runs.groupBy("key", "start", "length").agg(F.min("period").alias("period"))


def _finish(plant):
    """Rows (key, doc_id, text, runs) to the digest of the collapsed text."""

    def run(batches):
        for b in batches:
            digests = []
            for doc_id, text, runs in zip(b.column(1).to_pylist(), text_bytes(b.column(2)), b.column(3).to_pylist()):
                words = plant(words_of(text), doc_id)
                depth = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    depth[r["start"] + r["period"]] += 1
                    depth[r["start"] + r["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()
                digests.append(hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.string())], ["key", "collapsed"])

    return run


def _as_is(words: list[bytes], doc_id: int | None) -> list[bytes]:
    return words


def find_runs(docs: DataFrame, plant=_as_is, tile: int = TILE) -> DataFrame:
    """``(key, doc_id, n_words, runs, collapsed)`` of every row of ``docs``.

    ``runs`` are (start, period, length) by start, then period; ``collapsed`` is
    the digest of the words that no run repeats. ``plant(words, doc_id)`` may
    change a document's words first.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    read = scratch.table(rows.mapInArrow(
        _read(tile, plant),
        f"key long, doc_id long, text string, n_words long, plain string, fragments {_FRAGMENTS},"
        " tiles array<struct<low:long,high:long,start:long,stop:long,codes:binary>>",
    ))
    spread = read.where(F.size("tiles") > 0).select("key", "n_words", F.explode("tiles").alias("tile"))
    spread = spread.repartition(F.xxhash64("key", "tile.start", "tile.low"))
    solved = spread.mapInArrow(_solve_tiles, f"key long, fragments {_FRAGMENTS}")
    fragments = read.select("key", "fragments").unionAll(solved).select("key", F.inline("fragments"))
    runs = stitch(fragments).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = scratch.table(runs)
    digests = read.select("key", "doc_id", "text").where("text is not null").join(runs, "key")
    digests = scratch.table(digests.mapInArrow(_finish(plant), "key long, collapsed string"))
    none = F.array().cast("array<struct<start:long,period:long,length:long>>")
    return (
        read.select("key", "doc_id", "n_words", "plain").join(runs, "key", "left").join(digests, "key", "left")
        .select("key", "doc_id", "n_words", F.coalesce("runs", none).alias("runs"), F.coalesce("collapsed", "plain").alias("collapsed"))
    )


def summary(found: DataFrame) -> DataFrame:
    """The longest run and the digests of each document of ``find_runs``."""
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), 1)
    best = F.when(F.size("runs") > 0, best)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "n_words", "runs", "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"), "n_words",
    )

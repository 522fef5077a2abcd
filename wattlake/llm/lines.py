"""Near-duplicate lines by a segment-partition edit join.

Lines are compared lower-cased (A-Z) and with runs of white space as one blank.
Two lines of ``MIN_CHARS`` or more characters link at an edit distance of at
most ``MAX_EDITS``, or from ``LONG`` characters on of one edit in ``SHARE``
characters of the shorter line. For the first a line is cut into ``MAX_EDITS + 1`` even segments; a line
within the distance that is not shorter holds at least one of them unchanged,
at a place that its length and the segment's number narrow to a few positions.
Segments and probed substrings meet by hash, and candidate pairs are verified
by banded bit-parallel edit distance.

A hash shared by more than ``CROWD`` lines gives no pairs: its lines are compared
in bounded blocks that return spanning links only, by the rarest tiles of each
line and without those that other links already join. Hashes that are crowded in
one task's lines alone are set aside there and never shuffled to one task.

Pairs of long lines with more edits are candidates when a band of their MinHash
signatures (character grams of ``GRAM``) agrees; all candidates are verified.
Up to ``MAX_EDITS`` the join is exact; beyond it a pair is met with the
probability that its common grams give: nearly all where edits come in whole
words, less where single characters all over a line differ.

Of every class of linked or equal lines the first (smallest document, then
line) stays. Lines below the length are never touched, unless the whole document
goes: its long lines are all redundant and its short ones all stand in earlier
documents.

Defined results: null text has no lines; repeated rows are one occurrence and
share decisions; rows with a null ``doc_id`` are left as they are; an empty
table gives no rows; other columns pass untouched through ``deduplicate``.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, components, pieces, text_bytes

MAX_EDITS = 2
MIN_CHARS = 20
#: Lines of this length on may differ by one edit in so many characters.
LONG, SHARE = 64, 16
#: Characters of a gram, and bands and minima of each in a long line's signature.
GRAM, BANDS, MINIMA = 12, 20, 3
#: Grams that a core hashes at once.
_CACHED = 1 << 15
CROWD = 16
#: Lines that a partition remembers.
_SEEN = 1 << 18
#: Characters of lines that a task handles at once, and bits of the fixed-size filter of wanted lines.
_PIECE, BITS = 1 << 17, 26
_SEGMENT, _PROBE = 1, 2
#: Bits of a packed hash that hold the role, and rows that a task packs at once.
_ROLE, _HELD = np.uint64(2), 1 << 19
#: Documents to a bucket of hashes, and most buckets.
_DOCS, _BUCKETS = 1000, 1 << 13
#: Lines of a crowded hash that one task compares with as many others.
BLOCK = 768
#: Lines of a crowded hash up to which all of its pairs are verified, and rows of such hashes that are compared together.
_SMALL, _TOGETHER = 128, 8192
#: Most bits of a gram's hash by which a block counts it, and grams and pairs of lines that it looks at once.
_SLOTS, _TURN, _MEET = 20, 1 << 18, 1 << 18
#: Lines that a partition remembers.
_SEEN = 1 << 18
#: Characters of lines that a task handles at once, and bits of the fixed-size filter of wanted lines.
_PIECE, BITS = 1 << 17, 26
_SEGMENT, _PROBE = 1, 2
#: Bits of a packed hash that hold the role, and rows that a task packs at once.
_ROLE, _HELD = np.uint64(2), 1 << 19
#: Documents to a bucket of hashes, and most buckets.
_DOCS, _BUCKETS = 1000, 1 << 13
#: First bits of a gram's hash by which it is counted and known as a tile, and pairs of lines that a task looks at once.
_COUNTS, _KNOWN, _MEET = 22, 24, 1 << 21
_hash = xxhash.xxh64_intdigest


def normal(line: str) -> str:
    return " ".join(line.encode().lower().decode().split())


def allowed(length: int, edits: int = MAX_EDITS) -> int:
    """Most edits between two lines, the shorter one of ``length`` characters."""
    return max(edits, length // SHARE) if length >= LONG else edits


def _segments(length: int, parts: int) -> list[tuple[int, int]]:
    """Start and length of even segments, the longer ones last."""
    size, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = size + (i >= parts - longer)
        out.append((at, n))
        at += n
    return out


@lru_cache(maxsize=8192)
def _plan(length: int, edits: int) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """``(start, stop, seed)`` of what a line of ``length`` gives to the join, and the role of each.

    A line gives its own segments, and the substrings that may equal a segment
    of a line of its length or up to ``edits`` shorter. A place where both fall
    together is given once. The seed holds the segment's line length and number.
    """
    places, roles = [], []
    for less in range(edits + 1):
        if length - less <= edits:
            break
        for i, (at, size) in enumerate(_segments(length - less, edits + 1)):
            low = max(at - i, at + less - (edits - i), 0)
            high = min(at + i, at + less + (edits - i), length - size)
            for start in range(low, high + 1):
                places.append((start, start + size, (length - less) * 16 + i))
                roles.append(_PROBE | (_SEGMENT if not less and start == at else 0))
    return places, np.array(roles, np.int32)


def signatures(line: str, edits: int = MAX_EDITS) -> list[tuple[int, int, int, int]]:
    """``(hash, role, start, length)`` of a line's segments and probed substrings."""
    places, roles = _plan(len(line), edits)
    return [(_hash(line[a:b], seed), r, a, b - a) for (a, b, seed), r in zip(places, roles.tolist())]


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Both texts without their common start and end."""
    start = _common(a, b)
    a, b = a[start:], b[start:]
    end = _common(a[::-1], b[::-1])
    return a[:len(a) - end], b[:len(b) - end]


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance of ``a`` and ``b``, or ``most + 1`` if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    a, b = _trimmed(a, b)
    if not a or not b:
        return max(len(a), len(b))
    # a narrow band ends sooner; it is widened until the distance fits
    band = min(most, 4)
    while (found := _banded(a, b, band)) > band and band < most:
        band = min(most, 4 * band)
    return min(found, most + 1)


def _banded(a: str, b: str, most: int) -> int:
    """Distance by bit-parallel columns of the ``2 * most + 1`` diagonals around the main one, or ``most + 1``.

    Bit ``d`` of a column stands for the cell on diagonal ``d - most``, so a column's bits need no
    shift to the next one. ``up`` and ``down`` hold where a cell is one more or one less than the
    cell above it. The last diagonal's value is followed until it meets the end of ``a``, then
    the last row's.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    codes = np.frombuffer(a.encode("utf-32-le"), np.uint32)
    where = {chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little") for c in np.unique(codes)}
    mask, top, rows = (1 << 2 * most + 1) - 1, 1 << 2 * most, len(a)
    up, down, value = (mask >> most) << most, 0, min(most, rows)
    for j, c in enumerate(b, 1):
        shift = j - 1 - most
        bits = where.get(c, 0)
        same = (bits >> shift if shift >= 0 else bits << -shift) & mask
        level = (((same & up) + up ^ up) | same | down) & mask
        more, less = down | ~(level | up) & mask, level & up
        if j + most <= rows:
            value += not level & top
        else:
            last = 1 << rows - j + most
            value += bool(more & last) - bool(less & last)
        # what is left to come takes off at most one a column
        # (a way of ``most`` edits has ``most`` at this column and lies ``2 * most`` cells off the last diagonal, at most)
        if value - (len(b) - j) > most and j + most > rows or value > 3 * most:
            return most + 1
        up, down = less | ~(level >> 1 | more) & mask, level >> 1 & more
    return min(value, most + 1)


#: Widest band of ``within``, pairs that it takes at once and characters of them in all.
_BAND, _PAIRS, _CHARS = 255, 4096, 1 << 21
#: Pairs below which one at a time is faster, and characters of pairs that ``within`` sorts by band and length at once.
_FEW, _SORTED = 16, 1 << 22


def within(pairs: list[tuple[str, str]], most: list[int]) -> np.ndarray:
    """Which pairs are at most so many edits apart: banded bit-parallel columns of many pairs at once."""
    out = np.zeros(len(pairs), bool)
    left, chars = {}, 0
    for i, ((a, b), k) in enumerate(zip(pairs, most)):
        if abs(len(a) - len(b)) > k:
            continue
        a, b = _trimmed(a, b)
        if not a or not b or max(len(a), len(b)) <= k:
            out[i] = max(len(a), len(b)) <= k
        elif k > _BAND:
            out[i] = edit_distance(a, b, k) <= k
        else:
            # pairs whose bands take about as many words
            left.setdefault((2 * k >> 6).bit_length(), []).append((len(b), i, a, b))
            chars += len(a) + len(b)
            if chars > _SORTED:
                _within_sorted(left, most, out)
                left, chars = {}, 0
    _within_sorted(left, most, out)
    return out


def _within_sorted(left: dict, most: list[int], out: np.ndarray) -> None:
    """Sets ``out`` for pairs ``(length, place, a, b)`` by their bands."""
    for group in left.values():
        group.sort(key=lambda x: (x[0], x[1]), reverse=True)
        at = 0
        while at < len(group):
            part = group[at:at + max(1, min(_PAIRS, _CHARS // (group[at][0] + 2 * _BAND)))]
            at += len(part)
            if len(part) < _FEW:
                for _, i, a, b in part:
                    out[i] = edit_distance(a, b, most[i]) <= most[i]
                continue
            who = np.array([i for _, i, _, _ in part])
            limit = np.array([most[i] for i in who.tolist()])
            out[who] = _banded_many([a for _, _, a, _ in part], [b for _, _, _, b in part], int(limit.max())) <= limit


def _codes(texts: list[str], sizes: np.ndarray, before: int, width: int, kind: type, blank: int) -> np.ndarray:
    """Characters of the texts, one row each, ``before`` blanks ahead."""
    out = np.full((len(texts), width), blank, kind)
    at = np.arange(width)
    inside = (at >= before) & (at < before + sizes[:, None])
    out[inside] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return out


def _banded_many(a: list[str], b: list[str], most: int) -> np.ndarray:
    """``_banded`` of many pairs, the longest ``b`` first; larger distances come out above ``most``.

    A column's bits are in as many words as they need, the lowest first. The last diagonal's value is followed to the end of
    ``b``, beyond the end of ``a`` as if blanks came there; the cells below the end of ``a`` are taken off at last.
    """
    width = 2 * most + 1
    words = (width + 63) // 64
    rows, cols = (np.array([len(x) for x in v]) for v in (a, b))
    far = int(max(rows.max(), cols.max()))
    # as few bytes a character as hold all of them and two blanks
    top = ord(max(map(max, itertools.chain(a, b))))
    kind = next(x for x in (np.uint8, np.uint16, np.uint32) if top < np.iinfo(x).max - 1)
    first = _codes(a, rows, most, far + width + 1, kind, np.iinfo(kind).max)
    second = _codes(b, cols, 0, far, kind, np.iinfo(kind).max - 1).T.copy()
    one, high = np.uint64(1), np.uint64(63)
    masks = _word_masks(np.zeros(1, np.int64), np.array([width]), words)
    last, top_bit = masks[-1, 0], np.uint64(2 * most & 63)
    ups = np.repeat(_word_masks(np.array([most]), np.array([width]), words), len(a), axis=1)
    downs, hits = np.zeros_like(ups), np.zeros(len(a), np.uint64)
    spare = [np.empty_like(ups) for _ in range(4)]
    bits = np.zeros((len(a), 64 * words), bool)
    still = np.searchsorted(-cols, -np.arange(1, int(cols[0]) + 1), "right").tolist()
    n = 0
    for j, left in enumerate(still):
        if left != n:
            n = left
            up, down, hit, chosen = ups[:, :n], downs[:, :n], hits[:n], bits[:n, :width]
            level, more, less, half = (x[:, :n] for x in spare)
        np.equal(first[:n, j:j + width], second[j, :n, None], out=chosen)
        same = np.packbits(bits[:n], axis=1, bitorder="little").view("<u8").T
        np.bitwise_and(same, up, out=level)
        level += up
        if words > 1:
            over = level < up
            for w in range(1, words):
                level[w] += over[w - 1]
                over[w] |= (level[w] == 0) & over[w - 1]
        level ^= up
        level |= same
        level |= down
        level[-1] &= last
        np.bitwise_or(level, up, out=more)
        np.invert(more, out=more)
        more |= down
        np.bitwise_and(level, up, out=less)
        hit += level[-1] >> top_bit & one
        np.right_shift(level, one, out=half)
        if words > 1:
            half[:-1] |= level[1:] << high
        np.bitwise_and(half, more, out=down)
        half |= more
        np.invert(half, out=half)
        np.bitwise_or(less, half, out=up)
    below = _word_masks(rows - cols + most, np.full(len(a), 2 * most), words)
    taken = (np.bitwise_count(ups & below).astype(np.int64) - np.bitwise_count(downs & below)).sum(axis=0)
    return most + cols - hits.astype(np.int64) - taken


def _word_masks(low: np.ndarray, high: np.ndarray, words: int) -> np.ndarray:
    """Words with the bits from ``low`` up to ``high`` set, a column for each of the ranges."""
    at = 64 * np.arange(words)[:, None]

    def below(n):
        n = np.clip(n - at, 0, 64).astype(np.uint64)
        return np.where(n == 64, ~np.uint64(0), (np.uint64(1) << (n & np.uint64(63))) - np.uint64(1))

    return below(high) & ~below(low)


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if a[:1] != b[:1]:
        return 0
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _line_ids(line: str) -> tuple[int, int]:
    """Two independent hashes of a normalised line, signed."""
    h = xxhash.xxh3_128_intdigest(line)
    return tuple((x - (1 << 64) if x >> 63 else x) for x in (h & (1 << 64) - 1, h >> 64))


def _eligible(raw: bytes | None, least: int):
    """``(line number, normalised line)`` of a text's lines that are long enough."""
    for i, line in enumerate(raw.lower().decode().split("\n") if raw else ()):
        if len(line) >= least:
            line = " ".join(line.split())
            if len(line) >= least:
                yield i, line


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def _distinct_lines(batches, least: int):
    """Small lists of ids and lines, without lines that this partition has just given."""
    seen: set[int] = set()
    for b in pieces(batches):
        ids, lines, size = [], [], 0
        for raw in text_bytes(b.column(b.num_columns - 1)):
            for _, line in _eligible(raw, least):
                i = _line_ids(line)[0]
                if i not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(i)
                    ids.append(i)
                    lines.append(line)
                    size += len(line)
            if size > _PIECE:
                yield ids, lines
                ids, lines, size = [], [], 0
        if ids:
            yield ids, lines


def _signed(keys) -> np.ndarray:
    return np.fromiter(keys, np.uint64).view(np.int64)


def _rows(ids: list[int], lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, line id and role of every signature of the lines."""
    plans = [_plan(len(x), edits) for x in lines]
    keys = _signed(_hash(x[a:b], seed) for x, (places, _) in zip(lines, plans) for a, b, seed in places)
    of = np.repeat(np.array(ids, np.int64), [len(roles) for _, roles in plans])
    return keys, of, np.concatenate([roles for _, roles in plans])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _rolled(chars: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of every ``size`` characters: those of 1, 2, 4 and more characters put together."""
    n = max(len(chars) - size + 1, 0)
    out, part, width, at = np.zeros(n, np.uint64), chars, 1, 0
    while True:
        if size & width:
            out = out * np.uint64(pow(0x100000001B3, width, 1 << 64)) + part[at:at + n]
            at += width
        if at == size:
            return out
        part = part[:-width] * np.uint64(pow(0x100000001B3, width, 1 << 64)) + part[width:]
        width *= 2


def _bands(ids: list[int], lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, line id and role of every signature band of the long lines."""
    chosen = [i for i, x in enumerate(lines) if len(x) >= LONG]
    if not chosen:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    of = np.array([ids[i] for i in chosen], np.int64)
    sizes = np.array([len(lines[i]) for i in chosen])
    chars = np.frombuffer("".join(lines[i] for i in chosen).encode("utf-32-le"), np.uint32).astype(np.uint64)
    grams = _rolled(chars, GRAM)
    # grams that reach into the next line are left out
    starts = np.cumsum(sizes) - sizes
    inside = np.ones(len(chars), bool)
    for j in range(1, GRAM):
        inside[starts + sizes - j] = False
    grams = (_mixed(grams[inside[:len(grams)]]) >> np.uint64(32)).astype(np.uint32)
    firsts = np.cumsum(sizes - GRAM + 1) - (sizes - GRAM + 1)
    factors = (_mixed(np.arange(1, BANDS * MINIMA + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
    # lines of so many grams at once that a core's own cache holds them
    lows = np.empty((BANDS * MINIMA, len(of)), np.uint32)
    parts = np.flatnonzero(np.concatenate([[True], np.diff(firsts // _CACHED) > 0, [True]])).tolist()
    for begin, end in zip(parts, parts[1:]):
        some = grams[firsts[begin]:firsts[end] if end < len(of) else None]
        at, turned, spare = firsts[begin:end] - firsts[begin], np.empty_like(some), np.empty_like(some)
        for f, low in zip(factors, lows):
            np.multiply(some, f, out=turned)
            np.right_shift(turned, np.uint32(15), out=spare)
            turned ^= spare
            turned *= np.uint32(0x85EBCA6B)
            np.minimum.reduceat(turned, at, out=low[begin:end])
    keys = []
    for band in range(BANDS):
        key = np.full(len(of), band + 1 << 8, np.uint64)
        for low in lows[band * MINIMA:(band + 1) * MINIMA]:
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + low)
        keys.append(key.view(np.int64))
    return np.concatenate(keys), np.tile(of, BANDS), np.full(BANDS * len(of), _SEGMENT | _PROBE, np.int32)


def _runs(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal values."""
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    return at, np.diff(np.concatenate([at, [len(k)]]))


def _sent(least: int, edits: int, crowd: int, buckets: int):
    """The hashes of the lines, sorted and packed: ``(bucket, crowded, keys, ids)``, ranges of hashes in a bucket each.

    A hash carries the role in its lowest two bits. Hashes with more than ``crowd`` lines here are crowded anywhere: their
    rows go to any bucket, and a row of no role tells the hash's own bucket, so that none holds a very common hash's rows.
    """

    def pack(keys, ids, to):
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        at, size = _runs(keys >> _ROLE)
        own, marks = np.ones(len(keys), bool), []
        for s, n in zip(at[size > crowd].tolist(), size[size > crowd].tolist()):
            if len(np.unique(ids[s:s + n])) > crowd:
                own[s:s + n] = False
                marks.append(s)
        parts = []
        if marks:
            parts.append((to % buckets, True, keys[~own].tobytes(), ids[~own].tobytes()))
            marked = keys[marks] >> _ROLE << _ROLE
            keys, ids = np.concatenate([keys[own], marked]), np.concatenate([ids[own], ids[marks]])
            order = np.argsort(keys)
            keys, ids = keys[order], ids[order]
        ends = np.searchsorted(keys >> np.uint64(32), (np.arange(1, buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets))
        begin = 0
        for i, end in enumerate(ends.tolist()):
            if end > begin:
                parts.append((i, False, keys[begin:end].tobytes(), ids[begin:end].tobytes()))
            begin = end
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*parts), (pa.int32(), pa.bool_(), pa.binary(), pa.binary()))], ["bucket", "crowded", "keys", "ids"]
        )

    def run(batches):
        held, n, to = [], 0, 0
        for ids, lines in _distinct_lines(batches, least):
            to = to or abs(ids[0])
            for keys, of, roles in (_rows(ids, lines, edits), _bands(ids, lines)):
                held.append((keys.view(np.uint64) >> _ROLE << _ROLE | roles.astype(np.uint64), of))
                n += len(of)
            if n > _HELD:
                yield pack(*(np.concatenate(x) for x in zip(*held)), to)
                held, n, to = [], 0, to + 1
        if n:
            yield pack(*(np.concatenate(x) for x in zip(*held)), to)

    return run


_CANDIDATES = "a long, b long, crowd long"


def _meet(crowd: int):
    """Over a bucket's hashes: candidate pairs of each, or its lines (``crowd`` set) where there are too many."""

    def run(t: pa.Table) -> pa.Table:
        def rows(chosen):
            return (np.frombuffer(b"".join(chosen[c].to_pylist()), d) for c, d in (("keys", np.uint64), ("ids", np.int64)))

        told, told_ids = rows(t.filter(t["crowded"]))
        keys, ids = rows(t.filter(pc.invert(t["crowded"])))
        again = [(told >> _ROLE << _ROLE, told_ids)]
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        # most hashes are of one line
        at, size = _runs(keys >> _ROLE)
        many = np.repeat((size > 1) | (keys[at] & np.uint64(3) == 0), size)
        keys, ids = keys[many], ids[many]
        role, keys = (keys & np.uint64(3)).astype(np.int8), keys >> _ROLE << _ROLE
        order = np.lexsort((ids, keys))
        keys, ids, role = keys[order], ids[order], role[order]
        marked = np.unique(keys[role == 0])
        keys, ids, role = (x[role > 0] for x in (keys, ids, role))
        # one row for each hash and line
        at = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])])) if len(keys) else np.empty(0, np.int64)
        keys, ids, role = keys[at], ids[at], np.bitwise_or.reduceat(role, at) if len(at) else role[at]
        at, size = _runs(keys)
        full = (size > crowd) | np.isin(keys[at], marked)
        chosen = np.repeat(full, size)
        again.append((keys[chosen], ids[chosen]))
        pairs = []
        for n in range(2, crowd + 1):
            place = at[(size == n) & ~full]
            for i, j in itertools.combinations(range(n), 2) if len(place) else ():
                x, y = place + i, place + j
                near = (role[x] & role[y] >> 1 | role[x] >> 1 & role[y]) & 1 > 0
                pairs.append(np.stack([ids[x[near]], ids[y[near]]]))
        a, b = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
        key, of = (np.concatenate(x) for x in zip(*again))
        return pa.table({
            "a": np.concatenate([a, of]), "b": pa.concat_arrays([pa.array(b), pa.nulls(len(of), pa.int64())]),
            "crowd": pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(key.view(np.int64))]),
        })

    return run


def _bits(ids: DataFrame) -> np.ndarray:
    """A bit for each of ``2 ** BITS`` remainders, set where some id has it: ``2 ** (BITS - 3)`` bytes for any number of ids."""
    low = F.col("id").bitwiseAND(F.lit((1 << BITS) - 1))
    word, bit = F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, CAST(id & 63 AS INT))")
    found = ids.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << BITS - 6, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def occurrences(docs: DataFrame, ids: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, line, id, check, text)`` of every eligible line.

    ``text`` is there for lines with the given distinct ``id`` and few others, and not again where a partition has just given it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bits(ids))

    def batch(rows, seen):
        doc, line, i, check, text = zip(*rows)
        i = np.array(i, np.int64)
        low = i & (1 << BITS) - 1
        told = [None] * len(rows)
        for at in np.flatnonzero(shared.value[low >> 6] >> (low & 63).astype(np.uint64) & np.uint64(1)).tolist():
            if rows[at][2] not in seen:
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(rows[at][2])
                told[at] = text[at]
        cols = [pa.array(c, pa.int64()) for c in (doc, line, i, check)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(told, pa.string())], ["doc_id", "line", "id", "check", "text"])

    def run(batches):
        seen: set[int] = set()
        for b in pieces(batches):
            rows, size = [], 0
            for d, raw in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                for i, x in _eligible(raw, least):
                    rows.append((d, i, *_line_ids(x), x))
                    size += len(x)
                if size > _PIECE:
                    yield batch(rows, seen)
                    rows, size = [], 0
            if rows:
                yield batch(rows, seen)

    return _texts(docs).mapInArrow(run, "doc_id long, line long, id long, check long, text string")


def _neighbours(text: DataFrame) -> DataFrame:
    """Pairs of lines that stand together in the order of their texts, and of their texts read backwards."""

    def run(batches):
        before = []
        for b in batches:
            ids = before + b.column(0).to_pylist()
            pairs = [(min(x, y), max(x, y)) for x, y in zip(ids, ids[1:])]
            a, c = zip(*pairs) if pairs else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["a", "b"])
            before = ids[-1:]

    orders = [text.orderBy(by).select("id").mapInArrow(run, "a long, b long") for by in (F.col("text"), F.reverse("text"))]
    return orders[0].unionAll(orders[1])


def _grams(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, line and place of every gram of ``size`` characters, in order."""
    sizes = np.array([len(x) for x in lines])
    chars = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)
    key = _rolled(chars, size)
    line = np.repeat(np.arange(len(lines)), sizes)
    place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place + size <= sizes[line]
    return _mixed(key[inside[:len(key)]] + np.uint64(size)), line[inside], place[inside]


def _sizes(edits: int, least: int) -> tuple[int, int]:
    """Characters of a tile, of lines below ``LONG`` and from there on: a line holds one more than the edits it may have."""
    return min(6, max(1, least // (edits + 1))), min(8, max(1, LONG // (allowed(LONG, edits) + 1)))


def _tiles(lines: list[str], edits: int, least: int):
    """Hash, line, place and ``own`` of the grams that may meet; those ``own`` are tiles of the line, side by side."""
    out = []
    for long, size in enumerate(_sizes(edits, least)):
        # the shorter of a pair on both sides of LONG differs by ``edits`` at most
        chosen = [i for i, x in enumerate(lines) if (len(x) >= LONG - edits if long else len(x) < LONG + edits)]
        if not chosen:
            continue
        key, line, place = _grams([lines[i] for i in chosen], size)
        length = np.array([len(lines[i]) for i in chosen])[line]
        own = (place % size == 0) & ((length >= LONG) == bool(long))
        out.append((key, np.array(chosen)[line], place, own))
    return tuple(np.concatenate(x) for x in zip(*out))


def _alike(lines: list[str], label: np.ndarray, edits: int, least: int):
    """Arrays of places of two lines, shorter ones first, of different labels that may be within the distance.

    Of any ``k + 1`` pieces of a line, side by side, ``k`` edits leave one unchanged, at most ``k`` places away. So every
    line looks for its rarest tiles, one more than the edits it may have, in the other lines.
    """
    size = np.array([len(x) for x in lines])
    most = np.where(size >= LONG, np.maximum(edits, size // SHARE), edits)
    bits = min(max(int(size.sum()).bit_length() + 2, 12), _SLOTS)
    counts, known = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, bool)
    parts = np.flatnonzero(np.concatenate([[True], np.diff(np.cumsum(size) // _PIECE) > 0, [True]])).tolist()

    def slots(key):
        return (key >> np.uint64(64 - bits)).astype(np.int64)

    # the grams of a few lines are made once
    whole = _tiles(lines, edits, least) if len(parts) == 2 else None

    def chosen(begin, end):
        """Grams that more than one line may have, and which are tiles that their line looks for."""
        key, line, place, own = whole or _tiles(lines[begin:end], edits, least)
        line, own = line + begin, own.copy()
        n = counts[slots(key)]
        at = np.flatnonzero(own)
        at = at[np.lexsort((n[at], line[at]))]
        first, number = _runs(line[at])
        own[at[np.arange(len(at)) - np.repeat(first, number) > most[line[at]]]] = False
        some = n > 1
        return key[some], line[some], place[some], own[some]

    for begin, end in zip(parts, parts[1:]):
        counts += np.bincount(slots((whole or _tiles(lines[begin:end], edits, least))[0]), minlength=1 << bits).astype(np.int32)
    for begin, end in zip(parts, parts[1:]):
        key, _, _, own = chosen(begin, end)
        known[slots(key[own])] = True
    # the grams of very long lines in turns, by their hash
    turns = int(size.sum()) // _TURN + 1
    for turn in range(turns):
        rows = []
        for begin, end in zip(parts, parts[1:]):
            key, line, place, own = chosen(begin, end)
            here = known[slots(key)] & (key % np.uint64(turns) == turn)
            rows.append((key[here], line[here], place[here], own[here]))
        key, line, place, own = (np.concatenate(x) for x in zip(*rows))
        order = np.lexsort((place, key))
        key, line, place, own = (x[order] for x in (key, line, place, own))
        if not len(key):
            continue
        at, number = _runs(key)
        several = np.minimum.reduceat(label[line], at) != np.maximum.reduceat(label[line], at)
        here = np.repeat(several & np.logical_or.reduceat(own, at), number)
        key, line, place, own = key[here], line[here], place[here], own[here]
        # places of one hash are a range of these numbers
        at, number = _runs(key)
        base = np.repeat(np.arange(len(at)), number) << 32
        x = np.flatnonzero(own)
        low = np.searchsorted(base + place, base[x] + np.maximum(place[x] - most[line[x]], 0))
        high = np.searchsorted(base + place, base[x] + place[x] + most[line[x]], "right")
        total = np.cumsum(high - low)
        if len(x) and turns * int(total[-1]) > len(lines) ** 2:
            # most lines have most tiles: every pair once
            first = np.searchsorted(size, size - most)
            for j in range(1, len(lines)):
                i = np.arange(first[j], j)
                i = i[label[i] != label[j]]
                yield i, np.full(len(i), j)
            return
        begin = 0
        while begin < len(x):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + _MEET, "right")))
            n = high[begin:end] - low[begin:end]
            j = np.repeat(low[begin:end], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = line[np.repeat(x[begin:end], n)], line[j]
            near = (label[i] != label[j]) & (np.abs(size[i] - size[j]) <= np.minimum(most[i], most[j]))
            pairs, n = np.unique(np.minimum(i, j)[near] * len(lines) + np.maximum(i, j)[near], return_counts=True)
            pairs = pairs[np.argsort(-n, kind="stable")]
            yield pairs // len(lines), pairs % len(lines)
            begin = end


def _shared(keys: list[list[int]]) -> np.ndarray:
    """Bits of the keys that more than one of the lists holds: two rows have a bit in common where the lists have a key."""
    flat = np.array([k for v in keys for k in v], np.int64)
    row = np.repeat(np.arange(len(keys)), [len(v) for v in keys])
    _, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    chosen = n[at] > 1
    place = (np.cumsum(n > 1) - 1)[at[chosen]]
    out = np.zeros((len(keys), int((n > 1).sum()) // 8 + 1), np.uint8)
    np.bitwise_or.at(out, (row[chosen], place >> 3), (1 << (place & 7)).astype(np.uint8))
    return out


def _few_alike(lines: list[str], label: np.ndarray, edits: int):
    """All pairs of places of a few lines, shorter ones first, of different labels and lengths within the distance."""
    size = np.array([len(x) for x in lines])
    most = np.where(size >= LONG, np.maximum(edits, size // SHARE), edits)
    i, j = np.triu_indices(len(lines), 1)
    near = (label[i] != label[j]) & (size[j] - size[i] <= most[i])
    yield i[near], j[near]


def _block_links(edits: int, least: int):
    """Spanning links of the lines of a block, or of some keys with few lines, verified."""

    def run(t: pa.Table) -> pa.Table:
        ids, lines, others, keys = (t[c].to_pylist() for c in ("id", "text", "before", "key"))
        order = sorted(range(len(ids)), key=lambda i: (keys[i], len(lines[i]), ids[i]))
        ids, lines, others = ([v[i] for i in order] for v in (ids, lines, others))
        side, key = t["side"].to_numpy()[order], t["key"].to_numpy()[order]
        most = np.array([allowed(len(x), edits) for x in lines])
        label = np.unique(t["label"].to_numpy(), return_inverse=True)[1][order]
        a, b = [], []

        def link(i, j):
            """Verify pairs of places that are not linked yet; the first of a pair is not longer."""
            for at in range(0, len(i), 4 * _PAIRS):
                x, y = i[at:at + 4 * _PAIRS], j[at:at + 4 * _PAIRS]
                new = label[x] != label[y]
                x, y = x[new], y[new]
                near = within([(lines[p], lines[q]) for p, q in zip(x.tolist(), y.tolist())], most[x].tolist())
                for p, q in zip(x[near].tolist(), y[near].tolist()):
                    if label[p] != label[q]:
                        label[label == label[p]] = label[q]
                        a.append(ids[p])
                        b.append(ids[q])

        waiting, n = [], 0
        for begin, size in zip(*(x.tolist() for x in _runs(key))):
            part = slice(begin, begin + size)
            if label[part].min() == label[part].max():
                continue
            few = size <= _SMALL
            shared = _shared(others[part])
            for i, j in _few_alike(lines[part], label[part], edits) if few else _alike(lines[part], label[part], edits, least):
                # pairs that meet here, under the smallest key that both lines have
                meet = (side[begin + i] != side[begin + j]) | (side[begin + i] == 2)
                i, j = i[meet], j[meet]
                for at in range(0, len(i), _MEET):
                    x, y = i[at:at + _MEET], j[at:at + _MEET]
                    new = ~(shared[x] & shared[y]).any(axis=1)
                    waiting.append((begin + x[new], begin + y[new]))
                    n += len(waiting[-1][0])
                if n > (4 * _PAIRS if few else _PAIRS // 4):
                    link(*(np.concatenate(x) for x in zip(*waiting)))
                    waiting, n = [], 0
        if waiting:
            link(*(np.concatenate(x) for x in zip(*waiting)))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _dense_rows(still: DataFrame, text: DataFrame, edits: int, least: int, roots: DataFrame | None = None) -> DataFrame:
    """The lines ``(key, id)`` with their texts, by the groups that compare them: ``key, low, high``.

    A key's lines are one block, or blocks of ``BLOCK`` compared two by two; ``small`` keys have few lines. ``before`` holds the smaller keys of a line:
    a pair is compared under the smallest that both have. ``roots(node, root)`` are components known: lines of one need no
    comparison, and a key within one gives no rows.
    """
    if roots is None:
        known = still.select("key", "id", F.col("id").alias("label"))
    else:
        known = still.join(roots, still.id == roots.node, "left").select("key", "id", F.coalesce("root", "id").alias("label"))
    sizes = known.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most"))
    sizes = sizes.where("least <> most").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), (F.col("n") <= _SMALL).alias("small"))
    known = known.join(sizes, "key")
    every = still.groupBy("id").agg(F.collect_set("key").alias("every"))
    before = F.filter("every", lambda k: k < F.col("key")).alias("before")
    rows = known.join(text.join(every, "id"), "id")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    members = rows.select("key", "small", "id", "label", "text", before, own.alias("own"), other)
    return members.select(
        "key", "small", "id", "label", "text", "before", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )


def _dense_links(still: DataFrame, text: DataFrame, edits: int, least: int, roots: DataFrame | None = None) -> DataFrame:
    """Links among the lines ``(key, id)`` of each key, block against block, that join more than ``roots``."""
    session = still.sparkSession
    # alike texts compress well: by their size they would be few tasks
    tasks = max(4 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    # keys with few lines are compared together: a pair alone takes far longer than one of many
    parts = max(session.sparkContext.defaultParallelism, still.count() // _TOGETHER)
    part = F.when(F.col("small"), F.pmod(F.xxhash64("key"), F.lit(parts))).otherwise(F.col("key"))
    rows = _dense_rows(still, text, edits, least, roots).withColumn("part", part).repartition(tasks, "part", "low", "high")
    return rows.groupBy("part", "low", "high").applyInArrow(_block_links(edits, least), "a long, b long")


def _verified(pairs: DataFrame, text: DataFrame, edits: int) -> DataFrame:
    """The pairs within the distance."""

    def run(batches):
        for b in pieces(batches, _PAIRS):
            pairs = list(zip(b.column(2).to_pylist(), b.column(3).to_pylist()))
            ok = within(pairs, [allowed(min(len(x), len(y)), edits) for x, y in pairs])
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = text.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = text.select(F.col("id").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    short = F.least(F.length("left"), F.length("right"))
    most = F.when(short >= LONG, F.greatest(F.lit(edits), F.floor(short / SHARE))).otherwise(edits)
    close = both.where(F.abs(F.length("left") - F.length("right")) <= most)
    return close.mapInArrow(run, "a long, b long")


def _met(docs: DataFrame, scratch: Scratch, edits: int, least: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs, and the lines ``(key, id)`` of crowded hashes."""
    buckets = min(max(docs.count() // _DOCS, 16), _BUCKETS)
    rows = _texts(docs).select("text").mapInArrow(_sent(least, edits, crowd, buckets), "bucket int, crowded boolean, keys binary, ids binary")
    found = scratch.table(rows.groupBy("bucket").applyInArrow(_meet(crowd), _CANDIDATES))
    pairs = scratch.table(found.where("crowd is null").select("a", "b").distinct())
    crowded = scratch.table(found.where("crowd is not null").select(F.col("crowd").alias("key"), F.col("a").alias("id")).distinct())
    scratch.drop(found)
    return pairs, crowded


def _links(docs: DataFrame, scratch: Scratch, edits: int, least: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """The links of ``links``, and ``occurrences``."""
    pairs, crowded = _met(docs, scratch, edits, least, crowd)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionAll(crowded.select("id")).distinct()
    ids = scratch.table(ids)
    # the texts are read once for the lines of all and the texts of some
    every = scratch.table(occurrences(docs, ids, least))
    text = every.where("text is not null").select("id", "text").join(ids, "id", "left_semi")
    text = scratch.table(text.dropDuplicates(["id"]))
    if crowded.isEmpty():
        return _verified(pairs, text, edits), every
    # what the pairs and likely ones of the crowded lines link needs no comparison in a crowded key
    likely = _neighbours(text.join(crowded.select("id").distinct(), "id", "left_semi"))
    roots = scratch.table(components(scratch, _verified(pairs.unionAll(likely).distinct(), text, edits)))
    more = _dense_links(crowded, text, edits, least, roots)
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more), every


def links(docs: DataFrame, edits: int = MAX_EDITS, least: int = MIN_CHARS, crowd: int = CROWD) -> DataFrame:
    """Links ``(a, b)`` between hashes of different lines within the distance; they span every component."""
    return _links(docs, Scratch(docs.sparkSession), edits, least, crowd)[0]


def repeats(docs: DataFrame, edits: int = MAX_EDITS, least: int = MIN_CHARS, crowd: int = CROWD) -> DataFrame:
    """``(doc_id, line, first_doc, first_line, linked)`` of every line that an earlier line makes redundant."""
    scratch = Scratch(docs.sparkSession)
    found, every = _links(docs, scratch, edits, least, crowd)
    roots = components(scratch, found)
    # a component's root has no row of its own there
    roots = roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
    known = every.join(roots, every.id == roots.node, "left").select(
        "doc_id", "line", F.coalesce("root", "id").alias("class"),
        F.when(F.col("root").isNull(), F.col("check")).otherwise(0).alias("check"), F.col("root").isNotNull().alias("linked"),
    )
    first = known.groupBy("class", "check").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n"))
    # a table of its own, so that the join's sides are plain exchanges and a very common line can be split
    first = scratch.table(first.where("n > 1"))
    spare = known.join(first, ["class", "check"]).where(F.struct("doc_id", "line") != F.col("first"))
    return spare.select(
        "doc_id", "line", F.col("first.doc_id").alias("first_doc"), F.col("first.line").alias("first_line"), "linked"
    ).distinct()


def summary(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Per document: its lines, which of them are redundant, how many by a different text, and the documents that keep them."""
    per = found.groupBy("doc_id").agg(
        F.sort_array(F.collect_list("line")).alias("dropped"), F.sort_array(F.collect_set("first_doc")).alias("first_docs"),
        F.count_if("linked").alias("n_linked"),
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
    )
    none = F.array().cast("array<long>")
    return rows.join(per, "doc_id", "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("dropped", none).alias("dropped"), F.coalesce("first_docs", none).alias("first_docs"),
    )


def _fresh(docs: DataFrame, least: int) -> DataFrame:
    """``fresh``: documents with a short line, not blank, that no smaller ``doc_id`` has."""

    def run(batches):
        for b in pieces(batches):
            out = []
            for d, raw in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                short = {" ".join(x.split()) for x in raw.lower().decode().split("\n")} if raw else set()
                out += [(d, *_line_ids(x)) for x in short if 0 < len(x) < least]
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "id", "check"])

    short = _texts(docs).mapInArrow(run, "doc_id long, id long, check long")
    return short.groupBy("id", "check").agg(F.min("doc_id").alias("fresh")).select("fresh").distinct()


def deduplicate(docs: DataFrame, edits: int = MAX_EDITS, least: int = MIN_CHARS, crowd: int = CROWD) -> DataFrame:
    """``docs`` without redundant lines; a document with nothing but redundant and earlier short lines goes. Columns are unchanged."""
    others = [c for c in docs.columns if c != "text"]
    found = repeats(docs, edits, least, crowd)
    spare = found.groupBy("doc_id").agg(F.collect_list("line").alias("spare"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("key"),
    )
    fresh = _fresh(docs, least)
    joined = rows.join(spare, F.col("key") == spare.doc_id, "left").join(fresh, F.col("key") == fresh.fresh, "left")
    joined = joined.select("row", "text", "spare", F.col("fresh").isNotNull().alias("fresh"))

    def run(batches):
        for b in pieces(batches):
            texts, keep = [], []
            for raw, lines, fresh in zip(text_bytes(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if not lines:
                    texts.append(raw.decode() if raw is not None else None)
                    keep.append(True)
                    continue
                gone = set(lines)
                texts.append("\n".join(x for i, x in enumerate(raw.decode().split("\n")) if i not in gone))
                keep.append(fresh or any(i not in gone for i, _ in _eligible(raw, least)))
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["row", "text"])
            yield out.filter(pa.array(keep, pa.bool_()))

    out = joined.mapInArrow(run, rows.select("row", "text").schema)
    return out.select(*[F.col("text").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])

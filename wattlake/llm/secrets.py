"""Secret scan: base patterns, and formats inferred from labelled credentials.

One pass over the texts finds the base spans and the candidate tokens (runs of
token characters, with a digit and a letter or a known prefix). From the base spans, which are
credentials labelled with their kind, and from seeds of published formats, one
probabilistic automaton per kind is inferred; ordinary words give one more.
Every candidate is scored by its log-likelihood per symbol under the likeliest
format, and becomes a span if that is about what held-out credentials of the
kind reach and more than the ordinary automaton gives. A run is scored as a
whole and in its parts: what stands between '=', '/' and '.', behind its first
and last '=' and from each published prefix on; the best parts that don't
overlap become spans.

Training reads at most ``SAMPLE`` credentials of a kind and ``SAMPLE`` ordinary
words, smallest hashes first; everything else covers all texts.

Defined results: null text counts as empty; an empty table trains on the seeds
alone; repeated rows each get a row; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.automata import Automaton
from wattlake.llm.common import Scratch, sample_of, text_bytes

SAMPLE = 400
#: Standard deviations below held-out credentials of its kind that a token's likelihood may lie.
DEVIATIONS = 3.0
KINDS = ("assign", "access", "hex", "inferred")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(rb"[0-9a-f]{24}")
_DIGIT = re.compile(rb"[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_WORD = re.compile(rb"[a-zA-Z]{12,}")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# fixed values: published credential formats as (literal or alphabet, length) parts
FORMATS = {
    "access": [("AKIA", 0), (_UPPER + "234567", 16)],
    "hex": [("abcdef" + _DIGITS, 40)],
    "github": [("ghp_", 0), (_UPPER + _LOWER + _DIGITS, 36)],
    "gitlab": [("glpat-", 0), (_UPPER + _LOWER + _DIGITS + "_-", 20)],
    "slack": [("xoxb-", 0), (_DIGITS, 12), ("-", 0), (_DIGITS, 12), ("-", 0), (_UPPER + _LOWER + _DIGITS, 24)],
    "stripe": [("sk_live_", 0), (_UPPER + _LOWER + _DIGITS, 24)],
    "google": [("AIza", 0), (_UPPER + _LOWER + _DIGITS + "_-", 35)],
    "npm": [("npm_", 0), (_UPPER + _LOWER + _DIGITS, 36)],
}


_PREFIXES = sorted({p for parts in FORMATS.values() for p, n in parts[:1] if not n})
_CUT = re.compile("[=/.]|(?=" + "|".join(map(re.escape, _PREFIXES)) + ")")
_PREFIX = re.compile("|".join(map(re.escape, _PREFIXES)))


def _seeds(fmt: str, n: int) -> list[str]:
    rng = random.Random(fmt)
    return [
        "".join(p if not k else "".join(rng.choice(p) for _ in range(k)) for p, k in FORMATS[fmt]) for _ in range(n)
    ]


def base_spans(raw: bytes) -> list[tuple[str, int, int, str]]:
    """``(kind, start, stop, token)`` of the base patterns, by start, then kind; code points."""
    text, out = None, []
    low = raw.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        text = raw.decode()
        out += [("assign", *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        text = text or raw.decode()
        out += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if _LONG_HEX.search(raw):
        text = text or raw.decode()
        out += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(raw: bytes) -> list[tuple[int, int, str]]:
    """Runs of 16 or more token characters, without the punctuation at their ends, that may hold a credential."""
    out = []
    for m in _TOKEN.finditer(raw.decode()):
        token = m[0].strip(".=/+")
        start = m.start() + m[0].index(token)
        if len(token) >= 16 and _mixed(token):
            out.append((start, start + len(token), token))
    return out


def _mixed(token: str) -> bool:
    digit, letter = any(c.isdigit() for c in token), any(c.isalpha() for c in token)
    return letter and (digit or _PREFIX.search(token) is not None)


def parts(token: str) -> list[tuple[int, int]]:
    """``(start, stop)`` of what is scored of a run: their lengths add up to a few times its own."""
    cuts = list(_CUT.finditer(token))
    starts, stops = [0, *(m.end() for m in cuts)], [*(m.start() for m in cuts), len(token)]
    found = {(0, len(token)), *zip(starts, stops)}
    if "=" in token:
        found |= {(token.index("=") + 1, len(token)), (token.rindex("=") + 1, len(token))}
    for a, b in list(found):
        bare = token[a:b].strip("-_")
        if bare and len(bare) < b - a:
            at = a + token[a:b].index(bare)
            found.add((at, at + len(bare)))
    return sorted((a, b) for a, b in found if b - a >= 16 and _mixed(token[a:b]))


def best_parts(token: str, score) -> list[tuple[int, int, str, float]]:
    """``(start, stop, format, margin)`` of the accepted parts, best margins first where they overlap, by start."""
    scored = [(a, b, *score(token[a:b])) for a, b in parts(token)]
    out: list[tuple[int, int, str, float]] = []
    for p in sorted((p for p in scored if p[3] >= 0), key=lambda p: (-p[3], p[0], p[1])):
        at = bisect.bisect(out, p)
        if (not at or out[at - 1][1] <= p[0]) and (at == len(out) or p[1] <= out[at][0]):
            out.insert(at, p)
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("token", pa.string())])
_FIND_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("base", pa.list_(_SPAN)), ("candidates", pa.list_(_SPAN)), ("ordinary", pa.string())]
)


def _find(docs: DataFrame) -> DataFrame:
    """Per row: base spans, candidates, and the ordinary long word of smallest hash."""

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, raw in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                raw = raw or b""
                words = _WORD.findall(raw)
                rows.append({
                    "doc_id": doc_id,
                    "base": [dict(zip(("kind", "start", "stop", "token"), s)) for s in base_spans(raw)],
                    "candidates": [{"kind": "inferred", "start": s, "stop": e, "token": t} for s, e, t in candidates(raw)],
                    "ordinary": min(words, key=zlib.crc32).decode() if words else None,
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_FIND_SCHEMA)

    span = "array<struct<kind:string,start:long,stop:long,token:string>>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, base {span}, candidates {span}, ordinary string")


class Formats:
    """Automata of every credential kind, each with the least likelihood it accepts, and of ordinary words."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str]):
        self.ordinary = Automaton(ordinary or ["ordinary", "words"])
        self.kinds: dict[str, tuple[Automaton, float]] = {}
        for kind, strings in sorted(labelled.items()):
            # every fifth credential sets the least likelihood, the others the automaton
            held, fit = strings[::5], [s for i, s in enumerate(strings) if i % 5]
            automaton = Automaton(fit or held)
            seen = np.array([automaton.log_likelihood(s) / len(s) for s in held])
            self.kinds[kind] = (automaton, seen.mean() - DEVIATIONS * max(seen.std(), 0.02))

    def score(self, token: str) -> tuple[str, float]:
        """The likeliest kind, and by how much a symbol is likelier than that kind accepts and than in ordinary words.

        The lesser of the two differences; a span if not negative.
        """
        own = {k: a.log_likelihood(token) / len(token) for k, (a, _) in self.kinds.items()}
        best = max(own, key=own.get)
        return best, float(min(own[best] - self.kinds[best][1], own[best] - self.ordinary.log_likelihood(token) / len(token)))


def _sample(rows: DataFrame, kind: str, sample: int) -> DataFrame:
    """At most ``sample`` distinct tokens of ``kind``, smallest hashes first."""
    own = rows.where(F.col("kind") == kind).select("token").distinct()
    return sample_of(own, sample, own.count(), "token")


def learn(found: DataFrame, sample: int = SAMPLE) -> Formats:
    """Infer the formats from a bounded sample of ``_find()``'s labelled credentials and ordinary words."""
    labelled = found.select(F.explode("base").alias("s")).select("s.kind", "s.token")
    # of an assignment's token only the value was labelled; its plain words are no credential format
    labelled = labelled.where("kind <> 'assign' or (token rlike '[0-9]' and length(token) >= 16)")
    words = found.where("ordinary is not null").select(F.lit("").alias("kind"), F.col("ordinary").alias("token"))
    by_kind: dict[str, list[str]] = {f: _seeds(f, sample // 4) for f in FORMATS}
    for kind in KINDS[:3]:
        by_kind.setdefault(kind, []).extend(r.token for r in _sample(labelled, kind, sample).collect())
    ordinary = [r.token for r in _sample(words, "", sample).collect()]
    return Formats({k: v for k, v in by_kind.items() if v}, ordinary)


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, base, inferred)`` of every row: base spans, and candidates that fit a format and meet no base span."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.table(_find(docs))
    formats = docs.sparkSession.sparkContext.broadcast(learn(found, sample))
    inferred = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("format", pa.string()), ("score", pa.float64()),
    ]))

    def run(batches):
        score = formats.value.score
        for b in batches:
            out = []
            for base, tokens in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                spans = []
                # candidates don't overlap, so each base span rules out a range of them
                starts, stops = (np.array([t[k] for t in tokens], np.int64) for k in ("start", "stop"))
                free = np.ones(len(tokens), bool)
                for s in base:
                    free[np.searchsorted(stops, s["start"], "right"):np.searchsorted(starts, s["stop"], "left")] = False
                for t in (t for t, ok in zip(tokens, free) if ok):
                    for a, e, fmt, margin in best_parts(t["token"], score):
                        start, stop = t["start"] + a, t["start"] + e
                        spans.append({"kind": "inferred", "start": start, "stop": stop, "format": fmt, "score": margin})
                out.append(spans)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, inferred)], ["doc_id", "base", "inferred"]
            )

    return found.select("doc_id", "base", "candidates").mapInArrow(
        run,
        "doc_id long, base array<struct<kind:string,start:long,stop:long,token:string>>, "
        "inferred array<struct<kind:string,start:long,stop:long,format:string,score:double>>",
    )

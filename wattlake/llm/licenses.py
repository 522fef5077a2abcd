"""License scan: ordered signature rules behind a keyword prefilter.

Each text is searched once for the rules' keywords (an Aho-Corasick pass); only
rules whose keyword occurs are run. Their detections are taken by priority,
then length, then place; one whose interval lies within an accepted one of the
same or higher priority is suppressed, so "GNU Affero General Public License"
leaves no plain "General Public License".

Defined results: null text counts as empty; an empty text has no words, no
labels and score 0; repeated rows each get a row; only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import phrase_words, text_bytes
from wattlake.llm.license_rules import Rule, rules

# fixed values: phrases of consecutive words, and their labels
PHRASES = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}
#: Score of a text whose only evidence is a phrase.
PHRASE_SCORE = 0.5


@cache
def _prefilter():
    """Automaton of keywords, each with its rules; and the rules without a keyword."""
    by_word: dict[str, list[int]] = {}
    every = rules()
    for i, r in enumerate(every):
        by_word.setdefault(r.keyword, []).append(i)
    free = by_word.pop("", [])
    automaton = ahocorasick.Automaton()
    for word, ids in by_word.items():
        automaton.add_word(word, (word, ids))
    automaton.make_automaton()
    return every, automaton, free


def detections(text: str) -> list[tuple[int, int, Rule]]:
    """Accepted detections ``(start, stop, rule)``, in code points, by place."""
    every, automaton, free = _prefilter()
    wanted = set(free)
    for _, (_, ids) in automaton.iter(text.lower()):
        wanted.update(ids)
    # an identifier's interval is the identifier itself: one tag may name several licenses
    found = [
        (*m.span(1 if every[i].form == "identifier" else 0), every[i])
        for i in sorted(wanted) for m in every[i].pattern.finditer(text)
    ]
    found.sort(key=lambda d: d[:2])
    out, cluster, reach = [], [], 0
    for d in found:  # detections that don't overlap cannot suppress each other
        if cluster and d[0] >= reach:
            out += _resolved(cluster)
            cluster = []
        cluster.append(d)
        reach = max(reach, d[1]) if len(cluster) > 1 else d[1]
    return out + _resolved(cluster)


def _resolved(cluster: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections by priority, then length, then place, without those inside an earlier one; by place."""
    accepted: list[tuple[int, int, Rule]] = []
    for start, stop, rule in sorted(cluster, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label)):
        if not any(a <= start and stop <= b for a, b, _ in accepted):
            accepted.append((start, stop, rule))
    return sorted(accepted, key=lambda d: d[:2])


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Word index and label of every place where a phrase's words stand one after another."""
    joined = b" %b " % b" ".join(words)
    out = []
    for phrase, label in PHRASES.items():
        at = joined.find(b" %b " % phrase)
        word = counted = 0
        while at >= 0:
            # blanks since the place before, not from the start
            word += joined.count(b" ", counted, at)
            counted = at
            out.append((word, label))
            at = joined.find(b" %b " % phrase, at + 1)
    return out


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()),
    ("n_words", pa.int64()),
    ("places", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
    ("found", pa.list_(pa.struct([
        ("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("form", pa.string()), ("priority", pa.int64()),
    ]))),
])


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, places, found)``: phrase places by word, and the accepted detections of every row."""

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                words = phrase_words(text)
                rows.append({
                    "doc_id": doc_id,
                    "n_words": len(words),
                    "places": [{"word": w, "label": x} for w, x in sorted(phrase_places(words))],
                    "found": [
                        {"start": s, "stop": e, "label": r.label, "form": r.form, "priority": r.priority}
                        for s, e, r in detections(text.decode() if text else "")
                    ],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "doc_id long, n_words long, places array<struct<word:long,label:string>>, "
        "found array<struct<start:long,stop:long,label:string,form:string,priority:long>>",
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Per row of ``scan()``: the counts, first and last phrase place, labels and a score from 0 to 1."""

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.transform("places", lambda p: p["label"])
    best = F.array_max(F.transform("found", lambda d: d["priority"] / F.lit(100.0)))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["word"])).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("found", lambda d: d["label"]))).alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("places") > 0, PHRASE_SCORE).otherwise(0.0)).alias("score"),
    )

"""Mixing to target weights by iterative proportional fitting.

Tokens are counted per (source, language, topic) cell. Raking scales the cells'
token weights to the target marginals of each dimension in turn, with no cell
above its own tokens; a cell's sampling probability is its calibrated weight
over its tokens, at most one. A document is sampled if the hash of its id, a
number in [0, 1), lies below its cell's probability.

Targets that are not given are the token shares to the power ``TEMPER``; a value
whose share of the budget would exceed all its tokens is asked for all of them,
and the others share the rest. Given targets are met as they are: if no
probabilities up to one reach them, the budget is bisected downwards; targets
that no budget reaches raise an error that names the miss. Rounds go on until
every marginal is within ``RESIDUAL``; ``marginals`` reports what is reached.

Defined results: a null source or language is a value of its own (the empty
string); documents without words have topic ``none`` and zero tokens, and
probability 1 if their cell has no tokens; a null ``doc_id`` hashes as the empty
string; repeated rows are decided alike; an empty table gives no rows; further
columns, whatever their names, stand inside ``row``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, phrase_words, pieces, text_bytes

DIMENSIONS = ("source", "lang", "topic")
TOPICS = 8
#: Target share of a value: its share of the tokens to this power, renormalised.
TEMPER = 0.7
#: Share of all tokens that the sample is to hold.
BUDGET = 0.9
#: Largest relative miss of a marginal.
RESIDUAL = 0.01
#: Rounds a budget is given at most, and after how many without a fifth less to miss it counts as out of reach.
ROUNDS, PATIENCE = 60, 6
#: How closely a lower budget is searched, and the least one tried.
BISECTION, LEAST = 0.2, 0.01


def topic(words: list[bytes], topics: int = TOPICS) -> str:
    """A lexical stand-in for a topic: the most frequent class of initial letters (ties to the smaller)."""
    seen = [0] * topics
    for w in words:
        if 97 <= w[0] <= 122:
            seen[(w[0] - 97) % topics] += 1
    best = max(range(topics), key=lambda i: (seen[i], -i))
    return f"t{best}" if seen[best] else "none"


def with_cells(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """``(row, source, lang, topic, n_tokens)``; ``row`` holds the columns of ``docs``."""
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), source, lang)
    at = docs.columns.index("text")

    def run(batches):
        for b in pieces(batches, 500):
            found = [phrase_words(t) for t in text_bytes(b.column(0).field(at))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([topic(w, topics) for w in found], pa.string()), pa.array(map(len, found), pa.int64())],
                ["row", "source", "lang", "topic", "n_tokens"],
            )

    schema = rows.withColumns({"topic": F.lit("x"), "n_tokens": F.lit(1).cast("long")}).schema
    return rows.mapInArrow(run, schema)


def shares(cells: DataFrame, d: str, target: DataFrame | None, budget: float, total: int) -> DataFrame:
    """``(value, goal)`` of dimension ``d``: the given shares, or tempered ones that the budget can take."""
    have = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("n")).where("n > 0")
    if target is not None:
        asked = target.groupBy("value").agg(F.sum("share").alias("share")).where("share > 0")
        whole, lost = asked.join(have, "value", "left").agg(F.sum("share"), F.sum(F.when(F.col("n").isNull(), F.col("share")))).first()
        if lost or not whole:
            raise ValueError(f"targets of {d}: a share of {lost} is asked of values without tokens")
        asked = asked.select("value", (F.col("share") / whole).alias("goal"))
        return have.select("value").join(asked, "value", "left").select("value", F.coalesce("goal", F.lit(0.0)).alias("goal"))
    tempered = have.select("value", F.pow(F.col("n").cast("double"), F.lit(TEMPER)).alias("wish"), (F.col("n") / F.lit(budget * total)).alias("most"))
    scale = 0.0
    while True:  # the scale only grows, and ends when no further value is asked for all it has
        full = F.col("wish") * F.lit(scale) >= F.col("most")
        taken, open_ = tempered.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("wish")))).first()
        if not open_ or (1 - (taken or 0.0)) / open_ <= scale:
            return tempered.select("value", F.least("most", F.col("wish") * F.lit(scale)).alias("goal"))
        scale = (1 - (taken or 0.0)) / open_


def _round(cells: DataFrame, budget_tokens: float) -> DataFrame:
    """One raking step a dimension; ``miss`` is the largest relative miss of a marginal before its step.

    Of a value's cells those at their tokens stay there and the open ones are
    scaled to what is left of its aim; a value above its aim is scaled down as a
    whole. Neither passes the aim, as the drawn tokens are concave in the scale.
    """
    out = cells.drop("miss")
    for d in DIMENSIONS:
        drawn = F.least(F.col("weight"), F.col("tokens").cast("double"))
        of_value = out.groupBy(d).agg(
            (F.max(f"goal_{d}") * F.lit(budget_tokens)).alias("aim"), F.sum(drawn).alias("drawn"),
            F.sum(F.when(F.col("weight") < F.col("tokens"), F.col("weight")).otherwise(0.0)).alias("open"),
        )
        up = F.when(F.col("open") > 0, (F.col("aim") - F.col("drawn") + F.col("open")) / F.col("open")).otherwise(1.0)
        down = F.when(F.col("drawn") > 0, F.col("aim") / F.col("drawn")).otherwise(1.0)
        of_value = of_value.select(
            F.col(d).alias("of"), F.when(F.col("drawn") < F.col("aim"), up).otherwise(down).alias("step"),
            F.when(F.col("aim") > 0, F.abs(F.col("drawn") / F.col("aim") - 1)).otherwise(0.0).alias(f"miss_{d}"),
        )
        out = out.join(of_value, out[d] == of_value["of"]).drop("of")
        out = out.withColumn("weight", F.col("weight") * F.col("step")).drop("step")
    missed = [f"miss_{d}" for d in DIMENSIONS]
    return out.withColumn("miss", F.greatest(*missed)).drop(*missed)


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """``cells(source, lang, topic, tokens)`` with ``p``, ``weight`` and the goal of each of its values.

    ``targets`` gives ``(value, share)`` by dimension. ``weight`` is the cell's share of the expected sample.
    Every round is one written table, so a lost executor costs one round at most.
    """
    scratch = Scratch(cells.sparkSession)
    start = cells.where("tokens > 0")
    total = start.agg(F.sum("tokens")).first()[0]
    if not total:
        return start.withColumns({"p": F.lit(1.0), "weight": F.lit(0.0)} | {f"goal_{d}": F.lit(0.0) for d in DIMENSIONS})
    for d in DIMENSIONS:
        goal = scratch.table(shares(start, d, (targets or {}).get(d), budget, total)).select(F.col("value").alias("of"), F.col("goal").alias(f"goal_{d}"))
        start = start.join(goal, start[d] == goal["of"]).drop("of")
    high = budget
    for d in targets or {}:  # a value gives no more than it has
        of = start.groupBy(d).agg(F.max(f"goal_{d}").alias("goal"), F.sum("tokens").alias("n"))
        high = min(high, of.agg(F.min(F.col("n") / F.col("goal") / total)).first()[0])
    start = scratch.table(start)
    low, tried, best = 0.0, high, None
    current = scratch.table(start.withColumn("weight", F.col("tokens") * F.lit(float(tried))))
    while best is None or high - low > BISECTION * high:
        missed = []
        while not missed or (missed[-1] > RESIDUAL and len(missed) < ROUNDS):
            if len(missed) > PATIENCE and missed[-1] > 0.8 * missed[-1 - PATIENCE]:
                break
            after = scratch.table(_round(current, tried * total))
            if current is not best:
                scratch.drop(current)
            current = after
            missed.append(current.agg(F.max("miss")).first()[0])
        if missed[-1] <= RESIDUAL:
            if best is not None:
                scratch.drop(best)
            best, low = current, tried
        else:
            high = tried
        if low == high:
            break
        if high < LEAST:
            raise ValueError(f"no budget of {LEAST} or more reaches the targets: a marginal still misses {missed[-1]:.3f} of its target")
        tried = (low + high) / 2
    drawn = F.least(F.col("weight"), F.col("tokens").cast("double"))
    return best.select(
        *DIMENSIONS, "tokens", *[f"goal_{d}" for d in DIMENSIONS], (drawn / F.col("tokens")).alias("p"),
        (drawn / F.lit(float(low * total))).alias("weight"),
    )


def marginals(decided: DataFrame) -> DataFrame:
    """``(dimension, value, goal, reached)`` of cells with ``p``: target shares and those of the expected sample."""
    drawn = F.col("p") * F.col("tokens")
    total = decided.agg(F.sum(drawn)).first()[0] or 1.0
    parts = [
        decided.groupBy(F.col(d).alias("value")).agg(F.max(f"goal_{d}").alias("goal"), F.sum(drawn).alias("n"))
        .select(F.lit(d).alias("dimension"), "value", "goal", (F.col("n") / F.lit(float(total))).alias("reached"))
        for d in DIMENSIONS
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the id's hash."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, topics: int = TOPICS
) -> DataFrame:
    """``(row, source, lang, topic, n_tokens, weight, p, sampled)`` of every document."""
    every = with_cells(docs, topics)
    cells = every.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    cells = Scratch(docs.sparkSession).table(cells)
    decided = rake(cells, targets, budget)
    known = decided.select(*[F.col(c).alias(f"cell_{c}") for c in DIMENSIONS], "weight", "p")
    same = [F.col(c) == F.col(f"cell_{c}") for c in DIMENSIONS]
    # cells are few beside documents: Spark broadcasts them below its threshold, else splits skewed cells
    joined = every.join(known, same, "left").withColumn("p", F.coalesce("p", F.lit(1.0)))
    return joined.select(
        "row", *DIMENSIONS, "n_tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), "p",
        (uniform(F.col("row.doc_id")) < F.col("p")).alias("sampled"),
    )

"""Quality classifier: estimated accuracies, held-out accuracy, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.1"


def test_em_finds_the_accuracies_behind_the_votes():
    rng = np.random.default_rng(0)
    model = quality.Model(quality.INSULTS)
    m, n = len(quality.LABELLERS), 40_000
    truth = rng.choice(len(quality.CLASSES), n, p=[0.75, 0.05, 0.05, 0.05, 0.05, 0.05])
    right, wrong = rng.uniform(0.6, 0.98, m), rng.uniform(0.001, 0.03, m)
    yes = rng.random((n, m)) < np.where(model.accused[None, :] == truth[:, None], right, wrong)
    votes = np.where(rng.random((n, m)) < 0.1, quality._NONE, yes.astype(int))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model.fit_labellers(patterns, counts.astype(float))
    assert np.abs(model.right - right).max() < 0.1 and np.abs(model.wrong - wrong).max() < 0.02
    guess = model.posterior(votes).argmax(axis=1)
    best = quality.Model(quality.INSULTS)
    best.right, best.wrong, best.prior = right, wrong, np.array([0.75] + [0.05] * 5)
    assert (guess == truth).mean() > (best.posterior(votes).argmax(axis=1) == truth).mean() - 0.005


@pytest.mark.parametrize("text,said", [
    ("This is an ordinary sentence, with a few more words in it. And another one.", []),
    ("THIS!! IS!! ALL!! LOUD!! AND!! LONG!! ENOUGH!!", ["shouting", "exclaiming"]),
    ("a | b | c | d | e | f | g", ["cells", "bare_marks"]),
    ("one### two$$$ three%%% four&&& five*** six###", ["symbols", "symbol_words"]),
    ("again " * 30, ["repeats", "top_word"]),
    ("what an idiot and a loser", ["insult", "insults", "insulting"]),
])
def test_labellers(text, said):
    vote, _ = quality.votes(text.encode(), quality.INSULTS)
    assert [n for n, v in zip(quality.LABELLERS, vote) if v == quality._YES] == said


def test_held_out_accuracy(spark):
    """Labels of documents that the toxic word list never saw."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where("doc_id % 3 <> 0")
    model = quality.learn(docs, seen)
    found = quality.classify(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    r = found.agg(
        F.avg(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.col("kept").cast("int"))).alias("clean"),
        F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("junk"),
        F.avg(F.when((F.col("toxic") == 1) & (F.col("lang") == "en"), F.col("kept").cast("int"))).alias("toxic"),
    ).first()
    assert r.clean > 0.99 and r.junk < 0.05 and r.toxic < 0.05


def test_edges(spark):
    good = "This is an ordinary sentence, with a few more words in it. And another one follows it here."
    rows = [(i, good + f" Number {i}.") for i in range(40)] + [(100 + i, "BAD!! WORDS!! SHOUTED!! LOUD!! " * 5 + str(i)) for i in range(15)]
    rows += [(200, None), (201, ""), (202, "  \n"), (203, "Short one."), (203, "Short one."), (None, good), (204, good + " w" * 60000 + " end.")]
    docs = spark.createDataFrame([(d, t, None, "s", 1) for d, t in rows], SCHEMA).selectExpr("*", "1 AS kept", "2 AS votes")
    for labels in (None, spark.createDataFrame([(1, 1, 0), (100, 0, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")):
        model = quality.learn(docs, labels)
        out = quality.keep_good(docs, model)
        assert out.columns == docs.columns
        ids = [r.doc_id for r in out.collect()]
        assert {*range(40), 203, None} <= set(ids) and not set(ids) & {*range(100, 115), 200, 201, 202}
        assert ids.count(203) == 2
        told = quality.classify(docs, model)
        assert told.count() == len(rows) and told.where("doc_id = 200 and score = 0 and not kept").count() == 1
    empty = docs.limit(0)
    assert quality.classify(empty, quality.learn(empty)).count() == 0

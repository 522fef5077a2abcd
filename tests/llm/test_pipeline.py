"""The pipeline's stages on planted cases, and run() as their composition."""

import os

import pytest

import __spark_entry__ as E
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_are_registered():
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing to target weights"]
    names = [n.split("_")[0] for n in E.queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14))


def test_run_composes_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        rows = after.collect()
        assert after.columns == columns and 0 < len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, after.schema)
    assert sorted(rows) == sorted(corpus_pipeline.run(spark, SF).collect())


def test_planted_cases(spark, tmp_path):
    """Junk, copies, shared passages and benchmark passages go; clean documents stay."""
    import random

    rng = random.Random(0)
    vocab = ["".join(rng.choice("bcdfghlmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(3000)]
    sentence = lambda n: " ".join(rng.choice(vocab) for _ in range(n)).capitalize() + "."
    clean = {i: "\n".join(sentence(25) for _ in range(6)) for i in range(60)}
    passage, item = sentence(60), sentence(20)
    near = clean[3].split("\n")
    near[2] = near[2].replace(near[2].split()[5], "other", 1)
    rows = [(i, t) for i, t in clean.items()]
    rows += [(100, clean[0]), (101, "\n".join(near)), (102, sentence(30) + "\n" + passage), (103, passage + "\n" + sentence(30))]
    rows += [(104, "LOUD!! " * 60), (105, sentence(40) + "\n" + item + "\n" + sentence(40)), (106, "you idiot, " + sentence(8) + " stupid moron")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    frame.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs, texts = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf).collect()
        texts[name] = {r.doc_id: r for r in out}
        docs = spark.createDataFrame(out, docs.schema)
    assert set(texts["quality classifier"]) == {i for i, _ in rows} - {104, 106}
    after = texts["line dedup"]
    assert 100 not in after and passage in after[102].text and passage not in after[103].text
    assert all(after[i].text == t for i, t in clean.items())
    assert set(clean) <= set(texts["SimHash near-dedup"])
    last = texts["benchmark decontamination"]
    assert set(clean) <= set(last) and item[:-1].lower() not in last[105].text.lower()
    assert last[105].n_chars == len(last[105].text)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_empty_tables(spark, tmp_path):
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_line_stage_takes_every_line_of_a_near_copy(spark):
    import random

    rng = random.Random(0)
    word = lambda: "".join(rng.choice("bcdfghlmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4)))
    first = [" ".join(word() for _ in range(25)) for _ in range(6)]
    near = list(first)
    near[2] = near[2].replace(near[2].split()[5], "other", 1)
    rows = [(3, "\n".join(first)), (101, "\n".join(near))]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.line_stage(spark, frame, "").collect()] == [3]

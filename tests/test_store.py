"""Model table: finished versions, scoring in the JVM, reasons without a forecast."""

import datetime as dt

import numpy as np

from wattlake.ml import boost, store
from wattlake.schemas import HORIZON_COLS

T0 = dt.datetime(2024, 1, 1)
ROWS = "created_at timestamp_ntz, region_id string, a double, b double"


def _models(spark, regions, level, horizons=24):
    rows = [(r, h, float(level), [h * 1.0, 2.0]) for r in regions for h in range(1, horizons + 1)]
    return spark.createDataFrame(rows, store.LINEAR)


def test_newest_finished_version_counts_for_each_region(spark, tmp_path):
    base = str(tmp_path / "m")
    assert store.latest(spark, base).count() == 0
    store.publish(_models(spark, ["NSW1", "TAS1"], 1), base, 1, ["a", "b"])
    store.publish(_models(spark, ["NSW1"], 2), base, 2, ["a", "b"])
    store.publish(_models(spark, ["NSW1", "TAS1"], 3), base, 3, ["a", "b"], finish=False)  # the save broke off before its mark
    got = {r.region_id: (r.version, r.intercept, r.features) for r in store.latest(spark, base).collect()}
    assert got == {"NSW1": (2, 2.0, ["a", "b"]), "TAS1": (1, 1.0, ["a", "b"])}
    # a mark whose rows are not all there does not count; writing the version again mends it
    store.publish(_models(spark, ["NSW1"], 4), base, 4, ["a", "b"])
    store.overwrite_parts(_models(spark, ["NSW1"], 4, 5).selectExpr("*", "4L AS version"), f"{base}/models", "version")
    assert {r.version for r in store.latest(spark, base).where("region_id = 'NSW1'").collect()} == {2}
    store.publish(_models(spark, ["NSW1"], 5), base, 4, ["a", "b"])
    mended = store.latest(spark, base).where("region_id = 'NSW1'").collect()
    assert {(r.version, r.intercept) for r in mended} == {(4, 5.0)} and len(mended) == 24


def test_scores_and_reasons(spark):
    models = _models(spark, ["NSW1", "SA1"], 10, 23)
    hours = [T0 + dt.timedelta(hours=i) for i in range(3)]
    wanted = spark.createDataFrame([(t, r) for t in hours for r in ("NSW1", "SA1", "VIC1")], "created_at timestamp_ntz, region_id string")
    history = spark.createDataFrame([(hours[0], "NSW1", 1.5), (hours[1], "NSW1", 2.0), (hours[0], "VIC1", 1.0)], "time timestamp_ntz, region_id string, a double")
    forecast = spark.createDataFrame([(hours[0], r, 4.0) for r in ("NSW1", "SA1", "VIC1")], "time timestamp_ntz, region_id string, b double")
    scored, skipped = store.cycle(wanted, history, forecast, models, ["a", "b"])
    rows = scored.collect()
    assert [(r.created_at, r.region_id) for r in rows] == [(hours[0], "NSW1")]
    assert [rows[0][c] for c in HORIZON_COLS[:23]] == [10 + 1.5 * h + 8.0 for h in range(1, 24)] and rows[0].horizon_h24 is None
    assert {(r.reason, r.region_id): r.n for r in skipped.collect()} == {
        ("no_history", "SA1"): 3, ("no_history", "NSW1"): 1, ("no_history", "VIC1"): 2, ("no_forecast", "NSW1"): 1, ("no_model", "VIC1"): 1}
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_trees_walk_in_columns(spark, tmp_path):
    rng = np.random.default_rng(2)
    n = 300
    x = rng.normal(size=(n, 2)).astype(np.float32)
    y = np.column_stack([np.where(x[:, 0] > 0, 2, -2) * x[:, 1], x[:, 0]]).astype(np.float32)
    rows = [(T0 + dt.timedelta(hours=i), "NSW1", *map(float, x[i]), *map(float, y[i])) for i in range(n)]
    frame = spark.createDataFrame(rows, ROWS + ", t1 double, t2 double")
    model = boost.train(frame, ["a", "b"], ["t1", "t2"], boost.Settings(trees=3, depth=3, rate=0.5))
    base = str(tmp_path / "trees")
    store.publish(store.tree_rows(spark, model), base, 1, ["a", "b"])
    stored = store.latest(spark, base, store.TREES)
    asked = frame.select("created_at", "region_id", "a", "b").unionAll(
        spark.createDataFrame([(T0, "NSW1", None, 0.1), (T0, "SA1", 1.0, 1.0)], ROWS))
    got = store.score_trees(asked, stored, ["a", "b"]).collect()
    assert len(got) == n + 1
    want = model.predict("NSW1", np.vstack([x, [[np.nan, 0.1]]]).astype(np.float32))
    assert np.allclose(sorted(r.predicted[0] for r in got), sorted(want[:, 0])) and np.allclose(
        sorted(r.predicted[1] for r in got), sorted(want[:, 1]))

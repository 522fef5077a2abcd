"""Ridge model against plain least squares; saved versions; scoring on the same rows."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from wattlake.ml import linear, train

T0 = dt.datetime(2024, 1, 1)


def _rows(spark, n=240):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 3)) * [1, 100, 0.01] + [0, 500, 3]
    region = np.array(["NSW1", "SA1"])[np.arange(n) % 2]
    y = np.stack([x @ [2, 0.5, 30] + 7 + (region == "SA1") * x[:, 0], x @ [-1, 0.1, 5]], 1) + 0.01 * rng.normal(size=(n, 2))
    rows = [(T0 + dt.timedelta(hours=i), str(region[i]), *map(float, x[i]), 1.0, *map(float, y[i])) for i in range(n)]
    rows.append((T0, "QLD1", None, 1.0, 1.0, 1.0, 1.0, 1.0))
    schema = "time timestamp_ntz, region_id string, a double, b double, c double, k double, target_h1 double, target_h2 double"
    return spark.createDataFrame(rows, schema), x, region, y


def test_ridge_equals_least_squares(spark):
    df, x, region, y = _rows(spark)
    features, targets = ["a", "b", "c", "k"], ["target_h1", "target_h2"]  # k is constant
    coef = linear.train(df.repartition(5), features, targets, ridge=1e-9)
    assert sorted(coef) == ["NSW1", "SA1"]
    for r, w in coef.items():
        rows = region == r
        best, *_ = np.linalg.lstsq(np.hstack([np.ones((rows.sum(), 1)), x[rows]]), y[rows], rcond=None)
        assert np.allclose(w[:4], best, rtol=1e-4, atol=1e-4) and np.allclose(w[4], 0)
    scored = linear.predict(df, coef, features, targets)
    long = linear.predicted_long(scored, [1, 2]).where("region_id <> 'QLD1'")
    assert long.count() == 480
    assert long.agg(F.max(F.abs(F.col("actual") - F.col("predicted")))).first()[0] < 0.1
    assert scored.where("region_id = 'QLD1' and predicted_target_h1 is null").count() == 1
    assert linear.train(df.limit(0), features, targets) == {}


def test_versions_count_when_their_save_finished(spark, tmp_path):
    df, *_ = _rows(spark, 60)
    base, features = str(tmp_path / "models"), ["a", "b", "c"]
    models = train.train_horizons(df.na.drop(), features, [1, 2], max_iter=2)
    train.save_models(models, base, 1)
    models[1].write().overwrite().save(f"{base}/version=2/horizon=1")  # a save that broke off
    loaded = train.load_latest(spark, base, [1, 2, 3])
    assert sorted(loaded) == [1, 2]
    assert train.load_latest(spark, str(tmp_path / "none"), [1]) == {}
    rows = df.na.drop()
    wide = train.score(loaded, rows)
    assert wide.count() == rows.count() and wide.where("horizon_h01 is null or horizon_h02 is null").count() == 0
    assert wide.where("horizon_h03 is not null").count() == 0
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Scan")[0]
    long = train.predict_long(loaded, rows, features)
    assert long.count() == 2 * rows.count()

"""Step 10: train and evaluate on the wide features (rows-only check).

The registered evaluation fits all 24 horizons of every region with the
multi-output ridge model, in one pass; the boosted trees of ``ml/train.py``
take the same inputs. Model output is not SQL-expressible, so no oracle is
registered; tests hold the model against a plain least-squares solution.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.ml import linear, train as TR
from wattlake.operators import features as FT
from wattlake.operators import forecast as FC
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.plans.q_features import TRAIN_END, VAL_END
from wattlake.schemas import MAX_HORIZON
from wattlake.session import ensure_checkpoint_dir

HORIZONS = range(1, MAX_HORIZON + 1)


@register("train_eval")
def train_eval(spark, sf_dir):
    """M1 + M2 + A10 (+ U2, P15): fit on train and validation, evaluate on test.

    A row per region and horizon, then the macro average of every region and
    of all (horizon null).
    """
    wide, targets, feats = FT.features_wide(S.daily_series(spark, sf_dir))
    ensure_checkpoint_dir(spark)
    # read once for training and once for the test rows: cut the long plan on shared storage
    wide = wide.checkpoint(eager=True)
    train, val, test = FT.chrono_split(wide, TRAIN_END, VAL_END)
    coef = linear.train(train.unionByName(val), feats, targets)
    if not coef:
        # too little history for 744-row lags (e.g. sf0.001): nothing to fit
        return spark.createDataFrame([], TR.METRICS_SCHEMA)
    scored = linear.predict(test, coef, feats, targets)
    metrics = TR.evaluate(linear.predicted_long(scored, HORIZONS).where("predicted is not null"))
    average = FC.macro_average(metrics).select(
        "region_id", F.lit(None).cast("int").alias("horizon"), F.col("avg_r2").alias("r2"), F.col("avg_mae").alias("mae"),
        F.lit(None).cast("bigint").alias("n"),
    )
    return S.rounded(metrics.unionByName(average))

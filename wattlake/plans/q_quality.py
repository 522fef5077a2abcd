"""Step 6: data-quality suites and checkpoints over the silver/gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.functions.timecols import minute_floor
from wattlake.operators import quality as Q
from wattlake.plans import oracle_sql as O
from wattlake.plans import silver as S
from wattlake.plans.catalog import register
from wattlake.sources import standins

SUITE_TABLE = {
    "bronze.demand": "bronze_demand",
    "bronze.weather": "bronze_weather",
    "silver.demand_5min": "demand_5min",
    "silver.weather_hourly": "weather_hourly",
    "silver.features_ml": "features_ml",
    "silver.predictions": "predictions",
}


def _tables(spark, sf_dir):
    return {
        "bronze.demand": standins.bronze_demand(spark, sf_dir),
        "bronze.weather": standins.bronze_weather(spark, sf_dir),
        "silver.demand_5min": S.demand_5min(spark, sf_dir),
        "silver.weather_hourly": S.weather_hourly(spark, sf_dir),
        "silver.features_ml": S.features_ml(spark, sf_dir),
        "silver.predictions": S.predictions(spark, sf_dir),
    }


def all_results(spark, sf_dir):
    suites = Q.default_suites()
    out = None
    for name, df in _tables(spark, sf_dir).items():
        r = Q.run_suite(df, suites[name])
        out = r if out is None else out.unionByName(r)
    return out


# ------------------------------ SQL twin -----------------------------------
def _rule_sql(suite: str, i: int, r: Q.Rule) -> str:
    t = SUITE_TABLE[suite]
    head = f"SELECT '{suite}' AS suite, {i} AS rule_id, '{r.expectation}' AS expectation, "
    col = r.column
    if r.expectation == "expect_table_row_count_to_be_between":
        return (head + "CAST(NULL AS VARCHAR) AS column_name, 'critical' AS severity, count(*) AS evaluated, "
                f"CAST(NULL AS BIGINT) AS unexpected, {O.r4('count(*)', 'observed')}, "
                f"count(*) >= {int(r.min_value)} AND count(*) <= {int(r.max_value)} AS success FROM {t}")
    if r.expectation == "expect_column_values_to_not_be_null":
        bad = f"count(*) FILTER (WHERE {col} IS NULL)"
        return (head + f"'{col}' AS column_name, 'critical' AS severity, count(*) AS evaluated, {bad} AS unexpected, "
                f"{O.r4(f'{bad} / greatest(count(*), 1)', 'observed')}, {bad} = 0 AS success FROM {t}")
    if r.expectation == "expect_column_values_to_be_in_set":
        vals = ", ".join(f"'{v}'" for v in r.value_set)
        bad = f"count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
        return (head + f"'{col}' AS column_name, 'critical' AS severity, count({col}) AS evaluated, {bad} AS unexpected, "
                f"{O.r4(f'{bad} / greatest(count({col}), 1)', 'observed')}, {bad} = 0 AS success FROM {t}")
    if r.expectation == "expect_column_values_to_be_between":
        bad = f"count(*) FILTER (WHERE {col} IS NOT NULL AND NOT ({col} >= {r.min_value} AND {col} <= {r.max_value}))"
        frac = f"(CASE WHEN count({col}) = 0 THEN 1.0 ELSE 1.0 - {bad} / count({col}) END)"
        ok = f"{frac} >= {r.mostly}" if r.mostly is not None else f"{bad} = 0"
        return (head + f"'{col}' AS column_name, 'critical' AS severity, count({col}) AS evaluated, {bad} AS unexpected, "
                f"{O.r4(f'1.0 - {frac}', 'observed')}, {ok} AS success FROM {t}")
    cols = list(r.columns)
    key = ", ".join(cols)
    dup = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {t} GROUP BY {key} HAVING count(*) > 1))"
    return (head + f"'{','.join(cols)}' AS column_name, 'critical' AS severity, count(*) AS evaluated, "
            f"CAST({dup} AS BIGINT) AS unexpected, {O.r4(f'{dup} / greatest(count(*), 1)', 'observed')}, "
            f"{dup} = 0 AS success FROM {t}")


def _suite_sql_body() -> str:
    arms = []
    for name, suite in Q.default_suites().items():
        for i, r in enumerate(suite.rules, 1):
            arms.append(_rule_sql(name, i, r))
    return " UNION ALL ".join(arms)


@register(
    "dq_suite",
    O.sql(
        "SELECT suite, CAST(rule_id AS INTEGER) AS rule_id, expectation, column_name, severity, "
        "CAST(evaluated AS BIGINT) AS evaluated, CAST(unexpected AS BIGINT) AS unexpected, observed, success "
        f"FROM ({_suite_sql_body()}) x"
    ),
)
def dq_suite(spark, sf_dir):
    """Q1-Q6: all six suites (103 rules) over the stand-in tables."""
    return S.rounded(all_results(spark, sf_dir))


_CP_VALUES = ", ".join(f"('{cp}', '{s}')" for cp, ss in Q.CHECKPOINTS.items() for s in ss)


@register(
    "dq_checkpoint",
    O.sql(
        f", res AS (SELECT suite, success FROM ({_suite_sql_body()}) x), "
        f"cp AS (SELECT * FROM (VALUES {_CP_VALUES}) AS t(checkpoint, suite)) "
        "SELECT checkpoint, count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations, "
        "count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations, bool_and(success) AS success "
        "FROM res JOIN cp USING (suite) GROUP BY checkpoint"
    ).replace("\n, res AS", ", res AS"),
)
def dq_checkpoint(spark, sf_dir):
    """Q7: checkpoint statistics (warning only; never raises)."""
    return Q.run_checkpoint(all_results(spark, sf_dir), Q.CHECKPOINTS)


@register(
    "dq_duplicates",
    O.sql(
        f"SELECT date_trunc('hour', ts) + to_minutes(CAST((minute(ts) // 5) * 5 AS BIGINT)) AS time, "
        f"{standins._sql_case(standins.DEMAND_REGION_OF_EVENT, 'event_type')} AS region_id, count(*) AS n "
        "FROM events GROUP BY 1, 2 HAVING count(*) > 1"
    ),
)
def dq_duplicates(spark, sf_dir):
    """Q5 detail: raw events keyed by (5-minute bucket, region) before averaging."""
    e = standins.read(spark, sf_dir, "events")
    raw = e.select(
        minute_floor("ts", 5).alias("time"),
        standins._map_lookup(standins.DEMAND_REGION_OF_EVENT, F.col("event_type")).alias("region_id"),
    )
    return Q.duplicate_keys(raw, ["time", "region_id"])

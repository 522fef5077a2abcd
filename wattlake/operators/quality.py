"""Declarative data-quality suites (Q1-Q7).

A suite is an ordered list of rules over one table. All row-level rules of
a suite compile to aggregate expressions evaluated in **one** ``agg`` (a
single scan, partial aggregation per task); compound-key uniqueness needs a
``groupBy(keys)`` and runs as its own job. Results are rows, never
exceptions: ``(suite, rule_id, expectation, column_name, severity, evaluated,
unexpected, observed, success)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.schemas import HORIZON_COLS, PREDICTION_ROW_COUNT_MAX, ROW_COUNT_MAX, VALID_REGIONS


@dataclass(frozen=True)
class Rule:
    expectation: str
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = ()
    mostly: float | None = None
    columns: tuple = ()
    severity: str = "critical"


def row_count_between(lo: int, hi: int) -> Rule:
    return Rule("expect_table_row_count_to_be_between", None, lo, hi)


def not_null(col: str) -> Rule:
    return Rule("expect_column_values_to_not_be_null", col)


def in_set(col: str, values: Sequence[str]) -> Rule:
    return Rule("expect_column_values_to_be_in_set", col, value_set=tuple(values))


def between(col: str, lo: float, hi: float, mostly: float | None = None) -> Rule:
    return Rule("expect_column_values_to_be_between", col, lo, hi, mostly=mostly)


def unique_key(cols: Sequence[str]) -> Rule:
    return Rule("expect_compound_columns_to_be_unique", columns=tuple(cols))


@dataclass
class Suite:
    name: str
    rules: list[Rule] = field(default_factory=list)


def _row_rule_sql(r: Rule) -> tuple[str, str]:
    """(evaluated, unexpected) as decomposable count aggregates."""
    if r.expectation == "expect_table_row_count_to_be_between":
        return "count(1)", "CAST(NULL AS BIGINT)"
    c = f"`{r.column}`"
    if r.expectation == "expect_column_values_to_not_be_null":
        return "count(1)", f"count_if({c} IS NULL)"
    if r.expectation == "expect_column_values_to_be_in_set":
        vals = ", ".join("'" + str(v).replace("'", "''") + "'" for v in r.value_set)
        return f"count({c})", f"count_if({c} IS NOT NULL AND NOT {c} IN ({vals}))"
    if r.expectation == "expect_column_values_to_be_between":
        lo, hi = float(r.min_value), float(r.max_value)
        return f"count({c})", f"count_if({c} IS NOT NULL AND NOT ({c} >= {lo!r} AND {c} <= {hi!r}))"
    raise ValueError(f"not a row rule: {r.expectation}")


def _verdict_sql(r: Rule, e: str, u: str) -> tuple[str, str]:
    """(observed, success) from the evaluated / unexpected totals."""
    if r.expectation == "expect_table_row_count_to_be_between":
        return f"CAST({e} AS DOUBLE)", f"({e} >= {int(r.min_value)} AND {e} <= {int(r.max_value)})"
    if r.expectation == "expect_column_values_to_be_between":
        frac_ok = f"(CASE WHEN {e} = 0 THEN 1.0D ELSE 1.0D - {u} / {e} END)"
        ok = f"({frac_ok} >= {float(r.mostly)!r})" if r.mostly is not None else f"({u} = 0)"
        return f"CAST(1.0D - {frac_ok} AS DOUBLE)", ok
    return f"CAST({u} / greatest({e}, 1) AS DOUBLE)", f"({u} = 0)"


def _struct_sql(i: int, r: Rule, column: str | None, e: str, u: str, obs: str, ok: str) -> str:
    col = "NULL" if column is None else "'" + column + "'"
    return (
        f"named_struct('rule_id', {i}, 'expectation', '{r.expectation}', "
        f"'column_name', CAST({col} AS STRING), 'severity', '{r.severity}', "
        f"'evaluated', CAST({e} AS BIGINT), 'unexpected', CAST({u} AS BIGINT), 'observed', {obs}, 'success', {ok})"
    )


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """Q6: evaluate a suite in one global aggregate, plus one over the keys alone.

    Row rules are pairs of counts in a single ``agg`` (partial sums per task,
    no row is shuffled); a compound-key rule counts rows per key, so only the
    key columns are read and shuffled for it. Rules compile to SQL text.
    """
    rules = list(enumerate(suite.rules, 1))
    row_rules = [(i, r) for i, r in rules if r.expectation != "expect_compound_columns_to_be_unique"]
    key_rules = [(i, r) for i, r in rules if r.expectation == "expect_compound_columns_to_be_unique"]
    if len({r.columns for _, r in key_rules}) > 1:
        raise ValueError("one compound key per suite")
    parts = [_row_rule_sql(r) for _, r in row_rules]
    totals = df.selectExpr(
        "count(1) AS _rows",
        *[f"{ev} AS e{i}" for (i, _), (ev, _) in zip(row_rules, parts)],
        *[f"{bad} AS u{i}" for (i, _), (_, bad) in zip(row_rules, parts)],
    )
    structs = []
    for i, r in key_rules:
        per_key = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_n"))
        repeated = per_key.select(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)))
        totals = totals.withColumn("_dup", repeated.scalar())
        e, u = "_rows", "_dup"
        structs.append(_struct_sql(i, r, ",".join(r.columns), e, u, f"CAST({u} / greatest({e}, 1) AS DOUBLE)", f"({u} = 0)"))
    for i, r in row_rules:
        e, u = f"coalesce(e{i}, 0)", f"u{i}" if r.expectation == "expect_table_row_count_to_be_between" else f"coalesce(u{i}, 0)"
        obs, ok = _verdict_sql(r, e, u)
        structs.append(_struct_sql(i, r, r.column, e, u, obs, ok))
    out = totals.selectExpr(f"inline(array({', '.join(structs)}))")
    return out.select(F.lit(suite.name).alias("suite"), "*")


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5 detail: keys occurring more than once, with their row counts."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def run_checkpoint(results: DataFrame, checkpoints: dict[str, Sequence[str]]) -> DataFrame:
    """Q7: statistics per checkpoint over suite results (warns, never raises)."""
    rows = [(cp, s) for cp, suites in checkpoints.items() for s in suites]
    spark = results.sparkSession
    membership = spark.createDataFrame(rows, "checkpoint string, suite string")
    j = results.join(F.broadcast(membership), "suite")
    return j.groupBy("checkpoint").agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        F.bool_and("success").alias("success"),
    )


# ---------------------------------------------------------------------------
# Fixed suites (bounds as published for the demand/weather tables).
WEATHER_BOUNDS = [
    ("temperature_2m", -10, 55),
    ("relative_humidity_2m", 0, 100),
    ("precipitation", 0, 500),
    ("cloud_cover", 0, 100),
    ("wind_speed_10m", 0, 200),
    ("shortwave_radiation", 0, 1500),
]


def _weather_rules() -> list[Rule]:
    return [
        row_count_between(1, ROW_COUNT_MAX),
        not_null("time"),
        not_null("region_id"),
        not_null("temperature_2m"),
        in_set("region_id", VALID_REGIONS),
        *[between(c, lo, hi, mostly=0.95) for c, lo, hi in WEATHER_BOUNDS],
    ]


def default_suites() -> dict[str, Suite]:
    s = {
        "bronze.demand": Suite(
            "bronze.demand",
            [
                row_count_between(1, ROW_COUNT_MAX),
                not_null("time"),
                not_null("region_id"),
                in_set("region_id", VALID_REGIONS),
                between("demand_mw", 0, 20000, mostly=0.9),
            ],
        ),
        "bronze.weather": Suite("bronze.weather", _weather_rules()),
        "silver.demand_5min": Suite(
            "silver.demand_5min",
            [
                row_count_between(1, ROW_COUNT_MAX),
                not_null("time"),
                not_null("region_id"),
                not_null("demand_mw"),
                in_set("region_id", VALID_REGIONS),
                between("demand_mw", 0, 20000, mostly=0.95),
                unique_key(["time", "region_id"]),
            ],
        ),
        "silver.weather_hourly": Suite("silver.weather_hourly", _weather_rules() + [unique_key(["time", "region_id"])]),
        "silver.features_ml": Suite(
            "silver.features_ml",
            [
                row_count_between(1, ROW_COUNT_MAX),
                not_null("time"),
                not_null("region_id"),
                not_null("demand_mw"),
                not_null("hour"),
                not_null("day_of_week"),
                not_null("is_weekend"),
                not_null("month"),
                not_null("season"),
                in_set("region_id", VALID_REGIONS),
                between("demand_mw", 0, 20000, mostly=0.95),
                between("hour", 0, 23),
                between("day_of_week", 0, 6),
                between("month", 1, 12),
                between("season", 1, 4),
                unique_key(["time", "region_id"]),
            ],
        ),
    }
    pred_rules = [
        row_count_between(5, PREDICTION_ROW_COUNT_MAX),
        not_null("created_at"),
        not_null("region_id"),
        in_set("region_id", VALID_REGIONS),
    ]
    for c in HORIZON_COLS:
        pred_rules += [not_null(c), between(c, 0, 25000, mostly=0.95)]
    s["silver.predictions"] = Suite("silver.predictions", pred_rules)
    return s


CHECKPOINTS = {
    "bronze_validation": ["bronze.demand", "bronze.weather"],
    "silver_validation": ["silver.demand_5min", "silver.weather_hourly"],
    "features_validation": ["silver.features_ml"],
    "predictions_validation": ["silver.predictions"],
}
# ---------------------------------------------------------------------------

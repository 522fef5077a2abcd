"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus DuckDB twins.

Each query reads the driver's tables through the stand-ins and runs over
them whole. Doubles are rounded to 4 places at the edge, times are
``timestamp_ntz``; column names equal the SQL aliases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


MODULES = [
    "q_gold",
    "q_insight",
    "q_features",
    "q_incremental",
    "q_forecast",
    "q_quality",
    "q_ingest",
    "q_serving",
    "q_stream",
    "q_train",
    "q_models",
    "q_restart",
]


def load_all() -> None:
    """Import every query module so that its ``register`` calls run."""
    import importlib
    import importlib.util

    for m in MODULES:
        name = f"wattlake.plans.{m}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)

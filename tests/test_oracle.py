"""Every registered query against its DuckDB twin on the smallest fixture."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_compare import compare, duck_connection
from wattlake.plans import catalog

catalog.load_all()
ORACLE, QUERIES = catalog.ORACLE, catalog.QUERIES
# the long lags of these need more history than the smallest tables hold
LONG = {"features_wide", "split_profile", "horizon_long"}


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    if name in LONG:
        r = compare(QUERIES[name](spark, SF_CHECK), duck_connection(SF_CHECK), ORACLE[name])
        assert r["spark_rows"] > 0
    else:
        r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "demand_mw_avg" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"train_eval", "boosted_eval"}


@pytest.mark.parametrize("name", ["gold_hourly", "serving_lags", "stream_latest", "region_staleness"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["match"], r

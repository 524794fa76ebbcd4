"""Every registered query equals its DuckDB oracle on the given tables."""
import pytest

from eventide.plans.compare import compare
from eventide.plans.oracle import ORACLE
from eventide.plans.registry import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    r = compare(df, duck, ORACLE[name])
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["match"], r
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 8
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["q22_timezone_shift", "f37_uplift_projection", "f6_weekly_cohort",
                                  "f8_time_template", "m4_fct_events", "q28_weekly_health", "st2_hourly_counts"])
def test_results_do_not_depend_on_session_time_zone(spark, sf_dir, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r["match"], r

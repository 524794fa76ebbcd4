"""Checks and reports on inline rows: what must be found, and what must be left alone."""
import datetime as dt
import glob
import tempfile

from pyspark.sql import functions as F

from eventide.functions.skew import split_join
from eventide.operators import erasure as ER
from eventide.operators import funnel as FN
from eventide.operators import governance as G
from eventide.operators import quality as Q

D = dt.date(2024, 1, 1)
DAY = dt.timedelta(days=1)


def test_column_that_goes_empty_on_a_date_is_found(spark):
    a = spark.createDataFrame([(D + k * DAY, 1, "v", 1.0) for k in range(3) for _ in range(4)], "event_date date, id int, x string, gone double")
    b = spark.createDataFrame([(D + k * DAY, "1", "v" if k != 1 else None, 2) for k in range(3) for _ in range(4)], "event_date date, id string, x string, new int")
    got = {(r.column_name, r.drift): (r.first_date, r.last_date, r.dates) for r in Q.column_drift(Q.column_profile(a), Q.column_profile(b)).collect()}
    assert got == {("x", "emptied"): (D + DAY, D + DAY, 1), ("id", "type"): (D, D + 2 * DAY, 3), ("gone", "removed"): (D, D + 2 * DAY, 3), ("new", "added"): (D, D + 2 * DAY, 3)}


def test_a_missing_run_breaks_a_streak(spark):
    rows = [(D + k * DAY, "dedicated_user_invited", "WARN") for k in (0, 1, 3, 4)]              # no run on day 2
    rows += [(D + k * DAY, "other", "WARN") for k in (1, 2, 3)] + [(D + 2 * DAY, "dedicated_sso_configured", "FAIL"), (D + 3 * DAY, "dedicated_sso_configured", "MISSING"),
                                                                   (D + 4 * DAY, "other", "FAIL"), (D, "late", "PASS")]
    h = spark.createDataFrame(rows, "run_date date, event_name string, status string")
    assert [(r.event_name, r.first_run, r.consecutive_warns) for r in Q.escalations(h).collect()] == [("other", D + DAY, 3)]
    found = {(r.event_name, r.cause): (r.first_run, r.last_run, r.runs) for r in Q.incidents(h).collect()}
    assert found == {("dedicated_sso_configured", "FAIL"): (D + 2 * DAY, D + 3 * DAY, 2)}
    more = h.union(spark.createDataFrame([(D + 2 * DAY, "dedicated_user_invited", "WARN")], h.schema))
    assert ("dedicated_user_invited", "ESCALATED_WARN") in {(r.event_name, r.cause) for r in Q.incidents(more).collect()}


def test_plan_violations_of_each_kind(spark):
    rows = [("dedicated_pipeline_executed", '{"project_id": "p", "pipeline_id": "q", "status": "ok", "duration_seconds": 3, "runner_type": "r"}'),
            ("dedicated_pipeline_executed", '{"project_id": "p", "pipeline_id": "q", "status": "ok", "duration_seconds": "3", "extra": 1}'),
            ("dedicated_merge_request_merged", '{"project_id": "p", "mr_id": "m", "time_to_merge_hours": 1.5}'),
            ("dedicated_sso_configured", '{"provider_type": "saml", "configuration_action": null}'), ("unknown_event", '{"a": 1}'), ("dedicated_nav_section_clicked", "not json")]
    got = {(r.event_name.removeprefix("dedicated_"), r.property): (r.observed_type, r.violation) for r in G.plan_violations(spark.createDataFrame(rows, "event_name string, properties string")).collect()
           if r.violation != "not_observed"}
    assert got == {("pipeline_executed", "duration_seconds"): ("VARIANT", "wrong_type"), ("pipeline_executed", "extra"): ("BIGINT", "unplanned"),
                   ("merge_request_merged", "approvals_count"): (None, "missing"), ("sso_configured", "configuration_action"): ("VOID", "wrong_type"),
                   ("nav_section_clicked", "section_name"): (None, "missing"), ("nav_section_clicked", "previous_section"): (None, "missing")}


def test_erasure_rewrites_only_the_files_that_hold_the_tenant(spark):
    path = tempfile.mkdtemp(prefix="erase-", dir="/tmp") + "/t"
    for tenant in ("a", "b"):
        spark.createDataFrame([(tenant, D + k * DAY, k) for k in range(3)], "tenant_id string, event_date date, n int").write.mode("append").partitionBy("event_date").parquet(path)
    spark.createDataFrame([("a", D, 9), ("b", D, 10)], "tenant_id string, event_date date, n int").coalesce(1).write.mode("append").partitionBy("event_date").parquet(path)
    before = set(glob.glob(f"{path}/event_date=*/*.parquet"))
    gone = spark.createDataFrame([("a",)], "tenant_id string")
    old = ER.erase_tenant_files(spark, path, gone, "event_date", "r1")
    after = set(glob.glob(f"{path}/event_date=*/*.parquet"))
    assert len(old) == 4 and len(before & after) == 3       # only b's own files stay, by name
    rows = sorted((r.tenant_id, r.n) for r in spark.read.parquet(path).collect())
    assert rows == [("b", 0), ("b", 1), ("b", 2), ("b", 10)]
    # again, as after a crash: nothing is lost or doubled
    ER.erase_tenant_files(spark, path, gone, "event_date", "r1")
    assert sorted((r.tenant_id, r.n) for r in spark.read.parquet(path).collect()) == rows
    requests = spark.createDataFrame([("a", D), ("b", D), ("b2", D)], "tenant_id string, requested_on date")
    status = {r.tenant_id: r.status for r in ER.erasure_ledger(requests, ER.file_manifest(spark, path), "2024-02-01").collect()}
    assert status == {"a": "DONE", "b": "OVERDUE", "b2": "DONE"}
    assert {r.status for r in ER.erasure_ledger(requests, ER.file_manifest(spark, path), "2024-01-31").where("tenant_id = 'b'").collect()} == {"OPEN"}


def test_lift_needs_its_control_and_minimum(spark):
    p = spark.createDataFrame([(arm, int(k < n)) for arm, n in (("c", 50), ("t", 54), ("s", 52)) for k in range(100)], "arm string, ok int")
    got = {r.arm: (r.relative_change_pct, r.verdict) for r in FN.lift_compare(p, "arm", "ok", "c", 7.0).collect()}
    assert got == {"c": (0.0, "CONTROL"), "t": (8.0, "REACHES_EFFECT"), "s": (4.0, "BELOW_EFFECT")}
    assert {r.verdict for r in FN.lift_compare(p, "arm", "ok", "x", 7.0).collect()} == {"NO_CONTROL"}


def test_null_keys_spread_over_salts(spark):
    big = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit("k")).alias("k"), "id")
    small = spark.createDataFrame([("k", 1)], "k string, v int")
    left = split_join(big, small, ["k"], how="left", threshold=100)
    assert left.count() == 4000 and left.where("v IS NULL").count() == 2000
    assert split_join(big, small, ["k"], how="inner", threshold=100).count() == 2000

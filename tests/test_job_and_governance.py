"""The batch job end to end on sf0.001 tables, and governance rules on inline rows."""
import datetime as dt
import tempfile

from eventide.operators import governance as G
from eventide.operators.fact_store import FactStore
from eventide.plans import job
from eventide.sources import fixtures as X

T0 = dt.datetime(2024, 1, 3, 10, 0, 0)


def test_daily_job_writes_fact_and_reports(spark, sf_dir):
    d = tempfile.mkdtemp(prefix="job-", dir="/tmp")
    X.raw_events(spark, sf_dir).write.parquet(f"{d}/raw")
    X.dim_users(spark, sf_dir).write.parquet(f"{d}/dims/dim_users")
    X.dim_tenants(spark, sf_dir).write.parquet(f"{d}/dims/dim_tenants")
    job.run(spark, f"{d}/raw", f"{d}/dims", f"{d}/out", "2024-02-01 00:00:00")
    fact = FactStore(spark, f"{d}/out/fct_events").read()
    assert fact.count() == spark.read.parquet(f"{d}/raw").select("event_id").distinct().count()
    funnel = spark.read.parquet(f"{d}/out/reports/funnel")
    assert funnel.count() == 8
    statuses = {r.status for r in spark.read.parquet(f"{d}/out/reports/reconciliation").collect()}
    assert statuses == {"PASS"}
    # the next day's run merges what has come since, and changes nothing where nothing came
    before = {r.event_id: r.event_key for r in fact.collect()}
    job.run(spark, f"{d}/raw", f"{d}/dims", f"{d}/out", "2024-02-02 00:00:00", since="2024-01-20 00:00:00")
    assert {r.event_id: r.event_key for r in FactStore(spark, f"{d}/out/fct_events").read().collect()} == before


def test_name_lint_rules(spark):
    names = ["dedicated_user_invited", "dedicated_userInvited", "user_invited", "dedicated_tenant_provisioned",
             "dedicated_user_first_login", "dedicated_project_" + "x" * 60 + "_created"]
    df = spark.createDataFrame([(n,) for n in names], "event_name string")
    got = {r.event_name: r for r in G.name_lint(df).collect()}
    assert got["dedicated_user_invited"].status == "PASS"
    assert not got["dedicated_userInvited"].is_snake_case
    assert not got["user_invited"].has_prefix
    assert not got["dedicated_tenant_provisioned"].domain_ok       # 'tenant' is not a listed domain
    assert not got["dedicated_user_first_login"].past_tense         # 'login' is not past tense
    assert not got[names[-1]].length_ok


def test_pii_and_property_rules(spark):
    rows = [("e1", '{"contact": "a.b@example.com", "ip": "10.0.0.12"}'),
            ("e2", '{"is_admin": true, "template_used": false, "wait_duration": 3, "items_found": 2}')]
    df = spark.createDataFrame(rows, "event_name string, properties string")
    pii = {r.event_name: (r.rows_with_email, r.rows_with_ip) for r in G.pii_scan(df).collect()}
    assert pii == {"e1": (1, 1), "e2": (0, 0)}
    rules = {(r.property, r.rule) for r in G.property_naming(df).collect()}
    assert ("template_used", "boolean_without_is_has") in rules
    assert ("wait_duration", "duration_without_unit") in rules
    assert ("items_found", "count_without_suffix") in rules
    assert not any(p == "is_admin" for p, _ in rules)

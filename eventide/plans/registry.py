"""Named queries: each takes (spark, sf_dir) and returns a DataFrame built
from the given parquet tables. ``oracle.py`` holds the matching DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import funnel as FN
from ..operators import docs as D
from ..operators import governance as G
from ..operators import erasure as ER
from ..operators.fact_store import FactStore
from ..operators import model as M
from ..operators import quality as Q
from ..operators import reports as R
from ..session import scratch_path
from ..sources import fixtures as X
from ..sources import io as IO
from ..streaming import stream as ST

AS_OF = "2024-02-01 00:00:00"
FULL_RANGE = C.Window("2024-01-01", "2024-02-01")      # every event of the month


class Ctx:
    """Lazily built inputs of one query run (all derived from the parquet)."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: dict | None = None):
        self.spark, self.sf = spark, sf_dir
        # pre-built tables (e.g. the stored raw and fact tables of a pipeline run)
        for k, v in (tables or {}).items():
            self.__dict__[k] = v

    @cached_property
    def raw_n(self) -> DataFrame:
        return X.raw_events(self.spark, self.sf, keep_n=True)

    @cached_property
    def raw(self) -> DataFrame:
        return self.raw_n.drop("n")

    @cached_property
    def fact_n(self) -> DataFrame:
        return M.fact_from_raw(self.raw_n, as_of=AS_OF, keep=["n"])

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_n.drop("n")

    @cached_property
    def degraded(self) -> DataFrame:
        """The fact with injected faults for the reconciliation branches."""
        f = self.fact_n
        n, name = F.col("n"), F.col("event_name")
        kept = f.where((name != "dedicated_mr_created") & (n % 503 != 0) &
                       ~((name == "dedicated_pipeline_executed") & (n % 97 == 0)))
        orphan = f.where(n == 0).withColumn("event_name", F.lit("dedicated_orphan_event"))
        return kept.unionByName(orphan).drop("n")

    def replay(self, name: str, build, raw: DataFrame | None = None, route_delay: str | None = None,
               conf: dict | None = None) -> str:
        """Run a streaming query over raw events that land week by week;
        returns the query's folder (sinks go below it)."""
        import uuid
        root = scratch_path(self.spark, f"stream-{name}-{uuid.uuid4().hex}")
        self.run_dir = root
        ST.replay(self.spark, self.raw_n if raw is None else raw, root, build(root),
                  partitions=ST.state_partitions(self.spark), route_delay=route_delay, conf=conf)
        return root

    # Funnel intermediates: from a shared profile table when the run built
    # one (bench, daily job), else computed for the query at hand.
    @cached_property
    def st(self) -> DataFrame:
        if "profile" in self.__dict__:
            return FN.profile_steps(self.profile, bounded=True)
        return FN.step_times(self.raw)

    @cached_property
    def st_any(self) -> DataFrame:
        if "profile" in self.__dict__:
            return FN.profile_steps(self.profile, bounded=False)
        return FN.step_times(self.raw, C.executed_funnel(after_invite=False))

    @cached_property
    def users(self) -> DataFrame:
        return X.dim_users(self.spark, self.sf)

    @cached_property
    def users_nokey(self) -> DataFrame:
        """dim_users without the surrogate key (no numbering pass)."""
        return X.dim_users(self.spark, self.sf, with_key=False)

    @cached_property
    def tenants(self) -> DataFrame:
        return X.dim_tenants(self.spark, self.sf)

    @cached_property
    def tickets(self) -> DataFrame:
        return X.tickets(self.spark, self.sf)

    @cached_property
    def catalog(self) -> DataFrame:
        return X.event_catalog(self.spark)


def q(fn: Callable[[Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str, tables: dict | None = None) -> DataFrame:
        return fn(Ctx(spark, sf_dir, tables))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = q(fn)
        return fn
    return deco


# ------------------------------------------------------------------ model
@register("m1_raw_events")
def _m1(c: Ctx):
    return c.raw


@register("m4_fct_events")
def _m4(c: Ctx):
    """M-3 + M-4 + M-5: deduplicated, enriched fact with a dense event key."""
    return M.add_event_key(c.fact)


def _store(c: Ctx):
    import uuid
    return FactStore(c.spark, scratch_path(c.spark, f"fact-{uuid.uuid4().hex}"))


@register("m5_stored_key")
def _m5s(c: Ctx):
    """The dense key from stored positions and per-partition offsets: the table is written once."""
    store = _store(c)
    store.build(c.raw, as_of=AS_OF)
    return store.read().select("event_key", "event_id", "event_timestamp", "event_date")


@register("m14_incremental")
def _m14i(c: Ctx):
    """A build, then late rows and copies that move ids to other dates: equal to a full rebuild, keys included."""
    store, raw = _store(c), X.crossing_copies(c.raw_n)
    store.build(raw.where("batch = 0").drop("n", "batch"), as_of=AS_OF)
    store.apply(raw.where("batch = 1").drop("n", "batch"), as_of=AS_OF)
    return store.read().select("event_key", "event_id", "event_name", "event_timestamp", "event_date", "user_id", "properties_json")


@register("m6_derive_category")
def _m6(c: Ctx):
    return M.derive_category(c.raw, c.catalog).groupBy("event_name", "event_category") \
        .agg(F.count(F.lit(1)).alias("rows"))


@register("m7_star_keys")
def _m7(c: Ctx):
    return M.add_star_keys(c.fact, c.tenants, c.users).select("event_id", "tenant_key", "user_key")


@register("m9_scd2_as_of")
def _m9(c: Ctx):
    return M.scd2_as_of(c.fact.select("event_id", "user_id", "event_timestamp"), c.users_nokey, "user_id",
                        attrs=["role"]).select("event_id", "user_id", "role")


@register("m11_sessions")
def _m11(c: Ctx):
    return M.sessions(c.fact)


@register("m13_retention")
def _m13(c: Ctx):
    return M.retention(c.fact, "2024-02-15", 1).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


@register("m15_backfill_step_name")
def _m15(c: Ctx):
    return M.backfill_step_name(c.fact).where(F.col("event_name") == M.STEP_EVENT) \
        .select("event_id", "step_index", "step_name")


@register("m16_user_lifecycle")
def _m16(c: Ctx):
    return M.user_lifecycle(c.fact)


@register("m17_seat_usage")
def _m17(c: Ctx):
    return M.seat_usage(c.fact, c.tenants)


@register("m18_page_sequence")
def _m18(c: Ctx):
    return M.page_sequence(c.fact)


# ------------------------------------------------------------------ funnel
@register("f1_step_times")
def _f1(c: Ctx):
    return c.st


@register("f2_funnel")
def _f2(c: Ctx):
    return FN.funnel(c.raw, st=c.st).orderBy("step_number")


@register("f3_e2e_conversion")
def _f3(c: Ctx):
    return FN.e2e_conversion(c.raw, st=c.st)


@register("f4_time_to_complete")
def _f4(c: Ctx):
    return FN.time_to_complete(c.raw, st=c.st_any).orderBy("transition_order")


@register("f5_segment_by_role")
def _f5(c: Ctx):
    seg = FN.segment_by_role(c.raw, c.users_nokey, profile=c.__dict__.get("profile"))
    return seg.orderBy(F.col("activation_rate").desc_nulls_last(), "role")


@register("f6_weekly_cohort")
def _f6(c: Ctx):
    return FN.weekly_cohort(c.raw, profile=c.__dict__.get("profile")).orderBy("cohort_week")


@register("f7_funnel_template")
def _f7(c: Ctx):
    return FN.funnel_template(c.raw, FULL_RANGE)


@register("f8_time_template")
def _f8(c: Ctx):
    return FN.time_template(c.raw, FULL_RANGE)


@register("f10_segment_funnel")
def _f10(c: Ctx):
    return FN.segment_funnel(c.raw, c.users_nokey, c.tenants)


@register("f11_benchmark_compare")
def _f11(c: Ctx):
    return FN.benchmark_compare(FN.funnel(c.raw, st=c.st))


@register("f12_role_severity")
def _f12(c: Ctx):
    return FN.role_severity(FN.segment_by_role(c.raw, c.users_nokey))


@register("f13_top_dropoffs")
def _f13(c: Ctx):
    return FN.top_dropoffs(FN.funnel(c.raw, st=c.st), FN.time_to_complete(c.raw, st=c.st_any))


@register("f14_cohort_dropoff_trend")
def _f14(c: Ctx):
    return FN.cohort_dropoff_trend(c.raw)


@register("f15_completion_7d")
def _f15(c: Ctx):
    return FN.within_days_rate(c.raw, ["dedicated_onboarding_completed"], 7, "onboarding_completed_7d")


@register("f16_activation_7d")
def _f16(c: Ctx):
    return FN.within_days_rate(c.raw, list(FN.VALUE_EVENTS), 7, "value_action_7d")


@register("f17_retention_30d")
def _f17(c: Ctx):
    return FN.retention_30d(c.raw)


@register("f18_ttfv_user")
def _f18(c: Ctx):
    return FN.ttfv_user(c.raw)


@register("f19_ttfv_tenant")
def _f19(c: Ctx):
    return FN.ttfv_tenant(c.raw, c.tenants)


@register("f20_restart_rate")
def _f20(c: Ctx):
    return FN.restart_rate(c.raw)


@register("f21_behaviour_classes")
def _f21(c: Ctx):
    return FN.behaviour_classes(c.raw)


@register("f22_guided_activation")
def _f22(c: Ctx):
    return FN.guided_activation(c.raw)


@register("f36_step_pair_rate")
def _f36(c: Ctx):
    return FN.step_pair_rate(c.raw, 0, 2)


# ------------------------------------------------------------------ quality
@register("q1_reconcile_day")
def _q1(c: Ctx):
    return Q.reconcile(c.raw, c.degraded).orderBy("status", "event_date", "event_name")


@register("q1_reconcile_name")
def _q1n(c: Ctx):
    return Q.reconcile(c.raw, c.degraded, grain=["event_name"])


@register("q1_raw_vs_fact")
def _q1f(c: Ctx):
    return Q.reconcile(c.raw, c.fact)


@register("q2_reconcile_template")
def _q2(c: Ctx):
    return Q.reconcile(c.raw, c.degraded, th=C.Thresholds(two_band=True), window=FULL_RANGE, keep_nulls=True)


@register("q5_status_summary")
def _q5(c: Ctx):
    return Q.status_summary(Q.reconcile(c.raw, c.degraded))


@register("q6_null_checks")
def _q6(c: Ctx):
    return Q.null_checks(c.raw).orderBy(F.col("null_rate_pct").desc(), "event_name")


@register("q7_null_verdict")
def _q7(c: Ctx):
    return Q.null_verdict(Q.null_checks(c.raw))


@register("q8_null_checks_template")
def _q8(c: Ctx):
    return Q.null_checks_template(c.raw, FULL_RANGE)


@register("q9_duplicates")
def _q9(c: Ctx):
    return Q.duplicates(c.raw).orderBy(F.col("total_duplicate_rows").desc(), "event_name", "tenant_id")


@register("q10_duplicates_template")
def _q10(c: Ctx):
    return Q.duplicates_template(c.raw, FULL_RANGE)


@register("q11_p0_coverage")
def _q11(c: Ctx):
    return Q.p0_coverage(c.raw).orderBy(F.col("status").desc(), "tenant_id", "event_name")


@register("q12_coverage_gaps")
def _q12(c: Ctx):
    return Q.p0_coverage(c.raw, window=FULL_RANGE, gaps_only=True)


@register("q13_coverage_ratio")
def _q13(c: Ctx):
    return Q.coverage_ratio(Q.p0_coverage(c.raw))


@register("q14_unique")
def _q14(c: Ctx):
    return (Q.unique_check(c.fact, "event_id", "fct_events")
            .unionByName(Q.unique_check(c.users, "user_surrogate_key", "dim_users"))
            .unionByName(Q.unique_check(c.tenants, "tenant_surrogate_key", "dim_tenants"))
            .unionByName(Q.unique_check(c.raw, "event_id", "raw_events")))


@register("q15_not_null")
def _q15(c: Ctx):
    return Q.not_null_check(c.fact, ["event_id", "event_name", "tenant_id", "user_id", "event_timestamp",
                                     "event_date", "platform_version"], "fct_events")


@register("q16_accepted_values")
def _q16(c: Ctx):
    return Q.accepted_values(c.degraded, "event_name", C.ACCEPTED_EVENT_NAMES)


@register("q17_relationships")
def _q17(c: Ctx):
    return (Q.relationships(c.fact, c.tenants, "tenant_id", "fct.tenant_id→dim_tenants")
            .unionByName(Q.relationships(c.fact, c.users_nokey, "user_id", "fct.user_id→dim_users")))


@register("q18_timestamp_order")
def _q18(c: Ctx):
    return Q.timestamp_order(c.raw)


@register("q20_schema_drift")
def _q20(c: Ctx):
    return Q.schema_drift(c.raw, c.degraded)


@register("q21_tenant_reconcile")
def _q21(c: Ctx):
    return Q.reconcile(c.raw, c.degraded, grain=["tenant_id", "event_name"])


@register("q22_timezone_shift")
def _q22(c: Ctx):
    return Q.timezone_shift(c.raw, "America/Los_Angeles")


@register("q23_late_arrivals")
def _q23(c: Ctx):
    return Q.late_arrivals(c.raw)


@register("q27_recurring")
def _q27(c: Ctx):
    return Q.recurring(Q.run_history(Q.reconcile(c.raw, c.degraded)))


@register("q28_weekly_health")
def _q28(c: Ctx):
    return Q.weekly_health(Q.run_history(Q.reconcile(c.raw, c.degraded)))


@register("q29_cardinality")
def _q29(c: Ctx):
    return Q.cardinality(c.raw)


@register("q30_domain_values")
def _q30(c: Ctx):
    """All seven domains, over tables of which some values are out of them."""
    fact = M.fact_from_raw(X.worn_events(c.raw_n).drop("n"), as_of=AS_OF)
    return Q.domain_values({"fact": fact, **X.worn_dims(c.users_nokey, c.tenants, M.user_lifecycle(c.fact), M.sessions(c.fact))})


@register("q31_format_checks")
def _q31(c: Ctx):
    return Q.format_checks(X.worn_events(c.raw_n))


# ------------------------------------------------------------------ reports
@register("r1_executive_summary")
def _r1(c: Ctx):
    return R.executive_summary(c.raw, c.fact, c.tenants, c.users_nokey)


@register("r2_event_volume")
def _r2(c: Ctx):
    return R.event_volume(c.fact).orderBy(F.col("event_count").desc(), "event_category", "event_name")


@register("r3_category_distribution")
def _r3(c: Ctx):
    return R.category_distribution(c.fact)


@register("r4_tenant_overview")
def _r4(c: Ctx):
    return R.tenant_overview(c.fact, c.tenants).orderBy(F.col("total_events").desc(), "tenant_id")


@register("r5_quality_scorecard")
def _r5(c: Ctx):
    return R.quality_scorecard(Q.reconcile(c.raw, c.fact), Q.null_checks(c.raw), c.raw, c.fact)


@register("r6_funnel_share")
def _r6(c: Ctx):
    return R.funnel_share(FN.funnel(c.raw, st=c.st))


@register("r7_cohort_trend")
def _r7(c: Ctx):
    return R.cohort_trend(FN.weekly_cohort(c.raw))


# ------------------------------------------------------------------ streaming
FACT_COLS = ["event_id", "event_name", "tenant_id", "user_id", "session_id", "event_timestamp",
             "platform_version", "event_source", "properties"]


@register("st1_stream_dedupe")
def _st1(c: Ctx):
    root = c.replay("st1", lambda r: lambda src: ST.dedupe_stream(src).writeStream.format("parquet")
                    .option("path", f"{r}/out").outputMode("append"))
    return c.spark.read.parquet(f"{root}/out").select(*FACT_COLS)


@register("st2_hourly_counts")
def _st2(c: Ctx):
    keys = ["window_start", "window_end", "event_name"]
    root = c.replay("st2", lambda r: lambda src: ST.hourly_counts(src, delay="24 hours").writeStream
                    .outputMode("update").foreachBatch(ST.upsert_batches(f"{r}/out", keys)))
    return ST.latest(c.spark, f"{root}/out", keys)


@register("st3_late_routing")
def _st3(c: Ctx):
    """All routes, over events of which some lost a time (ids that end in 77
    the event time, in 78 the arrival time)."""
    def lost(src: DataFrame) -> DataFrame:
        return (src.withColumn("event_timestamp", F.when(~F.col("event_id").endswith("77"), F.col("event_timestamp")))
                   .withColumn("collector_tstamp", F.when(~F.col("event_id").endswith("78"), F.col("collector_tstamp"))))

    root = c.replay("st3", lambda r: lambda src: lost(src).writeStream.foreachBatch(ST.route_late(f"{r}/out")))
    return c.spark.read.parquet(f"{root}/out").select("event_id", "event_name", "event_timestamp",
                                                     "collector_tstamp", "route")


@register("st1_dedupe_routed")
def _st1r(c: Ctx):
    """Each event once, and the rows that came behind the watermark: no row vanishes."""
    root = c.replay("st1r", lambda r: lambda src: ST.dedupe_stream(src, "24 hours").writeStream.format("parquet")
                    .option("path", f"{r}/out").outputMode("append"), raw=X.very_late(c.raw_n), route_delay="24 hours")
    cols = ["event_id", "event_name", "event_timestamp"]
    return (c.spark.read.parquet(f"{root}/out").select(*cols, F.lit("once").alias("route"))
            .unionByName(ST.behind_rows(c.spark, f"{root}/routed").select(*cols, F.lit("behind").alias("route"))))


@register("st2_counts_routed")
def _st2r(c: Ctx):
    """Rows of each event name: counted in hourly windows and routed; together all rows that came in."""
    keys = ["window_start", "window_end", "event_name"]
    root = c.replay("st2r", lambda r: lambda src: ST.hourly_counts(src, delay="4 hours").writeStream
                    .outputMode("update").foreachBatch(ST.upsert_batches(f"{r}/out", keys)),
                    raw=X.very_late(c.raw_n), route_delay="4 hours")
    counted = ST.latest(c.spark, f"{root}/out", keys).select("event_name", F.col("events").alias("counted"), F.lit(0).alias("routed"))
    routed = ST.behind_rows(c.spark, f"{root}/routed").select("event_name", F.lit(0).alias("counted"), F.lit(1).alias("routed"))
    return (counted.unionByName(routed).groupBy("event_name")
            .agg(F.sum("counted").cast("long").alias("rows_counted"), F.sum("routed").cast("long").alias("rows_routed"),
                 (F.sum("counted") + F.sum("routed")).cast("long").alias("rows_in")))


@register("st4_debounce")
def _st4(c: Ctx):
    """Clicks with bursts, out of order and up to hours late: those decided and those still waiting in state."""
    root = c.replay("st4", lambda r: lambda src: ST.debounce_stream(src).writeStream.format("parquet")
                    .option("path", f"{r}/out").outputMode("append"), raw=X.click_bursts(c.raw_n), conf=ST.TIMER_CONF)
    return c.spark.read.schema(ST.CLICK_SCHEMA).parquet(f"{root}/out").unionByName(ST.debounce_pending(c.spark, f"{root}/checkpoint"))


@register("st4_debounce_state_table")
def _st4t(c: Ctx):
    """ST-4 with the waiting clicks kept as a table."""
    root = c.replay("st4t", lambda r: lambda src: src.writeStream.foreachBatch(ST.debounce_batches(f"{r}/clicks")),
                    raw=X.click_bursts(c.raw_n))
    return ST.debounced(c.spark, f"{root}/clicks")


@register("st4_debounce_batch")
def _st4b(c: Ctx):
    return ST.debounce_batch(X.click_bursts(c.raw_n))


@register("st5_sessions")
def _st5(c: Ctx):
    keys = ["session_id", "user_id", "tenant_id"]
    root = c.replay("st5", lambda r: lambda src: ST.session_stream(src).writeStream.outputMode("update")
                    .foreachBatch(ST.upsert_batches(f"{r}/out", keys)))
    return ST.latest(c.spark, f"{root}/out", keys)


OPT_OUT_TENANTS = ["tenant_5"]


@register("st6_opt_out")
def _st6(c: Ctx):
    opt = F.broadcast(c.spark.createDataFrame([(t,) for t in OPT_OUT_TENANTS], "tenant_id string"))
    root = c.replay("st6", lambda r: lambda src: ST.suppress_opted_out(src, opt).writeStream.format("parquet")
                    .option("path", f"{r}/out").outputMode("append"))
    return c.spark.read.parquet(f"{root}/out").select(*FACT_COLS, "collector_tstamp")


# ------------------------------------------------------------------ governance
DEPRECATIONS = {"dedicated_nav_section_clicked": "2023-09-01", "dedicated_mr_created": "2024-01-01"}
ERASED_TENANTS = ["tenant_6"]
STORAGE_REGION = "us-east-1"


@register("g1_name_lint")
def _g1(c: Ctx):
    return G.name_lint(c.raw)


@register("g2_required_properties")
def _g2(c: Ctx):
    return G.required_properties(c.raw)


@register("g3_property_count")
def _g3(c: Ctx):
    return G.property_count(c.raw)


@register("g4_pii_scan")
def _g4(c: Ctx):
    return G.pii_scan(c.raw)


@register("g5_property_naming")
def _g5(c: Ctx):
    return G.property_naming(X.worn_events(c.raw_n))


@register("g6_plan_violations")
def _g6p(c: Ctx):
    """Payloads of all planned events against the tracking plan."""
    return G.plan_violations(X.worn_events(c.raw_n))


@register("g6_property_types")
def _g6(c: Ctx):
    return G.property_types(c.raw)


@register("g7_category_check")
def _g7(c: Ctx):
    return G.category_check(c.raw, c.catalog)


@register("g8_opt_out_violations")
def _g8(c: Ctx):
    opt = c.spark.createDataFrame([(t,) for t in OPT_OUT_TENANTS], "tenant_id string")
    return G.opt_out_violations(c.raw, F.broadcast(opt))


def _clustered(c: Ctx) -> str:
    import uuid
    path = scratch_path(c.spark, f"erase-{uuid.uuid4().hex}")
    M.write_clustered(c.fact, path, cluster=("tenant_id",))
    return path


@register("g9_erasure_files")
def _g9f(c: Ctx):
    """A stored table after the files that hold an erased tenant were rewritten."""
    path = _clustered(c)
    gone = c.spark.createDataFrame([(t,) for t in ERASED_TENANTS], "tenant_id string")
    ER.erase_tenant_files(c.spark, path, gone, "event_date", run_id="1")
    return c.spark.read.parquet(path).groupBy("tenant_id", "event_date").agg(F.count(F.lit(1)).alias("rows"))


@register("g9_erasure_ledger")
def _g9l(c: Ctx):
    """Requests (one a tenant and day from December 28th) against what the table still holds."""
    path = _clustered(c)
    ER.erase_tenant_files(c.spark, path, c.spark.createDataFrame([(t,) for t in ERASED_TENANTS], "tenant_id string"), "event_date", run_id="1")
    requests = c.tenants.select("tenant_id", F.expr("date_add(DATE'2023-12-28', CAST(substring(tenant_id, 8) AS INT))").alias("requested_on"))
    return ER.erasure_ledger(requests, ER.file_manifest(c.spark, path), AS_OF)


@register("g9_erasure")
def _g9(c: Ctx):
    gone = c.spark.createDataFrame([(t,) for t in ERASED_TENANTS], "tenant_id string")
    return G.erase_tenants(c.fact, F.broadcast(gone)).groupBy("tenant_id", "event_date") \
        .agg(F.count(F.lit(1)).alias("rows"))


@register("g10_residency")
def _g10(c: Ctx):
    return G.residency(c.fact, c.tenants, STORAGE_REGION)


@register("g11_deprecated_firing")
def _g11(c: Ctx):
    return G.deprecated_firing(c.raw, DEPRECATIONS)


@register("g12_plan_coverage")
def _g12(c: Ctx):
    return G.plan_coverage(c.raw, c.catalog)


# ------------------------------------------------------------------ documents
@register("d1_page_text")
def _d1a(c: Ctx):
    return D.html_to_text(X.table(c.spark, c.sf, "pages"))


@register("d1_chunks")
def _d1b(c: Ctx):
    return D.chunk_text(X.table(c.spark, c.sf, "documents"), size=1000, overlap=200)


@register("d2_portfolio_summary")
def _d2(c: Ctx):
    """Portfolio CSV files derived from lineitem, one file per portfolio and named after it, loaded back and summarized."""
    import uuid
    path = scratch_path(c.spark, f"portfolios-{uuid.uuid4().hex}")
    li = X.table(c.spark, c.sf, "lineitem")
    IO.write_named_csv(li.select(
        F.concat(F.lit("pf_"), (F.col("l_orderkey") % 4).cast("string")).alias("portfolio_id"),
        F.concat(F.lit("T"), (F.col("l_partkey") % 50).cast("string")).alias("ticker"),
        F.col("l_quantity").cast("long").alias("shares"),
        (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100.0).alias("price"),
        F.col("l_shipdate").cast("date").alias("date")), path, "portfolio_id")
    return D.portfolio_summary(D.read_portfolios(c.spark, path))


@register("d3_vector_topk")
def _d3(c: Ctx):
    vec = X.table(c.spark, c.sf, "embeddings")
    q = vec.where(F.col("vec_id") == vec.agg(F.min("vec_id")).first()[0]).select("embedding").first()[0]
    return D.cosine_top_k(vec, list(q), k=10)


# ------------------------------------------------------------------ more quality / model
@register("q3_raw_extract")
def _q3r(c: Ctx):
    return Q.layer_extract(c.raw, "raw", FULL_RANGE)


@register("q3_bi_extract")
def _q3b(c: Ctx):
    return Q.layer_extract(c.degraded, "bi", FULL_RANGE)


@register("q4_runbook_diff")
def _q4(c: Ctx):
    return Q.runbook_diff(c.raw, c.degraded, FULL_RANGE)


@register("q19_freshness")
def _q19(c: Ctx):
    return Q.freshness(c.raw)


@register("q19_freshness_exact")
def _q19e(c: Ctx):
    return Q.freshness_exact(c.raw)


@register("q24_discrepancy_log")
def _q24(c: Ctx):
    return Q.discrepancy_log(Q.reconcile(c.raw, c.degraded), Q.null_checks(c.raw), Q.duplicates(c.raw),
                             Q.schema_drift(c.raw, c.degraded), Q.late_arrivals(c.raw),
                             tz_shift=Q.timezone_shift(c.raw, "America/Los_Angeles"),
                             tenant_recon=Q.reconcile(c.raw, c.degraded, grain=["tenant_id", "event_name"]))


ESCALATION_THRESHOLDS = C.Thresholds(fail_pct=10.0, warn_pct=0.1)


@register("q25_incidents")
def _q25i(c: Ctx):
    return Q.incidents(Q.run_history(Q.reconcile(c.raw, c.degraded, th=ESCALATION_THRESHOLDS)))


@register("q25_escalations")
def _q25(c: Ctx):
    return Q.escalations(Q.run_history(Q.reconcile(c.raw, c.degraded, th=ESCALATION_THRESHOLDS)))


@register("q26_stale_failures")
def _q26(c: Ctx):
    return Q.stale_failures(Q.run_history(Q.reconcile(c.raw, c.degraded)), "2024-02-05", 3)


@register("m8_scd2_apply")
def _m8(c: Ctx):
    """A role-change batch derived from customer (every 7th key) applied to
    the user dimension as of 2024-02-01."""
    cust = X.table(c.spark, c.sf, "customer").where(F.col("c_custkey") % 7 == 0)
    inc = cust.select(F.concat(F.lit("usr_"), F.col("c_custkey").cast("string")).alias("user_id"),
                      F.element_at(F.array(*[F.lit(r) for r in C.ROLES]),
                                   (F.col("c_custkey") % 5 + 1).cast("int")).alias("role"))
    return M.scd2_apply(c.users_nokey, inc, "user_id", ["role"], AS_OF)


@register("m8_scd2_keys")
def _m8k(c: Ctx):
    """The same batch with new members on the keyed dimension: old surrogate
    keys stay, new versions are numbered after them."""
    cust, ck = X.table(c.spark, c.sf, "customer"), F.col("c_custkey")
    sent = cust.select(F.when(ck % 11 == 0, "new_").otherwise("usr_").alias("kind"), ck).where((ck % 7 == 0) | (ck % 11 == 0))
    inc = sent.select(F.concat("kind", ck.cast("string")).alias("user_id"),
                      F.concat(F.lit("tenant_"), (ck % 3).cast("string")).alias("tenant_id"),
                      F.element_at(F.array(*[F.lit(r) for r in C.ROLES]), (ck % 5 + 1).cast("int")).alias("role"))
    out = M.scd2_apply(c.users, inc, "user_id", ["role"], AS_OF, surrogate="user_surrogate_key")
    return out.select("user_surrogate_key", "user_id", "tenant_id", "role", "is_active", "valid_from", "valid_to", "is_current")


@register("m10_scd1_upsert")
def _m10(c: Ctx):
    early = M.user_lifecycle(c.fact.where(F.col("event_date") < F.lit("2024-01-15").cast("date"))) \
        .withColumn("loaded_at", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    full = M.user_lifecycle(c.fact).withColumn("loaded_at", F.lit(AS_OF).cast("timestamp_ntz"))
    return M.scd1_upsert(early, full, ["user_id", "tenant_id"])


@register("m14_reprocess_dates")
def _m14(c: Ctx):
    import uuid
    path = scratch_path(c.spark, f"fact-{uuid.uuid4().hex}")
    rebuilt = M.reprocess_dates(c.raw, "2024-01-15 00:00:00", path, as_of=AS_OF)
    return rebuilt.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------ behaviour (S tier)
GUARDRAIL_CUT = "2024-01-15 00:00:00"


@register("f23_ssh_step_lift")
def _f23(c: Ctx):
    return FN.ssh_step_lift(c.raw)


@register("f24_sso_login_effect")
def _f24(c: Ctx):
    return FN.sso_login_effect(c.raw, c.tenants)


@register("f26_step_duration")
def _f26(c: Ctx):
    return FN.step_duration(c.fact)


@register("f27_ticket_rate")
def _f27(c: Ctx):
    return FN.ticket_rate(c.raw, c.tickets)


@register("f27_ticket_preceding_step")
def _f27b(c: Ctx):
    return FN.ticket_preceding_step(c.raw, c.tickets)


@register("f28_feature_adoption")
def _f28(c: Ctx):
    return FN.feature_adoption(c.raw, c.tenants)


@register("f29_pipeline_retention_corr")
def _f29(c: Ctx):
    """Retention by tenant at 1, 6 and 12 months; two tenants fall silent on January 2nd, so that the first horizon has both kinds."""
    silent = F.col("tenant_id").isin("tenant_2", "tenant_6") & (F.col("event_timestamp") >= F.lit("2024-01-02").cast("timestamp_ntz"))
    return FN.pipeline_retention_corr(c.raw.where(~silent), c.tenants, AS_OF, months=(1, 6, 12))


@register("f30_scan_adoption")
def _f30(c: Ctx):
    return FN.scan_adoption(c.fact)


@register("f30_top_admin_actions")
def _f30b(c: Ctx):
    return FN.top_admin_actions(c.fact)


@register("f31_composite_activation")
def _f31(c: Ctx):
    return FN.composite_activation(c.raw)


@register("f32_reinvite_recovery")
def _f32(c: Ctx):
    return FN.reinvite_recovery(c.fact)


@register("f33_plan_tier_lift")
def _f33(c: Ctx):
    return FN.plan_tier_lift(c.raw, c.tenants)


@register("f34_interrupted_series")
def _f34(c: Ctx):
    return FN.interrupted_series(FN.daily_activations(c.raw), "event_date", "activations", "2024-01-15")


@register("f35_guardrails")
def _f35(c: Ctx):
    """The month before and after the cut, with retention after a week (the data span a month)."""
    return FN.guardrails(c.raw, c.tickets, GUARDRAIL_CUT, retention_days=7)


@register("f37_uplift_projection")
def _f37(c: Ctx):
    return FN.uplift_projection(c.raw)


@register("f38_keyword_tags")
def _f38k(c: Ctx):
    """The opening text of every conversation as a ticket, with a complaint added to some; every fourth has a tag, the others
    are tagged by keyword."""
    t = X.table(c.spark, c.sf, "conversations")
    k = F.col("conv_id") % 7
    said = (F.when(k == 0, " I cannot log in").when(k == 1, " the SSH key is refused").when(k == 2, " a job failed in CI/CD")
             .when(k == 3, " no repository").otherwise(""))
    tickets = t.groupBy("conv_id").agg(F.min_by("text", "turn").alias("text")).withColumn("text", F.concat("text", said)).withColumn(
        "category", F.when(F.col("conv_id") % 4 == 0, "login").when(F.col("conv_id") % 4 == 1, ""))
    return FN.tag_untagged(tickets).select("conv_id", "category", "tag_source")


@register("f38_stratified_rates")
def _f38(c: Ctx):
    return FN.stratified_rates(c.raw, c.tenants)


# ------------------------------------------------------------------ sources / sinks
@register("src2_json_roundtrip")
def _src2(c: Ctx):
    """Raw events written as JSON-lines payloads and loaded back typed."""
    import uuid
    path = scratch_path(c.spark, f"json-{uuid.uuid4().hex}")
    IO.write_raw_json(c.raw, path)
    back = IO.read_raw_json(c.spark, path)
    return back.groupBy("event_name").agg(F.count(F.lit(1)).alias("rows"),
                                          F.countDistinct("event_id").alias("ids"),
                                          F.count_if(F.col("properties") != "{}").alias("with_properties"))


@register("src8_region_landing")
def _src8(c: Ctx):
    import uuid
    path = scratch_path(c.spark, f"region-{uuid.uuid4().hex}")
    IO.write_region_local(c.raw, c.tenants, path)
    return c.spark.read.parquet(path).groupBy("region").agg(F.count(F.lit(1)).alias("rows"),
                                                            F.countDistinct("tenant_id").alias("tenants"))


@register("m12_clustered_write")
def _m12(c: Ctx):
    import uuid
    path = scratch_path(c.spark, f"fact-clustered-{uuid.uuid4().hex}")
    M.write_clustered(c.fact, path)
    back = c.spark.read.parquet(path)
    return back.groupBy("event_date", "tenant_id", "event_name").agg(F.count(F.lit(1)).alias("rows"))


@register("st5_session_windows")
def _st5w(c: Ctx):
    """Gap-based sessions (30 min) per user and tenant, when no session id is trusted.
    Append mode emits a session once the watermark (max event time - 6 h)
    passes its end; those still open at the end of the input come from the state."""
    root = c.replay("st5w", lambda r: lambda src: ST.session_windows(src, gap="30 minutes", delay="6 hours")
                    .writeStream.format("parquet").option("path", f"{r}/out").outputMode("append"), conf=ST.SESSION_CONF)
    return c.spark.read.parquet(f"{root}/out").unionByName(ST.open_sessions(c.spark, f"{root}/checkpoint"))


@register("f25_role_step_dropoff")
def _f25(c: Ctx):
    return FN.role_step_dropoff(FN.segment_funnel(c.raw, c.users_nokey, c.tenants))


def _report_sets(c: Ctx) -> str:
    import uuid
    path = scratch_path(c.spark, f"reports-{uuid.uuid4().hex}")
    IO.write_report_sets({"event_volume": R.event_volume(c.fact), "tenant_overview": R.tenant_overview(
        c.fact, c.tenants)}, path, fmt="csv")
    return path


@register("src6_report_sets")
def _src6(c: Ctx):
    """Report data sets written as CSV (the workbook's sheets) and read back: the event volume."""
    schema = ("event_category string, event_name string, event_count long, tenants long, users long, "
              "first_seen date, last_seen date")
    return c.spark.read.schema(schema).option("header", True).csv(f"{_report_sets(c)}/event_volume")


@register("src6_tenant_overview")
def _src6t(c: Ctx):
    """The other of the two report data sets, read back."""
    schema = ("tenant_id string, tenant_name string, region string, plan_tier string, seat_limit int, sso_enabled boolean, "
              "provisioning_date date, total_events long, active_users long, event_types_used long")
    return c.spark.read.schema(schema).option("header", True).csv(f"{_report_sets(c)}/tenant_overview")


@register("q20_column_drift")
def _q20c(c: Ctx):
    """Profiles of the raw layer and of a reporting layer that lost one column's values on the 20th."""
    raw = c.raw.withColumn("event_date", F.to_date("event_timestamp"))
    bi = c.fact.withColumn("platform_version", F.when(F.col("event_date") < F.lit("2024-01-20").cast("date"), F.col("platform_version")))
    return Q.column_drift(Q.column_profile(raw), Q.column_profile(bi))


@register("d3_index_topk")
def _d3i(c: Ctx):
    """The nearest indexed vectors of every 20th vector, among those that share a bucket with it."""
    import uuid
    index = D.VectorIndex(c.spark, scratch_path(c.spark, f"vectors-{uuid.uuid4().hex}"))
    vectors = X.table(c.spark, c.sf, "embeddings")
    index.build(vectors)
    return index.search(vectors.where(F.col("vec_id") % 20 == 0))


@register("d4_passage_top_k")
def _d4a(c: Ctx):
    return D.passage_top_k(X.table(c.spark, c.sf, "benchmark"), X.table(c.spark, c.sf, "documents"), k=3)


@register("d4_keyword_recall")
def _d4b(c: Ctx):
    return D.keyword_recall_at_k(X.table(c.spark, c.sf, "benchmark"), X.table(c.spark, c.sf, "documents"), k=3)



@register("f24_template_ttfv_effect")
def _f24b(c: Ctx):
    return FN.template_ttfv_effect(c.raw)



@register("m16_dim_users_lifecycle")
def _m16b(c: Ctx):
    """The user dimension with lifecycle dates and status filled on the
    current versions (history rows keep theirs)."""
    return M.apply_lifecycle(c.users_nokey, M.user_lifecycle(c.fact))

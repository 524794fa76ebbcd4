"""Funnel and behaviour operators (F-*).

The shared building blocks are

* ``step_times`` — per (user, tenant) the first invite and the first time of
  every later funnel step, optionally bounded to ``ts >= invited_at`` and a
  day window. The bounded form joins step events to the per-key invite time
  with ``split_join`` (hot keys map-side); the unbounded form is a single
  conditional aggregation.
* ``invite_profile`` — per (user, tenant) invite time plus 0/1 flags of
  arbitrary events, one grouped aggregation that Spark combines map-side.

Counts become rates in a one-row frame that is unpivoted with ``stack``; no
window runs over unbounded data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.compat import boundary_diff, elapsed, flag, json_str, pct, week_start
from ..functions.ranking import exact_quantiles
from ..functions.skew import split_join
from ..session import checkpoint_dir

U, T, TS, NAME = "user_id", "tenant_id", "event_timestamp", "event_name"
STEP_EVENT = "dedicated_onboarding_step_completed"


def _with_step_name(events: DataFrame) -> DataFrame:
    if "step_name" in events.columns:
        return events
    src = "properties" if "properties" in events.columns else "properties_json"
    return events.withColumn("step_name", F.when(F.col(NAME) == STEP_EVENT, json_str(src, "step_name")))


def _step_cond(step: C.FunnelStep) -> Column:
    c = F.col(NAME) == F.lit(step.event)
    if step.predicate:
        c = c & F.expr(step.predicate)
    return c


def _needs_step_name(spec: C.FunnelSpec) -> bool:
    return any(s.predicate and "step_name" in s.predicate for s in spec.steps)


def invited_users(events: DataFrame, spec: C.FunnelSpec = C.executed_funnel(),
                  window: C.Window | None = None) -> DataFrame:
    """First invite per (user, tenant); NULL keys form their own group, as
    GROUP BY does."""
    inv = events.where(_step_cond(spec.invite))
    if window:
        inv = inv.where((F.col(TS) >= F.lit(window.start).cast("timestamp_ntz")) &
                        (F.col(TS) < F.lit(window.end).cast("timestamp_ntz")))
    return inv.groupBy(U, T).agg(F.min(TS).alias("invited_at"))


def step_times(events: DataFrame, spec: C.FunnelSpec = C.executed_funnel(),
               window: C.Window | None = None,
               hot_rows: int = C.Scale().hot_key_rows, checkpoint: bool = True) -> DataFrame:
    """F-1: per (user, tenant): invited_at and step_<n>_at for n ≥ 1."""
    if _needs_step_name(spec):
        events = _with_step_name(events)
    later = spec.steps[1:]
    step_names = sorted({s.event for s in later})
    flags = [_step_cond(s).alias(f"_s{s.number}") for s in later]
    step_events = (events.where(F.col(NAME).isin(*step_names) & F.col(U).isNotNull() & F.col(T).isNotNull())
                         .select(U, T, TS, *flags))
    mins = [F.min(F.when(F.col(f"_s{s.number}"), F.col(TS))).alias(f"step_{s.number}_at") for s in later]
    if not (spec.after_invite or spec.window_days):
        invited = invited_users(events, spec, window)
        per_key = step_events.groupBy(U, T).agg(*mins)
        return invited.join(per_key, [U, T], "left")

    # One pass gives the invite time and the step-row count per key (the
    # counts size the salting of hot keys in the join below).
    inv_cond = _step_cond(spec.invite)
    if window:
        inv_cond = inv_cond & (F.col(TS) >= F.lit(window.start).cast("timestamp_ntz")) & \
            (F.col(TS) < F.lit(window.end).cast("timestamp_ntz"))
    per_user = (events.where(F.col(NAME).isin(spec.invite.event, *step_names))
                      .groupBy(U, T)
                      .agg(F.min(F.when(inv_cond, F.col(TS))).alias("invited_at"),
                           F.count_if(F.col(NAME).isin(*step_names)).alias("_rows")))
    if checkpoint:
        # one row per (user, tenant), used three times below (salt sizes, join
        # side, final rows): materialize it once in the shared checkpoint
        # folder instead of rescanning the events for each use
        checkpoint_dir(events.sparkSession)
        per_user = per_user.checkpoint(eager=True)
    invited = per_user.where(F.col("invited_at").isNotNull()).select(U, T, "invited_at")

    def cond(l, r):
        c = F.col(f"_l.{TS}") >= F.col("_r.invited_at")
        if spec.window_days:
            c = c & (F.col(f"_l.{TS}") < F.timestamp_add("DAY", F.lit(spec.window_days), F.col("_r.invited_at")))
        return c
    joined = split_join(step_events, invited, [U, T], how="inner", condition=cond, threshold=hot_rows,
                        counts=per_user.select(U, T, "_rows"))
    per_key = joined.groupBy(U, T).agg(*mins)
    return invited.join(per_key, [U, T], "left")


def _counts_row(st: DataFrame, spec: C.FunnelSpec) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("c0")]
    aggs += [F.count(f"step_{s.number}_at").alias(f"c{s.number}") for s in spec.steps[1:]]
    return st.agg(*aggs)


def funnel(events: DataFrame, spec: C.FunnelSpec = C.executed_funnel(),
           st: DataFrame | None = None) -> DataFrame:
    """F-2: users per step; conversion vs the previous step (step 0 = 100, 0
    when the previous count is 0); drop-off = 100 - conversion (step 0: 0);
    1 decimal, half-even like the report. F-12 severity on the unrounded
    drop-off: red > 35, amber > 20."""
    st = st if st is not None else step_times(events, spec)
    row = _counts_row(st, spec)
    parts = []
    for i, s in enumerate(spec.steps):
        cur = F.col(f"c{s.number}").cast("double")
        prev = F.col(f"c{spec.steps[i - 1].number}").cast("double") if i > 0 else cur
        cvr = F.when(prev > 0, cur / prev * F.lit(100.0)).otherwise(F.lit(0.0))
        drop = (F.lit(100.0) - cvr) if i > 0 else F.lit(0.0)
        sev = (F.when(drop > 35, "red").when(drop > 20, "amber").otherwise("green")) if i > 0 else F.lit("green")
        parts.append(F.struct(F.lit(s.number).alias("step_number"), F.lit(s.name).alias("step_name"),
                              F.col(f"c{s.number}").alias("users"),
                              F.bround(cvr, 1).alias("conversion_pct"),
                              F.bround(drop, 1).alias("dropoff_pct"),
                              sev.alias("severity")))
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def e2e_conversion(events: DataFrame, spec: C.FunnelSpec = C.executed_funnel(),
                   st: DataFrame | None = None) -> DataFrame:
    """F-3: last / first step in percent, the ×1.3 target, and whether the
    e2e rate meets the 20 % / 26 % targets."""
    st = st if st is not None else step_times(events, spec)
    row = _counts_row(st, spec)
    first, last = F.col("c0").cast("double"), F.col(f"c{spec.steps[-1].number}").cast("double")
    e2e = F.when(first > 0, last / first * F.lit(100.0)).otherwise(F.lit(0.0))
    return row.select(
        F.col("c0").alias("invited"), F.col(f"c{spec.steps[-1].number}").alias("activated"),
        F.bround(e2e, 1).alias("e2e_conversion_pct"),
        F.bround(e2e * F.lit(C.IMPROVEMENT_FACTOR), 1).alias("target_pct"),
        (e2e >= F.lit(C.E2E_TARGET_PCT)).alias("meets_target"),
        (e2e >= F.lit(C.E2E_POST_IMPROVEMENT_TARGET_PCT)).alias("meets_post_improvement_target"))


def benchmark_compare(funnel_rows: DataFrame, benchmarks: dict = C.FUNNEL_BENCHMARKS) -> DataFrame:
    """F-11: actual step conversion against the benchmark of each transition.
    The benchmark list is a parameter (7 rows) → broadcast."""
    spark = funnel_rows.sparkSession
    bm = spark.createDataFrame([(int(k.split("→")[1]), k, float(v) * 100.0) for k, v in benchmarks.items()],
                               "step_number int, transition string, benchmark_pct double")
    f = funnel_rows.where(F.col("step_number") > 0).select("step_number", "conversion_pct")
    return (f.join(F.broadcast(bm), "step_number")
             .select("transition", "step_number", "conversion_pct", F.round("benchmark_pct", 1).alias("benchmark_pct"),
                     F.round(F.col("conversion_pct") - F.col("benchmark_pct"), 1).alias("gap_pct"),
                     (F.col("conversion_pct") >= F.col("benchmark_pct")).alias("meets_benchmark")))


def time_to_complete(events: DataFrame, spec: C.FunnelSpec = C.executed_funnel(after_invite=False),
                     transitions=tuple(C.TRANSITIONS), st: DataFrame | None = None) -> DataFrame:
    """F-4: exact median and P90 per transition (minutes; hours for the last),
    1 decimal. Steps are not bounded by the invite (the executed form), and
    users are regrouped by (user_id, invited_at). Every transition yields a
    row; an empty one gives NULLs."""
    st = st if st is not None else step_times(events, spec)
    cols = [f"step_{s.number}_at" for s in spec.steps[1:]]
    per_user = st.groupBy(U, "invited_at").agg(*[F.min(c).alias(c) for c in cols])

    def at(n):
        return F.col("invited_at") if n == 0 else F.col(f"step_{n}_at")

    pairs = [F.struct(F.lit(label).alias("transition"),
                      F.when(at(a).isNotNull() & at(b).isNotNull(), elapsed(at(a), at(b), unit)).alias("v"))
             for label, a, b, unit in transitions]
    long = per_user.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    q = exact_quantiles(long, ["transition"], "v", [0.5, 0.9], ["median_minutes", "p90_minutes"])
    spark = events.sparkSession
    labels = spark.createDataFrame([(i, t[0]) for i, t in enumerate(transitions)],
                                   "transition_order int, transition string")
    return (labels.join(q, "transition", "left")
                  .select("transition_order", "transition",
                          F.round("median_minutes", 1).alias("median_minutes"),
                          F.round("p90_minutes", 1).alias("p90_minutes")))


def invite_profile(events: DataFrame, flags: dict[str, Column | str], invite_event: str = C.FUNNEL_STEPS[0][2]
                   ) -> DataFrame:
    """Per (user, tenant) with an invite: invited_at and one 0/1 column per
    flag (any event of the pair, no time bound). A flag is a condition or an
    event name; if all are names, only those events are read. One aggregation. A NULL key
    forms its own invite group but, as with an equality join, matches no
    events, so its flags are 0."""
    keyed = F.col(U).isNotNull() & F.col(T).isNotNull()
    if all(isinstance(c, str) for c in flags.values()):
        events = events.where(F.col(NAME).isin(invite_event, *flags.values()))
    flags = {name: _ev(c) if isinstance(c, str) else c for name, c in flags.items()}
    aggs = [F.min(F.when(F.col(NAME) == invite_event, F.col(TS))).alias("invited_at")]
    aggs += [flag(c & keyed).alias(name) for name, c in flags.items()]
    return events.groupBy(U, T).agg(*aggs).where(F.col("invited_at").isNotNull())


def _ev(name: str) -> Column:
    return F.col(NAME) == F.lit(name)


def segment_by_role(events: DataFrame, dim_users: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """F-5: per role of the current user version: invited, logged in,
    completed, activated; login %, completion % of logged in, activation %.
    ``profile`` (see ``user_profiles``) replaces the event pass when given."""
    prof = profile if profile is not None else invite_profile(events, {
        "logged_in": "dedicated_user_first_login",
        "completed": "dedicated_onboarding_completed",
        "activated": "dedicated_user_activated"})
    cur = dim_users.where(F.col("is_current")).select(U, "role")
    per_user = (prof.join(cur, U).groupBy(U, "role")
                    .agg(F.max("logged_in").alias("logged_in"), F.max("completed").alias("completed"),
                         F.max("activated").alias("activated")))
    g = per_user.groupBy("role").agg(
        F.count(F.lit(1)).alias("invited"),
        F.sum("logged_in").cast("long").alias("logged_in"),
        F.sum("completed").cast("long").alias("completed"),
        F.sum("activated").cast("long").alias("activated"))
    return g.select("role", "invited", "logged_in", "completed", "activated",
                    pct("logged_in", "invited", 1).alias("login_rate"),
                    pct("completed", "logged_in", 1).alias("completion_rate"),
                    pct("activated", "invited", 1).alias("activation_rate"))


def role_severity(segments: DataFrame) -> DataFrame:
    """F-12 (roles): green ≥ 15 % activation, yellow ≥ 10 %, else red."""
    a = F.coalesce(F.col("activation_rate"), F.lit(0.0))
    return segments.withColumn("severity", F.when(a >= 15, "green").when(a >= 10, "yellow").otherwise("red"))


def weekly_cohort(events: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """F-6: per Monday-week of the first invite: invited, accepted, logged
    in, completed, activated, accept % and activation %."""
    prof = profile if profile is not None else invite_profile(events, {
                                   "accepted": "dedicated_user_invitation_accepted",
                                   "logged_in": "dedicated_user_first_login",
                                   "completed": "dedicated_onboarding_completed",
                                   "activated": "dedicated_user_activated"})
    per_user = (prof.withColumn("cohort_week", week_start("invited_at"))
                    .groupBy(U, "cohort_week")
                    .agg(*[F.max(c).alias(c) for c in ("accepted", "logged_in", "completed", "activated")]))
    g = per_user.groupBy("cohort_week").agg(
        F.count(F.lit(1)).alias("invited"),
        *[F.sum(c).cast("long").alias(c) for c in ("accepted", "logged_in", "completed", "activated")])
    return g.select("cohort_week", "invited", "accepted", "logged_in", "completed", "activated",
                    pct("accepted", "invited", 1).alias("accept_rate"),
                    pct("activated", "invited", 1).alias("activation_rate"))


def funnel_template(events: DataFrame, window: C.Window, spec: C.FunnelSpec = C.template_funnel(),
                    st: DataFrame | None = None) -> DataFrame:
    """F-7: invites in [start, end), steps within 30 days of the invite, the
    SSH-key predicate on step 3; counts and 8 rates (NULL when the previous
    count is 0)."""
    st = st if st is not None else step_times(events, spec, window)
    row = _counts_row(st, spec)
    names = ["step_0_invited", "step_1_accepted", "step_2_first_login", "step_3_ssh_key",
             "step_4_first_project", "step_5_first_pipeline", "step_6_onboarding_done", "step_7_activated"]
    out = [F.col(f"c{i}").alias(n) for i, n in enumerate(names)]
    for i in range(1, 8):
        out.append(pct(f"c{i}", f"c{i - 1}", 1).alias(f"cvr_{i - 1}_to_{i}"))
    out.append(pct("c7", "c0", 1).alias("cvr_e2e"))
    return row.select(*out)


def time_template(events: DataFrame, window: C.Window, spec: C.FunnelSpec = C.template_funnel(),
                  st: DataFrame | None = None, accuracy: int = 10000) -> DataFrame:
    """F-8: approximate P50/P90 of whole-unit boundary differences
    (``DATEDIFF('minute'|'hour', a, b)``); only the end step must be present.
    ``percentile_approx`` keeps a bounded sketch per group."""
    st = st if st is not None else step_times(events, spec, window)
    labels = ["Step 0→1: Invite → Accept", "Step 1→2: Accept → First Login", "Step 2→3: Login → SSH Key",
              "Step 3→4: SSH Key → First Project", "Step 4→5: Project → Pipeline",
              "Step 5→6: Pipeline → Onboarded", "Step 6→7: Onboarded → Activated"]

    def at(n):
        return F.col("invited_at") if n == 0 else F.col(f"step_{n}_at")

    pairs = []
    for i, label in enumerate(labels):
        unit = "hour" if i == 6 else "minute"
        pairs.append(F.struct(F.lit(i).alias("transition_order"), F.lit(label).alias("transition"),
                              F.when(at(i + 1).isNotNull(), boundary_diff(unit, at(i), at(i + 1))).alias("v")))
    long = st.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where(F.col("v").isNotNull())
    q = (long.groupBy("transition_order", "transition")
             .agg(F.percentile_approx("v", [0.5, 0.9], accuracy).alias("q"))
             .select("transition_order", "transition", F.col("q")[0].alias("median_minutes"),
                     F.col("q")[1].alias("p90_minutes")))
    spark = events.sparkSession
    lab = spark.createDataFrame(list(enumerate(labels)), "transition_order int, transition string")
    return lab.join(q, ["transition_order", "transition"], "left")


def seat_bucket(seats: Column) -> Column:
    """Tenant size bucket of the template cuts: 1-20, 21-100, 101-500, 500+."""
    return (F.when(seats <= 20, "1-20").when(seats <= 100, "21-100")
             .when(seats <= 500, "101-500").otherwise("500+"))


def segment_funnel(events: DataFrame, dim_users: DataFrame, dim_tenants: DataFrame) -> DataFrame:
    """F-10 / F-25: the executed funnel's step counts cut by role, SSO,
    region, seat bucket, invite cohort week and platform version of the first
    invite — all cuts in one aggregation over (segment, value) rows."""
    st = step_times(events)
    inv_version = (events.where(_ev("dedicated_user_invited"))
                         .groupBy(U, T).agg(F.min_by("platform_version", F.struct(TS, "platform_version"))
                                            .alias("platform_version")))
    users = dim_users.where(F.col("is_current")).select(U, "role")
    tenants = dim_tenants.where(F.col("is_current")).select(T, "sso_enabled", "region", "seat_limit")
    x = (st.join(inv_version, [U, T], "left").join(users, U, "left").join(tenants, T, "left"))
    segs = F.array(
        F.struct(F.lit("role").alias("segment"), F.col("role").alias("value")),
        F.struct(F.lit("sso_enabled").alias("segment"), F.col("sso_enabled").cast("string").alias("value")),
        F.struct(F.lit("region").alias("segment"), F.col("region").alias("value")),
        F.struct(F.lit("seat_bucket").alias("segment"), seat_bucket(F.col("seat_limit")).alias("value")),
        F.struct(F.lit("cohort_week").alias("segment"),
                 F.date_format(week_start("invited_at"), "yyyy-MM-dd").alias("value")),
        F.struct(F.lit("platform_version").alias("segment"), F.col("platform_version").alias("value")))
    steps = [f"step_{i}_at" for i in range(1, 8)]
    long = x.select(F.explode(segs).alias("s"), *steps).select("s.*", *steps)
    return long.groupBy("segment", "value").agg(
        F.count(F.lit(1)).alias("step_0"), *[F.count(c).alias(f"step_{i + 1}") for i, c in enumerate(steps)])


def top_dropoffs(funnel_rows: DataFrame, times: DataFrame, k: int = 3) -> DataFrame:
    """F-13: the k steps with the largest drop-off, with the P50/P90 of the
    transition into them (top-k is the feature here)."""
    t = times.select((F.col("transition_order") + 1).alias("step_number"), "transition",
                     "median_minutes", "p90_minutes")
    return (funnel_rows.where(F.col("step_number") > 0)
                       .join(t, "step_number", "left")
                       .orderBy(F.col("dropoff_pct").desc(), F.col("step_number"))
                       .limit(k)
                       .select("step_number", "step_name", "users", "dropoff_pct", "transition",
                               "median_minutes", "p90_minutes"))


def cohort_dropoff_trend(events: DataFrame, weeks: int = 8) -> DataFrame:
    """F-14: per invite week (last ``weeks`` weeks of data) the step counts
    and drop-off % of each step against the previous one."""
    st = step_times(events).withColumn("cohort_week", week_start("invited_at"))
    counts = st.groupBy("cohort_week").agg(
        F.count(F.lit(1)).alias("c0"), *[F.count(f"step_{i}_at").alias(f"c{i}") for i in range(1, 8)])
    parts = []
    for i in range(1, 8):
        prev, cur = F.col(f"c{i - 1}").cast("double"), F.col(f"c{i}").cast("double")
        parts.append(F.struct(F.lit(i).alias("step_number"), F.col(f"c{i}").alias("users"),
                              F.when(prev > 0, F.bround(F.lit(100.0) - cur / prev * 100.0, 1))
                               .alias("dropoff_pct")))
    # one row per week: a window over the aggregated weeks is tiny
    counts = counts.withColumn("_last", F.max("cohort_week").over(Window.partitionBy(F.lit(0))))
    counts = counts.where(F.col("cohort_week") > F.timestamp_add("DAY", F.lit(-7 * weeks), F.col("_last")))
    return counts.select("cohort_week", F.explode(F.array(*parts)).alias("p")).select("cohort_week", "p.*")


def within_days_rate(events: DataFrame, target_events: Sequence[str], days: int,
                     label: str) -> DataFrame:
    """F-15 / F-16: share of invited users with a target event within
    ``days`` days after the first invite (bounded join per user)."""
    spec = C.FunnelSpec((C.FunnelStep(0, "invite", C.FUNNEL_STEPS[0][2]),
                         *[C.FunnelStep(i + 1, e, e) for i, e in enumerate(target_events)]),
                        after_invite=True, window_days=days)
    st = step_times(events, spec)
    hits = [F.col(f"step_{i + 1}_at").isNotNull().cast("int") for i in range(len(target_events))]
    hit = F.greatest(*hits) if len(hits) > 1 else hits[0]
    return st.agg(F.count(F.lit(1)).alias("invited"), F.sum(hit).cast("long").alias("converted")) \
             .select(F.lit(label).alias("metric"), "invited", "converted",
                     pct("converted", "invited", 1).alias("rate_pct"))


def retention_30d(events: DataFrame, activation_event: str = "dedicated_user_activated",
                  hot_rows: int = C.Scale().hot_key_rows) -> DataFrame:
    """F-17: of activated users, the share with any event 8–30 days after
    their first activation."""
    act = (events.where(_ev(activation_event) & F.col(U).isNotNull())
                 .groupBy(U, T).agg(F.min(TS).alias("activated_at")))
    ev = events.where(F.col(U).isNotNull()).select(U, T, TS)

    def cond(l, r):
        lo = F.timestamp_add("DAY", F.lit(8), F.col("_r.activated_at"))
        hi = F.timestamp_add("DAY", F.lit(31), F.col("_r.activated_at"))
        return (F.col(f"_l.{TS}") >= lo) & (F.col(f"_l.{TS}") < hi)

    returned = (split_join(ev, act, [U, T], how="inner", condition=cond, threshold=hot_rows)
                .select(U, T).distinct().withColumn("returned", F.lit(1)))
    return (act.join(returned, [U, T], "left")
               .agg(F.count(F.lit(1)).alias("activated"), F.count("returned").alias("returned"))
               .select("activated", "returned", pct("returned", "activated", 1).alias("retention_pct")))


VALUE_EVENTS = ("dedicated_pipeline_executed", "dedicated_mr_created")


def ttfv_user(events: DataFrame, value_events: Sequence[str] = VALUE_EVENTS) -> DataFrame:
    """F-18: hours from first login to the first value action after it;
    exact P50 / P90 over users."""
    spec = C.FunnelSpec((C.FunnelStep(0, "login", "dedicated_user_first_login"),
                         *[C.FunnelStep(i + 1, e, e) for i, e in enumerate(value_events)]), after_invite=True)
    st = step_times(events, spec)
    first_value = F.least(*[F.col(f"step_{i + 1}_at") for i in range(len(value_events))])
    d = st.select(elapsed(F.col("invited_at"), first_value, 3600).alias("v"),
                  F.lit("login → first value").alias("metric")).where(F.col("v").isNotNull())
    q = exact_quantiles(d, ["metric"], "v", [0.5, 0.9], ["p50_hours", "p90_hours"])
    return q.select("metric", F.round("p50_hours", 2).alias("p50_hours"), F.round("p90_hours", 2).alias("p90_hours"))


def ttfv_tenant(events: DataFrame, dim_tenants: DataFrame,
                value_events: Sequence[str] = VALUE_EVENTS) -> DataFrame:
    """F-19: per tenant, days from provisioning to its first value action;
    median over tenants."""
    first = (events.where(F.col(NAME).isin(*value_events))
                   .groupBy(T).agg(F.min(TS).alias("first_value_at")))
    t = dim_tenants.where(F.col("is_current")).select(T, F.col("provisioning_date").cast("timestamp_ntz")
                                                      .alias("provisioned_at"))
    d = (t.join(first, T).select(F.lit("provisioning → first value").alias("metric"),
                                 elapsed("provisioned_at", "first_value_at", 86400).alias("v")))
    q = exact_quantiles(d, ["metric"], "v", [0.5], ["median_days"])
    return q.select("metric", F.round("median_days", 2).alias("median_days"))


ONBOARDING_EVENTS = ("dedicated_user_invitation_accepted", "dedicated_user_first_login",
                     "dedicated_onboarding_step_completed", "dedicated_onboarding_completed")


def restart_rate(events: DataFrame) -> DataFrame:
    """F-20: of users who abandoned onboarding, the share with an onboarding
    event after their first abandonment."""
    p = events.where(F.col(U).isNotNull()).groupBy(U, T).agg(
        F.min(F.when(_ev("dedicated_onboarding_abandoned"), F.col(TS))).alias("abandoned_at"),
        F.max(F.when(F.col(NAME).isin(*ONBOARDING_EVENTS), F.col(TS))).alias("last_onboarding_at"))
    a = p.where(F.col("abandoned_at").isNotNull())
    return a.agg(F.count(F.lit(1)).alias("abandoned"),
                 F.count_if(F.col("last_onboarding_at") > F.col("abandoned_at")).alias("restarted")) \
            .select("abandoned", "restarted", pct("restarted", "abandoned", 1).alias("restart_rate_pct"))


def behaviour_classes(events: DataFrame) -> DataFrame:
    """F-21: classify invited users by step count and span (all 7 later
    steps): fast (< 30 min), slow (> 7 days), partial (≥ 3 steps, not all),
    immediate (0–1 steps), other (2 steps, or all steps in 30 min – 7 days)."""
    st = step_times(events)
    cols = [F.col(f"step_{i}_at") for i in range(1, 8)]
    n_steps = sum(c.isNotNull().cast("int") for c in cols)
    span = elapsed(F.col("invited_at"), F.greatest(*cols), 60)
    cls = (F.when((n_steps == 7) & (span < 30), "fast_completer")
            .when((n_steps == 7) & (span > 7 * 24 * 60), "slow_completer")
            .when((n_steps >= 3) & (n_steps < 7), "partial_abandoner")
            .when(n_steps <= 1, "immediate_abandoner")
            .otherwise("other"))
    return (st.select(cls.alias("behaviour_class"))
              .groupBy("behaviour_class").agg(F.count(F.lit(1)).alias("users")))


def grouped_rate(profile: DataFrame, label_col: str, success_col: str) -> DataFrame:
    """F-22/F-23/F-33: success rate per label value and the relative lift of
    each arm against the lowest-rate arm (arms are few)."""
    g = profile.groupBy(label_col).agg(F.count(F.lit(1)).alias("users"),
                                      F.sum(success_col).cast("long").alias("successes"))
    g = g.withColumn("rate_pct", pct("successes", "users", 2))
    # one row per arm: a window over the aggregated arms is tiny
    g = g.withColumn("_base", F.min("rate_pct").over(Window.partitionBy(F.lit(0))))
    return (g
             .withColumn("lift_pct", F.when(F.col("_base") > 0, F.round(
                 (F.col("rate_pct") - F.col("_base")) * 100.0 / F.col("_base"), 2)))
             .drop("_base"))


def guided_activation(events: DataFrame) -> DataFrame:
    """F-22: 30-day activation of users who did vs skipped a guided
    onboarding step (any ``onboarding_step_completed`` within 30 days)."""
    spec = C.FunnelSpec((C.FunnelStep(0, "invite", C.FUNNEL_STEPS[0][2]),
                         C.FunnelStep(1, "guided", STEP_EVENT),
                         C.FunnelStep(2, "activated", "dedicated_user_activated")),
                        after_invite=True, window_days=30)
    st = step_times(events, spec)
    prof = st.select(F.when(F.col("step_1_at").isNotNull(), "guided").otherwise("skipped").alias("arm"),
                     F.col("step_2_at").isNotNull().cast("int").alias("activated_30d"))
    return grouped_rate(prof, "arm", "activated_30d")


def step_pair_rate(events: DataFrame, from_step: int = 0, to_step: int = 2) -> DataFrame:
    """F-36: of users reaching ``from_step``, the share reaching ``to_step``."""
    st = step_times(events)

    def at(n):
        return F.col("invited_at") if n == 0 else F.col(f"step_{n}_at")
    return st.agg(F.count(at(from_step)).alias("from_users"), F.count(
        F.when(at(from_step).isNotNull(), at(to_step))).alias("to_users")) \
        .select(F.lit(from_step).alias("from_step"), F.lit(to_step).alias("to_step"), "from_users",
                "to_users", pct("to_users", "from_users", 1).alias("rate_pct"))


def interrupted_series(daily: DataFrame, date_col: str, value_col: str, cut: str) -> DataFrame:
    """F-34: level and slope before vs after a cut date (regression of the
    value on the day number, per side)."""
    day = F.datediff(F.col(date_col), F.lit(cut).cast("date")).cast("double")
    x = daily.select(F.when(F.col(date_col) < F.lit(cut).cast("date"), "before").otherwise("after").alias("side"),
                     day.alias("x"), F.col(value_col).cast("double").alias("y"))
    return x.groupBy("side").agg(F.round(F.regr_slope("y", "x"), 4).alias("slope"),
                                 F.round(F.regr_intercept("y", "x"), 4).alias("level"),
                                 F.count(F.lit(1)).alias("days"))


def uplift_projection(events: DataFrame, factor: float = C.IMPROVEMENT_FACTOR) -> DataFrame:
    """F-37: per quarter of the first invite, invited users, current e2e
    conversion and the extra activated users at ``factor`` × conversion."""
    st = step_times(events)
    d = F.to_date("invited_at")
    quarter = F.make_date(F.year(d), (F.floor((F.month(d) - 1) / 3) * 3 + 1).cast("int"), F.lit(1)) \
        .cast("timestamp_ntz")
    q = st.groupBy(quarter.alias("quarter")) \
          .agg(F.count(F.lit(1)).alias("invited"), F.count("step_7_at").alias("activated"))
    cvr = F.col("activated").cast("double") / F.col("invited")
    return q.select("quarter", "invited", "activated",
                    F.round(F.col("invited") * cvr * F.lit(factor - 1.0), 1).alias("extra_activated"))


# ----------------------------------------------------------------- F-23..F-38
def _window_spec(events_after: Sequence[tuple[str, str | None]], days: int | None) -> C.FunnelSpec:
    steps = [C.FunnelStep(0, "invite", C.FUNNEL_STEPS[0][2])]
    steps += [C.FunnelStep(i + 1, e, e, p) for i, (e, p) in enumerate(events_after)]
    return C.FunnelSpec(tuple(steps), after_invite=True, window_days=days)


def ssh_step_lift(events: DataFrame, days: int = 30) -> DataFrame:
    """F-23: 30-day activation of users who completed the SSH-key step within
    30 days vs those who skipped it, with relative lift."""
    spec = _window_spec([(STEP_EVENT, "step_name = 'ssh_key_setup'"), ("dedicated_user_activated", None)], days)
    st = step_times(events, spec)
    prof = st.select(F.when(F.col("step_1_at").isNotNull(), "ssh_done").otherwise("ssh_skipped").alias("arm"),
                     F.col("step_2_at").isNotNull().cast("int").alias("activated_30d"))
    return grouped_rate(prof, "arm", "activated_30d")


def sso_login_effect(events: DataFrame, dim_tenants: DataFrame) -> DataFrame:
    """F-24: first-login rate of invited users by the tenant's SSO setting."""
    from ..functions.skew import bounded_broadcast
    prof = invite_profile(events, {"logged_in": "dedicated_user_first_login"})
    t = bounded_broadcast(dim_tenants.where(F.col("is_current")).select(T, "sso_enabled"))
    x = prof.join(t, T, "left").select(F.coalesce(F.col("sso_enabled").cast("string"), F.lit("unknown"))
                                       .alias("sso_enabled"), "logged_in")
    return grouped_rate(x, "sso_enabled", "logged_in")


def step_duration(fact: DataFrame, target_seconds: int = 120, project_step_limit: int = 300) -> DataFrame:
    """F-26: exact P50 of the reported step duration per onboarding step
    against the 120 s target; the project step's P50 against 5 minutes."""
    s = fact.where((F.col(NAME) == STEP_EVENT) & F.col("step_name").isNotNull()) \
            .select("step_name", F.col("duration_seconds").cast("double").alias("d"))
    q = exact_quantiles(s, ["step_name"], "d", [0.5], ["p50_seconds"])
    n = s.groupBy("step_name").agg(F.count(F.lit(1)).alias("events"))
    return (n.join(q, "step_name")
             .withColumn("p50_seconds", F.round("p50_seconds", 1))
             .withColumn("meets_target", F.col("p50_seconds") < target_seconds)
             .withColumn("over_project_limit", (F.col("step_name") == "create_first_project") &
                         (F.col("p50_seconds") > project_step_limit)))


def ticket_rate(events: DataFrame, tickets: DataFrame, days: int = 7,
                hot_rows: int = C.Scale().hot_key_rows) -> DataFrame:
    """F-27a: share of invited users who opened a ticket within ``days`` of
    their first invite, and the share of those tickets within 48 hours."""
    inv = invited_users(events).where(F.col(U).isNotNull())

    def cond(l, r):
        return (F.col("_l.opened_at") >= F.col("_r.invited_at")) & \
               (F.col("_l.opened_at") < F.timestamp_add("DAY", F.lit(days), F.col("_r.invited_at")))
    tk = split_join(tickets.select(U, T, "ticket_id", "opened_at"), inv, [U, T], how="inner",
                    condition=cond, threshold=hot_rows)
    tk = tk.withColumn("_48h", F.col("opened_at") < F.timestamp_add("HOUR", F.lit(48), F.col("invited_at")))
    per_user = tk.groupBy(U, T).agg(F.max(F.lit(1)).alias("has_ticket"))
    users = inv.join(per_user, [U, T], "left").agg(F.count(F.lit(1)).alias("invited"),
                                                   F.count("has_ticket").alias("with_ticket"))
    tks = tk.agg(F.count(F.lit(1)).alias("tickets"), F.count_if("_48h").alias("tickets_48h"))
    # two one-row aggregates side by side: union + max, no join
    both = users.unionByName(tks, allowMissingColumns=True)
    return (both.agg(*[F.max(c).alias(c) for c in ("invited", "with_ticket", "tickets", "tickets_48h")])
            .select("invited", "with_ticket", pct("with_ticket", "invited", 1).alias("ticket_rate_pct"),
                    "tickets", pct("tickets_48h", "tickets", 1).alias("within_48h_pct")))


def ticket_preceding_step(events: DataFrame, tickets: DataFrame) -> DataFrame:
    """F-27b: for each ticket, the onboarding event the user fired most
    recently at or before it (skew-safe as-of join); tickets per step."""
    from ..functions.ranking import asof_last
    onb = (events.where(F.col(NAME).isin(*[e for _, _, e in C.FUNNEL_STEPS]) & F.col(U).isNotNull())
                 .select(U, T, TS, F.col(NAME).alias("step_event")))
    last = asof_last(tickets, onb, [U, T], "opened_at", TS, "ticket_id", ["step_event"])
    return last.groupBy(F.coalesce("step_event", F.lit("none")).alias("preceding_step")) \
               .agg(F.count(F.lit(1)).alias("tickets"))


FEATURE_EVENTS = ("dedicated_project_created", "dedicated_pipeline_executed", "dedicated_mr_created",
                  "dedicated_mr_merged", "dedicated_security_scan_completed")


def feature_adoption(events: DataFrame, dim_tenants: DataFrame, days: int = 30) -> DataFrame:
    """F-28: per feature event, tenants that used it within ``days`` days of
    their provisioning date (first use per tenant, then a date compare)."""
    from ..functions.skew import bounded_broadcast
    first = (events.where(F.col(NAME).isin(*FEATURE_EVENTS))
                   .groupBy(T, NAME).agg(F.min(TS).alias("first_use")))
    t = bounded_broadcast(dim_tenants.where(F.col("is_current")).select(T, "provisioning_date"))
    x = first.join(t, T).where(F.col("first_use") < F.timestamp_add(
        "DAY", F.lit(days), F.col("provisioning_date").cast("timestamp_ntz")))
    return x.groupBy(NAME).agg(F.countDistinct(T).alias("tenants_adopted"))


def pipeline_retention_corr(events: DataFrame, dim_tenants: DataFrame, as_of: str, months: Sequence[int] = (6, 12)) -> DataFrame:
    """F-29: for each horizon (months after provisioning), over the tenants that have reached it: how the
    pipelines run before it correlate with being active after it. Events are first counted per tenant and
    day, so the join sees one row a tenant and day."""
    from ..functions.skew import bounded_broadcast
    daily = events.groupBy(T, F.to_date(TS).alias("_day")).agg(F.count_if(F.col(NAME) == "dedicated_pipeline_executed").alias("_runs"))
    t = bounded_broadcast(dim_tenants.where(F.col("is_current")).select(
        T, "provisioning_date", F.explode(F.array(*[F.lit(m) for m in months])).alias("horizon_months")))
    mark = F.add_months("provisioning_date", F.col("horizon_months"))
    due = t.withColumn("_mark", mark).where(F.col("_mark") <= F.lit(as_of).cast("date"))
    per = due.join(daily, T, "left").groupBy("horizon_months", T).agg(
        F.coalesce(F.sum(F.when(F.col("_day") < F.col("_mark"), F.col("_runs"))), F.lit(0)).cast("double").alias("_runs"),
        F.coalesce(F.max((F.col("_day") >= F.col("_mark")).cast("int")), F.lit(0)).alias("_kept"))
    corr = F.corr("_runs", F.col("_kept").cast("double"))
    found = per.groupBy("horizon_months").agg(F.count(F.lit(1)).alias("tenants"), F.sum("_kept").cast("long").alias("retained_tenants"),
                                              F.when(~F.isnan(corr), F.round(corr, 4)).alias("correlation"))
    every = events.sparkSession.createDataFrame([(m,) for m in months], "horizon_months int")
    zero = F.lit(0).cast("long")
    return every.join(found, "horizon_months", "left").select(
        "horizon_months", F.coalesce("tenants", zero).alias("tenants"), F.coalesce("retained_tenants", zero).alias("retained_tenants"), "correlation")


def scan_adoption(fact: DataFrame) -> DataFrame:
    """F-30a: scans, tenants and users per scan type."""
    return (fact.where(F.col(NAME) == "dedicated_security_scan_completed")
                .groupBy("scan_type").agg(F.count(F.lit(1)).alias("scans"),
                                          F.countDistinct(T).alias("tenants"), F.countDistinct(U).alias("users")))


def top_admin_actions(fact: DataFrame, k: int = 5) -> DataFrame:
    """F-30b: the k most frequent admin settings changed (top-k report)."""
    s = F.get_json_object("properties_json", "$.setting_name")
    return (fact.where(F.col(NAME) == "dedicated_admin_setting_changed")
                .groupBy(s.alias("setting_name")).agg(F.count(F.lit(1)).alias("changes"))
                .orderBy(F.col("changes").desc(), F.col("setting_name")).limit(k))


def composite_activation(events: DataFrame, required: Sequence[str] = VALUE_EVENTS, days: int = 30) -> DataFrame:
    """F-31: invited users who fired every required event within ``days``."""
    st = step_times(events, _window_spec([(e, None) for e in required], days))
    allc = F.lit(True)
    for i in range(len(required)):
        allc = allc & F.col(f"step_{i + 1}_at").isNotNull()
    return st.agg(F.count(F.lit(1)).alias("invited"), F.count_if(allc).alias("activated")) \
             .select("invited", "activated", pct("activated", "invited", 1).alias("activation_pct"))


def reinvite_recovery(events: DataFrame, hot_rows: int = C.Scale().hot_key_rows) -> DataFrame:
    """F-32: users invited at least twice; share accepting after the second
    invite. ``row_number() <= 2`` keeps two invites per user map-side."""
    w = Window.partitionBy(U, T).orderBy(TS)
    second = (events.where(_ev("dedicated_user_invited") & F.col(U).isNotNull())
                    .select(U, T, TS).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 2)
                    .select(U, T, F.col(TS).alias("second_invite_at")))
    acc = events.where(_ev("dedicated_user_invitation_accepted") & F.col(U).isNotNull()).select(U, T, TS)

    def cond(l, r):
        return F.col(f"_l.{TS}") >= F.col("_r.second_invite_at")
    rec = split_join(acc, second, [U, T], how="inner", condition=cond, threshold=hot_rows) \
        .select(U, T).distinct().withColumn("recovered", F.lit(1))
    return (second.join(rec, [U, T], "left")
                  .agg(F.count(F.lit(1)).alias("reinvited"), F.count("recovered").alias("recovered"))
                  .select("reinvited", "recovered", pct("recovered", "reinvited", 1).alias("recovery_pct")))


def lift_compare(profile: DataFrame, label_col: str, success_col: str, control: str, min_effect_pct: float) -> DataFrame:
    """F-33: success rate per arm against the control arm: relative change, and whether it reaches the
    minimum detectable effect that was set beforehand. Without a control arm there is nothing to compare."""
    g = profile.groupBy(label_col).agg(F.count(F.lit(1)).alias("users"), F.sum(success_col).cast("long").alias("successes"))
    g = g.withColumn("rate_pct", pct("successes", "users", 2))
    # the arms side by side with the control's rate: a handful of aggregated rows, no join
    arms = g.agg(F.collect_list(F.struct(*g.columns)).alias("_arms"), F.max(F.when(F.col(label_col) == control, F.col("rate_pct"))).alias("control_rate_pct"))
    g = arms.select("control_rate_pct", F.explode("_arms").alias("_a")).select("_a.*", "control_rate_pct")
    change = F.when(F.col("control_rate_pct") > 0, F.round((F.col("rate_pct") - F.col("control_rate_pct")) * 100.0 / F.col("control_rate_pct"), 2))
    return g.withColumn("relative_change_pct", change).select(
        label_col, "users", "successes", "rate_pct", "control_rate_pct", "relative_change_pct",
        F.when(F.col(label_col) == control, "CONTROL").when(F.col("relative_change_pct").isNull(), "NO_CONTROL")
         .when(F.col("relative_change_pct") >= min_effect_pct, "REACHES_EFFECT").otherwise("BELOW_EFFECT").alias("verdict"))


def plan_tier_lift(events: DataFrame, dim_tenants: DataFrame, control: str = "premium", min_effect_pct: float = 7.0) -> DataFrame:
    """F-33: activation rate per plan tier against the control tier (any label
    column works the same way)."""
    from ..functions.skew import bounded_broadcast
    prof = invite_profile(events, {"activated": "dedicated_user_activated"})
    t = bounded_broadcast(dim_tenants.where(F.col("is_current")).select(T, "plan_tier"))
    return lift_compare(prof.join(t, T, "left").fillna({"plan_tier": "unknown"}), "plan_tier", "activated", control, min_effect_pct)


def daily_activations(events: DataFrame) -> DataFrame:
    """Activations per event date (the F-34 series)."""
    return (events.where(_ev("dedicated_user_activated"))
                  .groupBy(F.to_date(TS).alias("event_date")).agg(F.count(F.lit(1)).alias("activations")))


# the guardrails: metric and allowed relative change for the worse in percent; None is tracked only
GUARDRAILS = [("ticket_volume", 10.0), ("retention_pct", 0.0), ("ssh_adoption_pct", None), ("completion_p50_hours", 20.0)]


def guardrails(events: DataFrame, tickets: DataFrame, cut: str, window_days: int = 28, retention_days: int = 30,
               ssh_days: int = 90) -> DataFrame:
    """F-35: four metrics of the ``window_days`` before and after ``cut``, each with its limit: tickets opened
    (no rise over 10 %), users invited then who are still active ``retention_days`` later (no fall), of them
    those who set up their SSH key within ``ssh_days`` (tracked), and the median hours from invite to
    completed onboarding (no rise over 20 %). One pass over the events gives every user's times."""
    at = F.lit(cut).cast("timestamp_ntz")

    def period(c):
        back, ahead = F.timestamp_add("DAY", F.lit(-window_days), at), F.timestamp_add("DAY", F.lit(window_days), at)
        return F.when((c >= back) & (c < at), "before").when((c >= at) & (c < ahead), "after")

    def first(event: str, more=None):
        cond = _ev(event) if more is None else _ev(event) & more
        return F.min(F.when(cond, F.col(TS)))

    ssh = F.get_json_object("properties", "$.step_name") == "ssh_key_setup"
    users = (events.where(F.col(U).isNotNull() & F.col(T).isNotNull()).groupBy(U, T).agg(
        first("dedicated_user_invited").alias("invited_at"), first("dedicated_onboarding_step_completed", ssh).alias("_ssh"),
        first("dedicated_onboarding_completed").alias("_done"), F.max(TS).alias("_last"))
        .withColumn("period", period(F.col("invited_at"))).where("period IS NOT NULL"))
    since = F.col("invited_at")
    kept = F.col("_last") >= F.timestamp_add("DAY", F.lit(retention_days), since)
    keyed = (F.col("_ssh") >= since) & (F.col("_ssh") < F.timestamp_add("DAY", F.lit(ssh_days), since))
    rates = users.groupBy("period").agg(
        pct(F.count_if(kept), F.count(F.lit(1)), 2).alias("retention_pct"), pct(F.count_if(keyed), F.count(F.lit(1)), 2).alias("ssh_adoption_pct"))
    hours = users.where(F.col("_done") >= since).withColumn("_h", elapsed(since, F.col("_done"), 3600))
    median = exact_quantiles(hours, ["period"], "_h", [0.5], ["m"]).select("period", F.round("m", 2).alias("completion_p50_hours"))
    volume = tickets.groupBy(period(F.col("opened_at")).alias("period")).agg(F.count(F.lit(1)).cast("double").alias("ticket_volume")).where("period IS NOT NULL")
    both = rates.join(median, "period", "full").join(volume, "period", "full")
    names = [m for m, _ in GUARDRAILS]
    # the two period rows side by side: conditional aggregates, no join
    j = both.agg(*[F.max(F.when(F.col("period") == p, F.col(m))).alias(f"{p}_{m}") for p in ("before", "after") for m in names])
    rows = []
    for m, limit in GUARDRAILS:
        old, new = F.col(f"before_{m}"), F.col(f"after_{m}")
        if limit is None:
            status = F.lit("TRACKED")
        else:
            held = new >= old if m == "retention_pct" else new <= old * (1 + limit / 100)
            status = F.when(old.isNull() | new.isNull(), "NO_DATA").when(held, "OK").otherwise("BREACH")
        rows.append(F.struct(F.lit(m).alias("metric"), old.alias("before"), new.alias("after"),
                             F.when(old > 0, F.round((new - old) * 100.0 / old, 2)).alias("change_pct"), status.alias("status")))
    return j.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def stratified_rates(events: DataFrame, dim_tenants: DataFrame, days: int = 90) -> DataFrame:
    """F-38: activation rate within tenant strata (seat bucket × SSO) for
    invites in the last ``days`` days of data."""
    from ..functions.skew import bounded_broadcast
    prof = invite_profile(events, {"activated": "dedicated_user_activated"})
    last = prof.agg(F.max("invited_at")).first()[0]      # one scalar to the driver
    t = bounded_broadcast(dim_tenants.where(F.col("is_current"))
                          .select(T, seat_bucket(F.col("seat_limit")).alias("seat_bucket"), "sso_enabled"))
    x = prof
    if last is not None:
        cut = F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz")   # exact, no zone conversion
        x = x.where(F.col("invited_at") > F.timestamp_add("DAY", F.lit(-days), cut))
    x = x.join(t, T, "left")
    return x.groupBy("seat_bucket", "sso_enabled").agg(F.count(F.lit(1)).alias("invited"),
                                                      F.sum("activated").cast("long").alias("activated")) \
            .withColumn("activation_pct", pct("activated", "invited", 1))


def role_step_dropoff(segments: DataFrame) -> DataFrame:
    """F-25: drop-off % of every funnel step against the previous one, per
    role (from the one-pass segment counts of ``segment_funnel``)."""
    r = segments.where(F.col("segment") == "role")
    parts = []
    for i in range(1, 8):
        prev, cur = F.col(f"step_{i - 1}").cast("double"), F.col(f"step_{i}").cast("double")
        parts.append(F.struct(F.lit(i).alias("step_number"), F.col(f"step_{i}").alias("users"),
                              F.when(prev > 0, F.bround(F.lit(100.0) - cur / prev * 100.0, 1)).alias("dropoff_pct")))
    return r.select(F.col("value").alias("role"), F.explode(F.array(*parts)).alias("p")).select("role", "p.*")


def template_ttfv_effect(events: DataFrame, value_events: Sequence[str] = VALUE_EVENTS) -> DataFrame:
    """F-24b: hours from first login to the first value action after it,
    exact median per arm: the user's first created project used a template
    or not (users without a project form their own arm)."""
    spec = C.FunnelSpec((C.FunnelStep(0, "login", "dedicated_user_first_login"),
                         *[C.FunnelStep(i + 1, e, e) for i, e in enumerate(value_events)]), after_invite=True)
    st = step_times(events, spec)
    first_value = F.least(*[F.col(f"step_{i + 1}_at") for i in range(len(value_events))])
    src = "properties" if "properties" in events.columns else "properties_json"
    proj = (events.where(_ev("dedicated_project_created") & F.col(U).isNotNull())
                  .groupBy(U, T)
                  .agg(F.min_by(F.get_json_object(src, "$.template_used"),
                                F.struct(TS, F.get_json_object(src, "$.template_used"))).alias("_tpl")))
    arm = F.when(F.col("_tpl") == "true", "template").when(F.col("_tpl") == "false", "no_template") \
           .otherwise("no_project")
    d = (st.join(proj, [U, T], "left")
           .select(arm.alias("arm"), elapsed(F.col("invited_at"), first_value, 3600).alias("v"))
           .where(F.col("v").isNotNull()))
    n = d.groupBy("arm").agg(F.count(F.lit(1)).alias("users"))
    q = exact_quantiles(d, ["arm"], "v", [0.5], ["p50_hours"])
    return n.join(q, "arm").withColumn("p50_hours", F.round("p50_hours", 2))


# Keyword rules for support tickets nobody tagged (first match wins).
TICKET_KEYWORDS = [
    ("onboarding", r"(?i)\b(onboard\w*|invit\w*|first login|sign ?in|log ?in)\b"),
    ("ssh", r"(?i)\b(ssh|public key|key pair)\b"),
    ("pipeline", r"(?i)\b(pipeline|ci/cd|runner|job failed)\b"),
    ("project", r"(?i)\b(project|repository|repo)\b"),
]


def tag_untagged(tickets: DataFrame, text_col: str = "text", tag_col: str = "category",
                 rules=tuple(TICKET_KEYWORDS)) -> DataFrame:
    """F-38 supplement: keep the existing tag; tickets without one get the
    first keyword rule matching their text (``tag_source`` says which)."""
    kw = None
    for tag, pattern in rules:
        cond = F.col(text_col).rlike(pattern)
        kw = F.when(cond, F.lit(tag)) if kw is None else kw.when(cond, F.lit(tag))
    tagged = F.col(tag_col).isNotNull() & (F.col(tag_col) != "")
    return (tickets.withColumn("tag_source", F.when(tagged, "tagged").when(kw.isNotNull(), "keyword")
                               .otherwise("untagged"))
                   .withColumn(tag_col, F.when(tagged, F.col(tag_col)).otherwise(kw)))



PROFILE_FLAGS = {"accepted": "dedicated_user_invitation_accepted", "logged_in": "dedicated_user_first_login",
                 "completed": "dedicated_onboarding_completed", "activated": "dedicated_user_activated"}


def user_profiles(events: DataFrame, spec: C.FunnelSpec = C.executed_funnel()) -> DataFrame:
    """One row per invited (user, tenant) with everything the funnel family
    reads: ``invited_at``; ``step_<n>_at`` bounded by the invite (F-1/F-2);
    ``any_step_<n>_at`` without the bound (F-4); 0/1 flags of the events any
    time (F-5/F-6). Built once per run and shared, instead of each analysis
    re-deriving invites and steps from the events."""
    bounded = step_times(events, spec)
    later = spec.steps[1:]
    aggs = [F.min(F.when(_step_cond(s), F.col(TS))).alias(f"any_step_{s.number}_at") for s in later]
    aggs += [flag(F.col(NAME) == F.lit(ev)).alias(name) for name, ev in PROFILE_FLAGS.items()]
    rest = (events.where(F.col(NAME).isin(*sorted({s.event for s in later} | set(PROFILE_FLAGS.values()))))
                  .groupBy(U, T).agg(*aggs))
    out = bounded.join(rest, [U, T], "left")
    return out.fillna(0, subset=list(PROFILE_FLAGS))


def profile_steps(profile: DataFrame, bounded: bool = True) -> DataFrame:
    """The step-times view of a profile: bounded (F-1/F-2) or not (F-4)."""
    cols = [F.col(f"step_{i}_at" if bounded else f"any_step_{i}_at").alias(f"step_{i}_at") for i in range(1, 8)]
    return profile.select(U, T, "invited_at", *cols)

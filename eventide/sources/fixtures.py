"""Adapter from the given parquet tables to the event-analytics data model.

The raw landing table, the tenant and user dimensions, the event catalog and
the support tickets are all *derived* from the given tables by plain column
expressions (FIXTURES.md), so every query's work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.compat import json_int

# ---------------------------------------------------------------------------
# FIXED VALUES — the adapter's mapping rules (FIXTURES.md §1a).
# (event_type, k below, extra condition on source user_id or None, event_name)
# First match wins; the last rule of a type has no k bound.
# ---------------------------------------------------------------------------
NAME_RULES = [
    ("signup", 50, None, "dedicated_user_invited"),
    ("signup", 70, None, "dedicated_user_invitation_accepted"),
    ("signup", 85, "tenant_not_3", "dedicated_sso_configured"),
    ("signup", None, None, "dedicated_tenant_provisioned"),
    ("click", 10, None, "dedicated_user_first_login"),
    ("click", 60, None, "dedicated_pipeline_executed"),
    ("click", None, None, "dedicated_nav_section_clicked"),
    ("view", 40, None, "dedicated_onboarding_step_completed"),
    ("view", 48, None, "dedicated_project_created"),
    ("view", None, None, "dedicated_nav_section_clicked"),
    ("purchase", 5, None, "dedicated_user_activated"),
    ("purchase", 12, None, "dedicated_onboarding_completed"),
    ("purchase", 60, None, "dedicated_mr_created"),
    ("purchase", None, None, "dedicated_security_scan_completed"),
    ("error", 20, None, "dedicated_onboarding_abandoned"),
    ("error", None, None, "dedicated_admin_setting_changed"),
]
SEGMENT_ROLES = {
    "AUTOMOBILE": "guest",
    "BUILDING": "reporter",
    "FURNITURE": "developer",
    "HOUSEHOLD": "maintainer",
    "MACHINERY": "owner",
}
N_TENANTS = 8
VISIBILITY_LEVELS = ["private", "internal"]
SDK_VERSION = "2.1.4"
DIM_START = "2023-01-01 00:00:00"
DIM_CHANGE = "2024-01-15 00:00:00"
TENANT_PROVISION_BASE = "2023-12-01"
# Fault injection moduli on the source id n.
MOD_NO_CATEGORY = 29
MOD_EMPTY_USER = 331
MOD_LATE = 211          # collector 5 h after the event
MOD_EARLY = 223         # collector 60 s before the event
MOD_NO_VERSION = 337
MOD_DUPLICATE = 83      # copied once, collector + 30 min
MOD_NULL_STEP_NAME = 31
# End of fixed values.
# ---------------------------------------------------------------------------

RAW_COLUMNS = ["event_id", "event_name", "event_category", "tenant_id", "user_id", "session_id",
               "event_timestamp", "collector_tstamp", "platform_version", "event_source",
               "properties", "sdk_version"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _arr(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _pick(values, idx: Column) -> Column:
    """values[idx] for a 0-based integer index column."""
    return F.element_at(_arr(values), (idx + F.lit(1)).cast("int"))


def _q(c: Column) -> Column:
    """JSON string literal of a column value."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _s(c: Column) -> Column:
    return c.cast("string")


def event_name_expr(event_type: Column, k: Column, src_user: Column) -> Column:
    out = None
    for etype, below, extra, name in NAME_RULES:
        cond = event_type == F.lit(etype)
        if below is not None:
            cond = cond & (k < F.lit(below))
        if extra == "tenant_not_3":
            cond = cond & ((src_user % F.lit(N_TENANTS)) != F.lit(3))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def category_expr(name: Column) -> Column:
    m = F.create_map(*[x for n, c in C.catalog_rows() for x in (F.lit(n), F.lit(c))])
    return F.try_element_at(m, name)


def properties_expr(name: Column, n: Column, k: Column, u: Column) -> Column:
    step = F.when(n % F.lit(MOD_NULL_STEP_NAME) == 0, F.lit("null")).otherwise(
        _q(_pick(C.ONBOARDING_STEPS, k % F.lit(6))))
    step_json = F.concat(F.lit('{"step_name": '), step,
                         F.lit(', "step_index": '), _s(k % F.lit(6)),
                         F.lit(', "duration_seconds": '), _s(F.lit(30) + n % F.lit(570)), F.lit("}"))
    project = F.concat(F.lit("proj_"), _s(u % F.lit(50)))
    pipe_json = F.concat(F.lit('{"pipeline_id": '), _q(F.concat(F.lit("pipe_"), _s(n))),
                         F.lit(', "project_id": '), _q(project),
                         F.lit(', "status": '), _q(_pick(C.PIPELINE_STATUSES, n % F.lit(3))),
                         F.lit(', "duration_seconds": '), _s(F.lit(15) + n % F.lit(585)), F.lit("}"))
    proj_json = F.concat(F.lit('{"project_id": '), _q(project),
                         F.lit(', "visibility_level": '), _q(_pick(VISIBILITY_LEVELS, n % F.lit(2))),
                         F.lit(', "template_used": '),
                         F.when(n % F.lit(5) < 2, F.lit("true")).otherwise(F.lit("false")), F.lit("}"))
    scan_json = F.concat(F.lit('{"scan_type": '), _q(_pick(C.SCAN_TYPES, n % F.lit(4))),
                         F.lit(', "vulnerabilities_found": '), _s(n % F.lit(26)),
                         F.lit(', "severity_critical": '), _s(n % F.lit(4)), F.lit("}"))
    nav_json = F.concat(F.lit('{"section_name": '), _q(_pick(C.NAV_SECTIONS, k % F.lit(10))), F.lit("}"))
    admin_json = F.concat(F.lit('{"setting_category": "general", "setting_name": '),
                          _q(_pick(C.ADMIN_SETTINGS, k % F.lit(6))), F.lit("}"))
    return (F.when(name == "dedicated_onboarding_step_completed", step_json)
             .when(name == "dedicated_pipeline_executed", pipe_json)
             .when(name == "dedicated_project_created", proj_json)
             .when(name == "dedicated_security_scan_completed", scan_json)
             .when(name == "dedicated_nav_section_clicked", nav_json)
             .when(name == "dedicated_admin_setting_changed", admin_json)
             .otherwise(F.lit("{}")))


# Clicks derived around navigation clicks, to exercise the debounce rule: (every n-th, suffix, ms after the click,
# hours late)
CLICK_ECHOES = [(3, "a", 150, 2), (5, "b", 290, 5), (7, "c", -120, 0), (2, "d", 500, 0)]
# Rows that arrive many days late, to exercise the watermark: ids that end in 7
VERY_LATE_DAYS = 10


def click_bursts(raw_n: DataFrame) -> DataFrame:
    """Raw events and, around navigation clicks, further clicks of the same key that come out of order and 2 or 5 hours late."""
    own = F.struct(F.lit("").alias("suffix"), F.lit(0).alias("ms"), F.lit(0).alias("hours"))
    nav = F.col("event_name") == "dedicated_nav_section_clicked"
    echoes = [F.when(nav & (F.col("n") % every == 0), F.struct(F.lit(f"_{s}").alias("suffix"), F.lit(ms).alias("ms"), F.lit(h).alias("hours")))
              for every, s, ms, h in CLICK_ECHOES]
    copies = F.filter(F.array(own, *echoes), lambda x: x.isNotNull())
    e = raw_n.withColumn("_e", F.explode(copies))
    moved = F.timestamp_add("MILLISECOND", F.col("_e.ms"), F.col("event_timestamp"))
    return (e.withColumn("event_id", F.concat("event_id", "_e.suffix")).withColumn("event_timestamp", moved)
             .withColumn("collector_tstamp", F.timestamp_add("HOUR", F.col("_e.hours"), F.col("collector_tstamp")))
             .select(*raw_n.columns))


def very_late(raw_n: DataFrame) -> DataFrame:
    """Raw events of which every tenth (id ending in 7) arrives ten days later than it did."""
    late = F.timestamp_add("DAY", F.lit(VERY_LATE_DAYS), F.col("collector_tstamp"))
    return raw_n.withColumn("collector_tstamp", F.when(F.col("event_id").endswith("7"), late).otherwise(F.col("collector_tstamp")))


def crossing_copies(raw_n: DataFrame) -> DataFrame:
    """Raw events with a landing ``batch`` (0 or 1) and, for every 17th, a copy a day later in event time that was collected
    an hour earlier, so that it wins; it lands in the batch after, whatever its times say."""
    both = F.when(F.col("n") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = raw_n.withColumn("_c", F.explode(both))
    copy = F.col("_c") == 1
    return (e.withColumn("event_timestamp", F.when(copy, F.timestamp_add("DAY", F.lit(1), F.col("event_timestamp"))).otherwise(F.col("event_timestamp")))
             .withColumn("collector_tstamp", F.when(copy, F.timestamp_add("HOUR", F.lit(-1), F.col("collector_tstamp"))).otherwise(F.col("collector_tstamp")))
             .withColumn("batch", F.when(copy | (F.to_date("event_timestamp") >= F.lit("2024-01-25").cast("date")) & (F.col("n") % 5 == 0), 1).otherwise(0))
             .select(*raw_n.columns, "batch"))


def worn_events(raw_n: DataFrame) -> DataFrame:
    """Raw events with faults of the kinds that the format, domain and tracking-plan checks look for: every 41st row has its
    payload's first number as text, every 43rd a property that nobody planned, every 97th a source out of its domain,
    every 89th a version of three parts and every 101st an overlong session id."""
    n, props = F.col("n"), F.col("properties")
    text_number = F.regexp_replace(props, r'^(.*?": )([0-9]+)([,}])', r'$1"$2"$3')
    unplanned = F.concat(F.regexp_replace(props, r"\}$", ""), F.when(props == "{}", F.lit('"project_uuid": "x"}')).otherwise(F.lit(', "project_uuid": "x"}')))
    return (raw_n.withColumn("properties", F.when(n % 41 == 0, text_number).when(n % 43 == 0, unplanned).otherwise(props))
                 .withColumn("event_source", F.when(n % 97 == 0, F.lit("edge")).otherwise(F.col("event_source")))
                 .withColumn("platform_version", F.when(n % 89 == 0, F.lit("17.4.2")).otherwise(F.col("platform_version")))
                 .withColumn("session_id", F.when(n % 101 == 0, F.lit("s" * 40)).otherwise(F.col("session_id"))))


def worn_dims(users: DataFrame, tenants: DataFrame, lifecycle: DataFrame, sessions: DataFrame) -> dict[str, DataFrame]:
    """The dimension tables with some values out of their domains, and a device for each session."""
    devices = [*C.DEVICE_TYPES, "watch"]
    return {
        "users": users.withColumn("role", F.when(F.col("user_id").endswith("50"), F.lit("admin")).otherwise(F.col("role"))),
        "tenants": tenants.withColumn("plan_tier", F.when(F.col("tenant_id") == "tenant_5", F.lit("starter")).otherwise(F.col("plan_tier"))),
        "lifecycle": lifecycle.withColumn("onboarding_status", F.when(F.col("user_id").endswith("13"), F.lit("paused")).otherwise(F.col("onboarding_status"))),
        "sessions": sessions.withColumn("device_type", _pick(devices, F.length("session_id") % len(devices))),
    }


def raw_events(spark: SparkSession, sf_dir: str, keep_n: bool = False,
               with_duplicates: bool = True) -> DataFrame:
    """M-1: the typed raw landing table, duplicates included."""
    # parse the JSON payload once; later expressions refer to the column
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                               json_int("props", "k").alias("_k0"))
    n, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    k = F.col("_k0")
    name = event_name_expr(F.col("event_type"), k, u)
    empty_user = (n % F.lit(MOD_EMPTY_USER)) == 0
    shift = (F.when(n % F.lit(MOD_LATE) == 0, F.lit(18000))
              .when(n % F.lit(MOD_EARLY) == 0, F.lit(-60))
              .otherwise(n % F.lit(5))).cast("int")
    base = ev.select(
        n.alias("n"),
        F.concat(F.lit("evt_"), _s(n)).alias("event_id"),
        name.alias("event_name"),
        k.alias("_k"),
        u.alias("_u"),
        ts.alias("event_timestamp"),
        shift.alias("_shift"),
        empty_user.alias("_empty"),
        # one scan: duplicated ids get a second copy, collector time + 30 min
        F.explode(F.when((n % F.lit(MOD_DUPLICATE) == 0) & F.lit(with_duplicates), F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    out = base.select(
        "n", "event_id", "event_name",
        F.when(F.col("n") % F.lit(MOD_NO_CATEGORY) == 0, F.lit(None).cast("string"))
         .otherwise(category_expr(F.col("event_name"))).alias("event_category"),
        F.concat(F.lit("tenant_"), _s(F.col("_u") % F.lit(N_TENANTS))).alias("tenant_id"),
        F.when(F.col("_empty"), F.lit("")).otherwise(F.concat(F.lit("usr_"), _s(F.col("_u")))).alias("user_id"),
        F.when(F.col("_empty"), F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("sess_"), _s(F.col("_u")), F.lit("_"),
                     _s(F.to_date("event_timestamp")))).alias("session_id"),
        F.col("event_timestamp"),
        F.timestamp_add("SECOND", F.col("_shift") + F.col("_copy") * F.lit(1800),
                        F.col("event_timestamp")).alias("collector_tstamp"),
        F.when(F.col("n") % F.lit(MOD_NO_VERSION) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("17."), _s(F.col("_u") % F.lit(4)))).alias("platform_version"),
        F.when(F.col("n") % F.lit(2) == 0, F.lit("client")).otherwise(F.lit("server")).alias("event_source"),
        properties_expr(F.col("event_name"), F.col("n"), F.col("_k"), F.col("_u")).alias("properties"),
        F.lit(SDK_VERSION).alias("sdk_version"),
    )
    cols = (["n"] if keep_n else []) + RAW_COLUMNS
    return out.select(*cols)


def dim_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant SCD2 dimension from ``nation`` (one current version per tenant)."""
    nk = F.col("n_nationkey")
    return (table(spark, sf_dir, "nation").where(nk < F.lit(N_TENANTS)).select(
        (nk + F.lit(1)).cast("long").alias("tenant_surrogate_key"),
        F.concat(F.lit("tenant_"), _s(nk)).alias("tenant_id"),
        F.col("n_name").alias("tenant_name"),
        _pick(C.REGIONS, nk % F.lit(4)).alias("region"),
        _pick(C.PLAN_TIERS, nk % F.lit(2)).alias("plan_tier"),
        _pick(C.SEAT_LIMITS, nk % F.lit(5)).cast("int").alias("seat_limit"),
        (nk != F.lit(3)).alias("sso_enabled"),
        F.date_add(F.lit(TENANT_PROVISION_BASE).cast("date"), nk).alias("provisioning_date"),
        F.date_add(F.lit(TENANT_PROVISION_BASE).cast("date"), nk).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    ))


def dim_users(spark: SparkSession, sf_dir: str, with_key: bool = True) -> DataFrame:
    """User SCD2 dimension from ``customer``; every 10th key has an older
    version (role guest) closed on 2024-01-15."""
    ck = F.col("c_custkey")
    role_map = F.create_map(*[x for s, r in SEGMENT_ROLES.items() for x in (F.lit(s), F.lit(r))])
    cust = table(spark, sf_dir, "customer")
    changed = (ck % F.lit(10)) == 0
    base = cust.select(
        F.concat(F.lit("usr_"), _s(ck)).alias("user_id"),
        F.concat(F.lit("tenant_"), _s(ck % F.lit(N_TENANTS))).alias("tenant_id"),
        F.try_element_at(role_map, F.col("c_mktsegment")).alias("role"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        changed.alias("_changed"),
    )
    nulls = [F.lit(None).cast("date").alias("invite_date"),
             F.lit(None).cast("date").alias("first_login_date"),
             F.lit(None).cast("date").alias("activation_date"),
             F.lit(None).cast("string").alias("onboarding_status")]
    current = base.select(
        "user_id", "tenant_id", "role", "is_active", *nulls,
        F.when(F.col("_changed"), F.lit(DIM_CHANGE)).otherwise(F.lit(DIM_START))
         .cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"))
    older = base.where(F.col("_changed")).select(
        "user_id", "tenant_id", F.lit("guest").alias("role"), "is_active", *nulls,
        F.lit(DIM_START).cast("timestamp_ntz").alias("valid_from"),
        F.lit(DIM_CHANGE).cast("timestamp_ntz").alias("valid_to"),
        F.lit(False).alias("is_current"))
    users = current.unionByName(older)
    if not with_key:
        return users
    from ..functions.ranking import dense_sequence
    keyed = dense_sequence(users, ["user_id", "valid_from"], out_col="user_surrogate_key",
                           tiebreak=[])
    return keyed.select("user_surrogate_key", *users.columns)


def event_catalog(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Event registry: name, category, priority, P0 flag, deprecation date, and
    whether the name is in the fact's accepted-values list. A parameter table
    (19 rows), broadcast wherever it is joined."""
    rows = []
    for name, cat in C.catalog_rows():
        p0 = name in C.P0_EVENTS
        rows.append((name, cat, "P0" if p0 else "P1", p0, None, name in C.ACCEPTED_EVENT_NAMES))
    schema = ("event_name string, category string, priority string, is_p0 boolean, "
              "deprecated_at date, in_accepted_values boolean")
    return spark.createDataFrame(rows, schema)


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support tickets (our schema): error events with k >= 95."""
    ev = table(spark, sf_dir, "events")
    k = json_int("props", "k")
    u = F.col("user_id")
    return (ev.where((F.col("event_type") == "error") & (k >= F.lit(95))).select(
        F.concat(F.lit("tkt_"), _s(F.col("event_id"))).alias("ticket_id"),
        F.concat(F.lit("tenant_"), _s(u % F.lit(N_TENANTS))).alias("tenant_id"),
        F.concat(F.lit("usr_"), _s(u)).alias("user_id"),
        F.col("ts").alias("opened_at"),
        _pick(["login", "ssh", "pipeline", "billing", "other"], F.col("event_id") % F.lit(5)).alias("category"),
    ))

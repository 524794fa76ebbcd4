"""DuckDB SQL for the adapter tables, written independently of the Spark
adapter, so the oracle checks the derivation too. Each entry is a CTE body;
``prelude`` assembles the ones a query needs, with their dependencies."""

from __future__ import annotations

from .. import config as C
from ..sources import fixtures as X


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _name_case() -> str:
    parts = []
    for etype, below, extra, name in X.NAME_RULES:
        cond = [f"event_type = '{etype}'"]
        if below is not None:
            cond.append(f"k < {below}")
        if extra == "tenant_not_3":
            cond.append(f"u % {X.N_TENANTS} <> 3")
        parts.append(f"WHEN {' AND '.join(cond)} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


def _category_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{n}' THEN '{c}'" for n, c in C.catalog_rows()) + " END"


def _props_case() -> str:
    steps = _sql_list(C.ONBOARDING_STEPS)
    q = "'\"'"
    return f"""CASE
      WHEN event_name = 'dedicated_onboarding_step_completed' THEN
        '{{"step_name": ' || CASE WHEN n % {X.MOD_NULL_STEP_NAME} = 0 THEN 'null'
                              ELSE {q} || {steps}[k % 6 + 1] || {q} END
        || ', "step_index": ' || CAST(k % 6 AS VARCHAR)
        || ', "duration_seconds": ' || CAST(30 + n % 570 AS VARCHAR) || '}}'
      WHEN event_name = 'dedicated_pipeline_executed' THEN
        '{{"pipeline_id": "pipe_' || CAST(n AS VARCHAR) || '", "project_id": "proj_' || CAST(u % 50 AS VARCHAR)
        || '", "status": "' || {_sql_list(C.PIPELINE_STATUSES)}[n % 3 + 1]
        || '", "duration_seconds": ' || CAST(15 + n % 585 AS VARCHAR) || '}}'
      WHEN event_name = 'dedicated_project_created' THEN
        '{{"project_id": "proj_' || CAST(u % 50 AS VARCHAR) || '", "visibility_level": "'
        || {_sql_list(X.VISIBILITY_LEVELS)}[n % 2 + 1] || '", "template_used": '
        || CASE WHEN n % 5 < 2 THEN 'true' ELSE 'false' END || '}}'
      WHEN event_name = 'dedicated_security_scan_completed' THEN
        '{{"scan_type": "' || {_sql_list(C.SCAN_TYPES)}[n % 4 + 1] || '", "vulnerabilities_found": '
        || CAST(n % 26 AS VARCHAR) || ', "severity_critical": ' || CAST(n % 4 AS VARCHAR) || '}}'
      WHEN event_name = 'dedicated_nav_section_clicked' THEN
        '{{"section_name": "' || {_sql_list(C.NAV_SECTIONS)}[k % 10 + 1] || '"}}'
      WHEN event_name = 'dedicated_admin_setting_changed' THEN
        '{{"setting_category": "general", "setting_name": "' || {_sql_list(C.ADMIN_SETTINGS)}[k % 6 + 1] || '"}}'
      ELSE '{{}}' END"""


AS_OF = "2024-02-01 00:00:00"

CTES: dict[str, tuple[list[str], str]] = {}

CTES["raw_named"] = ([], f"""
  SELECT event_id AS n, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id AS u,
         event_type, ts
  FROM events""")

CTES["raw_named2"] = (["raw_named"], f"""
  SELECT *, {_name_case()} AS event_name FROM raw_named""")

CTES["raw_once"] = (["raw_named2"], f"""
  SELECT n,
    'evt_' || CAST(n AS VARCHAR) AS event_id,
    event_name,
    CASE WHEN n % {X.MOD_NO_CATEGORY} = 0 THEN NULL ELSE {_category_case('event_name')} END AS event_category,
    'tenant_' || CAST(u % {X.N_TENANTS} AS VARCHAR) AS tenant_id,
    CASE WHEN n % {X.MOD_EMPTY_USER} = 0 THEN '' ELSE 'usr_' || CAST(u AS VARCHAR) END AS user_id,
    CASE WHEN n % {X.MOD_EMPTY_USER} = 0 THEN NULL
         ELSE 'sess_' || CAST(u AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) END AS session_id,
    ts AS event_timestamp,
    ts + to_seconds(CASE WHEN n % {X.MOD_LATE} = 0 THEN 18000 WHEN n % {X.MOD_EARLY} = 0 THEN -60
                         ELSE n % 5 END) AS collector_tstamp,
    CASE WHEN n % {X.MOD_NO_VERSION} = 0 THEN NULL ELSE '17.' || CAST(u % 4 AS VARCHAR) END AS platform_version,
    CASE WHEN n % 2 = 0 THEN 'client' ELSE 'server' END AS event_source,
    {_props_case()} AS properties,
    '{X.SDK_VERSION}' AS sdk_version
  FROM raw_named2""")

CTES["raw_events"] = (["raw_once"], f"""
  SELECT * FROM raw_once
  UNION ALL
  SELECT n, event_id, event_name, event_category, tenant_id, user_id, session_id, event_timestamp,
         collector_tstamp + INTERVAL 1800 SECOND, platform_version, event_source, properties, sdk_version
  FROM raw_once WHERE n % {X.MOD_DUPLICATE} = 0""")

def _payload(key: str, cast: str = "") -> str:
    return f"(properties->>'$.{key}'){cast}"


# one row per event id, the copy that was collected first; the step columns belong to step events
CTES["fct"] = (["raw_events"], f"""
  SELECT n, event_id, event_name, ifnull(event_category, 'unknown') AS event_category, tenant_id, user_id, session_id, event_timestamp,
    event_timestamp::DATE AS event_date, hour(event_timestamp)::INTEGER AS event_hour, dayofweek(event_timestamp)::INTEGER AS event_day_of_week,
    platform_version, event_source, if(is_step, {_payload("step_name")}, NULL) AS step_name, if(is_step, {_payload("step_index", "::INTEGER")}, NULL) AS step_index,
    {_payload("project_id")} AS project_id, {_payload("pipeline_id")} AS pipeline_id, {_payload("status")} AS pipeline_status,
    {_payload("scan_type")} AS scan_type, {_payload("duration_seconds", "::INTEGER")} AS duration_seconds,
    properties AS properties_json, TIMESTAMP '{AS_OF}' AS loaded_at
  FROM (SELECT DISTINCT ON (event_id) *, event_name = 'dedicated_onboarding_step_completed' AS is_step
        FROM raw_events ORDER BY event_id, collector_tstamp)""")

CTES["degraded"] = (["fct"], """
  SELECT * FROM fct
  WHERE event_name <> 'dedicated_mr_created' AND n % 503 <> 0
    AND NOT (event_name = 'dedicated_pipeline_executed' AND n % 97 = 0)
  UNION ALL
  SELECT * REPLACE ('dedicated_orphan_event' AS event_name) FROM fct WHERE n = 0""")

_roles = " ".join(f"WHEN '{s}' THEN '{r}'" for s, r in X.SEGMENT_ROLES.items())
CTES["users_base"] = ([], f"""
  SELECT 'usr_' || CAST(c_custkey AS VARCHAR) AS user_id,
         'tenant_' || CAST(c_custkey % {X.N_TENANTS} AS VARCHAR) AS tenant_id,
         CASE c_mktsegment {_roles} END AS role,
         c_acctbal >= 0 AS is_active,
         c_custkey % 10 = 0 AS changed
  FROM customer""")

CTES["dim_users"] = (["users_base"], f"""
  SELECT ROW_NUMBER() OVER (ORDER BY user_id, valid_from) AS user_surrogate_key, *
  FROM (
    SELECT user_id, tenant_id, role, is_active, CAST(NULL AS DATE) AS invite_date,
           CAST(NULL AS DATE) AS first_login_date, CAST(NULL AS DATE) AS activation_date,
           CAST(NULL AS VARCHAR) AS onboarding_status,
           CASE WHEN changed THEN TIMESTAMP '{X.DIM_CHANGE}' ELSE TIMESTAMP '{X.DIM_START}' END AS valid_from,
           CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
    FROM users_base
    UNION ALL
    SELECT user_id, tenant_id, 'guest', is_active, NULL, NULL, NULL, NULL,
           TIMESTAMP '{X.DIM_START}', TIMESTAMP '{X.DIM_CHANGE}', FALSE
    FROM users_base WHERE changed) v""")

CTES["dim_tenants"] = ([], f"""
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS tenant_surrogate_key,
         'tenant_' || CAST(n_nationkey AS VARCHAR) AS tenant_id,
         n_name AS tenant_name,
         {_sql_list(C.REGIONS)}[n_nationkey % 4 + 1] AS region,
         {_sql_list(C.PLAN_TIERS)}[n_nationkey % 2 + 1] AS plan_tier,
         CAST([{', '.join(str(s) for s in C.SEAT_LIMITS)}][n_nationkey % 5 + 1] AS INTEGER) AS seat_limit,
         n_nationkey <> 3 AS sso_enabled,
         CAST(DATE '{X.TENANT_PROVISION_BASE}' + n_nationkey AS DATE) AS provisioning_date,
         CAST(DATE '{X.TENANT_PROVISION_BASE}' + n_nationkey AS TIMESTAMP) AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM nation WHERE n_nationkey < {X.N_TENANTS}""")

CTES["catalog"] = ([], "\n  SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{c}', {'TRUE' if n in C.P0_EVENTS else 'FALSE'})" for n, c in C.catalog_rows())
    + ") AS t(event_name, category, is_p0)")


def prelude(*names: str) -> str:
    """``WITH`` clause holding the named adapter CTEs and their dependencies."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)

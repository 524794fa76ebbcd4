"""Parameters of the analytics: event catalog, funnel specs, thresholds.

Operators never hard-code these; they take a spec or a threshold object and
default to the values below.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the product's instrumentation plan for results to
# agree (event names, categories, steps, benchmarks, value lists).
# ---------------------------------------------------------------------------

ONBOARDING_STEPS = [
    "account_setup",
    "ssh_key_setup",
    "create_first_project",
    "configure_ci",
    "run_first_pipeline",
    "invite_teammate",
]

EVENT_CATALOG = {
    "onboarding": [
        "dedicated_user_invited",
        "dedicated_user_invitation_accepted",
        "dedicated_user_first_login",
        "dedicated_onboarding_step_completed",
        "dedicated_onboarding_completed",
        "dedicated_onboarding_abandoned",
    ],
    "feature_adoption": [
        "dedicated_project_created",
        "dedicated_pipeline_executed",
        "dedicated_mr_created",
        "dedicated_mr_merged",
        "dedicated_security_scan_completed",
        "dedicated_user_activated",
    ],
    "admin": [
        "dedicated_tenant_provisioned",
        "dedicated_admin_setting_changed",
        "dedicated_sso_configured",
        "dedicated_user_role_assigned",
        "dedicated_instance_upgrade_initiated",
    ],
    "navigation": [
        "dedicated_nav_section_clicked",
        "dedicated_nav_search_executed",
    ],
}

# Accepted values of the fact's event_name column test (18 names; the catalog
# above has one more, dedicated_nav_search_executed).
ACCEPTED_EVENT_NAMES = [
    "dedicated_tenant_provisioned",
    "dedicated_user_invited",
    "dedicated_user_invitation_accepted",
    "dedicated_user_first_login",
    "dedicated_onboarding_step_completed",
    "dedicated_onboarding_completed",
    "dedicated_onboarding_abandoned",
    "dedicated_user_activated",
    "dedicated_user_role_assigned",
    "dedicated_project_created",
    "dedicated_pipeline_executed",
    "dedicated_mr_created",
    "dedicated_mr_merged",
    "dedicated_security_scan_completed",
    "dedicated_nav_section_clicked",
    "dedicated_admin_setting_changed",
    "dedicated_sso_configured",
    "dedicated_instance_upgrade_initiated",
]

# Events every tenant is expected to report.
P0_EVENTS = [
    "dedicated_tenant_provisioned",
    "dedicated_user_invited",
    "dedicated_onboarding_step_completed",
    "dedicated_pipeline_executed",
    "dedicated_sso_configured",
]

# Funnel: (step number, display name, event name)
FUNNEL_STEPS = [
    (0, "Invitation Sent", "dedicated_user_invited"),
    (1, "Invitation Accepted", "dedicated_user_invitation_accepted"),
    (2, "First Login", "dedicated_user_first_login"),
    (3, "SSH Key Configured", "dedicated_onboarding_step_completed"),
    (4, "First Project Created", "dedicated_project_created"),
    (5, "First Pipeline Run", "dedicated_pipeline_executed"),
    (6, "Onboarding Completed", "dedicated_onboarding_completed"),
    (7, "Activated", "dedicated_user_activated"),
]

# Labels the executed funnel report prints (step 3 counts any step event).
FUNNEL_REPORT_LABELS = [
    "Invitation Sent",
    "Invitation Accepted",
    "First Login",
    "Onboarding Step",
    "First Project",
    "First Pipeline",
    "Onboarding Complete",
    "Activated",
]

FUNNEL_BENCHMARKS = {
    "0→1": 0.70,
    "1→2": 0.85,
    "2→3": 0.60,
    "3→4": 0.80,
    "4→5": 0.65,
    "5→6": 0.90,
    "6→7": 0.75,
}
E2E_TARGET_PCT = 20.0
E2E_POST_IMPROVEMENT_TARGET_PCT = 26.0
IMPROVEMENT_FACTOR = 1.3

# Time-to-complete transitions: (label, from step, to step, seconds per unit)
TRANSITIONS = [
    ("Invite → Accept", 0, 1, 60),
    ("Accept → Login", 1, 2, 60),
    ("Login → Onboarding", 2, 3, 60),
    ("Onboarding → Project", 3, 4, 60),
    ("Project → Pipeline", 4, 5, 60),
    ("Pipeline → Complete", 5, 6, 60),
    ("Complete → Activated", 6, 7, 3600),
]

REGIONS = ["us-east-1", "eu-west-1", "ap-southeast-1", "us-west-2"]
PLAN_TIERS = ["premium", "ultimate"]
SEAT_LIMITS = [25, 50, 100, 250, 500]
ROLES = ["guest", "reporter", "developer", "maintainer", "owner"]
NAV_SECTIONS = ["projects", "groups", "milestones", "issues", "merge_requests",
                "ci_cd", "security", "packages", "infrastructure", "admin"]
ADMIN_SETTINGS = ["visibility_level", "signup_restrictions", "ci_runner_config",
                  "email_notifications", "two_factor_auth", "repository_storage"]
SCAN_TYPES = ["sast", "dast", "dependency_scanning", "container_scanning"]
PIPELINE_STATUSES = ["success", "failed", "canceled"]
EVENT_SOURCES = ["client", "server"]
ONBOARDING_STATUSES = ["not_started", "in_progress", "abandoned", "completed"]
DEVICE_TYPES = ["desktop", "mobile", "tablet", "api"]
# Event-name pattern dedicated_{domain}_{object}_{action}: allowed domains.
NAME_DOMAINS = ["user", "onboarding", "project", "pipeline", "mr", "security", "admin", "nav",
                "billing", "support", "instance"]
NAME_PREFIX = "dedicated_"
MAX_NAME_LENGTH = 60
MAX_PROPERTIES = 15
# Required base fields of every event payload (the raw table's columns).
REQUIRED_FIELDS = ["event_id", "event_name", "tenant_id", "user_id", "event_timestamp",
                   "platform_version", "session_id", "event_source"]
# Irregular past-tense actions accepted besides the regular "-ed" form.
IRREGULAR_PAST = ["sent", "built", "run", "begun", "done", "made", "set", "shown", "taken", "written"]

# Duplicate-cause bands (seconds between first and last copy).
RETRY_MAX_SECONDS = 2
REPLAY_MAX_SECONDS = 300

# End of fixed values.
# ---------------------------------------------------------------------------


def catalog_rows():
    """(event_name, category) pairs of the catalog, in catalog order."""
    return [(name, cat) for cat, names in EVENT_CATALOG.items() for name in names]


@dataclass(frozen=True)
class FunnelStep:
    number: int
    name: str
    event: str
    predicate: str | None = None  # optional Spark SQL predicate on the event row


@dataclass(frozen=True)
class FunnelSpec:
    steps: tuple[FunnelStep, ...]
    after_invite: bool = True        # bound step events by ts >= invited_at
    window_days: int | None = None   # upper bound invited_at + N days (template)

    @property
    def invite(self) -> FunnelStep:
        return self.steps[0]


def executed_funnel(after_invite: bool = True) -> FunnelSpec:
    """The funnel the pipeline runs: step 3 counts any onboarding step."""
    return FunnelSpec(tuple(FunnelStep(n, label, ev) for (n, _, ev), label
                            in zip(FUNNEL_STEPS, FUNNEL_REPORT_LABELS)),
                      after_invite=after_invite)


def template_funnel(window_days: int = 30) -> FunnelSpec:
    """The funnel template: step 3 is the SSH key step, 30-day window."""
    steps = []
    for n, label, ev in FUNNEL_STEPS:
        pred = "step_name = 'ssh_key_setup'" if n == 3 else None
        steps.append(FunnelStep(n, label, ev, pred))
    return FunnelSpec(tuple(steps), after_invite=True, window_days=window_days)


@dataclass(frozen=True)
class Thresholds:
    """Reconciliation bands in percent of raw distinct events."""
    fail_pct: float = 1.0
    warn_pct: float = 0.1
    two_band: bool = False  # template form: PASS / WARN only, orphan+missing are FAIL


@dataclass(frozen=True)
class Window:
    """Half-open [start, end) range on event time, ISO date strings."""
    start: str
    end: str


@dataclass
class Scale:
    """Knobs for skew handling; defaults suit a large cluster."""
    hot_key_rows: int = 2_000_000   # a key with more rows than this is 'hot'
    extra: dict = field(default_factory=dict)


# ---------------------------------------------------------------------------
# FIXED VALUES — the planned events with their payload properties and types
# (tenant, user and time stand in columns, not in the payload), and the length
# limits of the raw columns.
PLANNED_PROPERTIES = {
    "dedicated_tenant_provisioned": {"region": "string", "plan_tier": "string", "provisioning_duration_seconds": "int"},
    "dedicated_user_invited": {"inviter_user_id": "string", "invitee_email_hash": "string", "role_assigned": "string"},
    "dedicated_onboarding_step_completed": {"step_name": "string", "step_index": "int", "duration_seconds": "int"},
    "dedicated_onboarding_abandoned": {"last_step_completed": "string", "steps_remaining": "int"},
    "dedicated_project_created": {"project_id": "string", "visibility_level": "string", "template_used": "boolean"},
    "dedicated_pipeline_executed": {"project_id": "string", "pipeline_id": "string", "status": "string", "duration_seconds": "int", "runner_type": "string"},
    "dedicated_merge_request_created": {"project_id": "string", "mr_id": "string", "source_branch": "string", "target_branch": "string"},
    "dedicated_merge_request_merged": {"project_id": "string", "mr_id": "string", "time_to_merge_hours": "float", "approvals_count": "int"},
    "dedicated_security_scan_completed": {"project_id": "string", "scan_type": "string", "vulnerabilities_found": "int", "severity_critical": "int"},
    "dedicated_nav_section_clicked": {"section_name": "string", "previous_section": "string"},
    "dedicated_admin_setting_changed": {"setting_category": "string", "setting_name": "string", "old_value_hash": "string", "new_value_hash": "string"},
    "dedicated_sso_configured": {"provider_type": "string", "configuration_action": "string"},
    "dedicated_user_role_assigned": {"admin_user_id": "string", "target_user_id": "string", "previous_role": "string", "new_role": "string"},
    "dedicated_instance_upgrade_initiated": {"from_version": "string", "to_version": "string", "upgrade_type": "string"},
    "dedicated_support_ticket_created": {"ticket_id": "string", "severity": "string", "category": "string"},
}
COLUMN_LENGTHS = {"event_id": 36, "event_name": 60, "event_category": 30, "tenant_id": 36, "user_id": 36, "session_id": 36,
                  "platform_version": 20, "event_source": 10, "sdk_version": 20}
# End of fixed values.
# ---------------------------------------------------------------------------

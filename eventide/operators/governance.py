"""Governance and compliance checks over event tables (G-*): naming, payload
rules, PII, categories, opt-out, erasure, residency, deprecation, plan
coverage. All checks are filters and grouped aggregates; lookups against the
event registry (a fixed list of event names) are broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

NAME = "event_name"
SNAKE = r"^[a-z][a-z0-9]*(_[a-z0-9]+)*$"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IPV4 = r"\b(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}\b"


def _names(events: DataFrame) -> DataFrame:
    return events.groupBy(NAME).agg(F.count(F.lit(1)).alias("rows"))


def name_lint(events: DataFrame) -> DataFrame:
    """G-1: per distinct event name: prefix, snake_case, length ≤ 60, domain
    in the allowed list, past-tense action (regular -ed or allow-listed)."""
    n = F.col(NAME)
    parts = F.split(n, "_")
    domain = F.try_element_at(parts, F.lit(2))
    action = F.try_element_at(parts, F.lit(-1))
    past = action.endswith("ed") | action.isin(*C.IRREGULAR_PAST)
    checks = {
        "has_prefix": n.startswith(C.NAME_PREFIX),
        "is_snake_case": n.rlike(SNAKE),
        "length_ok": F.length(n) <= C.MAX_NAME_LENGTH,
        "domain_ok": domain.isin(*C.NAME_DOMAINS),
        "past_tense": past,
    }
    out = _names(events).select(NAME, "rows", *[c.alias(k) for k, c in checks.items()])
    ok = F.lit(True)
    for k in checks:
        ok = ok & F.col(k)
    return out.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def required_properties(events: DataFrame, fields: Sequence[str] = tuple(C.REQUIRED_FIELDS)) -> DataFrame:
    """G-2: per event name, rows missing each required base field (NULL, or
    empty for strings)."""
    types = dict(events.dtypes)

    def missing(c: str) -> Column:
        col = F.col(c)
        return (col.isNull() | (col == "")) if types[c] == "string" else col.isNull()
    g = events.groupBy(NAME).agg(F.count(F.lit(1)).alias("rows"),
                                 *[F.count_if(missing(c)).alias(f"missing_{c}") for c in fields])
    total = sum(F.col(f"missing_{c}") for c in fields)
    return g.withColumn("status", F.when(total > 0, "FAIL").otherwise("PASS"))


def property_count(events: DataFrame, limit: int = C.MAX_PROPERTIES, props: str = "properties") -> DataFrame:
    """G-3: property keys per event: max and rows over the limit, per name."""
    k = F.coalesce(F.size(F.json_object_keys(F.col(props))), F.lit(0))
    return events.groupBy(NAME).agg(F.max(k).alias("max_properties"),
                                    F.count_if(k > limit).alias("rows_over_limit"))


def pii_scan(events: DataFrame, props: str = "properties") -> DataFrame:
    """G-4: rows whose properties hold an e-mail address or an IPv4 address
    (names cannot be detected by rule)."""
    p = F.col(props)
    return events.groupBy(NAME).agg(F.count_if(p.rlike(EMAIL)).alias("rows_with_email"),
                                    F.count_if(p.rlike(IPV4)).alias("rows_with_ip"))


def property_naming(events: DataFrame, props: str = "properties") -> DataFrame:
    """G-5: (event, property) pairs breaking the naming rules: snake_case;
    booleans start is_/has_; counts (a word ``count``, ``counts`` or
    ``found``) end _count; durations end _seconds/_hours; identifiers (a
    word ``id``, ``ids``, ``uuid``, ``guid`` or ``identifier``) end _id. Keys are aggregated per (event, key) before the rules
    run, so the rules see one row per payload shape."""
    kv = (events.select(NAME, F.from_json(F.col(props), "map<string,string>").alias("m"))
                .select(NAME, F.explode("m").alias("key", "value")))
    shapes = kv.groupBy(NAME, "key").agg(
        F.max(F.col("value").isin("true", "false").cast("int")).alias("_bool"),
        F.count(F.lit(1)).alias("rows"))
    key = F.col("key")
    rules = [
        ("not_snake_case", ~key.rlike(SNAKE)),
        ("boolean_without_is_has", (F.col("_bool") == 1) & ~(key.startswith("is_") | key.startswith("has_"))),
        ("duration_without_unit", key.contains("duration") & ~(key.endswith("_seconds") | key.endswith("_hours"))),
        ("identifier_without_suffix", key.rlike("(^|_)(id|ids|uuid|guid|identifier)(_|$)") & ~key.endswith("_id")),
        ("count_without_suffix", key.rlike("(^|_)(count|counts|found)(_|$)") & ~key.endswith("_count")),
    ]
    viol = F.array(*[F.when(c, F.lit(r)) for r, c in rules])
    return (shapes.select(NAME, F.col("key").alias("property"), "rows",
                          F.explode(F.array_compact(viol)).alias("rule")))


# Registry of property types per event (our encoding of the tracking plan).
PROPERTY_TYPES = {
    "dedicated_onboarding_step_completed": {"step_name": "string", "step_index": "int",
                                            "duration_seconds": "int"},
    "dedicated_pipeline_executed": {"pipeline_id": "string", "project_id": "string", "status": "string",
                                    "duration_seconds": "int"},
    "dedicated_project_created": {"project_id": "string", "visibility_level": "string",
                                  "template_used": "boolean"},
    "dedicated_security_scan_completed": {"scan_type": "string", "vulnerabilities_found": "int",
                                          "severity_critical": "int"},
}


def property_types(events: DataFrame, registry: dict = PROPERTY_TYPES, props: str = "properties") -> DataFrame:
    """G-6: per (event, property) rows whose value does not parse as the
    registered type (present but not castable), and rows missing it. One
    pass: each row is expanded into its event's registered properties, then
    one grouped aggregate."""
    pairs = F.array(*[F.struct(F.lit(ev).alias("_ev"), F.lit(k).alias("property"),
                               F.lit(t).alias("expected_type"))
                      for ev, spec in registry.items() for k, t in spec.items()])
    rows = (events.where(F.col(NAME).isin(*registry))
                  .select(NAME, F.from_json(F.col(props), "map<string,string>").alias("_m"),
                          F.explode(pairs).alias("x"))
                  .where(F.col("x._ev") == F.col(NAME))
                  .select(NAME, "x.property", "x.expected_type",
                          F.try_element_at(F.col("_m"), F.col("x.property")).alias("_v")))
    bad = F.lit(False)
    for t in sorted({t for spec in registry.values() for t in spec.values()}):
        bad = bad | ((F.col("expected_type") == t) & F.col("_v").isNotNull() & F.col("_v").try_cast(t).isNull())
    return rows.groupBy(NAME, "property", "expected_type").agg(
        F.count_if(bad).alias("misfit_rows"), F.count_if(F.col("_v").isNull()).alias("missing_rows"))


# what a VARIANT calls the types of the tracking plan
VARIANT_TYPES = {"string": ["STRING"], "int": ["BIGINT"], "float": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"]}


def plan_violations(events: DataFrame, plan: dict[str, dict[str, str]] = C.PLANNED_PROPERTIES, props: str = "properties") -> DataFrame:
    """G-6 over the whole tracking plan: what the payloads hold against what was planned.

    One pass gives each event's payload schema (``schema_of_variant_agg`` merges the types of all rows; values
    of two kinds merge to VARIANT, nulls alone are VOID). One row per deviation: a planned property that no row
    has (``missing``), one with other types than planned (``wrong_type``), one that nobody planned
    (``unplanned``), and planned events without rows (``not_observed``).
    """
    spark = events.sparkSession
    # one row per planned property: a parameter table
    planned = F.broadcast(spark.createDataFrame([(e, k, t) for e, spec in plan.items() for k, t in spec.items()],
                                                "event_name string, property string, expected_type string"))
    merged = events.where(F.col(NAME).isin(*plan)).groupBy(NAME).agg(F.schema_of_variant_agg(F.try_parse_json(props)).alias("_s"))
    # OBJECT<key: TYPE, ...>: payloads are flat, so a nested type is one value
    field = F.regexp_extract_all(F.regexp_extract("_s", r"^OBJECT<(.*)>$", 1), F.lit(r"([^:<>, ]+: [A-Z]+)"), 1)
    seen = merged.select(NAME, F.explode_outer(field).alias("_f")).select(
        NAME, F.split_part("_f", F.lit(": "), F.lit(1)).alias("property"), F.split_part("_f", F.lit(": "), F.lit(2)).alias("observed_type"))
    fits = F.lit(False)
    for t, kinds in VARIANT_TYPES.items():
        fits = fits | ((F.col("expected_type") == t) & F.col("observed_type").isin(*kinds))
    both = planned.join(seen.where("property IS NOT NULL"), [NAME, "property"], "full")
    kind = (F.when(F.col("expected_type").isNull(), "unplanned").when(F.col("observed_type").isNull(), "missing")
             .when(~fits, "wrong_type"))
    deviations = both.join(F.broadcast(merged.select(NAME)), NAME, "left_semi").withColumn("violation", kind).where("violation IS NOT NULL")
    names = planned.select(NAME).distinct()
    absent = names.join(merged.select(NAME), NAME, "left_anti").select(
        NAME, F.lit(None).cast("string").alias("property"), F.lit(None).cast("string").alias("expected_type"),
        F.lit(None).cast("string").alias("observed_type"), F.lit("not_observed").alias("violation"))
    return deviations.select(*absent.columns).unionByName(absent)


def category_check(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """G-7: per event name: rows with NULL category, rows whose category
    differs from the catalog's, and whether the name is in the catalog."""
    cat = F.broadcast(catalog.select(NAME, F.col("category").alias("_expected")))
    j = events.select(NAME, "event_category").join(cat, NAME, "left")
    return j.groupBy(NAME).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_category").isNull()).alias("null_category"),
        F.count_if(F.col("event_category").isNotNull() & F.col("_expected").isNotNull() &
                   (F.col("event_category") != F.col("_expected"))).alias("wrong_category"),
        F.max(F.col("_expected").isNotNull()).alias("in_catalog"))


def opt_out_violations(events: DataFrame, opt_out: DataFrame) -> DataFrame:
    """G-8: rows still present for opted-out tenants, per tenant."""
    return (events.join(opt_out.select("tenant_id").distinct(), "tenant_id", "left_semi")
                  .groupBy("tenant_id").agg(F.count(F.lit(1)).alias("violating_rows")))


def erase_tenants(events: DataFrame, tenants: DataFrame) -> DataFrame:
    """G-9: the table without the erased tenants' rows (anti join); written
    back with dynamic partition overwrite this rewrites only touched dates."""
    return events.join(tenants.select("tenant_id").distinct(), "tenant_id", "left_anti")


def residency(events: DataFrame, dim_tenants: DataFrame, storage_region: str) -> DataFrame:
    """G-10: rows of tenants whose home region differs from the region the
    table is stored in, per tenant."""
    t = dim_tenants.where(F.col("is_current")).select("tenant_id", "region")
    return (events.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("rows"))
                  .join(t, "tenant_id", "left")
                  .withColumn("storage_region", F.lit(storage_region))
                  .withColumn("violation", F.coalesce(F.col("region") != F.lit(storage_region), F.lit(True))))


def deprecated_firing(events: DataFrame, deprecations: dict[str, str], grace_days: int = 90) -> DataFrame:
    """G-11: deprecated events still firing more than ``grace_days`` after
    their deprecation date: last fire date and rows after the grace end."""
    spark = events.sparkSession
    dep = F.broadcast(spark.createDataFrame(list(deprecations.items()), "event_name string, deprecated_at string")
                      .withColumn("deprecated_at", F.col("deprecated_at").cast("date")))
    j = events.select(NAME, F.to_date("event_timestamp").alias("d")).join(dep, NAME)
    grace_end = F.date_add(F.col("deprecated_at"), grace_days)
    return (j.groupBy(NAME, "deprecated_at")
             .agg(F.max("d").alias("last_fired"), F.count_if(F.col("d") > grace_end).alias("rows_after_grace"))
             .withColumn("status", F.when(F.col("rows_after_grace") > 0, "FAIL").otherwise("PASS")))


def plan_coverage(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """G-12: every registered event with its observed rows (0 when never
    seen) and whether it is P0; unregistered names observed are listed too."""
    seen = _names(events)
    reg = catalog.select(NAME, "is_p0")
    j = reg.join(seen, NAME, "full")
    return j.select(NAME, F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
                    F.coalesce("is_p0", F.lit(False)).alias("is_p0"),
                    F.when(F.col("is_p0").isNull(), "UNREGISTERED")
                     .when(F.col("rows").isNull(), F.when(F.col("is_p0"), "P0_MISSING").otherwise("NOT_OBSERVED"))
                     .otherwise("OBSERVED").alias("status"))

"""Data sets behind the summary report (R-*). Rendering (workbook, charts) is
not rebuilt; these frames are what it would show."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.compat import pct


def executive_summary(raw: DataFrame, fact: DataFrame, dim_tenants: DataFrame,
                      dim_users: DataFrame) -> DataFrame:
    """R-1: seven metrics as (metric_order, metric, value) rows. One
    aggregate per table, stacked into rows, then the two derived metrics."""
    r = raw.agg(F.count(F.lit(1)).cast("double").alias("raw"),
                F.countDistinct("event_name").cast("double").alias("types"))
    f = fact.agg(F.count(F.lit(1)).cast("double").alias("bi"))
    t = dim_tenants.agg(F.countDistinct("tenant_id").cast("double").alias("tenants"))
    u = dim_users.agg(F.countDistinct("user_id").cast("double").alias("users"))

    def rows(df, pairs):
        return df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("v"))
                                             for k, c in pairs])).alias("x")).select("x.*")
    parts = (rows(r, [("raw", "raw"), ("types", "types")]).unionByName(rows(f, [("bi", "bi")]))
             .unionByName(rows(t, [("tenants", "tenants")])).unionByName(rows(u, [("users", "users")])))
    wide = parts.agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(k)
                       for k in ("raw", "bi", "tenants", "users", "types")])
    metrics = [
        (1, "Total Raw Events", F.col("raw")),
        (2, "Total BI Events (Deduplicated)", F.col("bi")),
        (3, "Duplicate Events Removed", F.col("raw") - F.col("bi")),
        (4, "Active Tenants", F.col("tenants")),
        (5, "Total Users", F.col("users")),
        (6, "Distinct Event Types", F.col("types")),
        (7, "Dedup Rate %", F.round((F.col("raw") - F.col("bi")) * 100.0 / F.col("raw"), 2)),
    ]
    return wide.select(F.explode(F.array(*[F.struct(F.lit(i).alias("metric_order"), F.lit(m).alias("metric"),
                                                    v.alias("value")) for i, m, v in metrics])).alias("m")) \
               .select("m.*")


def event_volume(fact: DataFrame) -> DataFrame:
    """R-2: per (category, name): events, tenants, users, first/last date."""
    return fact.groupBy("event_category", "event_name").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.countDistinct("tenant_id").alias("tenants"),
        F.countDistinct("user_id").alias("users"),
        F.min("event_date").alias("first_seen"),
        F.max("event_date").alias("last_seen"))


def category_distribution(fact: DataFrame) -> DataFrame:
    """R-3: events per category and share of all events (2 dp). The share
    window runs over the handful of aggregated category rows."""
    g = fact.groupBy("event_category").agg(F.count(F.lit(1)).alias("event_count"))
    tot = F.sum("event_count").over(Window.partitionBy(F.lit(0)))
    return g.select("event_category", "event_count",
                    F.round(F.col("event_count").cast("double") * 100.0 / tot, 2).alias("share_pct"))


def tenant_overview(fact: DataFrame, dim_tenants: DataFrame) -> DataFrame:
    """R-4: current tenants with distinct events, active users and event
    types. The fact is aggregated per tenant first; tenants without events
    get zeros."""
    # event_id is unique in the fact (dedupe; checked by Q-14), so the
    # distinct count of ids is a plain count and needs no Expand leg
    agg = fact.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("total_events"),
                                        F.countDistinct("user_id").alias("active_users"),
                                        F.countDistinct("event_name").alias("event_types_used"))
    t = dim_tenants.where(F.col("is_current")).select(
        "tenant_id", "tenant_name", "region", "plan_tier", "seat_limit", "sso_enabled", "provisioning_date")
    out = t.join(agg, "tenant_id", "left")
    for c in ("total_events", "active_users", "event_types_used"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast("long")))
    return out


def quality_scorecard(recon: DataFrame, nulls: DataFrame, raw: DataFrame, fact: DataFrame) -> DataFrame:
    """R-5: reconciliation status counts; field completeness (rows × 5
    checks vs nulls of event_id, user_id, version); unique vs duplicate rows.
    Rows: (panel, label, value)."""
    s = recon.groupBy("status").agg(F.count(F.lit(1)).alias("value")) \
             .select(F.lit("reconciliation").alias("panel"), F.col("status").alias("label"),
                     F.col("value").cast("long").alias("value"))
    n = nulls.agg((F.sum("total_events") * 5).cast("long").alias("checks"),
                  (F.sum("null_event_id") + F.sum("null_user_id") + F.sum("null_version")).cast("long")
                  .alias("nulls"))
    n = n.select(F.explode(F.array(
        F.struct(F.lit("Clean").alias("label"), (F.col("checks") - F.col("nulls")).alias("value")),
        F.struct(F.lit("Null/Empty").alias("label"), F.col("nulls").alias("value")))).alias("x")) \
         .select(F.lit("completeness").alias("panel"), "x.*")
    rc = raw.agg(F.count(F.lit(1)).alias("raw"))
    fc = fact.agg(F.count(F.lit(1)).alias("bi"))
    d = (rc.select(F.lit("Duplicates").alias("label"), F.col("raw").alias("value"))
           .unionByName(fc.select(F.lit("Unique").alias("label"), F.col("bi").alias("value"))))
    d = d.agg(F.max(F.when(F.col("label") == "Duplicates", F.col("value"))).alias("raw"),
              F.max(F.when(F.col("label") == "Unique", F.col("value"))).alias("bi")) \
         .select(F.explode(F.array(
             F.struct(F.lit("Unique").alias("label"), F.col("bi").alias("value")),
             F.struct(F.lit("Duplicates").alias("label"), (F.col("raw") - F.col("bi")).alias("value"))))
             .alias("x")).select(F.lit("deduplication").alias("panel"), "x.*")
    return s.unionByName(n).unionByName(d)


def funnel_share(funnel_rows: DataFrame) -> DataFrame:
    """R-6: users per step as a share of the largest step (1 dp); the window
    spans the 8 funnel rows."""
    mx = F.max("users").over(Window.partitionBy(F.lit(0)))
    return funnel_rows.select("step_number", "step_name", "users",
                              pct(F.col("users"), mx, 1).alias("share_of_max_pct"))


def cohort_trend(cohorts: DataFrame) -> DataFrame:
    """R-7: the cohort series for the trend chart."""
    return cohorts.select("cohort_week", "invited", "accept_rate", "activation_rate")

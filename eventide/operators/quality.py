"""Reconciliation and data-quality operators (Q-*).

Every check is one or two grouped aggregations (combined map-side) plus joins
of aggregated results; none collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.compat import boundary_diff, null_or_empty, pct, seconds_between

TS, NAME = "event_timestamp", "event_name"


def _in_window(df: DataFrame, window: C.Window | None, col: str = TS) -> DataFrame:
    if window is None:
        return df
    c = F.col(col)
    lo, hi = F.lit(window.start), F.lit(window.end)
    if col == "event_date":
        return df.where((c >= lo.cast("date")) & (c < hi.cast("date")))
    return df.where((c >= lo.cast("timestamp_ntz")) & (c < hi.cast("timestamp_ntz")))


# ------------------------------------------------------------------ Q-1..Q-4
def layer_counts(df: DataFrame, grain: Sequence[str], prefix: str) -> DataFrame:
    """Rows and distinct event ids per grain (Q-3 layer extract)."""
    if "event_date" in grain and "event_date" not in df.columns:
        df = df.withColumn("event_date", F.to_date(TS))
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias(f"{prefix}_rows"),
                                  F.countDistinct("event_id").alias(f"{prefix}_distinct"))


def layer_extract(df: DataFrame, prefix: str, window: C.Window | None = None) -> DataFrame:
    """Q-3: per (event, date) counts, distinct ids and tenants reporting, for
    one layer (raw: event time; BI: its event_date column)."""
    if "event_date" in df.columns:
        df = _in_window(df, window, "event_date")
    else:
        df = _in_window(df, window).withColumn("event_date", F.to_date(TS))
    tenants = "tenants_reporting" if prefix == "raw" else "tenants_in_model"
    return df.groupBy(NAME, "event_date").agg(F.count(F.lit(1)).alias(f"{prefix}_event_count"),
                                              F.countDistinct("event_id").alias(f"{prefix}_distinct_event_count"),
                                              F.countDistinct("tenant_id").alias(tenants))


def runbook_diff(raw: DataFrame, bi: DataFrame, window: C.Window, warn_pct: float = 0.1) -> DataFrame:
    """Q-4: the runbook's raw-vs-BI comparison of distinct ids with its four
    outcomes: ORPHAN IN BI, MISSING FROM BI, VARIANCE EXCEEDS THRESHOLD, PASS."""
    r = (_in_window(raw, window).groupBy(NAME, F.to_date(TS).alias("event_date"))
         .agg(F.countDistinct("event_id").alias("raw_count")))
    b = _in_window(bi, window, "event_date").groupBy(NAME, "event_date") \
        .agg(F.countDistinct("event_id").alias("bi_count"))
    j = r.join(b, [NAME, "event_date"], "full")
    rc, bc = F.coalesce("raw_count", F.lit(0).cast("long")), F.coalesce("bi_count", F.lit(0).cast("long"))
    ratio = F.abs(rc - bc).cast("double") * 100.0 / F.col("raw_count").cast("double")
    return j.select(NAME, "event_date", rc.alias("raw_count"), bc.alias("bi_count"), (rc - bc).alias("count_diff"),
                    F.when(rc == 0, F.lit(None).cast("double")).otherwise(F.round(ratio, 4)).alias("variance_pct"),
                    F.when((rc == 0) & (bc > 0), "ORPHAN IN BI").when((bc == 0) & (rc > 0), "MISSING FROM BI")
                     .when(ratio > warn_pct, "VARIANCE EXCEEDS THRESHOLD").otherwise("PASS")
                     .alias("reconciliation_status"))


def reconcile(raw: DataFrame, bi: DataFrame, grain: Sequence[str] = ("event_name", "event_date"),
              th: C.Thresholds = C.Thresholds(), window: C.Window | None = None,
              keep_nulls: bool = False) -> DataFrame:
    """Q-1 / Q-2 / Q-4 / Q-21: per grain, raw vs BI rows and distinct ids,
    their difference, variance % (4 dp; NULL when raw has none) and a status:
    ORPHAN (only BI), MISSING (only raw), FAIL (> fail %), WARN (> warn %),
    PASS. ``two_band`` gives the template's FAIL/WARN/PASS wording;
    ``keep_nulls`` leaves absent-side counts NULL (template)."""
    grain = list(grain)
    if window is not None:
        raw = _in_window(raw, window)
        bi = _in_window(bi, window, "event_date" if "event_date" in bi.columns else TS)
    r = layer_counts(raw, grain, "raw")
    b = layer_counts(bi, grain, "bi")
    j = r.join(b, grain, "full")
    rd, bd = F.coalesce(F.col("raw_distinct"), F.lit(0)), F.coalesce(F.col("bi_distinct"), F.lit(0))
    diff = rd - bd
    var = F.when(rd == 0, F.lit(None).cast("double")).otherwise(
        F.round(F.abs(diff).cast("double") * F.lit(100.0) / rd.cast("double"), 4))
    ratio = F.abs(diff).cast("double") * F.lit(100.0) / F.col("raw_distinct").cast("double")
    if th.two_band:
        status = (F.when((rd == 0) & (bd > 0), "FAIL — Orphan rows in transformed layer")
                   .when((bd == 0) & (rd > 0), "FAIL — Events missing from transformed layer")
                   .when(ratio > th.warn_pct, f"WARN — Variance exceeds {th.warn_pct}% threshold")
                   .otherwise("PASS"))
    else:
        status = (F.when((rd == 0) & (bd > 0), "ORPHAN")
                   .when((bd == 0) & (rd > 0), "MISSING")
                   .when(ratio > th.fail_pct, "FAIL")
                   .when(ratio > th.warn_pct, "WARN")
                   .otherwise("PASS"))
    counts = ([F.col(c) for c in ("raw_rows", "bi_rows", "raw_distinct", "bi_distinct")] if keep_nulls else
              [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
               for c in ("raw_rows", "bi_rows", "raw_distinct", "bi_distinct")])
    return j.select(*grain, *counts, diff.alias("count_diff"), var.alias("variance_pct"),
                    status.alias("status"))


def status_summary(recon: DataFrame) -> DataFrame:
    """Q-5: checks per status and the pass rate (PASS / all × 100, 1 dp)."""
    g = recon.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))
    tot = F.sum("checks").over(Window.partitionBy(F.lit(0)))  # one row per status
    passed = F.sum(F.when(F.col("status") == "PASS", F.col("checks")).otherwise(0)).over(Window.partitionBy(F.lit(0)))
    return g.select("status", "checks", F.round(passed.cast("double") * 100.0 / tot, 1).alias("pass_rate_pct"))


# ------------------------------------------------------------------ Q-6..Q-8
CRITICAL5 = ("event_id", "tenant_id", "user_id", "event_timestamp", "platform_version")


def _nulls(c: str) -> Column:
    return F.col(c).isNull() if c == TS else null_or_empty(c)


def null_checks(raw: DataFrame) -> DataFrame:
    """Q-6: per event name, null-or-empty counts of six fields and the null
    rate over five of them (session excluded), 4 dp."""
    names = {"event_id": "null_event_id", "tenant_id": "null_tenant_id", "user_id": "null_user_id",
             "event_timestamp": "null_timestamp", "platform_version": "null_version",
             "session_id": "null_session_id"}
    g = raw.groupBy(NAME).agg(F.count(F.lit(1)).alias("total_events"),
                              *[F.count_if(_nulls(c)).alias(n) for c, n in names.items()])
    s5 = sum(F.col(names[c]) for c in CRITICAL5)
    return g.withColumn("null_rate_pct", F.round(s5.cast("double") * 100.0 / (F.col("total_events") * 5), 4))


def null_verdict(checks: DataFrame) -> DataFrame:
    """Q-7: FAIL when event_id, user_id or version has a null (the pipeline's
    rule; tenant and timestamp are not part of it)."""
    crit = F.col("null_event_id") + F.col("null_user_id") + F.col("null_version")
    return checks.select(NAME, crit.alias("critical_nulls"),
                         F.when(crit > 0, "FAIL").otherwise("PASS").alias("status"))


def null_checks_template(raw: DataFrame, window: C.Window) -> DataFrame:
    """Q-8: per (event name, date) in the range, eight null counts, the
    5-field rate and verdict; only groups with a null among the five."""
    names = {"event_id": "null_event_id", "tenant_id": "null_tenant_id", "user_id": "null_user_id",
             "event_timestamp": "null_timestamp", "event_name": "null_event_name",
             "platform_version": "null_platform_version", "session_id": "null_session_id",
             "event_source": "null_event_source"}
    g = (_in_window(raw, window).withColumn("event_date", F.to_date(TS))
         .groupBy(NAME, "event_date")
         .agg(F.count(F.lit(1)).alias("total_events"),
              *[F.count_if(_nulls(c)).alias(n) for c, n in names.items()]))
    s5 = (F.col("null_event_id") + F.col("null_tenant_id") + F.col("null_user_id") +
          F.col("null_timestamp") + F.col("null_platform_version"))
    return (g.where(s5 > 0)
             .withColumn("null_rate_pct", F.round(s5.cast("double") * 100.0 / (F.col("total_events") * 5), 4))
             .withColumn("validation_result", F.lit("FAIL — Required fields have NULL values")))


# ------------------------------------------------------------------ Q-9/Q-10
def duplicates(raw: DataFrame) -> DataFrame:
    """Q-9: ids seen more than once by (id, name, tenant); per (name,
    tenant): duplicated ids, their rows, excess rows, max occurrences."""
    d = (raw.groupBy("event_id", NAME, "tenant_id").agg(F.count(F.lit(1)).alias("occ"))
            .where(F.col("occ") > 1))
    return d.groupBy(NAME, "tenant_id").agg(
        F.count(F.lit(1)).alias("duplicate_event_ids"),
        F.sum("occ").cast("long").alias("total_duplicate_rows"),
        (F.sum("occ") - F.count(F.lit(1))).cast("long").alias("excess_rows"),
        F.max("occ").alias("max_occurrences"))


def duplicates_template(raw: DataFrame, window: C.Window) -> DataFrame:
    """Q-10: + user key, first/last seen, boundary-counted span in seconds,
    the group's duplicate rate against all its rows and the probable cause.
    One scan: the per-id groups give both the duplicate statistics (groups
    seen more than once) and the group totals the rate needs (all groups),
    instead of a correlated subquery."""
    r = _in_window(raw, window)
    keys = ["event_id", NAME, "tenant_id", "user_id"]
    ids = (r.groupBy(*keys).agg(F.count(F.lit(1)).alias("occ"), F.min(TS).alias("first_seen"),
                                F.max(TS).alias("last_seen"))
            .withColumn("span", boundary_diff("second", "first_seen", "last_seen"))
            .withColumn("_dup", F.col("occ") > 1))
    dup = F.col("_dup")
    g = ids.groupBy(NAME, "tenant_id").agg(
        F.count_distinct(F.when(dup, F.col("event_id"))).alias("duplicate_event_count"),
        F.sum(F.when(dup, F.col("occ"))).cast("long").alias("total_duplicate_rows"),
        F.avg(F.when(dup, F.col("span"))).alias("avg_time_span_seconds"),
        F.max(F.when(dup, F.col("occ"))).alias("max_occurrences"),
        F.sum("occ").alias("_total"))
    g = (g.where(F.col("duplicate_event_count") > 0)
          .withColumn("excess_rows", (F.col("total_duplicate_rows") - F.col("duplicate_event_count")).cast("long")))
    avg = F.col("avg_time_span_seconds")
    cause = (F.when(avg < C.RETRY_MAX_SECONDS, "Likely: Client retry / double fire")
              .when(avg.between(C.RETRY_MAX_SECONDS, C.REPLAY_MAX_SECONDS), "Likely: Collector replay")
              .otherwise("Likely: Pipeline re-ingestion"))
    return (g.withColumn("duplicate_rate_pct", pct("excess_rows", "_total", 4))
             .withColumn("probable_cause", cause)
             .select(NAME, "tenant_id", "duplicate_event_count", "total_duplicate_rows", "excess_rows",
                     "avg_time_span_seconds", "max_occurrences", "duplicate_rate_pct", "probable_cause"))


# ---------------------------------------------------------------- Q-11..Q-13
def p0_coverage(raw: DataFrame, expected: Sequence[str] = tuple(C.P0_EVENTS),
                window: C.Window | None = None, gaps_only: bool = False) -> DataFrame:
    """Q-11 / Q-12: for every tenant seen, the count of each expected event;
    MISSING when 0. One grouped pass with a conditional count per expected
    event, then unpivot — no tenant × event cross join."""
    r = _in_window(raw, window)
    g = r.groupBy("tenant_id").agg(*[F.count_if((F.col(NAME) == e) & F.col("event_id").isNotNull())
                                     .alias(f"_c{i}") for i, e in enumerate(expected)])
    cells = F.array(*[F.struct(F.lit(e).alias(NAME), F.col(f"_c{i}").alias("event_count"))
                      for i, e in enumerate(expected)])
    out = (g.select("tenant_id", F.explode(cells).alias("c")).select("tenant_id", "c.*")
            .withColumn("status", F.when(F.col("event_count") == 0, "MISSING").otherwise("OK")))
    return out.where(F.col("status") == "MISSING") if gaps_only else out


def coverage_ratio(cov: DataFrame) -> DataFrame:
    """Q-13: OK cells / all cells in percent (1 dp)."""
    return cov.agg(F.count(F.lit(1)).alias("total_checks"),
                   F.count_if(F.col("status") == "OK").alias("ok_checks")) \
              .select("total_checks", "ok_checks", pct("ok_checks", "total_checks", 1).alias("coverage_pct"))


# ---------------------------------------------------------------- Q-14..Q-19
def unique_check(df: DataFrame, key: str, table: str) -> DataFrame:
    """Q-14: keys occurring more than once (count of such keys and their rows)."""
    d = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return d.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                  F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows")) \
            .select(F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), "*",
                    F.when(F.col("duplicate_keys") == 0, "PASS").otherwise("FAIL").alias("status"))


def not_null_check(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    """Q-15: NULL count per listed column, one pass."""
    g = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in cols])
    return (g.select(F.explode(cells).alias("c")).select(F.lit(table).alias("table_name"), "c.*")
             .withColumn("status", F.when(F.col("null_rows") == 0, "PASS").otherwise("FAIL")))


def accepted_values(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Q-16 / Q-30: values outside the allowed list with their row counts
    (``isin`` on a fixed list; the check itself is a filter + aggregate)."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed))
              .groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(col).alias("column_name"), "value", "rows"))


def relationships(child: DataFrame, parent: DataFrame, key: str, label: str) -> DataFrame:
    """Q-17: child keys without a parent row (anti join on distinct keys)."""
    ck = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    pk = parent.select(key).distinct()
    return ck.join(pk, key, "left_anti").select(F.lit(label).alias("relationship"),
                                                F.col(key).alias("orphan_key"), "rows")


def timestamp_order(raw: DataFrame) -> DataFrame:
    """Q-18: rows whose collector time precedes the event time, per event name."""
    return (raw.groupBy(NAME).agg(F.count(F.lit(1)).alias("rows"),
                                  F.count_if(F.col("collector_tstamp") < F.col(TS)).alias("violations"))
               .withColumn("status", F.when(F.col("violations") > 0, "FAIL").otherwise("PASS")))


def freshness_exact(raw: DataFrame, max_lag_hours: float = 4.0, arrival_col: str = "collector_tstamp"
                    ) -> DataFrame:
    """Q-19 with exact interpolated P50/P90 (range-partitioned positions)."""
    from ..functions.ranking import exact_quantiles
    lagged = (raw.withColumn("event_date", F.to_date(TS))
                 .withColumn("_lag", seconds_between(TS, arrival_col) / 60.0))
    base = lagged.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.max("_lag"), 2).alias("max_lag_minutes"),
        F.count_if(F.col("_lag") > max_lag_hours * 60).alias("late_rows"))
    q = exact_quantiles(lagged, ["event_date"], "_lag", [0.5, 0.9], ["p50", "p90"])
    return (base.join(q, "event_date", "left")
                .select("event_date", "rows", F.round("p50", 2).alias("p50_lag_minutes"),
                        F.round("p90", 2).alias("p90_lag_minutes"), "max_lag_minutes", "late_rows",
                        F.when(F.col("late_rows") > 0, "WARN").otherwise("PASS").alias("status")))


def freshness(raw: DataFrame, max_lag_hours: float = 4.0, arrival_col: str = "collector_tstamp",
              accuracy: int = 10000) -> DataFrame:
    """Q-19: load lag (arrival - event) per event date: P50 / P90 (sketch)
    and max in minutes, rows over the objective."""
    lag = seconds_between(TS, arrival_col) / 60.0
    return (raw.withColumn("event_date", F.to_date(TS)).withColumn("_lag", lag)
               .groupBy("event_date")
               .agg(F.count(F.lit(1)).alias("rows"),
                    F.percentile_approx("_lag", [0.5, 0.9], accuracy).alias("_q"),
                    F.round(F.max("_lag"), 2).alias("max_lag_minutes"),
                    F.count_if(F.col("_lag") > max_lag_hours * 60).alias("late_rows"))
               .select("event_date", "rows", F.round(F.col("_q")[0], 2).alias("p50_lag_minutes"),
                       F.round(F.col("_q")[1], 2).alias("p90_lag_minutes"), "max_lag_minutes", "late_rows",
                       F.when(F.col("late_rows") > 0, "WARN").otherwise("PASS").alias("status")))


# ---------------------------------------------------------------- Q-20..Q-24
def schema_drift(raw: DataFrame, bi: DataFrame) -> DataFrame:
    """Q-20: event names present in raw but absent from BI (and reverse)."""
    r = raw.groupBy(NAME).agg(F.count(F.lit(1)).alias("raw_rows"))
    b = bi.groupBy(NAME).agg(F.count(F.lit(1)).alias("bi_rows"))
    j = r.join(b, NAME, "full")
    return (j.where(F.col("raw_rows").isNull() | F.col("bi_rows").isNull())
             .select(NAME, F.coalesce("raw_rows", F.lit(0).cast("long")).alias("raw_rows"),
                     F.coalesce("bi_rows", F.lit(0).cast("long")).alias("bi_rows"),
                     F.when(F.col("bi_rows").isNull(), "MISSING_IN_BI").otherwise("MISSING_IN_RAW")
                      .alias("drift")))


def column_profile(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Per (date, column): the column's type, the rows and how many of them have a value. One pass; the
    columns are unpivoted after the aggregation, so each date sends one row per task."""
    cols = [c for c in df.columns if c != date_col]
    types = dict(df.dtypes)
    g = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(c).alias("non_null")) for c in cols])
    return g.select(F.col(date_col).alias("event_date"), F.col("_rows").alias("rows"), F.explode(cells).alias("c")).select("event_date", "rows", "c.*")


def column_drift(a: DataFrame, b: DataFrame) -> DataFrame:
    """Q-20 (columns): the difference of two layers' profiles (``column_profile``), per column and kind:
    ``removed`` / ``added`` columns, a changed ``type``, and dates on which a column that has values in
    ``a`` has none in ``b`` (``emptied``) or the other way round (``filled``)."""
    x = a.select("event_date", "column_name", F.col("data_type").alias("type_a"), F.col("non_null").alias("_a"))
    y = b.select("event_date", "column_name", F.col("data_type").alias("type_b"), F.col("non_null").alias("_b"))
    kinds = F.array_compact(F.array(
        F.when(F.col("type_b").isNull(), "removed").when(F.col("type_a").isNull(), "added").when(F.col("type_a") != F.col("type_b"), "type"),
        F.when((F.col("_a") > 0) & (F.col("_b") == 0), "emptied").when((F.col("_a") == 0) & (F.col("_b") > 0), "filled")))
    return (x.join(y, ["event_date", "column_name"], "full").withColumn("drift", F.explode(kinds))
             .groupBy("column_name", "drift", "type_a", "type_b")
             .agg(F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"), F.count(F.lit(1)).alias("dates")))


def timezone_shift(raw: DataFrame, zone: str) -> DataFrame:
    """Q-22: daily counts under UTC vs under a second zone, per date. One
    pass: every row contributes its UTC date and its local date."""
    # wall-clock UTC → wall clock in ``zone``, both timestamp_ntz (no session zone involved)
    local = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(TS)))
    days = F.array(F.struct(F.lit("utc").alias("k"), F.to_date(TS).alias("event_date")),
                   F.struct(F.lit("local").alias("k"), local.alias("event_date")))
    g = (raw.select(F.explode(days).alias("x")).select("x.*")
            .groupBy("event_date").agg(F.count_if(F.col("k") == "utc").alias("utc_rows"),
                                       F.count_if(F.col("k") == "local").alias("local_rows")))
    return g.select("event_date", "utc_rows", "local_rows", (F.col("local_rows") - F.col("utc_rows")).alias("shift"))


def late_arrivals(raw: DataFrame, max_lag_hours: float = 4.0) -> DataFrame:
    """Q-23: rows arriving more than ``max_lag_hours`` after the event, per
    event date (these dates need M-14 reprocessing)."""
    late = seconds_between(TS, "collector_tstamp") > F.lit(max_lag_hours * 3600)
    return (raw.where(late).groupBy(F.to_date(TS).alias("event_date"))
               .agg(F.count(F.lit(1)).alias("late_rows"), F.countDistinct(NAME).alias("event_names")))


# FIXED VALUES — discrepancy type codes of the discrepancy log.
DISCREPANCY_CODES = ["ROW_COUNT", "MISSING_EVENT", "DUPLICATE", "NULL_FIELD", "SCHEMA_DRIFT", "TIMEZONE",
                     "LATE_ARRIVAL", "FILTER"]


def discrepancy_log(recon: DataFrame, nulls: DataFrame, dups: DataFrame, drift: DataFrame,
                    late: DataFrame, tz_shift: DataFrame | None = None,
                    tenant_recon: DataFrame | None = None,
                    p0_events=tuple(C.P0_EVENTS)) -> DataFrame:
    """Q-24: every WARN/FAIL finding as one typed row (check_name, code,
    event_name, event_date, detail, severity, is_p0, escalation). Codes are
    the log's eight types; findings on a P0 event escalate immediately."""
    def s(c):
        return F.col(c).cast("string")
    missing = F.col("status").isin("MISSING", "ORPHAN")
    r = (recon.where(F.col("status") != "PASS")
              .select(F.lit("reconciliation").alias("check_name"),
                      F.when(missing, "MISSING_EVENT").otherwise("ROW_COUNT").alias("code"), NAME,
                      F.col("event_date").cast("date").alias("event_date"),
                      F.concat(F.col("status"), F.lit(" raw="), s("raw_distinct"), F.lit(" bi="), s("bi_distinct"))
                       .alias("detail"),
                      F.when(F.col("status") == "WARN", "WARN").otherwise("FAIL").alias("severity")))
    n = (null_verdict(nulls).where(F.col("status") == "FAIL")
         .select(F.lit("null_fields").alias("check_name"), F.lit("NULL_FIELD").alias("code"), NAME,
                 F.lit(None).cast("date").alias("event_date"),
                 F.concat(F.lit("critical_nulls="), s("critical_nulls")).alias("detail"),
                 F.lit("FAIL").alias("severity")))
    d = dups.select(F.lit("duplicates").alias("check_name"), F.lit("DUPLICATE").alias("code"), NAME,
                    F.lit(None).cast("date").alias("event_date"),
                    F.concat(F.lit("tenant="), F.col("tenant_id"), F.lit(" excess="), s("excess_rows")).alias("detail"),
                    F.lit("WARN").alias("severity"))
    sd = drift.select(F.lit("schema_drift").alias("check_name"), F.lit("SCHEMA_DRIFT").alias("code"), NAME,
                      F.lit(None).cast("date").alias("event_date"),
                      F.concat(F.col("drift"), F.lit(" raw_rows="), s("raw_rows"), F.lit(" bi_rows="), s("bi_rows"))
                       .alias("detail"),
                      F.lit("FAIL").alias("severity"))
    la = late.select(F.lit("late_arrival").alias("check_name"), F.lit("LATE_ARRIVAL").alias("code"),
                     F.lit(None).cast("string").alias(NAME), "event_date",
                     F.concat(F.lit("late_rows="), s("late_rows")).alias("detail"),
                     F.lit("WARN").alias("severity"))
    out = r.unionByName(n).unionByName(d).unionByName(sd).unionByName(la)
    if tz_shift is not None:
        out = out.unionByName(
            tz_shift.where(F.col("shift") != 0)
                    .select(F.lit("timezone_shift").alias("check_name"), F.lit("TIMEZONE").alias("code"),
                            F.lit(None).cast("string").alias(NAME), "event_date",
                            F.concat(F.lit("shift="), s("shift")).alias("detail"), F.lit("WARN").alias("severity")))
    if tenant_recon is not None:
        out = out.unionByName(
            tenant_recon.where(F.col("status") != "PASS")
                        .select(F.lit("tenant_reconciliation").alias("check_name"), F.lit("FILTER").alias("code"),
                                NAME, F.lit(None).cast("date").alias("event_date"),
                                F.concat(F.col("status"), F.lit(" tenant="), F.col("tenant_id")).alias("detail"),
                                F.when(F.col("status") == "WARN", "WARN").otherwise("FAIL").alias("severity")))
    p0 = F.col(NAME).isin(*p0_events)
    return (out.withColumn("is_p0", F.coalesce(p0, F.lit(False)))
               .withColumn("escalation", F.when(F.col("is_p0"), "immediate").otherwise("standard")))


# ---------------------------------------------------------------- Q-25..Q-28
def run_history(recon_daily: DataFrame) -> DataFrame:
    """Run history derived from a daily reconciliation: each event date is
    one run; a non-PASS check opens on its run date and resolves on the next
    PASS run of the same event (NULL when never)."""
    h = recon_daily.select(F.col("event_date").alias("run_date"), NAME,
                           F.lit("reconciliation").alias("check_type"), "status")
    nxt = Window.partitionBy(NAME).orderBy("run_date")
    nxt_pass = F.min(F.when(F.col("status") == "PASS", F.col("run_date"))).over(
        nxt.rowsBetween(1, Window.unboundedFollowing))
    return h.withColumn("resolved_at", F.when(F.col("status") != "PASS", nxt_pass))


def run_calendar(history: DataFrame) -> DataFrame:
    """The runs that were due, numbered: every day from the first to the last run of the history."""
    ends = history.agg(F.min("run_date").alias("_lo"), F.max("run_date").alias("_hi")).where("_lo IS NOT NULL")
    return ends.select("_lo", F.explode(F.sequence("_lo", "_hi")).alias("run_date")).select("run_date", F.date_diff("run_date", "_lo").alias("run_no"))


def _streaks(history: DataFrame, statuses: Sequence[str], calendar: DataFrame | None, length: str) -> DataFrame:
    """Runs of an event in ``statuses`` without a gap in the calendar: a run with another status, or a
    run that did not report the event, ends a streak. An event has one row a day, so its window is small."""
    due = F.broadcast(calendar if calendar is not None else run_calendar(history))      # one row a day
    w = Window.partitionBy(NAME).orderBy("run_no")
    found = history.where(F.col("status").isin(*statuses)).join(due, "run_date")
    return (found.withColumn("_streak", F.col("run_no") - F.row_number().over(w)).groupBy(NAME, "_streak")
                 .agg(F.min("run_date").alias("first_run"), F.max("run_date").alias("last_run"), F.count(F.lit(1)).alias(length))
                 .drop("_streak"))


def escalations(history: DataFrame, runs: int = 3, calendar: DataFrame | None = None) -> DataFrame:
    """Q-25: an event in WARN for ``runs`` or more consecutive runs of the calendar → FAIL."""
    return (_streaks(history, ["WARN"], calendar, "consecutive_warns").where(F.col("consecutive_warns") >= runs)
            .withColumn("escalated_status", F.lit("FAIL")))


def incidents(history: DataFrame, p0: Sequence[str] = tuple(C.P0_EVENTS), runs: int = 3, calendar: DataFrame | None = None) -> DataFrame:
    """Q-25: the incidents: P0 events that failed (or went missing), one per streak of runs, and P0 events
    whose warnings were escalated."""
    own = history.where(F.col(NAME).isin(*p0))
    failed = _streaks(own, ["FAIL", "MISSING"], calendar, "runs").withColumn("cause", F.lit("FAIL"))
    warned = escalations(own, runs, calendar).select(NAME, "first_run", "last_run", F.col("consecutive_warns").alias("runs"), F.lit("ESCALATED_WARN").alias("cause"))
    return failed.unionByName(warned)


def stale_failures(history: DataFrame, as_of: str, business_days: int = 3) -> DataFrame:
    """Q-26: FAIL findings unresolved for more than ``business_days``
    weekdays (counted between open and resolution or ``as_of``)."""
    end = F.coalesce(F.col("resolved_at"), F.lit(as_of).cast("date"))
    days = F.expr("filter(sequence(date_add(run_date, 1), _end), d -> dayofweek(d) BETWEEN 2 AND 6)")
    f = (history.where(F.col("status").isin("FAIL", "MISSING", "ORPHAN"))
                .withColumn("_end", end)
                .withColumn("open_business_days", F.when(F.col("_end") > F.col("run_date"), F.size(days))
                            .otherwise(F.lit(0))))
    return f.where(F.col("open_business_days") > business_days).drop("_end")


def recurring(history: DataFrame, min_count: int = 3) -> DataFrame:
    """Q-27: the same event and finding type occurring ≥ ``min_count`` times."""
    return (history.where(F.col("status") != "PASS").groupBy(NAME, "status")
                   .agg(F.count(F.lit(1)).alias("occurrences"))
                   .where(F.col("occurrences") >= min_count))


def weekly_health(history: DataFrame) -> DataFrame:
    """Q-28: per ISO week: checks, pass, warn, fail; Degraded when any FAIL."""
    wk = F.date_sub(F.col("run_date"), ((F.dayofweek("run_date") + 5) % 7).cast("int"))
    s = F.col("status")
    g = history.groupBy(wk.alias("week_start")).agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(s == "PASS").alias("passed"),
        F.count_if(s == "WARN").alias("warned"),
        F.count_if(s.isin("FAIL", "MISSING", "ORPHAN")).alias("failed"))
    return g.withColumn("health", F.when(F.col("failed") > 0, "Degraded").otherwise("Healthy"))


# ---------------------------------------------------------------- Q-29..Q-31
def cardinality(raw: DataFrame) -> DataFrame:
    """Q-29: children linked to more than one parent: user → tenant,
    session → user, event → session. One pass: the three (child, parent)
    pairs of every row are stacked, then one two-level aggregate."""
    rules = [("user→one tenant", "user_id", "tenant_id"), ("session→one user", "session_id", "user_id"),
             ("event→one session", "event_id", "session_id")]
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(c).alias("child"), F.col(p).alias("parent"))
                      for r, c, p in rules])
    per_child = (raw.select(F.explode(pairs).alias("x")).select("x.*")
                    .where(F.col("child").isNotNull() & (F.col("child") != ""))
                    .groupBy("rule", "child").agg(F.countDistinct("parent").alias("parents")))
    found = per_child.groupBy("rule").agg(F.count_if(F.col("parents") > 1).alias("violations"))
    spark = raw.sparkSession
    all_rules = spark.createDataFrame([(r,) for r, _, _ in rules], "rule string")
    return all_rules.join(found, "rule", "left").select(
        "rule", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))


UUID_V4 = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
SEMVER = r"^[0-9]+\.[0-9]+\.[0-9]+$"


def format_checks(raw: DataFrame, limits: dict[str, int] = C.COLUMN_LENGTHS) -> DataFrame:
    """Q-31: per event name, ids not UUID v4, versions not of three numbers, and for every limited column
    the values that are too long."""
    return raw.groupBy(NAME).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("event_id").rlike(UUID_V4)).alias("bad_event_id"),
        F.count_if(F.col("platform_version").isNotNull() & ~F.col("platform_version").rlike(SEMVER))
         .alias("bad_version"),
        *[F.count_if(F.length(c) > n).alias(f"long_{c}") for c, n in limits.items()])


DOMAINS = {
    "fact": {"event_source": C.EVENT_SOURCES, "pipeline_status": C.PIPELINE_STATUSES, "scan_type": C.SCAN_TYPES},
    "users": {"role": C.ROLES},
    "tenants": {"plan_tier": C.PLAN_TIERS},
    "lifecycle": {"onboarding_status": C.ONBOARDING_STATUSES},
    "sessions": {"device_type": C.DEVICE_TYPES},
}


def domain_values(tables: dict[str, DataFrame], domains: dict[str, dict[str, Sequence[str]]] = DOMAINS) -> DataFrame:
    """Q-30: values outside their domain, with their rows. One pass a table: the (column, value) pairs of a
    row that break a rule are stacked and counted together."""
    found = []
    for table, columns in domains.items():
        if table not in tables:
            continue
        cells = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*allowed), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
                 for c, allowed in columns.items()]
        found.append(tables[table].select(F.explode(F.array_compact(F.array(*cells))).alias("x")).select("x.*"))
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))

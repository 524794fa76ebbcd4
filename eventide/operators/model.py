"""Ingest and modelling operators (M-*): dedupe, fact build, keys, SCD2/SCD1,
sessions, lifecycle, retention, partitioned writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.compat import day_of_week_sun0, json_int, json_str
from ..functions.ranking import dense_sequence, lag_by_position
from ..functions.skew import fits, split_join
from ..session import scratch_path

STEP_EVENT = "dedicated_onboarding_step_completed"
NAV_EVENT = "dedicated_nav_section_clicked"
OPEN_END = "TIMESTAMP_NTZ'9999-12-31 00:00:00'"


# --------------------------------------------------------------------- M-3
def dedupe_events(raw: DataFrame, key: str = "event_id",
                  order: Sequence[str] = ("collector_tstamp",)) -> DataFrame:
    """Keep, per event_id, the copy with the earliest ``collector_tstamp``.

    ``row_number() = 1`` lets Catalyst plan a partial WindowGroupLimit before
    the shuffle: every map task forwards at most one row per event_id, so an
    id replayed millions of times costs one row per task, not one hot task.
    Ties on the collector time are broken by event time, name and a hash of
    the payload, so the pick is deterministic.
    """
    payload = [c for c in raw.columns if c != key and c not in order]
    tie = [c for c in ("event_timestamp", "event_name") if c in payload]
    w = Window.partitionBy(key).orderBy(*[F.col(c) for c in order], *[F.col(c) for c in tie],
                                        F.xxhash64(*[F.col(c) for c in payload]))
    return raw.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# --------------------------------------------------------------------- M-4
def build_fact(deduped: DataFrame, as_of: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The enriched fact: category defaulted, date parts, JSON extracts; the
    step columns only for step events. ``loaded_at`` is the ``as_of`` time
    (a literal, for reproducible runs) or the current time."""
    is_step = F.col("event_name") == F.lit(STEP_EVENT)
    loaded = (F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp())
    ts = F.col("event_timestamp")
    return deduped.select(
        *keep,
        "event_id", "event_name",
        F.coalesce(F.col("event_category"), F.lit("unknown")).alias("event_category"),
        "tenant_id", "user_id", "session_id", "event_timestamp",
        F.to_date(ts).alias("event_date"),
        F.hour(ts).cast("int").alias("event_hour"),
        day_of_week_sun0(ts).alias("event_day_of_week"),
        "platform_version", "event_source",
        F.when(is_step, json_str("properties", "step_name")).alias("step_name"),
        F.when(is_step, json_int("properties", "step_index")).alias("step_index"),
        json_str("properties", "project_id").alias("project_id"),
        json_str("properties", "pipeline_id").alias("pipeline_id"),
        json_str("properties", "status").alias("pipeline_status"),
        json_str("properties", "scan_type").alias("scan_type"),
        json_int("properties", "duration_seconds").alias("duration_seconds"),
        F.col("properties").alias("properties_json"),
        loaded.alias("loaded_at"),
    )


# --------------------------------------------------------------------- M-5
def add_event_key(fact: DataFrame) -> DataFrame:
    """Dense surrogate key 1..n in (event_timestamp, event_id) order, computed
    from range partitions + per-partition offsets (no single-task window)."""
    keyed = dense_sequence(fact, ["event_timestamp", "event_id"], out_col="event_key", tiebreak=[])
    return keyed.select("event_key", *fact.columns)


def fact_from_raw(raw: DataFrame, as_of: str | None = None, with_key: bool = False,
                  keep: Sequence[str] = ()) -> DataFrame:
    """M-3 + M-4 (+ M-5 when ``with_key``): the fact table from raw events."""
    fact = build_fact(dedupe_events(raw), as_of=as_of, keep=keep)
    return add_event_key(fact) if with_key else fact


# --------------------------------------------------------------------- M-6
def derive_category(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Fill a missing ``event_category`` from the catalog (broadcast: the
    catalog is a fixed registry of event names); unknown names → 'unknown'."""
    cat = F.broadcast(catalog.select("event_name", F.col("category").alias("_cat")))
    return (events.join(cat, "event_name", "left")
                  .withColumn("event_category",
                              F.coalesce(F.col("event_category"), F.col("_cat"), F.lit("unknown")))
                  .drop("_cat").select(*events.columns))


# --------------------------------------------------------------------- M-9
def scd2_as_of(events: DataFrame, dim: DataFrame, key: str, ts_col: str = "event_timestamp",
               attrs: Sequence[str] = (), hot_rows: int = C.Scale().hot_key_rows) -> DataFrame:
    """Attach the dimension version valid at event time:
    ``valid_from <= ts < coalesce(valid_to, 9999-12-31)`` (half-open so a row
    on a change boundary matches exactly one version). Events of hot keys are
    joined map-side against a bounded broadcast of their versions."""
    versions = dim.select(key, "valid_from", "valid_to", *attrs)

    def cond(l, r):
        return (F.col(f"_l.{ts_col}") >= F.col("_r.valid_from")) & \
               (F.col(f"_l.{ts_col}") < F.coalesce(F.col("_r.valid_to"), F.expr(OPEN_END)))

    return split_join(events, versions, [key], how="left", condition=cond, threshold=hot_rows) \
        .drop("valid_from", "valid_to")


def scd2_as_of_small(events: DataFrame, dim: DataFrame, key: str, ts_col: str = "event_timestamp",
                     attrs: Sequence[str] = (), hot_rows: int = C.Scale().hot_key_rows, max_rows: int = 100_000) -> DataFrame:
    """``scd2_as_of`` against a dimension that is broadcast if it has at most ``max_rows`` versions: the
    events then stay where they are."""
    if not fits(dim, max_rows):
        return scd2_as_of(events, dim, key, ts_col, attrs, hot_rows)
    v = F.broadcast(dim.select(F.col(key).alias("_k"), "valid_from", "valid_to", *attrs))
    ts = F.col(ts_col)
    cond = (F.col(key) == F.col("_k")) & (ts >= F.col("valid_from")) & (ts < F.coalesce(F.col("valid_to"), F.expr(OPEN_END)))
    return events.join(v, cond, "left").select(*[events[c] for c in events.columns], *attrs)


# --------------------------------------------------------------------- M-7
def add_star_keys(fact: DataFrame, dim_tenants: DataFrame, dim_users: DataFrame,
                  hot_rows: int = C.Scale().hot_key_rows) -> DataFrame:
    """``tenant_key`` / ``user_key`` of the version valid at event time; -1
    when no version matches."""
    t = dim_tenants.select("tenant_id", "valid_from", "valid_to",
                           F.col("tenant_surrogate_key").alias("tenant_key"))
    u = dim_users.select("user_id", "valid_from", "valid_to",
                         F.col("user_surrogate_key").alias("user_key"))
    out = scd2_as_of_small(fact, t, "tenant_id", attrs=["tenant_key"], hot_rows=hot_rows)
    out = scd2_as_of(out, u, "user_id", attrs=["user_key"], hot_rows=hot_rows)
    return (out.withColumn("tenant_key", F.coalesce("tenant_key", F.lit(-1).cast("long")))
               .withColumn("user_key", F.coalesce("user_key", F.lit(-1).cast("long"))))


# --------------------------------------------------------------------- M-8
def scd2_apply(current: DataFrame, incoming: DataFrame, key: str, attrs: Sequence[str],
               as_of: str, surrogate: str | None = None) -> DataFrame:
    """Apply a batch of incoming attribute rows to an SCD2 dimension.

    Open versions whose attributes changed are closed at ``as_of``; a new
    open version starts at ``as_of``; unchanged and historical rows stay.
    Re-applying the same batch is a no-op. Attributes are compared null-safe.
    A key without an open version takes every column that the batch sends.
    Surrogate keys never change: new versions are numbered after the greatest
    key. Batch rows with a NULL key are left out.
    """
    ts = F.lit(as_of).cast("timestamp_ntz")
    cols = current.columns
    sent = [c for c in cols if c in incoming.columns
            and c not in (key, "valid_from", "valid_to", "is_current", surrogate, *attrs)]
    # one incoming row per key; a key sent twice keeps its greatest row by
    # attributes (deterministic, combined map-side)
    inc = (incoming.where(F.col(key).isNotNull()).groupBy(key)
                   .agg(F.max(F.struct(*attrs, *sent)).alias("_new")).withColumnRenamed(key, "_key"))
    joined = (current.withColumn("_old", F.lit(True))
                     .join(inc, F.col("is_current") & (F.col(key) == F.col("_key")), "full"))
    is_old = F.col("_old").isNotNull()
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_new.{a}"))
    changed = is_old & F.col("_key").isNotNull() & ~same
    opened = {c: F.col(c) for c in cols}
    opened.update({c: F.when(is_old, F.col(c)).otherwise(F.col(f"_new.{c}")) for c in sent})
    opened.update({a: F.col(f"_new.{a}") for a in attrs})
    opened.update({key: F.col("_key"), "valid_from": ts, "valid_to": F.lit(None), "is_current": F.lit(True)})
    if surrogate in cols:
        opened[surrogate] = F.lit(None)

    def version(values: dict) -> F.Column:
        return F.struct(*[values.get(c, F.col(c)).cast(current.schema[c].dataType).alias(c) for c in cols])

    versions = (F.when(changed, F.array(version({"valid_to": ts, "is_current": F.lit(False)}), version(opened)))
                 .when(is_old, F.array(version({}))).otherwise(F.array(version(opened))))
    out = joined.select(F.explode(versions).alias("_v")).select("_v.*")
    if surrogate not in cols:
        return out
    # written once: the kept rows and the fresh ones are read from it, not joined again
    path = scratch_path(current.sparkSession, f"scd2-{uuid.uuid4().hex}")
    out.write.parquet(path)
    out = current.sparkSession.read.schema(out.schema).parquet(path)
    top = current.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    fresh = dense_sequence(out.where(F.col(surrogate).isNull()).drop(surrogate), [key, "valid_from"],
                           out_col=surrogate, tiebreak=[])
    fresh = fresh.withColumn(surrogate, (F.col(surrogate) + F.lit(top)).cast(current.schema[surrogate].dataType))
    return out.where(F.col(surrogate).isNotNull()).unionByName(fresh.select(*cols))


# -------------------------------------------------------------------- M-10
def scd1_upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str] | str,
                order_col: str = "loaded_at") -> DataFrame:
    """Overwrite by key: the latest row per key wins (ties: incoming).
    ``row_number() = 1`` gets a partial WindowGroupLimit before the shuffle,
    so a hot key forwards one row per task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = current.columns
    both = (current.select(*cols).withColumn("_src", F.lit(0))
            .unionByName(incoming.select(*cols).withColumn("_src", F.lit(1))))
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc(), F.col("_src").desc())
    return both.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(*cols)


# -------------------------------------------------------------------- M-11
def sessions(events: DataFrame, nav_event: str = NAV_EVENT) -> DataFrame:
    """Session dimension rows: start, end, duration, page views (navigation
    events) and event count, per (session, user, tenant)."""
    ts = F.col("event_timestamp")
    return (events.where(F.col("session_id").isNotNull())
                  .groupBy("session_id", "user_id", "tenant_id")
                  .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"),
                       F.count_if(F.col("event_name") == F.lit(nav_event)).alias("page_views"),
                       F.count(F.lit(1)).alias("events_count"))
                  .withColumn("session_duration_seconds",
                              F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end")))
                  .select("session_id", "user_id", "tenant_id", "session_start", "session_end",
                          "session_duration_seconds", "page_views", "events_count"))


# -------------------------------------------------------------------- M-12
def clustered_layout(df: DataFrame, part_col: str, cluster: Sequence[str] = (),
                     num_partitions: int | None = None) -> DataFrame:
    """Range-partition on (partition column, cluster columns, a unique row
    key) and sort within partitions. A date or a hot tenant spreads over as
    many balanced tasks as its size needs; each task writes a contiguous,
    sorted slice, so files stay few per date and row groups carry narrow
    min/max statistics. ``repartition(date)`` would instead give one task per
    date."""
    row_key = F.col("event_id") if "event_id" in df.columns else F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [F.col(part_col), *[F.col(c) for c in cluster], row_key]
    # without an explicit count AQE sizes the range shuffle from the data
    # (advisory partition size), so tasks stay balanced at any volume
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(part_col, *cluster)


def write_clustered(df: DataFrame, path: str, date_col: str = "event_date",
                    cluster: Sequence[str] = ("tenant_id", "event_name"), mode: str = "overwrite",
                    shuffle: bool = True) -> None:
    """M-12 / SRC-7: partition by date, cluster rows by tenant and event inside
    each file (see ``clustered_layout``). ``shuffle=False`` skips the range
    shuffle for input already range-partitioned by time (e.g. after
    ``add_event_key``): each task then holds a contiguous time range."""
    out = clustered_layout(df, date_col, cluster) if shuffle else df.sortWithinPartitions(date_col, *cluster)
    out.write.mode(mode).partitionBy(date_col).parquet(path)


# -------------------------------------------------------------------- M-13
def retention(df: DataFrame, as_of: str, months: int, date_col: str = "event_date") -> DataFrame:
    """Rolling retention: keep rows of the last ``months`` months before
    ``as_of``. On a date-partitioned table this prunes partitions."""
    cutoff = F.add_months(F.lit(as_of).cast("date"), -months)
    return df.where(F.col(date_col) >= cutoff)


# -------------------------------------------------------------------- M-14
def touched_dates(raw: DataFrame, cutoff: str, date_col: str = "event_timestamp",
                  arrival_col: str = "collector_tstamp") -> DataFrame:
    """Event dates that received rows after the transform cutoff."""
    return (raw.where(F.col(arrival_col) > F.lit(cutoff).cast("timestamp_ntz"))
               .select(F.to_date(date_col).alias("event_date")).distinct())


def reprocess_dates(raw: DataFrame, cutoff: str, path: str, as_of: str | None = None) -> DataFrame:
    """Rebuild only the fact partitions that late rows touched, with dynamic
    partition overwrite (other dates in ``path`` stay); returns the rebuilt
    partitions as stored."""
    dates = touched_dates(raw, cutoff)
    affected = raw.join(dates, F.to_date("event_timestamp") == dates.event_date, "left_semi")
    rebuilt = fact_from_raw(affected, as_of=as_of)
    (rebuilt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date").parquet(path))
    return raw.sparkSession.read.parquet(path).join(dates, "event_date", "left_semi")


# -------------------------------------------------------------------- M-15
def backfill_step_name(fact: DataFrame, steps: Sequence[str] = tuple(C.ONBOARDING_STEPS)) -> DataFrame:
    """Fill a NULL ``step_name`` from ``step_index`` (0-based into the step list)."""
    arr = F.array(*[F.lit(s) for s in steps])
    idx = F.col("step_index")
    fill = F.when((idx >= 0) & (idx < F.lit(len(steps))), F.element_at(arr, (idx + 1).cast("int")))
    return fact.withColumn("step_name", F.coalesce(F.col("step_name"), fill))


# -------------------------------------------------------------------- M-16
def user_lifecycle(events: DataFrame) -> DataFrame:
    """Per (user, tenant): invite, first login and activation dates and the
    furthest onboarding status reached
    (not_started < in_progress < abandoned < completed)."""
    n, d = F.col("event_name"), F.to_date("event_timestamp")
    progress = n.isin("dedicated_user_first_login", "dedicated_user_invitation_accepted", STEP_EVENT)
    agg = events.groupBy("user_id", "tenant_id").agg(
        F.min(F.when(n == "dedicated_user_invited", d)).alias("invite_date"),
        F.min(F.when(n == "dedicated_user_first_login", d)).alias("first_login_date"),
        F.min(F.when(n == "dedicated_user_activated", d)).alias("activation_date"),
        F.max(F.when(n == "dedicated_onboarding_completed", 3)
               .when(n == "dedicated_onboarding_abandoned", 2)
               .when(progress, 1).otherwise(0)).alias("_rank"))
    status = F.element_at(F.array(*[F.lit(s) for s in C.ONBOARDING_STATUSES]), (F.col("_rank") + 1).cast("int"))
    return agg.withColumn("onboarding_status", status).drop("_rank")


def apply_lifecycle(dim_users: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Fill the lifecycle columns of the current user versions."""
    lc = lifecycle.select("user_id", "tenant_id",
                          *[F.col(c).alias(f"_{c}") for c in
                            ("invite_date", "first_login_date", "activation_date", "onboarding_status")])
    out = dim_users.join(lc, ["user_id", "tenant_id"], "left")
    for c in ("invite_date", "first_login_date", "activation_date"):
        out = out.withColumn(c, F.when(F.col("is_current"), F.coalesce(F.col(c), F.col(f"_{c}")))
                             .otherwise(F.col(c)))
    out = out.withColumn("onboarding_status", F.when(
        F.col("is_current"), F.coalesce(F.col("_onboarding_status"), F.lit("not_started")))
        .otherwise(F.col("onboarding_status")))
    return out.select(*dim_users.columns)


# -------------------------------------------------------------------- M-17
def seat_usage(fact: DataFrame, dim_tenants: DataFrame) -> DataFrame:
    """Distinct active users per tenant against the seat limit."""
    active = (fact.where(F.col("user_id").isNotNull() & (F.col("user_id") != ""))
                  .groupBy("tenant_id").agg(F.countDistinct("user_id").alias("active_users")))
    t = dim_tenants.where(F.col("is_current")).select("tenant_id", "seat_limit")
    return (t.join(active, "tenant_id", "left")
             .withColumn("active_users", F.coalesce("active_users", F.lit(0).cast("long")))
             .withColumn("seat_utilization_pct",
                         F.round(F.col("active_users").cast("double") * 100.0 / F.col("seat_limit"), 2))
             .withColumn("over_limit", F.col("active_users") > F.col("seat_limit")))


# -------------------------------------------------------------------- M-18
def page_sequence(fact: DataFrame) -> DataFrame:
    """Ordered navigation sections per session with the previous section.
    One row per navigation event (never a whole session in one array)."""
    nav = (fact.where((F.col("event_name") == NAV_EVENT) & F.col("session_id").isNotNull())
               .select("session_id", "event_id", "event_timestamp",
                       json_str("properties_json", "section_name").alias("section_name")))
    out = lag_by_position(nav, ["session_id"], ["event_timestamp"], ["section_name"],
                          tiebreak=["event_id"])
    return out.select("session_id", (F.col("seq_no") + 1).alias("seq_no"), "event_id",
                      "event_timestamp", "section_name", "prev_section_name")

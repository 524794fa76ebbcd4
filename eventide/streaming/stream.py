"""Structured Streaming operators over a landing folder of raw event files
(ST-1 … ST-6). Each operator maps a streaming DataFrame to a streaming
DataFrame or starts a query into a sink; ``run_available`` drives a query to
completion with ``trigger(availableNow=True)`` (no server, no port).

State is keyed and bounded by watermarks; sinks are parquet folders (or
``foreachBatch`` writers) under the shared checkpoint folder, so a restarted
query resumes from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..functions.compat import EPOCH_NTZ, epoch_micros
from ..session import settings

RAW_STREAM_SCHEMA = ("n long, event_id string, event_name string, event_category string, tenant_id string, "
                     "user_id string, session_id string, event_timestamp timestamp_ntz, "
                     "collector_tstamp timestamp_ntz, platform_version string, event_source string, "
                     "properties string, sdk_version string")

NAV_EVENT = "dedicated_nav_section_clicked"
ET = "_event_time"


def with_event_time(df: DataFrame, col: str = "event_timestamp") -> DataFrame:
    """Watermarks need an instant (TIMESTAMP); the wall-clock UTC
    ``timestamp_ntz`` is mapped through epoch microseconds, time-zone free."""
    return df.withColumn(ET, F.timestamp_micros(epoch_micros(col)))


def to_ntz(c) -> "F.Column":
    """Instant → UTC wall clock (``timestamp_ntz``), time-zone free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(EPOCH_NTZ))


# ------------------------------------------------------------------ source
# the JVM does not compile methods of more bytes; the derived columns of raw events make one far larger, which ran interpreted
LAND_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def land_files(raw: DataFrame, path: str, lo: str | None = None, hi: str | None = None,
               mode: str = "append") -> None:
    """Land raw events as collector files, one folder per arrival
    (collector) date; optionally only the arrivals in [lo, hi). Each input
    task writes its own rows, sorted, a file per date: tasks are as balanced
    as the input's splits, never one task per day, and every row is derived
    once (a range shuffle would derive all rows once more for its sample)."""
    df = raw.withColumn("arrival_date", F.to_date("collector_tstamp"))
    if lo is not None:
        df = df.where((F.col("arrival_date") >= F.lit(lo).cast("date")) &
                      (F.col("arrival_date") < F.lit(hi).cast("date")))
    with settings(raw.sparkSession, LAND_CONF):
        (df.sortWithinPartitions("arrival_date", "collector_tstamp")
           .write.mode(mode).partitionBy("arrival_date").parquet(path))


def _files(spark: SparkSession, path: str):
    """(Hadoop path, its file system) of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def staged_dates(spark: SparkSession, path: str) -> list:
    """Arrival dates that ``land_files`` wrote folders of, in order."""
    import datetime as dt
    folder, fs = _files(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(dt.date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith("arrival_date="))


def land_staged(spark: SparkSession, staged: str, path: str, dates: Sequence) -> None:
    """Land the staged folders of these arrival dates: they are moved, no row is read."""
    to, fs = _files(spark, path)
    fs.mkdirs(to)
    for day in dates:
        name = f"arrival_date={day.isoformat()}"
        if not fs.rename(_files(spark, f"{staged}/{name}")[0], _files(spark, f"{path}/{name}")[0]):
            raise OSError(f"{name} was not landed")


def read_landing(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the landing folder with an explicit schema.
    ``files_per_trigger`` caps the files per micro-batch (files are taken in
    modification-time order)."""
    r = spark.readStream.schema(RAW_STREAM_SCHEMA + ", arrival_date date")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path).drop("arrival_date")


def replay(spark: SparkSession, raw: DataFrame, root: str, build, chunk_days: int = 7,
           partitions: int | None = None, route_delay: str | None = None, conf: dict | None = None) -> None:
    """Let files arrive over time: land the raw events chunk by chunk in
    arrival order and, after each landing, let the query catch up
    (``availableNow``, one micro-batch per landing). One checkpoint carries
    offsets and state across the runs, as after a restart. ``build`` maps the
    streaming source to a DataStreamWriter. With ``route_delay`` the rows go
    through ``route_behind`` first and the query reads those it lets pass. The
    raw events are read and laid out once, for all landings; a landing then
    moves the folders of its arrival dates. The loop runs over arrival-date
    chunks (a handful per month), each step a distributed job."""
    import datetime as dt
    land_files(raw.where(F.col("collector_tstamp").isNotNull()), f"{root}/staged")
    dates = staged_dates(spark, f"{root}/staged")
    if not dates:
        return
    day = dates[0]
    while day <= dates[-1]:
        nxt = day + dt.timedelta(days=chunk_days)
        land_staged(spark, f"{root}/staged", f"{root}/landing", [d for d in dates if day <= d < nxt])
        source = read_landing(spark, f"{root}/landing")
        if route_delay:
            run_available(spark, source.writeStream.foreachBatch(route_behind(f"{root}/routed", route_delay)),
                          f"{root}/router", partitions)
            source = read_routed(spark, f"{root}/routed")
        run_available(spark, build(source), f"{root}/checkpoint", partitions, conf)
        day = nxt


def state_partitions(spark: SparkSession) -> int:
    """Shuffle/state partitions for a new stateful query: the session's
    setting, capped at twice the cluster's default parallelism (state
    partitions are fixed for the life of a checkpoint, and every micro-batch
    runs one task per partition)."""
    cur = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, min(cur, 2 * spark.sparkContext.defaultParallelism))


# session settings of queries with timers and state variables
TIMER_CONF = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
# sessions are merged before the shuffle, so that a user with very many events sends few rows
SESSION_CONF = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def run_available(spark: SparkSession, query_writer, checkpoint: str, partitions: int | None = None,
                  conf: dict | None = None):
    """Start a DataStreamWriter of ``spark`` with availableNow and wait for it
    (the active session may be a foreachBatch's own). When ``partitions`` is
    given it is the query's shuffle/state partition count; it and ``conf`` are
    set only while the query starts, then restored."""
    want = {**(conf or {}), **({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})}
    with settings(spark, want):
        q = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


# ------------------------------------------------------------------ ST-1
def dedupe_stream(events: DataFrame, delay: str = "24 hours") -> DataFrame:
    """ST-1: drop repeated event_ids within the watermark. Keeps the first
    arrival; copies share the payload, so the fact rows agree with batch."""
    return (with_event_time(events).withWatermark(ET, delay)
            .dropDuplicatesWithinWatermark(["event_id"]).drop(ET))


# ------------------------------------------------------------------ ST-2
def hourly_counts(events: DataFrame, delay: str = "4 hours") -> DataFrame:
    """ST-2: events per (1-hour tumbling window, event_name)."""
    return (with_event_time(events).withWatermark(ET, delay)
                  .groupBy(F.window(ET, "1 hour").alias("w"), "event_name")
                  .agg(F.count(F.lit(1)).alias("events"))
                  .select(to_ntz(F.col("w.start")).alias("window_start"),
                          to_ntz(F.col("w.end")).alias("window_end"), "event_name", "events"))


def _batch_dir(path: str, batch_id: int) -> str:
    # one folder per micro-batch, overwritten on retry: a batch replayed after
    # a failure replaces its own output instead of appending it twice
    return f"{path}/_batch={batch_id}"


def upsert_batches(path: str, keys: Sequence[str]):
    """foreachBatch writer for update-mode aggregates: every micro-batch's
    changed rows go to their own batch folder; readers take the latest row
    per key (``latest``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_dir(path, batch_id))
    write.keys = list(keys)
    return write


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Latest version of each key written by ``upsert_batches``."""
    df = spark.read.parquet(path)
    vals = [c for c in df.columns if c not in keys and c != "_batch"]
    best = F.max_by(F.struct(*[F.col(c) for c in vals]), F.col("_batch")).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


# ------------------------------------------------------------------ ST-3
def route_late(path: str, max_lag_hours: float = 4.0, arrival_col: str = "collector_tstamp"):
    """ST-3: foreachBatch that writes each batch once, split by ``route``:
    ``late`` rows arrived more than ``max_lag_hours`` after the event (their
    dates are what M-14 reprocesses), ``unknown`` rows lack one of the times,
    all others are ``on_time``. Every row lands in exactly one folder."""
    lag = F.timestamp_diff("MICROSECOND", F.col("event_timestamp"), F.col(arrival_col))
    route = (F.when(lag.isNull(), "unknown").when(lag > F.lit(int(max_lag_hours * 3600 * 1_000_000)), "late")
              .otherwise("on_time"))

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("route", route).write.mode("overwrite").option("partitionOverwriteMode", "static")
              .partitionBy("route").parquet(_batch_dir(path, batch_id)))
    return write


def delay_ms(delay: str) -> int:
    """Milliseconds of a delay such as ``4 hours``."""
    n, unit = delay.split()
    return int(n) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def _mark(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The horizon (epoch ms) left by the batch before, if there was one."""
    if batch_id == 0:
        return None
    row = spark.read.schema("horizon long").parquet(f"{path}/mark={batch_id - 1}").first()
    return row[0] if row else None


def _set_mark(batch: DataFrame, path: str, batch_id: int, before: int | None, delay: str) -> int | None:
    """Store the horizon after this batch: the latest event time so far less the delay, never going back."""
    spark = batch.sparkSession
    seen = batch.agg(F.max(epoch_micros("event_timestamp"))).first()[0]
    new = [x for x in (before, None if seen is None else seen // 1000 - delay_ms(delay)) if x is not None]
    after = max(new) if new else None
    spark.createDataFrame([(after,)], "horizon long").coalesce(1).write.mode("overwrite").parquet(f"{path}/mark={batch_id}")
    return after


def route_behind(path: str, delay: str):
    """ST-1 / ST-2: foreachBatch ahead of a stateful query with the same
    ``delay``. Rows at or before the watermark that the query will have (the
    latest event time of the batches before, less the delay) would be dropped
    there without a trace; they go to ``behind``, to be counted and
    reprocessed by M-14. All others, also those without an event time, go to
    ``ahead``, which the query reads. However the query batches them, its
    watermark is no further than the router's, so it drops none."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        horizon = _mark(spark, f"{path}_marks", batch_id)
        behind = epoch_micros("event_timestamp") <= F.lit((horizon or 0) * 1000) if horizon is not None else F.lit(False)
        (batch.withColumn("route", F.when(behind, "behind").otherwise("ahead"))
              .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route").parquet(_batch_dir(path, batch_id)))
        # the latest event time is read from what was written, one column of it
        written = spark.read.schema(RAW_STREAM_SCHEMA).parquet(_batch_dir(path, batch_id))
        _set_mark(written, f"{path}_marks", batch_id, horizon, delay)
    return write


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    """Streaming read of the rows that ``route_behind`` let pass."""
    return spark.readStream.schema(RAW_STREAM_SCHEMA).parquet(f"{path}/_batch=*/route=ahead")


def behind_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``route_behind`` kept from the query."""
    return spark.read.schema(RAW_STREAM_SCHEMA + ", route string, _batch long").parquet(path).where("route = 'behind'").drop("route", "_batch")


# ------------------------------------------------------------------ ST-4
# The rule: a navigation click is dropped if another click of the same
# (user, session, section) stands at most 200 ms before it, by event time
# (ties by event_id), whenever the two arrived. Only the last 200 ms matter,
# so a key is cut into buckets of time, each with copies of the clicks at the
# end of the bucket before; a hot key spreads over its buckets.
CLICK_KEYS = ["user_id", "session_id", "section_name"]
CLICK = ["event_id", *CLICK_KEYS, "event_timestamp"]
CLICK_SCHEMA = ("event_id string, user_id string, session_id string, section_name string, "
                "event_timestamp timestamp_ntz")
BUCKET_SECONDS = 600
KEY_SHARDS = 8           # groups of keys a bucket in the state of debounce_stream


def nav_clicks(events: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The navigation clicks with the columns that the rule needs (it cannot judge one without an event time)."""
    return (events.where((F.col("event_name") == NAV_EVENT) & F.col("event_timestamp").isNotNull())
                  .select("event_id", "user_id", "session_id",
                          F.get_json_object("properties", "$.section_name").alias("section_name"),
                          "event_timestamp", *extra))


def in_buckets(clicks: DataFrame, window_ms: int = 200, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Each click in its bucket (``own``), and a copy in the next one if the window reaches over."""
    if window_ms >= bucket_seconds * 1000:
        raise ValueError("a bucket must be longer than the window")
    size = F.lit(bucket_seconds * 1_000_000)
    us = epoch_micros("event_timestamp")

    def bucket(at):
        return ((at - F.pmod(at, size)) / size).cast("long")

    here, ahead = bucket(us), bucket(us + F.lit(window_ms * 1000))
    places = F.filter(F.array(F.struct(here.alias("bucket"), F.lit(True).alias("own")),
                              F.struct(ahead.alias("bucket"), F.lit(False).alias("own"))),
                      lambda x: x.own | (x.bucket != here))
    return clicks.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")


def judge(bucketed: DataFrame, window_ms: int = 200) -> DataFrame:
    """``keep`` for every click that a bucket owns; one exchange on (key, bucket)."""
    w = Window.partitionBy(*CLICK_KEYS, "bucket").orderBy("event_timestamp", "event_id")
    before = F.lag("event_timestamp").over(w)
    gap = F.timestamp_diff("MICROSECOND", before, F.col("event_timestamp"))
    return (bucketed.withColumn("keep", before.isNull() | (gap > F.lit(window_ms * 1000)))
                    .where("own").drop("own", "bucket"))


def debounce_batch(events: DataFrame, window_ms: int = 200) -> DataFrame:
    """ST-4 over a table. NULL keys form their own group, as in GROUP BY."""
    return judge(in_buckets(nav_clicks(events), window_ms), window_ms).where("keep").select(*CLICK)


class ClickDebouncer(StatefulProcessor):
    """Buffers a shard's clicks of a bucket until the watermark passes its end, then judges them in event-time order.

    Clicks may arrive in any order up to the watermark's delay; nothing is
    judged before all that could change it has come. State is one bucket of
    the keys of one shard, and is cleared when its timer fires: calls to the
    state store are per shard and bucket, not per key.
    """

    def __init__(self, window_ms: int, bucket_seconds: int):
        self.window_us, self.bucket_ms = window_ms * 1000, bucket_seconds * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.clicks = handle.getListState("clicks", "event_id string, user_id string, session_id string, section_name string, us long, own boolean")

    def handleInputRows(self, key, rows, timerValues):
        cols = ["event_id", *CLICK_KEYS, "us", "own"]
        found = [click for pdf in rows for click in zip(*(pdf[c].tolist() for c in cols), strict=True)]
        if found:
            self.clicks.appendList(found)
            self.handle.registerTimer((int(key[-1]) + 1) * self.bucket_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        by_key: dict[tuple, list] = {}
        for event_id, user_id, session_id, section, us, own in self.clicks.get():
            # a null id stands before others
            by_key.setdefault((user_id, session_id, section), []).append((us, event_id is not None, event_id or "", own))
        self.clicks.clear()
        kept = [(event_id if known else None, *k, pd.Timestamp(us, unit="us")) for k, rows in by_key.items() for ordered in [sorted(rows)]
                for (us, known, event_id, own), (before, *_) in zip(ordered, [(None,), *ordered], strict=False)
                if own and (before is None or us - before > self.window_us)]
        if kept:
            yield pd.DataFrame(kept, columns=CLICK)

    def close(self) -> None:
        pass


def debounce_stream(events: DataFrame, window_ms: int = 200, delay: str = "24 hours",
                    bucket_seconds: int = BUCKET_SECONDS, shards: int = KEY_SHARDS) -> DataFrame:
    """ST-4 on a stream: clicks are emitted once the watermark has passed their
    bucket. What still waits in state can be read with ``debounce_pending``.
    The keys are dealt over ``shards`` groups a bucket (fixed for a checkpoint)."""
    clicks = with_event_time(nav_clicks(events)).withWatermark(ET, delay)
    dealt = (in_buckets(clicks, window_ms, bucket_seconds).withColumn("us", epoch_micros("event_timestamp"))
             .withColumn("shard", F.pmod(F.xxhash64(*CLICK_KEYS), F.lit(shards)).cast("int")))
    return (dealt.select("event_id", *CLICK_KEYS, "shard", "bucket", "us", "own", ET).groupBy("shard", "bucket")
                 .transformWithStateInPandas(ClickDebouncer(window_ms, bucket_seconds), CLICK_SCHEMA, "append", "EventTime"))


def debounce_pending(spark: SparkSession, checkpoint: str, window_ms: int = 200) -> DataFrame:
    """The clicks that wait in the state of ``debounce_stream``, judged by what has come so far
    (read through the state data source)."""
    state = spark.read.format("statestore").option("stateVarName", "clicks").load(checkpoint)
    rows = (state.select("key.bucket", "list_element.*").withColumn("event_timestamp", to_ntz(F.timestamp_micros("us")))
            .drop("us"))
    return judge(rows, window_ms).where("keep").select(*CLICK)


def debounce_batches(path: str, window_ms: int = 200, delay: str = "24 hours"):
    """ST-4 without Python state: a ``foreachBatch`` writer. Clicks wait in a
    table under ``path`` until the horizon (latest event time less ``delay``)
    has passed them; each micro-batch is judged together with those, by the
    same bucketed window as a table, so a hot key spreads over many tasks. A
    batch writes its own folders, so a retry overwrites what it had written.
    Clicks behind the horizon go to ``behind`` (see ``route_behind``)."""
    schema = CLICK_SCHEMA + ", done boolean"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # of other events only the time is kept, for the horizon
        nav = F.col("event_name") == NAV_EVENT
        batch = batch.select("event_timestamp", *[F.when(nav, F.col(x)).alias(x) for x in ("event_name", "event_id", "user_id", "session_id", "properties")]).persist()
        before = _mark(spark, f"{path}/marks", batch_id)
        after = _set_mark(batch, f"{path}/marks", batch_id, before, delay)
        us = epoch_micros("event_timestamp")
        clicks = nav_clicks(batch)
        if before is not None:
            clicks.where(us <= F.lit(before * 1000)).write.mode("overwrite").parquet(_batch_dir(f"{path}/behind", batch_id))
            clicks = clicks.where(us > F.lit(before * 1000))
        clicks = clicks.withColumn("done", F.lit(False))
        if batch_id:
            old = spark.read.schema(schema + ", keep boolean").parquet(_batch_dir(f"{path}/waiting", batch_id - 1))
            clicks = clicks.unionByName(old.drop("keep"))
        judged = judge(in_buckets(clicks, window_ms), window_ms)
        passed = us <= F.lit((after or 0) * 1000) if after is not None else F.lit(False)
        # what is decided goes out once; the last 200 ms of it stay as predecessors
        judged.write.mode("overwrite").parquet(_batch_dir(f"{path}/judged", batch_id))
        judged = spark.read.schema(schema + ", keep boolean").parquet(_batch_dir(f"{path}/judged", batch_id))
        judged.where(passed & F.col("keep") & ~F.col("done")).select(*CLICK).write.mode("overwrite").parquet(_batch_dir(f"{path}/out", batch_id))
        stays = us > F.lit((after * 1000 if after is not None else 0) - window_ms * 1000) if after is not None else F.lit(True)
        judged.where(stays).withColumn("done", passed).write.mode("overwrite").parquet(_batch_dir(f"{path}/waiting", batch_id))
        batch.unpersist()
    return write


def debounced(spark: SparkSession, path: str) -> DataFrame:
    """All clicks kept so far by ``debounce_batches``: those that are decided, and the waiting ones as they stand."""
    out = spark.read.schema(CLICK_SCHEMA + ", _batch long").parquet(f"{path}/out").drop("_batch")
    last = spark.read.schema("horizon long, mark long").parquet(f"{path}/marks").agg(F.max("mark")).first()[0]
    waiting = spark.read.schema(CLICK_SCHEMA + ", done boolean, keep boolean").parquet(_batch_dir(f"{path}/waiting", last))
    return out.unionByName(waiting.where("keep AND NOT done").select(*CLICK))


# ------------------------------------------------------------------ ST-5
def session_stream(events: DataFrame, delay: str = "24 hours") -> DataFrame:
    """ST-5: running session aggregates per (session, user, tenant), emitted
    in update mode (sink keeps the latest per key)."""
    ts = F.col("event_timestamp")
    return (with_event_time(events.where(F.col("session_id").isNotNull()))
                  .withWatermark(ET, delay)
                  .groupBy("session_id", "user_id", "tenant_id")
                  .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"),
                       F.count_if(F.col("event_name") == NAV_EVENT).alias("page_views"),
                       F.count(F.lit(1)).alias("events_count")))


def session_windows(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """ST-5 without a session id: gap-based ``session_window`` per user."""
    return (with_event_time(events).withWatermark(ET, delay)
                  .groupBy(F.session_window(ET, gap).alias("s"), "user_id", "tenant_id")
                  .agg(F.count(F.lit(1)).alias("events_count"))
                  .select(to_ntz(F.col("s.start")).alias("session_start"), to_ntz(F.col("s.end")).alias("session_end"),
                          "user_id", "tenant_id", "events_count"))


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions of ``session_windows`` that are still open: they stand in the
    query's state, which the state data source reads."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(to_ntz(F.col("value.session_window.start")).alias("session_start"),
                        to_ntz(F.col("value.session_window.end")).alias("session_end"),
                        "key.user_id", "key.tenant_id", F.col("value.count").alias("events_count"))


# ------------------------------------------------------------------ ST-6
def suppress_opted_out(events: DataFrame, opt_out: DataFrame) -> DataFrame:
    """ST-6: stream-static anti join; the opt-out list is static and on the
    right (broadcast only when its size is bounded by the caller)."""
    return events.join(opt_out, "tenant_id", "left_anti")

"""Streaming operators on crafted landing files: state carried across
micro-batches, watermark dedupe, late routing."""
import datetime as dt
import tempfile

from pyspark.sql import functions as F

from eventide.streaming import stream as ST

T0 = dt.datetime(2024, 1, 3, 10, 0, 0)
NAV = "dedicated_nav_section_clicked"


def row(n, name, ts, ct=None, section="issues", user="u1", session="s1"):
    props = '{"section_name": "%s"}' % section if name == NAV else "{}"
    return (n, f"evt_{n}", name, None, "t1", user, session, ts, ct or ts, "17.1", "client", props, "2.1.4")


def land(spark, batches):
    """One landing folder per arrival date, one file per batch."""
    path = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, ST.RAW_STREAM_SCHEMA)
        df.coalesce(1).write.mode("overwrite").parquet(f"{path}/arrival_date=2024-01-{i + 1:02d}")
    return path


def run(spark, df, mode="append"):
    out = tempfile.mkdtemp(prefix="out-", dir="/tmp")
    ST.run_available(spark, df.writeStream.format("parquet").option("path", f"{out}/data").outputMode(mode),
                     f"{out}/ckpt")
    return spark.read.parquet(f"{out}/data")


def clicks():
    """Micro-batches in arrival order: out of order, 2 h and 5 h late, across bucket edges, and a hot key without ids."""
    ms, hour = dt.timedelta(milliseconds=1), dt.timedelta(hours=1)
    edge = T0 + dt.timedelta(minutes=10)                                     # a bucket begins here
    b1 = [row(1, NAV, T0), row(2, NAV, T0 + 100 * ms), row(6, NAV, edge - 50 * ms), row(7, NAV, edge + 500 * ms, section="groups")]
    b2 = [row(3, NAV, T0 + 250 * ms), row(4, NAV, T0 + 900 * ms),            # 3 dropped vs 2 (150 ms)
          row(5, NAV, T0 + 950 * ms, section="groups"),                      # other section: kept
          row(8, NAV, edge + 100 * ms),                                      # dropped vs 6, in the bucket before
          row(9, NAV, T0 - 150 * ms)]                                        # out of order: 1 is dropped after all
    b3 = [row(10, NAV, T0 + 850 * ms, ct=T0 + 2 * hour),                     # 2 h late: 4 is dropped
          row(11, NAV, edge + 400 * ms, ct=T0 + 5 * hour, section="groups"), # 5 h late: 7 is dropped
          row(12, NAV, T0 + 6 * hour)]
    b4 = [row(20 + k, NAV, T0 + 30 * hour + 150 * k * ms, user="", session=None) for k in range(40)]
    b4 += [row(60 + k, NAV, T0 + 31 * hour + 1000 * k * ms, user="", session=None) for k in range(40)]
    return [b1, b2, b3, b4]


KEPT = [f"evt_{k}" for k in (9, 10, 5, 6, 11, 12, 20, *range(60, 100))]


def test_debounce_of_a_table(spark):
    rows = spark.createDataFrame([r for b in clicks() for r in b], ST.RAW_STREAM_SCHEMA)
    out = ST.debounce_batch(rows)
    assert sorted(r.event_id for r in out.collect()) == sorted(KEPT)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_debounce_in_state_agrees_with_the_table(spark):
    src = ST.read_landing(spark, land(spark, clicks()), files_per_trigger=1)
    out = tempfile.mkdtemp(prefix="deb-", dir="/tmp")
    ST.run_available(spark, ST.debounce_stream(src).writeStream.format("parquet").option("path", f"{out}/data").outputMode("append"), f"{out}/ckpt", conf=ST.TIMER_CONF)
    decided = [r.event_id for r in spark.read.parquet(f"{out}/data").collect()]
    waiting = [r.event_id for r in ST.debounce_pending(spark, f"{out}/ckpt").collect()]
    assert sorted(decided + waiting) == sorted(KEPT)
    # the watermark stands a day before the last click
    assert "evt_9" in decided and "evt_60" in waiting


def test_debounce_in_a_waiting_table_agrees(spark):
    src = ST.read_landing(spark, land(spark, clicks()), files_per_trigger=1)
    out = tempfile.mkdtemp(prefix="deb-", dir="/tmp")
    ST.run_available(spark, src.writeStream.foreachBatch(ST.debounce_batches(f"{out}/o")), f"{out}/ckpt")
    assert sorted(r.event_id for r in ST.debounced(spark, f"{out}/o").collect()) == sorted(KEPT)


def test_debounce_state_is_kept_a_shard_and_bucket(spark):
    ms = dt.timedelta(milliseconds=1)
    rows = [row(2 * k + d, NAV, T0 + (k + 150 * d) * ms, user=f"u{k}" if k else None) for k in range(200) for d in (0, 1)]
    out = tempfile.mkdtemp(prefix="deb-", dir="/tmp")
    stream = ST.debounce_stream(ST.read_landing(spark, land(spark, [rows])))
    ST.run_available(spark, stream.writeStream.format("parquet").option("path", f"{out}/data").outputMode("append"), f"{out}/ckpt", conf=ST.TIMER_CONF)
    state = spark.read.format("statestore").option("stateVarName", "clicks").load(f"{out}/ckpt")
    assert state.count() == 400 and state.select("key").distinct().count() <= 8
    assert sorted(r.event_id for r in ST.debounce_pending(spark, f"{out}/ckpt").collect()) == sorted(f"evt_{2 * k}" for k in range(200))


def test_replay_reads_the_raw_events_once_for_all_landings(spark):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("timestamp_ntz")
    def counted(t):
        evaluated.add(1)
        return t

    day = dt.timedelta(days=1)
    rows = [row(k, "x", T0 + k * day) for k in range(60)] + [(*row(60, "x", T0)[:8], None, *row(60, "x", T0)[9:])]
    raw = spark.createDataFrame(rows, ST.RAW_STREAM_SCHEMA).withColumn("collector_tstamp", counted("collector_tstamp"))
    out = tempfile.mkdtemp(prefix="replay-", dir="/tmp")
    seen = []

    def build(src):
        return src.writeStream.foreachBatch(lambda b, i: seen.append(sorted(r.n for r in b.select("n").collect())))

    ST.replay(spark, raw, out, build, partitions=2)
    # weeks in order, each a batch of its own; rows without an arrival never land
    assert seen == [list(range(k, min(k + 7, 60))) for k in range(0, 60, 7)]
    # the layout samples its rows once and writes them once, however many weeks there are
    assert evaluated.value <= 4 * len(rows)


def test_landing_derives_each_row_once_and_keeps_settings(spark):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("timestamp_ntz")
    def counted(t):
        evaluated.add(1)
        return t

    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit, None)
    rows = [row(k, "x", T0 + (k % 9) * dt.timedelta(days=1)) for k in range(200)] + [row(7, "x", T0)] * 2
    raw = spark.createDataFrame(rows, ST.RAW_STREAM_SCHEMA).withColumn("collector_tstamp", counted("collector_tstamp"))
    out = tempfile.mkdtemp(prefix="landed-", dir="/tmp")
    ST.land_files(raw, f"{out}/landing")
    assert evaluated.value == len(rows) and spark.conf.get(limit, None) == before
    landed = spark.read.schema(ST.RAW_STREAM_SCHEMA + ", arrival_date date").parquet(f"{out}/landing")
    assert sorted(tuple(r) for r in landed.drop("arrival_date").select("n", "collector_tstamp").collect()) == sorted((r[0], r[8]) for r in rows)
    assert landed.where("arrival_date <> to_date(collector_tstamp)").isEmpty() and len(ST.staged_dates(spark, f"{out}/landing")) == 9


def test_routing_and_debouncing_cache_no_whole_events(spark, monkeypatch):
    cached = []
    frame = type(spark.range(0))
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: cached.append(self) or persist(self, *a))
    hour = dt.timedelta(hours=1)
    batch = spark.createDataFrame([row(1, NAV, T0), row(2, "x", T0 + 9 * hour)], ST.RAW_STREAM_SCHEMA)
    out = tempfile.mkdtemp(prefix="cached-", dir="/tmp")
    ST.route_behind(f"{out}/r", "4 hours")(batch, 0)
    ST.debounce_batches(f"{out}/d")(batch, 0)
    seen = [r for df in cached for r in df.collect()]
    # only what debouncing needs: of other events the time
    assert all(set(r.asDict()) <= {"event_timestamp", "event_name", "event_id", "user_id", "session_id", "properties"} for r in seen)
    assert [r.event_id for r in seen if r.event_timestamp == T0 + 9 * hour] == [None]
    # the horizon follows all events
    for marks, delay in (("r_marks", 4), ("d/marks", 24)):
        at = spark.read.parquet(f"{out}/{marks}/mark=0").first().horizon
        assert at == int(((T0 + (9 - delay) * hour) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def test_replay_of_no_events(spark):
    out = tempfile.mkdtemp(prefix="replay-", dir="/tmp")
    ST.replay(spark, spark.createDataFrame([], ST.RAW_STREAM_SCHEMA), out, lambda src: 1 / 0)


def test_rows_behind_the_watermark_are_routed(spark):
    hour = dt.timedelta(hours=1)
    b1 = [row(1, "x", T0), row(2, "x", T0 + 10 * hour)]
    b2 = [row(3, "x", T0 + 6 * hour, ct=T0 + 10 * hour), row(4, "x", T0 + 7 * hour, ct=T0 + 10 * hour), row(5, "x", T0 + 11 * hour)]
    out = tempfile.mkdtemp(prefix="behind-", dir="/tmp")
    src = ST.read_landing(spark, land(spark, [b1, b2]), files_per_trigger=1)
    ST.run_available(spark, src.writeStream.foreachBatch(ST.route_behind(f"{out}/r", "4 hours")), f"{out}/router")
    keys = ["window_start", "window_end", "event_name"]
    ST.run_available(spark, ST.hourly_counts(ST.read_routed(spark, f"{out}/r")).writeStream.outputMode("update")
                     .foreachBatch(ST.upsert_batches(f"{out}/t", keys)), f"{out}/ckpt")
    behind = [r.event_id for r in ST.behind_rows(spark, f"{out}/r").collect()]
    counted = sum(r.events for r in ST.latest(spark, f"{out}/t", keys).collect())
    assert behind == ["evt_3"] and counted == 4


def test_open_sessions_come_from_the_state(spark):
    minute = dt.timedelta(minutes=1)
    b1 = [row(1, "x", T0), row(2, "x", T0 + 10 * minute), row(3, "x", T0 + 300 * minute)]
    b2 = [row(4, "x", T0 + 310 * minute), row(5, "x", T0 + 305 * minute, user="u2")]
    out = tempfile.mkdtemp(prefix="open-", dir="/tmp")
    src = ST.read_landing(spark, land(spark, [b1, b2]), files_per_trigger=1)
    ST.run_available(spark, ST.session_windows(src).writeStream.format("parquet").option("path", f"{out}/data").outputMode("append"), f"{out}/ckpt", conf=ST.SESSION_CONF)
    closed = {(r.user_id, r.session_start): r.events_count for r in spark.read.parquet(f"{out}/data").collect()}
    still = {(r.user_id, r.session_start): r.events_count for r in ST.open_sessions(spark, f"{out}/ckpt").collect()}
    assert closed == {("u1", T0): 2}
    assert still == {("u1", T0 + 300 * minute): 2, ("u2", T0 + 305 * minute): 1}


def test_dedupe_within_watermark_keeps_first_arrival(spark):
    b1 = [row(1, "x", T0), row(2, "x", T0)]
    b2 = [row(1, "x", T0, ct=T0 + dt.timedelta(minutes=30)), row(3, "x", T0 + dt.timedelta(hours=1))]
    src = ST.read_landing(spark, land(spark, [b1, b2]), files_per_trigger=1)
    out = run(spark, ST.dedupe_stream(src))
    got = {r.event_id: r.collector_tstamp for r in out.collect()}
    assert got == {"evt_1": T0, "evt_2": T0, "evt_3": T0 + dt.timedelta(hours=1)}


def test_every_row_takes_one_route(spark):
    late = T0 - dt.timedelta(hours=5)
    gone = row(4, "x", T0, ct=T0)
    b1 = [row(1, "x", T0), row(2, "x", late, ct=T0), row(3, "x", T0, ct=T0 + dt.timedelta(hours=4)), gone]
    src = ST.read_landing(spark, land(spark, [b1]), files_per_trigger=1)
    src = src.withColumn("event_timestamp", F.when(F.col("event_id") != "evt_4", F.col("event_timestamp")))
    out = tempfile.mkdtemp(prefix="route-", dir="/tmp")
    ST.run_available(spark, src.writeStream.foreachBatch(ST.route_late(f"{out}/o")), f"{out}/ckpt")
    got = {r.event_id: r.route for r in spark.read.parquet(f"{out}/o").collect()}
    assert got == {"evt_1": "on_time", "evt_2": "late", "evt_3": "on_time", "evt_4": "unknown"}


def test_hourly_counts_in_update_mode_keep_latest(spark):
    b1 = [row(1, "x", T0), row(2, "x", T0 + dt.timedelta(minutes=10))]
    b2 = [row(3, "x", T0 + dt.timedelta(minutes=20)), row(4, "x", T0 + dt.timedelta(hours=1))]
    src = ST.read_landing(spark, land(spark, [b1, b2]), files_per_trigger=1)
    out = tempfile.mkdtemp(prefix="hourly-", dir="/tmp")
    keys = ["window_start", "window_end", "event_name"]
    ST.run_available(spark, ST.hourly_counts(src).writeStream.outputMode("update")
                     .foreachBatch(ST.upsert_batches(f"{out}/t", keys)), f"{out}/ckpt")
    got = {r.window_start: r.events for r in ST.latest(spark, f"{out}/t", keys).collect()}
    assert got == {T0: 3, T0 + dt.timedelta(hours=1): 1}

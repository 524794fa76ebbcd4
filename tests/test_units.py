"""Known-answer tests on inline rows: status branches, boundaries, ties,
NULL keys, and the skew-safe primitives against their naive forms."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide import config as C
from eventide.functions import ranking, skew
from eventide.operators import docs as D
from eventide.operators import funnel as FN
from eventide.operators import governance as G
from eventide.operators import model as M
from eventide.operators import quality as Q
from eventide.sources import io as IO

RAW_SCHEMA = ("event_id string, event_name string, event_category string, tenant_id string, user_id string, "
              "session_id string, event_timestamp timestamp_ntz, collector_tstamp timestamp_ntz, "
              "platform_version string, event_source string, properties string, sdk_version string")
T0 = dt.datetime(2024, 1, 3, 10, 0, 0)


def ev(eid, name, user="u1", tenant="t1", ts=T0, ct=None, version="17.1", props="{}"):
    return (eid, name, None, tenant, user, "s1", ts, ct or ts, version, "client", props, "2.1.4")


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_reconcile_status_branches_and_boundaries(spark):
    # 1000 vs 999 distinct → 0.1 % exactly → PASS (not > 0.1); 100 vs 99 → 1.0 % → WARN (not > 1.0);
    # 100 vs 98 → FAIL; raw only → MISSING; BI only → ORPHAN; 1000 vs 998 → 0.2 % WARN.
    def rows(name, n, prefix):
        return [ev(f"{prefix}{i}", name) for i in range(n)]
    raw = raw_df(spark, rows("a", 1000, "a") + rows("b", 100, "b") + rows("c", 100, "c") + rows("d", 5, "d")
                 + rows("f", 1000, "f"))
    bi = raw_df(spark, rows("a", 999, "a") + rows("b", 99, "b") + rows("c", 98, "c") + rows("e", 3, "e")
                + rows("f", 998, "f"))
    out = {r.event_name: r for r in Q.reconcile(raw, bi, grain=["event_name"]).collect()}
    assert out["a"].status == "PASS" and out["a"].variance_pct == 0.1
    assert out["b"].status == "WARN" and out["b"].variance_pct == 1.0
    assert out["c"].status == "FAIL"
    assert out["d"].status == "MISSING"
    assert out["e"].status == "ORPHAN" and out["e"].variance_pct is None
    assert out["f"].status == "WARN"
    two = {r.event_name: r.status for r in
           Q.reconcile(raw, bi, grain=["event_name"], th=C.Thresholds(two_band=True)).collect()}
    assert two["c"].startswith("WARN") and two["d"].startswith("FAIL") and two["a"] == "PASS"


def test_dedupe_keeps_earliest_collector_and_is_idempotent(spark):
    rows = [ev("x", "n1", ct=T0 + dt.timedelta(seconds=30)), ev("x", "n1", ct=T0 + dt.timedelta(seconds=5)),
            ev("y", "n1"), ev("y", "n1")]
    raw = raw_df(spark, rows)
    d = M.dedupe_events(raw)
    got = {r.event_id: r.collector_tstamp for r in d.collect()}
    assert got == {"x": T0 + dt.timedelta(seconds=5), "y": T0}
    assert sorted(map(tuple, M.dedupe_events(d).collect())) == sorted(map(tuple, d.collect()))
    # reconcile raw vs its own fact is all PASS
    assert {r.status for r in Q.reconcile(raw, M.build_fact(d)).collect()} == {"PASS"}


def test_funnel_null_key_and_after_invite_bound(spark):
    inv, acc = "dedicated_user_invited", "dedicated_user_invitation_accepted"
    rows = [ev("1", inv), ev("2", acc, ts=T0 - dt.timedelta(hours=1)),      # accept before invite: ignored
            ev("3", inv, user="u2"), ev("4", acc, user="u2", ts=T0 + dt.timedelta(minutes=5)),
            ev("5", inv, user=None), ev("6", acc, user=None, ts=T0 + dt.timedelta(minutes=1))]
    raw = raw_df(spark, rows)
    st = {(r.user_id, r.tenant_id): r.step_1_at for r in FN.step_times(raw).collect()}
    assert st[("u1", "t1")] is None
    assert st[("u2", "t1")] == T0 + dt.timedelta(minutes=5)
    assert st[(None, "t1")] is None           # '=' never matches NULL: counted at step 0 only
    f = {r.step_number: (r.users, r.conversion_pct) for r in FN.funnel(raw).collect()}
    assert f[0] == (3, 100.0) and f[1] == (1, 33.3)
    unbounded = {(r.user_id): r.step_1_at for r in
                 FN.step_times(raw, C.executed_funnel(after_invite=False)).collect()}
    assert unbounded["u1"] == T0 - dt.timedelta(hours=1)   # the F-4 population keeps it


def test_split_join_hot_path_equals_plain_join(spark):
    big = spark.range(0, 3000).select((F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7)).alias("k"),
                                      F.col("id").alias("v"))
    keyed = spark.range(0, 7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = sorted(map(tuple, big.join(keyed, "k").select("k", "v", "w").collect()))
    split = sorted(map(tuple, skew.split_join(big, keyed, ["k"], threshold=100).select("k", "v", "w").collect()))
    assert plain == split
    hot = [r.k for r in skew.hot_keys(big, ["k"], 500).collect()]
    assert hot == [0]
    cond = sorted(map(tuple, skew.split_join(big, keyed, ["k"], how="left", threshold=100,
                                             condition=lambda l, r: F.col("_l.v") > F.col("_r.w") * 100)
                  .select("k", "v", "w").collect()), key=str)
    ref = sorted(map(tuple, big.alias("l").join(keyed.alias("r"), (F.col("l.k") == F.col("r.k")) &
                                                 (F.col("l.v") > F.col("r.w") * 100), "left")
                     .select("l.k", "l.v", "r.w").collect()), key=str)
    assert cond == ref


def test_dense_sequence_equals_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 1000).alias("a"), F.col("id").alias("b"))
    seq = ranking.dense_sequence(df, ["a", "b"], out_col="seq", tiebreak=[])
    ref = df.withColumn("seq", F.row_number().over(Window.orderBy("a", "b")))
    assert sorted(map(tuple, seq.select("a", "b", "seq").collect())) == \
        sorted(map(tuple, ref.select("a", "b", "seq").collect()))
    assert "SinglePartition" not in seq._jdf.queryExecution().executedPlan().toString()


def test_exact_quantiles_match_interpolation(spark):
    import numpy as np
    vals = [(g, float(v)) for g in ("x", "y") for v in ([3, 1, 4, 1, 5, 9, 2, 6] if g == "x" else [7, 7, 7, 1])]
    df = spark.createDataFrame(vals, "g string, v double")
    got = {r.g: (r.p50, r.p90) for r in ranking.exact_quantiles(df, ["g"], "v", [0.5, 0.9], ["p50", "p90"]).collect()}
    for g in ("x", "y"):
        arr = np.array([v for k, v in vals if k == g])
        assert abs(got[g][0] - np.quantile(arr, 0.5)) < 1e-9
        assert abs(got[g][1] - np.quantile(arr, 0.9)) < 1e-9


def test_lag_by_position_equals_window_lag(spark):
    df = spark.range(0, 400).select((F.col("id") % 3).alias("g"), ((F.col("id") * 37) % 101).alias("t"),
                                    F.col("id").alias("i"))
    got = ranking.lag_by_position(df, ["g"], ["t"], ["i"], tiebreak=["i"])
    ref = df.withColumn("prev_i", F.lag("i").over(Window.partitionBy("g").orderBy("t", "i")))
    assert sorted(map(tuple, got.select("g", "t", "i", "prev_i").collect())) == \
        sorted(map(tuple, ref.select("g", "t", "i", "prev_i").collect()))


def test_scd2_apply_invariants(spark):
    schema = ("user_id string, role string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    t1 = dt.datetime(2023, 1, 1)
    cur = spark.createDataFrame([("a", "guest", t1, None, True), ("b", "owner", t1, None, True),
                                 ("c", "dev", t1, None, True)], schema)
    inc = spark.createDataFrame([("a", "owner"), ("b", "owner"), ("d", "guest")], "user_id string, role string")
    out = M.scd2_apply(cur, inc, "user_id", ["role"], "2024-01-15 00:00:00")
    rows = out.collect()
    assert len(rows) == 5
    per = {}
    for r in rows:
        per.setdefault(r.user_id, []).append(r)
    assert all(sum(x.is_current for x in v) == 1 for v in per.values())      # one current version
    a = sorted(per["a"], key=lambda r: r.valid_from)
    assert a[0].valid_to == a[1].valid_from == dt.datetime(2024, 1, 15)      # no gap, no overlap
    assert a[1].role == "owner" and a[0].role == "guest"
    again = M.scd2_apply(out, inc, "user_id", ["role"], "2024-01-20 00:00:00")
    assert again.count() == 5                                                # same batch: no-op


def test_scd2_apply_keeps_keys_and_new_members_columns(spark):
    schema = ("user_id string, tenant_id string, role string, valid_from timestamp_ntz, valid_to timestamp_ntz, "
              "is_current boolean, k long")
    t0, t1 = dt.datetime(2022, 1, 1), dt.datetime(2023, 1, 1)
    cur = spark.createDataFrame([("b", "t1", "guest", t0, t1, False, 1), ("b", "t1", "owner", t1, None, True, 2),
                                 ("c", "t2", "dev", t1, None, True, 7)], schema)
    inc = spark.createDataFrame([("a", "t9", "guest"), ("c", "t8", "owner"), ("b", "t1", "owner"), (None, "t1", "x")],
                                "user_id string, tenant_id string, role string")
    out = M.scd2_apply(cur, inc, "user_id", ["role"], "2024-01-15 00:00:00", surrogate="k")
    got = sorted((r.k, r.user_id, r.tenant_id, r.role, r.is_current) for r in out.collect())
    assert got == [(1, "b", "t1", "guest", False), (2, "b", "t1", "owner", True), (7, "c", "t2", "dev", False),
                   (8, "a", "t9", "guest", True), (9, "c", "t2", "owner", True)]
    empty = M.scd2_apply(cur, inc.limit(0), "user_id", ["role"], "2024-01-15 00:00:00", surrogate="k")
    assert empty.exceptAll(cur).count() == 0 and empty.count() == 3


def test_property_naming_matches_whole_words(spark):
    ev = spark.createDataFrame([("e", '{"account_id": "1", "country": "x", "discount_pct": "2", "count_files": "3", "issues_found": "4"}')],
                               "event_name string, properties string")
    got = {r.property for r in G.property_naming(ev).collect()}
    assert got == {"count_files", "issues_found"}


def test_portfolio_value_keeps_all_places(spark):
    pos = spark.createDataFrame([("p", "T1", 1000, 1.2345, dt.date(2024, 1, 1))],
                                "portfolio_id string, ticker string, shares long, price double, date date")
    assert D.portfolio_summary(pos).first().market_value == 1234.5


def test_time_to_complete_empty_transition_row(spark):
    raw = raw_df(spark, [ev("1", "dedicated_user_invited")])
    out = FN.time_to_complete(raw).collect()
    assert len(out) == 7 and all(r.median_minutes is None for r in out)


def test_coverage_without_cross_join(spark):
    rows = [ev(str(i), e, tenant=t) for i, (t, e) in enumerate(
        [("t1", e) for e in C.P0_EVENTS] + [("t2", C.P0_EVENTS[0])])]
    cov = Q.p0_coverage(raw_df(spark, rows))
    got = {(r.tenant_id, r.event_name): r.status for r in cov.collect()}
    assert len(got) == 10 and sum(v == "MISSING" for v in got.values()) == 4
    plan = cov._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_exact_quantiles_by_refinement(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    values = {"ties": [float((i * 7919) % 109) for i in range(300)], "one": [3.5], "same": [2.0] * 40, "two": [1.0, 2.0], None: [5.0, 1.0, 3.0],
              "spread": [float(x) for x in rng.lognormal(0, 6, 700)], "signs": [float(x) for x in rng.normal(0, 1e-3, 200)]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("none", None)], "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    for octave, buckets, cuts in ((512, 1 << 14, 1), (1, 4, 2), (2, 3, 0)):
        out = ranking.exact_quantiles(df, ["g"], "v", probs, [f"q{k}" for k in range(5)], octave=octave, buckets=buckets, refinements=cuts)
        got = {r.g: [r[f"q{k}"] for k in range(5)] for r in out.collect()}
        assert set(got) == set(values)
        for g, vs in values.items():
            assert np.allclose(got[g], np.quantile(vs, probs), rtol=1e-12), g
    whole = ranking.exact_quantiles(df, [], "v", [0.5], ["m"]).collect()
    assert np.isclose(whole[0].m, np.median([v for vs in values.values() for v in vs]))


def test_salted_paths_give_the_same_results(spark, sf_dir):
    from eventide.plans.registry import Ctx
    c = Ctx(spark, sf_dir)
    base = sorted(map(tuple, FN.step_times(c.raw).collect()), key=str)
    salted = sorted(map(tuple, FN.step_times(c.raw, hot_rows=3).collect()), key=str)
    assert base == salted
    plain = M.scd2_as_of(c.fact.select("event_id", "user_id", "event_timestamp"), c.users_nokey, "user_id",
                         attrs=["role"])
    hot = M.scd2_as_of(c.fact.select("event_id", "user_id", "event_timestamp"), c.users_nokey, "user_id",
                       attrs=["role"], hot_rows=2)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, hot.collect()), key=str)


def test_asof_last_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    left = [(i, rnd.choice("ab") if i % 3 else "a", rnd.randint(0, 500)) for i in range(300)]
    right = [(rnd.choice("ab") if j % 4 else "a", rnd.randint(0, 500), f"v{j:03d}") for j in range(900)]
    lf = spark.createDataFrame(left, "lid long, k string, t long")
    rf = spark.createDataFrame(right, "k string, ts long, val string")
    got = {r.lid: r.val for r in ranking.asof_last(lf, rf, ["k"], "t", "ts", "lid", ["val"]).collect()}
    for lid, k, t in left:
        cands = [(ts, v) for kk, ts, v in right if kk == k and ts <= t]
        assert got[lid] == (max(cands)[1] if cands else None)


def test_passage_search_equals_plain_python(spark, sf_dir):
    import re

    from eventide.operators import docs as D
    from eventide.sources import fixtures as X

    def parts(text):
        w = [x for x in re.split(r"\s+", text or "", flags=re.ASCII) if x]
        return {" ".join(w[i:i + 8]) for i in range(len(w) - 7)}

    q, d = X.table(spark, sf_dir, "benchmark"), X.table(spark, sf_dir, "documents")
    texts = {r.doc_id: parts(r.text) for r in d.collect()}
    want = []
    for r in q.collect():
        own = parts(r.text)
        shared = sorted((-len(own & t), k) for k, t in texts.items() if own & t)
        want += [(r.item_id, k, -n, i + 1) for i, (n, k) in enumerate(shared[:3])]
    got = sorted(map(tuple, D.passage_top_k(q, d, k=3).select("item_id", "doc_id", "shared_shingles", "rank").collect()))
    assert got == sorted(want) and len(got) > 0


def test_keyword_tagging_keeps_tags_and_fills_untagged(spark):
    rows = [(1, "billing", "cannot log in"), (2, None, "My SSH key is rejected"),
            (3, "", "the pipeline runner is stuck"), (4, None, "nothing relevant here")]
    df = spark.createDataFrame(rows, "ticket_id int, category string, text string")
    got = {r.ticket_id: (r.category, r.tag_source) for r in FN.tag_untagged(df).collect()}
    assert got == {1: ("billing", "tagged"), 2: ("ssh", "keyword"), 3: ("pipeline", "keyword"),
                   4: (None, "untagged")}


def test_shared_profile_gives_the_same_funnel_family(spark, sf_dir):
    from eventide.plans.registry import QUERIES, Ctx
    c = Ctx(spark, sf_dir)
    profile = FN.user_profiles(c.raw)
    for name in ("f1_step_times", "f2_funnel", "f4_time_to_complete", "f5_segment_by_role", "f6_weekly_cohort",
                 "f13_top_dropoffs", "r6_funnel_share"):
        direct = sorted(map(tuple, QUERIES[name](spark, sf_dir).collect()), key=str)
        shared = sorted(map(tuple, QUERIES[name](spark, sf_dir, {"profile": profile}).collect()), key=str)
        assert direct == shared, name


def test_salted_join_balances_a_hot_key(spark):
    """One key holds a third of the rows: the salted join's largest reducer
    input is far below the plain join's (AQE skew handling off, so the
    difference is the salting alone; partition coalescing off to see the
    reducer inputs)."""
    big = spark.range(0, 300_000).select(
        F.when(F.col("id") < 100_000, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    keyed = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.skewJoin.enabled",
                                                 "spark.sql.shuffle.partitions",
                                                 "spark.sql.adaptive.coalescePartitions.enabled",
                                                 "spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        plain = largest(big.join(keyed, "k"))
        salted = largest(skew.split_join(big, keyed, ["k"], threshold=10_000))
        assert salted * 2 < plain, (salted, plain)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_distributed_positions_keep_null_groups(spark):
    import numpy as np
    rows = [(None, float(v)) for v in (5, 1, 3)] + [("a", float(v)) for v in (2, 4)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.p50 for r in ranking.exact_quantiles(df, ["g"], "v", [0.5], ["p50"]).collect()}
    assert got == {None: float(np.quantile([5, 1, 3], 0.5)), "a": 3.0}
    lag = ranking.lag_by_position(df, ["g"], ["v"], ["v"], tiebreak=[])
    prev = {(r.g, r.v): r.prev_v for r in lag.collect()}
    assert prev[(None, 3.0)] == 1.0 and prev[(None, 1.0)] is None and prev[("a", 4.0)] == 2.0


def test_reprocess_dates_is_idempotent_and_keeps_other_dates(spark):
    import tempfile
    late = T0 + dt.timedelta(hours=30)
    rows = [ev("a", "x", ts=T0), ev("b", "x", ts=T0 + dt.timedelta(days=2)),
            ev("c", "x", ts=T0, ct=late)]                                    # late row of 2024-01-03
    raw = raw_df(spark, rows)
    path = tempfile.mkdtemp(prefix="fact-", dir="/tmp")
    M.build_fact(M.dedupe_events(raw_df(spark, [ev("z", "x", ts=T0 + dt.timedelta(days=5))])))\
        .write.mode("overwrite").partitionBy("event_date").parquet(path)    # an untouched older partition
    cutoff = (T0 + dt.timedelta(hours=20)).isoformat(sep=" ")
    first = sorted(r.event_id for r in M.reprocess_dates(raw, cutoff, path).collect())
    second = sorted(r.event_id for r in M.reprocess_dates(raw, cutoff, path).collect())
    assert first == second == ["a", "b", "c"]       # dates with arrivals after the cutoff: 01-03, 01-05
    everything = sorted(r.event_id for r in spark.read.parquet(path).collect())
    assert everything == ["a", "b", "c", "z"]       # 01-08 untouched, nothing duplicated


def test_scd1_upsert_latest_wins_ties_to_incoming(spark):
    schema = "k string, v string, loaded_at timestamp_ntz"
    cur = spark.createDataFrame([("a", "old", T0), ("b", "keep", T0)], schema)
    inc = spark.createDataFrame([("a", "new", T0), ("c", "add", T0 + dt.timedelta(days=1))], schema)
    got = {r.k: r.v for r in M.scd1_upsert(cur, inc, "k").collect()}
    assert got == {"a": "new", "b": "keep", "c": "add"}


def test_a_large_portfolio_is_written_and_read_in_parts(spark, tmp_path):
    day = dt.date(2024, 1, 3)
    rows = [("a", f"T{k % 3}", 2, 1.5, day) for k in range(70)] + [("b", "T0", 1, 2.0, day)]
    df = spark.createDataFrame(rows, "portfolio_id string, ticker string, shares long, price double, date date")
    IO.write_named_csv(df, str(tmp_path), "portfolio_id", rows_per_file=20)
    files = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("[!.]*.csv"))
    assert "a.csv" in files and "b.csv" in files and any(f.startswith("portfolio_id=a/") for f in files)
    assert max(len(p.read_text().splitlines()) for p in tmp_path.rglob("[!.]*.csv")) <= 21
    out = {r.portfolio_id: r for r in D.portfolio_summary(D.read_portfolios(spark, str(tmp_path))).collect()}
    assert {k: (r.positions, r.tickers, r.market_value) for k, r in out.items()} == {
        "a": (70, 3, 210.0), "b": (1, 1, 2.0)}

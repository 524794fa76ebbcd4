"""The stored fact table: one build, changes by date, pruned reads, dense keys without renumbering."""
import datetime as dt
import glob
import tempfile

from eventide.operators import model as M
from eventide.operators.fact_store import FactStore
from eventide.sources import fixtures as X

T0 = dt.datetime(2024, 1, 3, 10, 0, 0)
SCHEMA = ("event_id string, event_name string, event_category string, tenant_id string, user_id string, session_id string, "
          "event_timestamp timestamp_ntz, collector_tstamp timestamp_ntz, platform_version string, event_source string, "
          "properties string, sdk_version string")


def event(key, ts, collected=None, props="{}"):
    return (key, "x", None, "t", "u", "s", ts, collected or ts, "1", "client", props, "2")


def keyed(store):
    return [(r.event_key, r.event_id, r.event_date) for r in store.read().orderBy("event_key").collect()]


def expected(rows):
    """A full rebuild in Python."""
    best = {}
    for r in rows:
        if r[0] not in best or (r[7], r[6]) < (best[r[0]][7], best[r[0]][6]):
            best[r[0]] = r
    order = sorted(best.values(), key=lambda r: (r[6] is not None, r[6] or T0, r[0]))
    return [(k + 1, r[0], r[6] and r[6].date()) for k, r in enumerate(order)]


def test_changes_equal_a_rebuild_and_touch_their_dates_only(spark):
    day, hour = dt.timedelta(days=1), dt.timedelta(hours=1)
    first = [event(f"e{d}_{k}", T0 + d * day + k * hour) for d in range(5) for k in range(6)]
    first += [event("only", T0 + 9 * day), event("none", None, T0)]
    store = FactStore(spark, tempfile.mkdtemp(prefix="fact-", dir="/tmp"))
    store.build(spark.createDataFrame(first, SCHEMA))
    assert keyed(store) == expected(first)
    files = {d: sorted(glob.glob(f"{store.path}/data/w=*/event_date=2024-01-0{3 + d}/*.parquet")) for d in range(5)}

    # a late row, a copy that loses, a copy that wins and moves its id, and one that empties a date
    more = [event("late", T0 + day + 30 * dt.timedelta(minutes=1), T0 + 6 * day), event("e0_1", T0 + 2 * day, T0 + 8 * day),
            event("e1_2", T0 + 3 * day, T0 - hour), event("only", T0 + 3 * day + hour, T0 - hour)]
    dates = store.apply(spark.createDataFrame(more, SCHEMA))
    assert sorted(d.day for d in dates) == [4, 6, 12]
    assert keyed(store) == expected(first + more)
    ids = [r[1] for r in keyed(store)]
    assert len(ids) == len(set(ids))
    # untouched dates keep their files, and none of them was written again
    for d in (0, 2, 4):
        assert sorted(glob.glob(f"{store.path}/data/w=*/event_date=2024-01-0{3 + d}/*.parquet")) == files[d]
    # the same rows again change nothing
    assert store.apply(spark.createDataFrame(more, SCHEMA)) == []
    assert keyed(store) == expected(first + more)


def test_reads_of_some_dates_are_pruned(spark):
    store = FactStore(spark, tempfile.mkdtemp(prefix="fact-", dir="/tmp"))
    store.build(spark.createDataFrame([event(f"e{d}", T0 + dt.timedelta(days=d)) for d in range(8)], SCHEMA))
    some = store._current("data", [T0.date(), T0.date() + dt.timedelta(days=1)])
    filters = some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in filters and "w" in filters
    assert sorted(r.event_id for r in some.collect()) == ["e0", "e1"]


def test_keys_are_those_of_one_global_order(spark, sf_dir):
    raw = X.raw_events(spark, sf_dir)
    store = FactStore(spark, tempfile.mkdtemp(prefix="fact-", dir="/tmp"))
    store.build(raw.where("collector_tstamp < '2024-01-20'"))
    store.apply(raw.where("collector_tstamp >= '2024-01-20'"))
    want = {r.event_id: r.event_key for r in M.fact_from_raw(raw, with_key=True).select("event_id", "event_key").collect()}
    assert {r.event_id: r.event_key for r in store.read().select("event_id", "event_key").collect()} == want

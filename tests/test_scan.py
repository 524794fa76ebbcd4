"""The one-exchange scan against plain Python, over partitions that cut groups anywhere."""
import pytest
from pyspark.sql import functions as F

from eventide.functions.scan import scan_groups


@pytest.mark.parametrize("parts", [1, 3, 13])
def test_scan_matches_row_by_row(spark, parts):
    rows = [(None if k % 11 == 0 else f"g{(k * k) % 7}", "hot" if k % 3 else None, k % 29, k, f"v{k}" if k % 5 else None) for k in range(400)]
    rows += [("one", "hot", None, 1000 + k, str(k)) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, h string, o int, id long, v string").repartition(4)
    got = {r.id: (r.seq_no, r.prev_v, r.prev_o) for r in scan_groups(df, ["g", "h"], ["o", "id"], ["v", "o"], num_partitions=parts).collect()}
    want, groups = {}, {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3])):
        before = groups.setdefault(r[:2], [])
        want[r[3]] = (len(before), before[-1][4] if before else None, before[-1][2] if before else None)
        before.append(r)
    assert got == want


def test_scan_needs_one_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    out = scan_groups(df, ["g"], ["id"], ["id"], num_partitions=5)
    assert out.where("seq_no = 0").count() == 3
    assert "Exchange hash" not in out._jdf.queryExecution().executedPlan().toString()
    assert scan_groups(df.limit(0), ["g"], ["id"], ["id"]).count() == 0
    assert sorted(r.seq_no for r in scan_groups(df, [], ["id"], [], num_partitions=7).collect()) == list(range(1000))

"""Positions in a global or per-group order without a single-task window.

``ROW_NUMBER() OVER (ORDER BY …)`` and exact quantiles put a whole group (or
the whole table) into one task. Here rows are range-partitioned on the order
keys, sorted inside each partition, numbered locally with
``monotonically_increasing_id`` and shifted by the row counts of the earlier
partitions. A hot group spreads over many range partitions, so no task holds
more than one partition's share. The numbered frame is checkpointed to the
shared checkpoint folder, so both passes (counts and numbering) read the same
materialized partitions even after an executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shuffle_partitions
from .scan import scan_groups

_LOCAL_MASK = (1 << 33) - 1


def with_position(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                  tiebreak: Sequence[str] | None = None, num_partitions: int | None = None,
                  pos_col: str = "_pos", size_col: str | None = "_n") -> DataFrame:
    """Attach a 0-based position of each row within its group in ``order_cols``
    order (ascending, NULLs first), plus the group size.

    ``tiebreak`` columns make range keys unique so that ties on the order keys
    can still be split across partitions; by default a per-row id taken before
    the shuffle is used.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    group_cols, order_cols = list(group_cols), list(order_cols)
    if tiebreak is None:
        df = df.withColumn("_tb", F.monotonically_increasing_id())
        tb = ["_tb"]
    else:
        tb = list(tiebreak)
    keys = group_cols + order_cols + tb
    # without a count AQE sizes the partitions from the data
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = (ranged.sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_MASK))))
    ranged = ranged.checkpoint(eager=True)

    if not group_cols:
        # One count per partition:
        # running offsets are computed on the driver and broadcast back.
        counts = dict(ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt")).collect())
        rows, acc = [], 0
        for pid in sorted(counts):
            rows.append((pid, acc))
            acc += counts[pid]
        offsets = F.broadcast(spark.createDataFrame(rows or [(0, 0)], "_pid int, _offset long"))
        out = ranged.join(offsets, "_pid").withColumn(pos_col, F.col("_offset") + F.col("_local"))
        if size_col:
            out = out.withColumn(size_col, F.lit(acc).cast("long"))
        return out.drop("_pid", "_local", "_offset", *(["_tb"] if tiebreak is None else []))

    # One row per (partition, group) present: at most partitions + groups rows;
    # the offset window is partitioned by group.
    stats = ranged.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_cnt"),
                                                   F.min("_local").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid")
    stats = stats.withColumn("_offset", F.sum("_cnt").over(w) - F.col("_cnt"))
    if size_col:
        stats = stats.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    # null-safe on the group columns: a NULL group is a group like any other
    st = stats.select(F.col("_pid").alias("_spid"), *[F.col(g).alias(f"_s_{g}") for g in group_cols],
                      "_first", "_offset", *([size_col] if size_col else []))
    cond = F.col("_pid") == F.col("_spid")
    for g in group_cols:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_s_{g}"))
    out = (ranged.join(st, cond)
                 .withColumn(pos_col, F.col("_offset") + F.col("_local") - F.col("_first"))
                 .drop("_pid", "_spid", "_local", "_first", "_offset", *[f"_s_{g}" for g in group_cols],
                       *(["_tb"] if tiebreak is None else [])))
    return out


def dense_sequence(df: DataFrame, order_cols: Sequence[str], out_col: str = "seq",
                   tiebreak: Sequence[str] | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_cols)`` (1-based) without a
    single-partition window."""
    return (with_position(df, order_cols, (), tiebreak=tiebreak, size_col=None)
            .withColumn(out_col, F.col("_pos") + F.lit(1)).drop("_pos"))


# the first histogram has so many buckets an octave, later ones so many in all
OCTAVE, BUCKETS, REFINEMENTS = 512, 1 << 14, 1


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], names: Sequence[str],
                    octave: int = OCTAVE, buckets: int = BUCKETS, refinements: int = REFINEMENTS) -> DataFrame:
    """Exact interpolated quantiles (``QUANTILE_CONT``) per group.

    Position h = (n-1)·p; result = v[⌊h⌋] + (h-⌊h⌋)·(v[⌈h⌉] - v[⌊h⌋]).

    Ranks are found by histogram refinement, the same for groups of any size:
    equal values are counted (combined map-side) and put into buckets by their
    logarithm, whose counts tell which one holds a wanted rank; that one is cut
    into ``buckets`` equal parts between its least and greatest value, and the
    few values left are walked in order. A window sees the buckets of a group
    (15,000 for values from 0 to 10^9), or the distinct values of a slice of
    10^-7 of its value. All of it is one lazy plan, whose counts are shuffled
    once and reused.
    """
    group_cols = list(group_cols)
    # a struct compares null-safe, so a NULL group is a group like any other
    group = F.struct(*[F.col(g) for g in group_cols]) if group_cols else F.struct(F.lit(0).alias("_all"))
    counts = (df.select(group.alias("_g"), F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
                .groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c")))

    def at(p: float):
        return (F.col("_n") - 1).cast("double") * F.lit(float(p))

    def before(by: str, *group):
        w = Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_c").over(w), F.lit(0))

    # a bucket number that never falls as the value rises; it is a key of the joins, so a hot group is spread
    size = F.floor(F.log2(F.abs(F.col("_v")) + 1) * octave)
    counts = counts.withColumn("_b", F.when(F.col("_v") < 0, -1 - size).otherwise(size))
    first = (counts.groupBy("_g", "_b")
                   .agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
                   .withColumn("_before", before("_b", "_g")).withColumn("_n", F.sum("_c").over(Window.partitionBy("_g"))))
    ranks = F.array_distinct(F.array(*[f(at(p)).cast("long") for p in probs for f in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda t: (t >= F.col("_before")) & (t < F.col("_before") + F.col("_c")))
    sought = first.select("_g", "_b", "_n", "_lo", "_hi", "_before", F.explode(here).alias("_t")).withColumn("_r", F.col("_t") - F.col("_before")).drop("_before")
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))

    def holding(counted: DataFrame, by: str) -> DataFrame:
        """The rows of (_g, _t) whose counts, in the order of ``by``, reach over the wanted rank."""
        return (counted.withColumn("_before", before(by, "_g", "_t"))
                       .where((F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_before") + F.col("_c")))
                       .withColumn("_r", F.col("_r") - F.col("_before")))

    for _ in range(refinements):
        width = F.col("_hi") - F.col("_lo")
        bucket = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / width * buckets), F.lit(buckets - 1))).otherwise(0)
        counted = (counts.join(sought, ["_g", "_b"]).where(inside).groupBy("_g", "_b", "_n", "_t", "_r", bucket.alias("_part"))
                         .agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
        sought = holding(counted, "_part").select("_g", "_b", "_n", "_t", "_lo", "_hi", "_r")
    found = holding(counts.join(sought, ["_g", "_b"]).where(inside), "_v").groupBy("_g", "_n").agg(
        F.map_from_entries(F.collect_list(F.struct("_t", "_v"))).alias("_at"))       # two entries a quantile at most
    out = [F.col("_g").getField(g).alias(g) for g in group_cols]
    for p, name in zip(probs, names):
        lo, hi = (F.element_at("_at", f(at(p)).cast("long")) for f in (F.floor, F.ceil))
        out.append((lo + (hi - lo) * (at(p) - F.floor(at(p)))).alias(name))
    return found.select(*out)


def lag_by_position(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    value_cols: Sequence[str], tiebreak: Sequence[str],
                    prefix: str = "prev_") -> DataFrame:
    """``LAG(v) OVER (PARTITION BY g ORDER BY o)`` and the 0-based ``seq_no``,
    by one scan of range partitions (see ``scan_groups``); a hot group is
    spread over as many of them as it needs."""
    return scan_groups(df, group_cols, [*order_cols, *tiebreak], value_cols, prefix=prefix)


def asof_last(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              left_id: str, value_cols: Sequence[str]) -> DataFrame:
    """As-of join: for each left row, the right row of the same keys with the
    greatest ``right_ts <= left_ts`` (NULL values when none; among rows with
    that time, the greatest value).

    Both sides are merged into one timeline, range-partitioned on
    (keys, ts) so a hot key spreads over many partitions, checkpointed, and
    scanned with a running "last value" inside each (partition, key). The
    value entering a partition from earlier ones comes from a small table
    with one row per (partition, key). No key's rows meet in one task.
    Returns ``left_id`` and ``value_cols``.
    """
    spark = left.sparkSession
    checkpoint_dir(spark)
    keys = list(keys)
    id_type = dict(left.dtypes)[left_id]
    vstruct = F.struct(F.col(right_ts).alias("_vts"), *[F.col(v) for v in value_cols])
    r = right.select(*keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_kind"),
                     F.lit(None).cast(id_type).alias("_lid"), vstruct.alias("_v"))
    l = left.select(*keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_kind"), F.col(left_id).alias("_lid"),
                    F.lit(None).cast(r.schema["_v"].dataType).alias("_v"))
    u = l.unionByName(r).withColumn("_tb", F.monotonically_increasing_id())
    order = [*keys, "_ts", "_kind", "_v", "_tb"]   # ties on time: greatest value wins
    ranged = (u.repartitionByRange(shuffle_partitions(spark), *order)
               .withColumn("_pid", F.spark_partition_id())).checkpoint(eager=True)
    right_row = F.when(F.col("_kind") == 0, F.struct("_ts", "_v", "_tb"))
    stats = ranged.groupBy("_pid", *keys).agg(F.max(right_row).alias("_lastrow"))
    carry_w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_carry", F.last(F.col("_lastrow._v"), ignorenulls=True).over(carry_w)) \
                 .select("_pid", *keys, "_carry")
    run_w = (Window.partitionBy("_pid", *keys).orderBy("_ts", "_kind", "_v", "_tb")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_local", F.last(F.when(F.col("_kind") == 0, F.col("_v")), ignorenulls=True)
                              .over(run_w)).where(F.col("_kind") == 1)
    st = stats.select(F.col("_pid").alias("_spid"), *[F.col(k).alias(f"_s_{k}") for k in keys], "_carry")
    cond = F.col("_pid") == F.col("_spid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_s_{k}"))      # NULL keys carry over too
    out = local.join(st, cond, "left").withColumn("_best", F.coalesce("_local", "_carry"))
    return out.select(F.col("_lid").alias(left_id), *[F.col(f"_best.{v}").alias(v) for v in value_cols])

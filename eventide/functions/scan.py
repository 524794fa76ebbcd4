"""One pass over globally sorted rows, with one carried row per range partition.

``LAG`` and ``ROW_NUMBER`` over a window put a whole group into one task.
Here the rows are range-partitioned on (group, order), so a hot group spreads
over as many partitions as it needs, and each task scans its sorted partition
in Arrow batches. Only a partition's first group can have begun before it:
its rows take the count and the last row of the partition before, from a
table with one row per partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..session import scratch_path


def _same_as_before(batch, columns: Sequence[str]) -> np.ndarray:
    """Whether each row but the first has the values of the row before it (nulls are equal)."""
    import pyarrow.compute as pc

    same = np.ones(max(batch.num_rows - 1, 0), bool)
    for c in columns:
        col = batch.column(batch.schema.get_field_index(c))
        a, b = col.slice(1), col.slice(0, len(col) - 1)
        both_null = pc.and_(pc.is_null(a), pc.is_null(b))
        same &= pc.or_(pc.fill_null(pc.equal(a, b), False), both_null).to_numpy(zero_copy_only=False)
    return same


def _scan(groups: Sequence[str], values: Sequence[str], prefix: str):
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        last, held = None, None         # the last row so far (with its place), and the batch not yet given out
        lead = True                     # still in the partition's first group
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            begins = np.concatenate([[True], ~_same_as_before(batch, groups)])
            edge = last is None
            if not edge:
                begins[0] = [col[g][0].as_py() for g in groups] != last[0]
            first = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
            seq = np.where(first >= 0, np.arange(n) - first, np.arange(n) + (last[1] + 1 if not edge else 0))
            in_lead = np.zeros(n, bool)
            if lead:
                later = np.flatnonzero(begins[1:]) + 1 if edge else np.flatnonzero(begins)
                in_lead[:later[0] if len(later) else n] = True
                lead = not len(later)
            before = []
            for v in values:
                head = pa.nulls(1, col[v].type) if edge else last[2][v]
                shifted = pa.concat_arrays([head, col[v].slice(0, n - 1)])
                before.append(pc.if_else(pa.array(begins), pa.scalar(None, col[v].type), shifted))
            marks = np.zeros(n, bool)
            out = [*batch.columns, pa.array(seq.astype(np.int64)), *before, pa.array(in_lead), pa.array(np.arange(n) == (0 if edge else -1)), pa.array(marks)]
            names = [*batch.schema.names, "_seq", *[prefix + v for v in values], "_lead", "_edge", "_end"]
            if held is not None:
                yield held
            held = pa.RecordBatch.from_arrays(out, names=names)
            last = [col[g][n - 1].as_py() for g in groups], int(seq[-1]), {v: col[v].slice(n - 1, 1) for v in values}
        if held is not None:
            end = np.zeros(held.num_rows, bool)
            end[-1] = True
            yield pa.RecordBatch.from_arrays([*held.columns[:-1], pa.array(end)], names=held.schema.names)
    return run


def scan_groups(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str],
                num_partitions: int | None = None, prefix: str = "prev_", seq_col: str = "seq_no") -> DataFrame:
    """``df`` with the 0-based place of each row in its group and the values of the row before it.

    ``order_cols`` order a group's rows, nulls first; NULL groups are groups
    like any other. Costs one range exchange and one write of the scanned
    rows; the carried rows are one per partition.
    """
    spark, groups, values = df.sparkSession, list(group_cols), list(value_cols)
    keys = [*groups, *order_cols]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id())
    schema = StructType([*ranged.schema.fields, StructField("_seq", LongType()),
                         *[StructField(prefix + v, df.schema[v].dataType) for v in values],
                         *[StructField(c, BooleanType()) for c in ("_lead", "_edge", "_end")]])
    path = scratch_path(spark, f"scan-{uuid.uuid4().hex}")
    ranged.mapInArrow(_scan(groups, values, prefix), schema).write.parquet(path)
    scanned = spark.read.schema(schema).parquet(path)

    # one row per partition: what its first group carries over
    ends = scanned.where("_edge OR _end").select("_pid", "_edge", "_end", "_lead", "_seq", F.struct(*groups).alias("_g") if groups else F.lit(None).alias("_g"),
                                                 *[F.col(v) for v in values]).collect()
    first = {r._pid: r for r in ends if r._edge}
    last = {r._pid: r for r in ends if r._end}
    rows, carry = [], None              # carry: (group, rows so far, values) of the partition before
    for pid in sorted(first):
        if carry is not None and carry[0] == first[pid]._g:
            rows.append((pid, carry[1], *carry[2]))
            so_far = carry[1]
        else:
            so_far = 0
        end = last[pid]
        carry = end._g, end._seq + 1 + (so_far if end._lead else 0), [end[v] for v in values]
    table = StructType([StructField("_pid", schema["_pid"].dataType), StructField("_before", LongType()),
                        *[StructField(f"_c_{v}", df.schema[v].dataType) for v in values]])
    out = scanned.join(F.broadcast(spark.createDataFrame(rows, table)), "_pid", "left")
    return out.select(*df.columns, (F.col("_seq") + F.when(F.col("_lead"), F.coalesce("_before", F.lit(0))).otherwise(0)).alias(seq_col),
                      *[F.when(F.col("_edge") & F.col("_before").isNotNull(), F.col(f"_c_{v}")).otherwise(F.col(prefix + v)).alias(prefix + v) for v in values])

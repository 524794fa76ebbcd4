"""The fact table kept on storage: built once, then changed date by date (M-5, M-12, M-14).

    data/w=<write>/event_date=<date>/   fact rows, each with its place in the write's sorted order
    ids/w=<write>/event_date=<date>/    the index of winners: event_id and what its copies are ranked by
    parts/v=<write>/                    which write a date's rows are current in, with the row counts

Every write sorts by (event_timestamp, event_id) over range partitions and
stores a row's partition and position. ``parts`` holds one row per (date,
partition) with its count; the sums of the counts before it are offsets, and
``event_key`` = offset + position. So the dense key costs no second write, and
it stays dense when a date is rewritten: only the offsets, a small table,
change for the dates behind it.

A change writes new folders for the dates that it touches and then a new
``parts`` version, which is the commit: readers and retries see the state
before or after it, never one between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.skew import bounded_broadcast
from ..session import scratch_path
from .model import build_fact, dedupe_events

# what the copies of an event are ranked by, and where each row stands
RANK = ["_collected", "event_timestamp", "event_name", "_tie"]
PLACE = ["_pid", "_pos"]
_LOCAL = (1 << 33) - 1


class FactStore:
    """A stored fact table under ``path``; ``keep`` names further raw columns that its rows carry."""

    def __init__(self, spark: SparkSession, path: str, cluster: Sequence[str] = ("tenant_id", "event_name"),
                 keep: Sequence[str] = ()):
        self.spark, self.path, self.cluster, self.keep = spark, path.rstrip("/"), list(cluster), list(keep)

    # ---- reading
    def version(self) -> int | None:
        """The last committed write, None before the first."""
        try:
            found = self.spark.read.parquet(f"{self.path}/parts")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise
        return found.agg(F.max("v")).first()[0]

    def _parts(self) -> DataFrame:
        v = self.version()
        if v is None:
            raise ValueError(f"no fact table under {self.path}")
        return self.spark.read.parquet(f"{self.path}/parts/v={v}")

    def offsets(self) -> DataFrame:
        """(w, event_date, _pid, _shift): ``event_key`` is ``_shift`` + ``_pos``. One row per date and file group."""
        w = Window.orderBy("event_date", "_pid").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(w), F.lit(0))
        return self._parts().select("w", "event_date", "_pid", (before - F.col("first") + 1).alias("_shift"))

    def _current(self, table: str, dates: Sequence | None = None) -> DataFrame:
        """Rows of the current writes; with ``dates`` only those folders are read."""
        parts = self._parts()
        df = self.spark.read.option("basePath", f"{self.path}/{table}").parquet(f"{self.path}/{table}")
        if dates is not None:
            some = [d for d in dates if d is not None]
            cond = F.col("event_date").isin(*some) if some else F.lit(False)
            if len(some) < len(dates):
                cond = cond | F.col("event_date").isNull()
            parts, df = parts.where(cond), df.where(cond)
            writes = [r[0] for r in parts.select("w").distinct().collect()]      # one a write
            df = df.where(F.col("w").isin(*writes) if writes else F.lit(False))
        now = parts.select(F.col("w").alias("_w"), F.col("event_date").alias("_d")).distinct()
        return df.join(bounded_broadcast(now), (F.col("w") == F.col("_w")) & F.col("event_date").eqNullSafe(F.col("_d")), "left_semi")

    def read(self, with_key: bool = True) -> DataFrame:
        """The fact rows, with the dense ``event_key`` in (event_timestamp, event_id) order."""
        df = self._current("data")
        if with_key:
            o = bounded_broadcast(self.offsets().select(F.col("w").alias("_w"), F.col("event_date").alias("_d"), F.col("_pid").alias("_p"), "_shift"))
            df = df.join(o, (F.col("w") == F.col("_w")) & F.col("event_date").eqNullSafe(F.col("_d")) & (F.col("_pid") == F.col("_p")))
            df = df.withColumn("event_key", F.col("_shift") + F.col("_pos")).drop("_w", "_d", "_p", "_shift")
        out = df.drop("w", "_collected", "_tie", *PLACE)
        return out.select("event_key", *[c for c in out.columns if c != "event_key"]) if with_key else out

    # ---- writing
    def _write(self, fact: DataFrame, write: int) -> DataFrame:
        """Store rows as one write; returns the counts of its (date, partition)s."""
        order = ["event_timestamp", "event_id"]
        placed = (fact.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_pid", F.spark_partition_id())
                  .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL))))
        data, ids = f"{self.path}/data/w={write}", f"{self.path}/ids/w={write}"
        (placed.sortWithinPartitions("event_date", *self.cluster).write.mode("overwrite")
               .option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(data))
        kept = self.spark.read.parquet(data)
        # narrow: five columns of what was just written, for the index
        (kept.select("event_id", *RANK, "event_date").write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(ids))
        return (kept.groupBy("event_date", "_pid").agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first"))
                    .select(F.lit(write).alias("w"), "event_date", "_pid", "n", "first"))

    def _commit(self, parts: DataFrame, version: int) -> None:
        parts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/parts/v={version}")

    @staticmethod
    def _winners(raw: DataFrame) -> DataFrame:
        """One row per event_id, with the columns that its rank among copies is kept by (see ``dedupe_events``)."""
        payload = [c for c in raw.columns if c not in ("event_id", "collector_tstamp")]
        return (dedupe_events(raw).withColumn("_tie", F.xxhash64(*[F.col(c) for c in payload]))
                .withColumn("_collected", F.col("collector_tstamp")))

    def build(self, raw: DataFrame, as_of: str | None = None) -> None:
        """A full build from raw events, duplicates included."""
        version = self.version()
        write = 0 if version is None else version + 1
        self._commit(self._write(build_fact(self._winners(raw), as_of=as_of, keep=[*self.keep, "_collected", "_tie"]), write), write)

    def apply(self, raw: DataFrame, as_of: str | None = None) -> list:
        """Merge further raw events, however late; returns the dates that were rewritten.

        A copy that outranks the stored one replaces it, also on another date; all other copies of known ids
        are ignored. Untouched dates are neither read nor written, beyond the index.
        """
        write = self.version() + 1
        new = self._winners(raw)
        old = self._current("ids").select(F.col("event_id").alias("_id"), F.struct(*RANK).alias("_old"), F.col("event_date").alias("_old_date"))
        found = new.join(old, F.col("event_id") == F.col("_id"), "left").where(F.col("_id").isNull() | (F.struct(*RANK) < F.col("_old")))
        path = scratch_path(self.spark, f"{self.path.rsplit('/', 1)[-1]}-accepted-{write}")
        build_fact(found, as_of=as_of, keep=[*self.keep, "_collected", "_tie", "_id", "_old_date"]).write.mode("overwrite").parquet(path)
        accepted = self.spark.read.parquet(path)
        gone = accepted.where(F.col("_id").isNotNull())
        # one row a date
        dates = [r[0] for r in accepted.select("event_date").union(gone.select("_old_date")).distinct().collect()]
        if not dates:
            return []
        stays = self._current("data", dates).drop("w", *PLACE).join(gone.select("event_id"), "event_id", "left_anti")
        fresh = accepted.drop("_id", "_old_date")
        counts = self._write(stays.select(*fresh.columns).unionByName(fresh), write)
        some = [d for d in dates if d is not None]
        touched = F.coalesce(F.col("event_date").isin(*some), F.lit(None in dates)) if some else F.col("event_date").isNull()
        self._commit(self._parts().where(~touched).unionByName(counts), write)
        return dates

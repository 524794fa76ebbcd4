"""Joins that stay balanced when one key holds a large share of the rows.

``split_join`` salts hot keys: a key of the large side with more than
``threshold`` rows gets ``ceil(rows / threshold)`` salts; its rows pick a salt
by hash and the per-key side (``keyed``: a dimension or a per-key aggregate,
few rows per key) is replicated once per salt. One shuffle join then serves
hot and cold keys alike, and no reducer receives more than about
``threshold`` rows of one key. The table of salted keys is broadcast; its
size is bounded by construction (at most rows / threshold keys). The per-key
counts come from one partial aggregate, or from the caller when it already
aggregates the same rows (fused into its own pass).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions

DEFAULT_HOT_ROWS = 2_000_000


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; combined map-side, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(df: DataFrame, keys: Sequence[str], threshold: int = DEFAULT_HOT_ROWS,
             counts: DataFrame | None = None) -> DataFrame:
    """Keys with more than ``threshold`` rows and their salt count."""
    c = counts if counts is not None else key_counts(df, keys)
    return (c.where(F.col("_rows") > F.lit(threshold))
             .select(*keys, F.ceil(F.col("_rows") / F.lit(threshold)).cast("int").alias("_salts")))


def split_join(big: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str = "inner",
               condition=None, threshold: int = DEFAULT_HOT_ROWS,
               counts: DataFrame | None = None) -> DataFrame:
    """``big`` joined with ``keyed`` on ``keys`` (+ optional residual condition).

    ``how`` is ``inner`` or ``left`` (rows of ``big`` kept). ``condition`` is a
    function ``(big_df, keyed_df) -> Column`` evaluated after the key match.
    ``counts`` (keys, ``_rows``) may be passed when the caller has them.
    """
    if how not in ("inner", "left"):
        raise ValueError("split_join supports inner and left joins")
    keys = list(keys)
    no_key = F.lit(False)
    for c in keys:
        no_key = no_key | F.col(c).isNull()
    if how == "inner":
        big = big.where(~no_key)
    # at most rows / threshold keys
    salts = F.broadcast(hot_keys(big, keys, threshold, counts))
    n = F.coalesce(F.col("_salts"), F.lit(1))
    # a NULL key meets nothing; its rows may go anywhere, so they take as many salts as there are partitions
    spread = F.when(no_key, F.lit(shuffle_partitions(big.sparkSession))).otherwise(n)
    b = (big.join(salts, keys, "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), spread).cast("int"))
            .drop("_salts"))
    k = (keyed.join(salts, keys, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
              .drop("_salts"))
    jk = keys + ["_salt"]
    if condition is None:
        return b.join(k, jk, how).drop("_salt")
    l, r = b.alias("_l"), k.alias("_r")
    cond: Column = condition(l, r)
    for c in jk:
        cond = (F.col(f"_l.{c}") == F.col(f"_r.{c}")) & cond
    other = [c for c in keyed.columns if c not in keys]
    return l.join(r, cond, how).select(*[F.col(f"_l.{c}") for c in big.columns],
                                       *[F.col(f"_r.{c}") for c in other])


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (a limited count)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows
    (a cheap limited count); otherwise return it unhinted so the planner and
    AQE pick a shuffle join from runtime sizes."""
    return F.broadcast(df) if fits(df, max_rows) else df

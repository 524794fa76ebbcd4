"""Connected components of an edge table, by DataFrame joins with the edges kept on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; the root is the smallest node of its component.

    Alternating large-star and small-star steps: each links nodes to the
    smallest node they see, so stars remain after a number of rounds
    logarithmic in the number of nodes. Every round is written to the shared
    folder; minima are pre-aggregated before the shuffle. Null ends and loops
    are left out; no edges give no rows.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e = stored(e, "edges")
    while not _only_stars(e):
        big = _star(e, large=True)
        e = stored(_star(big, large=False).distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star step; the result has edges (u, v) with u > v, no more than ``e`` for a large one."""
    both = (e.union(e.select("v", "u")) if large
            else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # large: neighbours above u go to m; small: u and its lower neighbours go to m
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
    else:
        out = moved.select(F.col("v").alias("x"), F.col("m").alias("y")).union(
            least.select(F.col("u").alias("x"), F.col("m").alias("y")))
    return out.where("x <> y").select(F.col("x").alias("u"), F.col("y").alias("v"))


def _only_stars(e: DataFrame) -> bool:
    """Whether every edge (u, v) leads down to a v that no edge leaves, and is the only one of its u."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in"), (F.col("u") < F.col("v")).alias("up")).union(
        e.select("v", F.lit(0), F.lit(1), F.lit(False)))
    of = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in"), F.max("up").alias("up"))
    return of.where("out > 1 or (out = 1 and in = 1) or up").agg(F.count(F.lit(1))).first()[0] == 0

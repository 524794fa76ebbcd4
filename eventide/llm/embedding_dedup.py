"""Near-duplicate vectors by sorted projection passes.

Each pass gives every vector 64 random hashes (signs of random projections),
concatenated to one number, sorts the table by it, and compares each vector
with a bounded window of its successors; the verified pairs of all passes are
united. So many passes are made that a pair at the bound is met with
probability ``RECALL``; nearer pairs are met sooner.

Windows alone would lose links inside groups larger than a window. They only
have to connect a group, though: the links of a component are then counted
exactly. By the triangle inequality two members whose distances from the
component's mean sum to no more than the link distance are linked; the members
too far out for that are compared with each other, in blocks. Equal vectors are
one node with a weight throughout, so copies cost nothing.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, nor do vectors of different lengths. Rows that
repeat an id are rows of their own. A null id is no candidate for a component's
smallest id; a component of null ids only has the id null and keeps its rows.
Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import stored
from eventide.llm.components import connected_components

WINDOW = 128            # successors that a vector is compared with
BITS = 64
RECALL = 0.999          # chance that the passes meet a pair at the bound
TOGETHER = 4            # passes in one job: what is shuffled at a time
PART_ROWS = 1 << 14     # sorted rows of a task
BLOCK_ROWS = 1 << 11    # outer members that are compared at a time
SLACK = 1e-9            # of distances, for rounding


def passes_for(n: int, least: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair with cosine ``least`` among ``n`` vectors has met in a window with probability ``recall``.

    Vectors stand within a window when about log2(n / window) leading hashes agree.
    """
    agree = 1 - math.acos(least) / math.pi
    met = agree ** (max(0.0, math.log2(max(n, 1) / window)) + 1)
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - met))) if met < 1 else 4


def _matrix(column: pa.Array, lo: int, hi: int, dim: int) -> np.ndarray:
    return column.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(hi - lo, dim)


def _runs(*keys: np.ndarray):
    """(first, end) of the runs of rows that are equal in all keys."""
    n = len(keys[0])
    cut = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1 if n else []
    return zip([0, *cut] if n else [], [*cut, n], strict=True)


def signatures(passes: int):
    """Adds unit vectors ``y`` and a number of hashes for each pass; vectors without a direction get nulls."""

    def run(batches):
        projections: dict[int, np.ndarray] = {}
        for batch in batches:
            v, dims = batch.column(batch.schema.get_field_index("v")), batch.column(batch.schema.get_field_index("dim")).to_numpy()
            unit, sigs = [None] * len(dims), [None] * len(dims)
            order = np.argsort(dims, kind="stable")
            v = v.take(pa.array(order))
            for lo, hi in _runs(dims[order]):
                d = int(dims[order[lo]])
                if d not in projections:
                    projections[d] = np.random.default_rng(d).standard_normal((d, passes * BITS))
                x = _matrix(v, lo, hi, d)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                bits = np.packbits(x @ projections[d] > 0, axis=1).reshape(hi - lo, passes, BITS // 8)
                # as signed numbers in the order of the bits
                sig = (bits.reshape(-1).view(">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64).reshape(hi - lo, passes)
                for k, row in enumerate(order[lo:hi].tolist()):
                    unit[row], sigs[row] = x[k], sig[k]
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("node", "dim", "w", "least")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(unit, pa.list_(pa.float64())), pa.array(sigs, pa.list_(pa.int64()))],
                                             names=["node", "dim", "w", "least", "y", "sigs"])
    return run


def _windows(bound: float, window: int):
    """From rows sorted by (pass, dim, hashes): edges that connect what is linked within windows."""

    def run(batches):
        left = None
        for batch in batches:
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in ("pass", "dim", "node", "y")}
            step, dims, nodes = col["pass"].to_numpy(), col["dim"].to_numpy(), col["node"].to_numpy(zero_copy_only=False)
            out_a, out_b = [], []
            for lo, hi in _runs(step, dims):
                key, y, name = (step[lo], dims[lo]), _matrix(col["y"], lo, hi, int(dims[lo])), nodes[lo:hi]
                if left is not None and left[0] == key:
                    y, name = np.concatenate([left[1], y]), np.concatenate([left[2], name])
                label = np.arange(len(y))
                pairs = []
                for s in range(0, len(y), 512):
                    i, j = np.nonzero(y[s:s + 512] @ y[s:s + 512 + window].T >= bound)
                    near = (j > i) & (j - i <= window)
                    pairs.append((i[near] + s, j[near] + s))
                i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
                while len(i):
                    np.minimum.at(label, j, label[i])
                    np.minimum.at(label, i, label[j])
                    label = label[label]
                    if (label[i] == label[j]).all():
                        break
                moved = np.flatnonzero(label != np.arange(len(y)))
                out_a.append(name[moved])
                out_b.append(name[label[moved]])
                left = key, y[-window:], name[-window:]
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).tolist(), pa.string()) for x in (out_a, out_b)], names=["a", "b"])
    return run


def _outer_links(bound: float):
    """Of one pair of blocks of a component's outer members: each member's links to those of the other block, by weight."""

    def run(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        own, node = table.column("block").to_numpy(), table.column("node").to_numpy()
        dim = len(table.column("y")[0])
        y, w = _matrix(table.column("y").combine_chunks(), 0, len(own), dim), table.column("w").to_numpy()
        one, two = np.flatnonzero(own == i), np.flatnonzero(own == j)
        links = np.zeros(len(own), np.int64)
        for s in range(0, len(one), 256):
            rows = one[s:s + 256]
            near = y[rows] @ y[two].T >= bound
            if i == j:
                near[np.arange(len(rows)), np.arange(s, s + len(rows))] = False
            else:
                links[two] += w[rows] @ near
            links[rows] += near @ w[two]
        return pa.table({"node": pa.array(node, pa.string()), "links": pa.array(links)})
    return run


def near_duplicates(df: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", window: int = WINDOW) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept) with links at cosine >= ``least``.

    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id reachable by
    links, itself included, ``kept`` marks the rows that have it.
    """
    id_type = df.schema[id_col].dataType
    vector = F.col(vector_col).cast("array<double>")
    good = F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(vector, lambda x: x != 0), F.lit(False))
    # equal vectors are one node, named by 128 bits of hash
    name = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), F.transform(vector, lambda x: x + 0.0))), 16, "0") for k in (1, 2)])
    rows = stored(df.select(F.col(id_col).alias("id"), F.when(good, name).alias("node"), F.when(good, vector).alias("v")), "vectors")
    nodes = (rows.where("node IS NOT NULL").groupBy("node")
             .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("w"), F.first("v").alias("v")).withColumn("dim", F.size("v")))
    passes = passes_for(rows.count(), least, window)
    idt = id_type.simpleString()
    nodes = stored(nodes.mapInArrow(signatures(passes), f"node string, dim int, w long, least {idt}, y array<double>, sigs array<long>"), "nodes")
    n = nodes.count()
    edges = None
    for at in range(0, passes, TOGETHER):
        some = min(TOGETHER, passes - at)
        dealt = nodes.select("node", "dim", "y", F.posexplode(F.slice("sigs", at + 1, some)).alias("pass", "sig"))
        order = ["pass", "dim", "sig", "node"]
        met = stored(dealt.repartitionByRange(max(1, -(-n * some // PART_ROWS)), *order).sortWithinPartitions(*order)
                     .mapInArrow(_windows(least, window), "a string, b string"), "met")
        edges = met if edges is None else edges.union(met)
    roots = connected_components(edges)
    member = stored(nodes.drop("sigs").join(roots, "node"), "members")

    # distance of each member from its component's mean, and what that tells
    apart = math.sqrt(2 - 2 * least) - SLACK
    mean = member.groupBy("root").agg(vector_to_array(Summarizer.mean(array_to_vector("y"))).alias("mean"), F.sum("w").alias("all_w"), F.min("least").alias("component"))
    off = F.sqrt(F.aggregate(F.zip_with("y", "mean", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    member = stored(member.join(mean, "root").select("root", "node", "w", "y", "all_w", "component", off.alias("off")), "offs")
    most = member.groupBy("root").agg(F.max("off").alias("most"))
    member = member.join(most, "root").withColumn("outer", F.col("off") + F.col("most") > apart)
    outer = stored(member.where("outer").select("root", "node", "w", "y"), "outer")
    size = outer.groupBy("root").agg(F.sum("w").alias("outer_w"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    blocks = (outer.join(size, "root").withColumn("block", F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)"))
              .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .select("root", "node", "w", "y", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    direct = blocks.groupBy("root", "i", "j").applyInArrow(_outer_links(least), "node string, links long").groupBy("node").agg(F.sum("links").alias("links"))
    linked = (member.join(size.select("root", "outer_w"), "root", "left").join(direct, "node", "left")
              .select("node", "component", F.when(F.col("outer"), F.col("all_w") - F.col("outer_w") + F.col("links") + F.col("w") - 1)
                      .otherwise(F.col("all_w") - 1).alias("links")))
    # every node, also those without links
    linked = nodes.select("node", "w", "least").join(linked, "node", "left").select(
        "node", F.coalesce("links", F.col("w") - 1).alias("links"), F.coalesce("component", "least").alias("component"))
    out = rows.select("id", "node").join(linked, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))

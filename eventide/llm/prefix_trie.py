"""The trie of conversation prefixes, measured by an Euler tour.

Every node of the trie gets an enter and an exit arc; each arc knows its
successor on the tour around the trie (first child, next sibling, or back to
the parent). The tour is one linked list, which is ranked distributedly: a
sixteenth of the arcs are rulers, pointers double until they reach a ruler,
and the list of rulers is ranked the same way until it fits one bounded task.
Prefix sums of leaves and savings at the arcs' positions then give each
subtree as a difference of two sums.

Nodes are told apart by 128 bits: the sum of the hashes of (place, role,
text) over a prefix, so a parent's name is a child's name less its last turn.

Defined cases: turns of one conversation that share a number come by role,
then by the SHA-256 of the text; repeated rows are turns of their own. A null
role or text is empty, a null turn comes first. Rows without a conv_id belong
to no conversation. ``c % group`` has the sign of c. Other columns are not
read. No conversations give no nodes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.ranking import lag_by_position, with_position
from eventide.llm.common import stored
from eventide.session import shuffle_partitions

RULERS = 16             # one arc in so many is a ruler
ONE_TASK = 1 << 16      # links of a list that one task ranks
WIDTH = 1 << 14         # rows of one window of a running sum
PART_ROWS = 1 << 17     # numbered rows of a task
LANES = ["s1", "s2", "s3", "s4"]
ROOT = "root"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def running_sums(df: DataFrame, keys: list[str], at: str, values: list[str], width: int = WIDTH) -> DataFrame:
    """Inclusive running sums of ``values`` (non-null) by ``at``, 0, 1, 2, … within ``keys``, in place of the values.

    Sums run over blocks of ``width`` rows, the blocks' totals over blocks of blocks, and those over the rest,
    so that no window holds more than ``width`` rows up to width cubed rows a key.
    """
    def blocks_before(of: DataFrame, by: str, window) -> DataFrame:
        return of.select(*keys, by, *(["up"] if by == "block" else []), *[(F.sum(v).over(window.orderBy(by)) - F.col(v)).alias(f"{v}_{by}") for v in values])

    df = df.withColumn("block", F.expr(f"`{at}` DIV {width}"))
    totals = df.groupBy(*keys, "block").agg(*[F.sum(v).alias(v) for v in values]).withColumn("up", F.expr(f"block DIV {width}"))
    upper = totals.groupBy(*keys, "up").agg(*[F.sum(v).alias(v) for v in values])
    upper = blocks_before(upper, "up", Window.partitionBy(*keys))
    lower = blocks_before(totals, "block", Window.partitionBy(*keys, "up"))
    before = (lower.join(upper, [*keys, "up"]).where("block > 0")
              .select(*keys, "block", *[(F.col(f"{v}_block") + F.col(f"{v}_up")).alias(f"{v}_before") for v in values]))
    own = Window.partitionBy(*keys, "block").orderBy(at)
    out = df.select(*[c for c in df.columns if c not in values], *[F.sum(v).over(own).alias(v) for v in values])
    out = out.join(before, [*keys, "block"], "left")
    return out.select(*[c for c in df.columns if c not in values and c != "block"],
                      *[(F.col(v) + F.coalesce(f"{v}_before", F.lit(0))).alias(v) for v in values])


def list_ranks(links: DataFrame, level: int = 0) -> DataFrame:
    """(id, rank) of one linked list given as (id, next, hop): the sum of hops from each link to the list's end.

    ``next`` of the last link is null. Every round doubles the pointers that have not yet met a ruler; each
    pointer is looked up by one other at most, so no key is hot.
    """
    links = stored(links, "links")
    if links.count() <= ONE_TASK:
        return links.groupBy(F.lit(0).alias("all_")).applyInArrow(_rank_here, "id string, rank long")
    # each level draws rulers of its own
    ruler = f"pmod(xxhash64(to, {level}), {RULERS}) = 0"
    state = stored(links.select("id", F.col("next").alias("to"), F.col("hop").alias("dist")).withColumn("done", F.expr(f"to IS NULL OR {ruler}")), "hops")
    while state.where("NOT done").limit(1).count():
        ahead = state.select(F.col("id").alias("to"), F.col("to").alias("then"), F.col("dist").alias("more"), F.col("done").alias("there"))
        moved = state.where("NOT done").join(ahead, "to").select("id", F.col("then").alias("to"), (F.col("dist") + F.col("more")).alias("dist"), F.col("there").alias("done"))
        state = stored(state.where("done").unionByName(moved), "hops")
    # rulers are the links that pointers stop at; the list of them is ranked the same way
    at_ruler = F.expr(ruler.replace("to,", "id,"))
    ranks = list_ranks(state.where(at_ruler).select("id", F.col("to").alias("next"), F.col("dist").alias("hop")), level + 1)
    ranks = stored(ranks, "ranks")
    rest = state.where(~at_ruler).join(ranks.select(F.col("id").alias("to"), "rank"), "to", "left")
    return rest.select("id", (F.col("dist") + F.coalesce("rank", F.lit(0))).alias("rank")).unionByName(ranks)


def _rank_here(table: pa.Table) -> pa.Table:
    ids, nxt, hop = (table.column(c).to_pylist() for c in ("id", "next", "hop"))
    at = {x: k for k, x in enumerate(ids)}
    before = {x: k for k, x in enumerate(nxt) if x is not None}
    rank = np.zeros(len(ids), np.int64)
    k, total = nxt.index(None) if ids else None, 0
    while k is not None:
        total += hop[k]
        rank[k] = total
        k = before.get(ids[k])
    assert len(at) == len(ids)
    return pa.table({"id": pa.array(ids, pa.string()), "rank": pa.array(rank)})


def rebuilt_turns(conversations: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): (c, len) of every conversation and (c, at, len, digest, chars) of its rebuilt turns.

    Conversation c begins with the first crc32(c) mod ``heads`` turns of conversation c - c % ``group`` and goes
    on with its own turns after as many. ``at`` counts from 0.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"), F.sha2(text, 256).alias("digest"), F.char_length(text).cast("long").alias("chars"))
    parts = max(shuffle_partitions(turns.sparkSession), -(-turns.count() // PART_ROWS))
    turns = with_position(turns, ["turn", "role", "digest"], ["c"], num_partitions=parts, pos_col="i", size_col="n")
    turns = stored(turns.select("c", "i", "n", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("digest")), 256).alias("digest"), "chars"), "turns")
    head = F.crc32(F.col("c").cast("string").cast("binary")) % heads
    convs = turns.where("i = 0").select("c", "n", head.alias("h"), F.expr(f"c - c % {group}").alias("base"))
    first = turns.where(f"c % {group} = 0 AND i < {heads - 1}").select(F.col("c").alias("base"), F.col("i").alias("at"), "digest", "chars")
    has = first.groupBy("base").agg(F.count(F.lit(1)).alias("has"))
    convs = stored(convs.join(has, "base", "left").select(
        "c", "h", "base", F.least("h", F.coalesce("has", F.lit(0))).alias("taken"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
        .withColumn("len", F.col("taken") + F.col("own")), "convs")
    taken = convs.join(first, "base").where("at < h").select("c", "at", "len", "digest", "chars")
    kept = (turns.withColumn("h", head).where("i >= h").withColumn("base", F.expr(f"c - c % {group}")).join(has, "base", "left")
            .withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
            .select("c", (F.col("i") - F.col("h") + F.col("taken")).alias("at"), (F.col("n") - F.col("h") + F.col("taken")).alias("len"), "digest", "chars"))
    return convs.select("c", "len"), taken.unionByName(kept)


def _name(depth: Column, lanes: list[Column]) -> Column:
    """128 bits for (depth, sums); the root's name for depth 0."""
    both = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), depth, *lanes)), 16, "0") for k in (1, 2)])
    return F.when(depth == 0, F.lit(ROOT)).otherwise(both)


def _id_digests(batches):
    """From (node, block, ids) sorted by node and block: each node's SHA-256 over its comma-joined ids, read as a stream."""
    node, sha = None, None
    for batch in batches:
        out = []
        for key, ids in zip(batch.column(batch.schema.get_field_index("node")).to_pylist(), batch.column(batch.schema.get_field_index("ids")).to_pylist(), strict=True):
            if key != node:
                if sha is not None:
                    out.append((node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pydict({"node": pa.array([x for x, _ in out], pa.string()), "ends_sha256": pa.array([y for _, y in out], pa.string())})
    if sha is not None:
        yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [sha.hexdigest()]})


def trie(conversations: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt_turns(conversations, group, heads)
    # a hash of (place, turn) in four lanes of 32 bits, whose sums cannot overflow
    x, y = F.xxhash64("at", "digest"), F.xxhash64("digest", "at", F.lit(1))
    low, high = (lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))), (lambda h: F.shiftrightunsigned(h, 32))
    turns = turns.select("c", "at", "len", "chars", *[v.alias(s) for s, v in zip(LANES, (low(x), high(x), low(y), high(y)), strict=True)],
                         *[v.alias(f"own_{s}") for s, v in zip(LANES, (low(x), high(x), low(y), high(y)), strict=True)])
    sums = running_sums(turns, ["c"], "at", LANES)
    depth = F.col("at") + 1
    steps = stored(sums.select("c", "chars", depth.alias("depth"), (depth == F.col("len")).alias("last"), _name(depth, [F.col(s) for s in LANES]).alias("node"),
                               _name(F.col("at"), [F.col(s) - F.col(f"own_{s}") for s in LANES]).alias("parent")), "steps")

    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    nodes = stored(steps.groupBy("node", "parent", F.col("depth").cast("long").alias("depth"))
                   .agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars")).unionByName(root), "nodes")
    family = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min(F.struct("conv_id", "node")).getField("node").alias("first_child"))
    nodes = stored(nodes.join(family, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    family = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"))
    nodes = stored(nodes.join(family, "parent", "left"), "nodes")

    # siblings follow each other by conv_id, which no two of them share
    beside = lag_by_position(nodes.where("siblings > 1").select("parent", "conv_id", "node"), ["parent"], ["conv_id"], ["node"], tiebreak=["node"])
    beside = beside.where("prev_node IS NOT NULL").select(F.col("prev_node").alias("node"), F.col("node").alias("next_sibling"))
    tour = nodes.join(beside, "node", "left")
    enter, leave = (lambda c: F.concat(F.lit("+"), c)), (lambda c: F.concat(F.lit("-"), c))
    arcs = tour.select(F.explode(F.array(
        F.struct(enter("node").alias("id"), F.coalesce(enter("first_child"), leave("node")).alias("next")),
        F.struct(leave("node").alias("id"), F.coalesce(enter("next_sibling"), leave("parent")).alias("next")))).alias("arc")).select("arc.*", F.lit(1).cast("long").alias("hop"))
    ranks = list_ranks(arcs)

    # positions from the tour's start, and what each enter arc brings
    weigh = nodes.select(enter("node").alias("id"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    length = 2 * nodes.count()
    placed = ranks.withColumn("at", F.lit(length) - F.col("rank")).join(weigh, "id", "left").select(
        "id", "at", F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    summed = running_sums(placed, [], "at", ["leaves", "saved"])
    side = F.when(F.col("id").startswith("+"), -1).otherwise(1)
    spans = summed.groupBy(F.expr("substring(id, 2)").alias("node")).agg(F.sum(side * F.col("leaves")).alias("inside"), F.sum(side * F.col("saved")).alias("saved_inside"))

    # ids of conversations that end at a node, in blocks of 1024 numbers
    ends = steps.where("last").select("node", "c").unionByName(convs.where("len = 0").select(F.lit(ROOT).alias("node"), "c"))
    ends = ends.groupBy("node", F.shiftright("c", 10).alias("block")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    ends = (ends.select("node", "block", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
            .repartition("node").sortWithinPartitions("node", "block").mapInArrow(_id_digests, "node string, ends_sha256 string"))
    # a node's own arc stands before its subtree, so the difference lacks the node itself
    return nodes.join(spans, "node").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
        (F.col("inside") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_inside") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))

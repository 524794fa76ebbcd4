"""SimHash near-duplicates: 64-bit fingerprints linked at a few differing bits.

Fingerprints: words are runs of bytes other than space and \\t..\\r after
lower-casing A-Z; a shingle is ``shingle`` words joined by one space, repeats
included (fewer words: the whole sequence); its hash is XXH64 with seed 42;
a bit is set if it is set in over half of the hashes. No words: zero.

Links: a byte-position inverted index. Two fingerprints within 4 bits share
at least 4 of their 8 positional bytes, so the postings of three positional
bytes taken together meet every such pair once the triples are a Turán
(8,4,3) system: 20 triples, one of which lies in any 4 positions. Postings
are read triple by triple; for each pair in a posting list the shared
positional bytes are tallied, pairs with at least the guaranteed number are
kept and verified bit by bit. Equal fingerprints are one posting. Within a
list the linked ones are found by breadth-first search that leaves out what
is already reached, and only a spanning forest is emitted, never all pairs.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; null ids get a component like others but never name one unless all
of its ids are null; repeated rows are returned each; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import shards_for, stored
from eventide.llm.components import connected_components
from eventide.llm.textcode import LOWER, blocks, word_spans

SHINGLE = 4
MAX_BITS = 4
BITS = np.arange(64, dtype=np.uint64)


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions so that any two fingerprints within ``max_bits`` agree on all of one set.

    With d bits apart at least 8 - d of 8 bytes agree. For d = 4 the Turán
    (8,4,3) construction: positions in three groups of 3, 3, 2 in a cycle; the
    sets are those inside a group, and those with two in a group and one in
    the next. For other d: all sets of 8 - d positions.
    """
    if not 0 <= max_bits <= 7:
        raise ValueError("a byte index needs 0 to 7 bits")
    if max_bits != 4:
        return list(combinations(range(8), 8 - max_bits))
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for c in combinations(range(8), 3):
        g = sorted(group[p] for p in c)
        if g[0] == g[2] or (g[0] == g[1] and g[2] == (g[0] + 1) % 3) or (g[1] == g[2] and g[0] == (g[1] + 1) % 3):
            out.append(c)
    return out


def _bits(h: np.ndarray) -> int:
    """Fingerprint of an array of shingle hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.bitwise_or.reduce(np.where(2 * ones > len(h), np.uint64(1) << BITS, np.uint64(0))))


def simhash_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row; ``fp`` is the fingerprint as a signed 64-bit integer."""

    def run(batches):
        digest = xxhash.xxh64_intdigest
        for batch, lo, hi, data, offs in blocks(batches, text_col):
            low = LOWER[data]
            starts, ends, counts = word_spans(low, offs)
            raw = low.tobytes()
            # words of a row joined by one space: equal to the bytes themselves where single spaces part them
            fps, at = np.zeros(hi - lo, np.uint64), 0
            for k, n in enumerate(counts.tolist()):
                if n:
                    s, e = starts[at:at + n], ends[at:at + n]
                    if n > 1 and ((s[1:] - e[:-1] != 1).any() or (low[e[:-1]] != 32).any()):
                        words = [raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
                        joined = b" ".join(words)
                        lens = e - s
                        s = np.concatenate([[0], np.cumsum(lens[:-1] + 1)])
                        e = s + lens
                    else:
                        joined = raw
                    if n <= shingle:
                        h = [digest(joined[s[0]:e[-1]], 42)]
                    else:
                        h = [digest(joined[a:b], 42) for a, b in zip(s[:n - shingle + 1].tolist(), e[shingle - 1:].tolist(), strict=True)]
                    fps[k] = _bits(np.array(h, np.uint64))
                at += n
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(id_col)).slice(lo, hi - lo),
                                              pa.array(fps.view(np.int64))], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, fp long")


def _forest(x: np.ndarray, max_bits: int, same: int) -> list[tuple[int, int]]:
    """Spanning edges of the links among distinct fingerprints of one posting list."""
    left, edges = x, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            a = queue.pop()
            diff = left ^ a
            tally = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)     # shared positional bytes
            hit = (tally >= same) & (np.bitwise_count(diff) <= max_bits)
            if hit.any():
                near, left = left[hit], left[~hit]
                edges += [(int(a), int(b)) for b in near]
                queue += list(near)
    return edges


def hamming_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) among the distinct values of column ``fp`` that span every component."""
    sets = position_sets(max_bits)
    same = 8 - max_bits
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    keys = [sum((byte[p] * (1 << 8 * j) for j, p in enumerate(c)), F.lit(k).cast("long") * (1 << 8 * len(c)))
            if len(c) < 7 else F.xxhash64(F.lit(k), *[byte[p] for p in c]) for k, c in enumerate(sets)]
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("k"))
    n = postings.sparkSession.conf.get("spark.sql.shuffle.partitions")
    postings = postings.repartition(int(n), "k").sortWithinPartitions("k")

    def run(batches):
        kept_k, kept_fp = np.empty(0, np.int64), np.empty(0, np.uint64)

        def close(k, fp, final):
            """Edges of all whole lists; the last list waits for the next batch unless final."""
            cut = len(k) if final else int(np.searchsorted(k, k[-1])) if len(k) else 0
            whole, f = k[:cut], fp[:cut]
            starts = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]])) if cut else np.empty(0, np.int64)
            sizes = np.diff(np.append(starts, cut))
            out = []
            two = starts[sizes == 2]
            if len(two):
                a, b = f[two], f[two + 1]
                d = a ^ b
                ok = ((d.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= same) & (np.bitwise_count(d) <= max_bits)
                out += list(zip(a[ok].tolist(), b[ok].tolist(), strict=True))
            for s, m in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                out += _forest(f[s:s + m], max_bits, same)
            return out, k[cut:], fp[cut:]

        def table(out):
            e = np.array(out, np.uint64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0].copy().view(np.int64)), pa.array(e[:, 1].copy().view(np.int64))], names=["a", "b"])

        for batch in batches:
            kept_k = np.concatenate([kept_k, batch.column(1).to_numpy(zero_copy_only=False)])
            kept_fp = np.concatenate([kept_fp, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            out, kept_k, kept_fp = close(kept_k, kept_fp, False)
            if out:
                yield table(out)
        out, _, _ = close(kept_k, kept_fp, True)
        if out:
            yield table(out)

    return postings.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row."""
    fps = stored(simhash_column(docs, id_col, text_col, shingle), "simhash")
    distinct = fps.groupBy("fp").agg(F.min(id_col).alias("first_id"))
    links = stored(hamming_links(distinct.select("fp"), max_bits).distinct(), "simhash-links")
    roots = connected_components(links)                                  # (node, root) of linked fingerprints
    nodes = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = nodes.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

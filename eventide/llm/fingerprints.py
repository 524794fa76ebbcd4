"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over 7 bytes decides chunk boundaries; each chunk gives one
18-bit symbol of the signature. A fingerprint holds the signatures at block
size b and 2b, where b is the smallest power of two with at most 64 chunks, so
every byte of a text of any length is in a chunk. Two fingerprints are
compared where their block sizes meet, by edit distance with insertions and
deletions (a substitution costs both), as 1 - distance / total length.

Defined cases: a null text is the empty text; its fingerprint is ``0::`` and
two empty fingerprints are alike 1, an empty and a non-empty one 0. Equal
texts have equal fingerprints. Rows are ordered by descending id, null ids
last, ties by the text; every row of the input is in the result once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import SHARD_BYTES, shards_for
from eventide.llm.textcode import prefix_hash, span_hash

WINDOW = 7          # bytes of the rolling hash
MAX_CHUNKS = 64     # of a signature; the block size grows with the text
SYMBOL_BITS = 18
BROADCAST_ROWS = 1_000_000
_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_CODE = np.frombuffer(_ALPHABET, np.uint8)
_VALUE = {c: i for i, c in enumerate(_ALPHABET)}


def _symbols(s: np.ndarray, cuts: np.ndarray, n: int) -> str:
    """One 3-character symbol for each chunk between cuts (the tail is a chunk too)."""
    ends = cuts if len(cuts) and cuts[-1] == n else np.append(cuts, n)
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
    h = span_hash(s, starts, ends) >> np.uint64(64 - SYMBOL_BITS)
    six = np.stack([(h >> np.uint64(12)) & np.uint64(63), (h >> np.uint64(6)) & np.uint64(63), h & np.uint64(63)], 1)
    return _CODE[six.astype(np.int64)].tobytes().decode()


def fingerprint(text: bytes) -> str:
    """``exponent:signature:signature at twice the block size`` of one whole text."""
    n = len(text)
    if n == 0:
        return "0::"
    data = np.frombuffer(text, np.uint8)
    s = prefix_hash(data)
    roll = np.zeros(n, np.uint32)
    c = data.astype(np.uint32) + np.uint32(1)
    factor = np.uint32(1)
    for k in range(min(WINDOW, n)):
        roll[k:] += c[:n - k] * factor
        factor = np.uint32(int(factor) * 0x01000193 & 0xFFFFFFFF)
    roll ^= roll >> np.uint32(15)
    roll *= np.uint32(0x2C1B3C6D)
    roll ^= roll >> np.uint32(12)
    # positions that cut at block size 2^k have k low zero bits, so cuts are nested
    at = np.flatnonzero((roll & np.uint32(1)) == 0)
    r = roll[at]
    k = 1
    while len(at) >= MAX_CHUNKS:
        k += 1
        keep = (r & np.uint32((1 << k) - 1)) == 0 if k < 32 else np.zeros(len(r), bool)
        at, r = at[keep], r[keep]
    wide = at[(r & np.uint32(min((1 << (k + 1)) - 1, 0xFFFFFFFF))) == 0]
    return f"{k}:{_symbols(s, at + 1, n)}:{_symbols(s, wide + 1, n)}"


def _alike(a: str, b: str) -> float:
    """1 - (insertions + deletions) / total symbols, by bit-parallel longest common subsequence."""
    x = [a[i:i + 3] for i in range(0, len(a), 3)]
    y = [b[i:i + 3] for i in range(0, len(b), 3)]
    if not x and not y:
        return 1.0
    masks: dict[str, int] = {}
    for i, c in enumerate(x):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(x)) - 1
    v = full
    for c in y:
        if m := masks.get(c):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return 2.0 * (len(x) - v.bit_count()) / (len(x) + len(y))


def likeness(a: str, b: str) -> float:
    """Likeness (0 to 1) of two fingerprints, at the block sizes they share."""
    if a == b:
        return 1.0
    (ka, a1, a2), (kb, b1, b2) = a.split(":"), b.split(":")
    if not a1 or not b1:
        return 0.0
    ka, kb = int(ka), int(kb)
    if ka == kb:
        return max(_alike(a1, b1), _alike(a2, b2))
    if kb == ka + 1:
        return _alike(a2, b1)
    if ka == kb + 1:
        return _alike(a1, b2)
    return 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, fingerprint string"

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint((t or "").encode()) for t in texts], pa.string())],
                                             names=[id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _dealt_with_next(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows dealt into ranges of descending id; each range also holds the row that follows it.

    Ranges are cut at approximate quantiles of the ids. The first row of a
    range is sent to the range before it as well (the first of all to the
    last), marked as a guest, so a range can be read on its own, in order.
    Only the cuts, one number a range, pass through the driver.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_bytes, low = base.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)), F.min("id")).first()
    n = shards_for(n_bytes, SHARD_BYTES // 2)
    cuts = base.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10_000)).first()[0] or []
    cuts = sorted({c for c in cuts if c > low}, reverse=True)
    parts = len(cuts) + 1
    # part = cuts above the id; null ids come after all others
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    part = F.when(F.col("id").isNull(), parts - 1).otherwise(F.size(F.filter(edges, lambda c: c > F.col("id"))))
    dealt = base.withColumn("part", part.cast("int"))
    top = dealt.groupBy("part").agg(F.max("id").alias("id")).select(F.col("part").alias("p"), F.col("id").alias("i"))
    top = F.broadcast(top) if parts <= BROADCAST_ROWS else top       # two numbers a range
    heads = (dealt.join(top, (dealt.part == top.p) & dealt.id.eqNullSafe(top.i))
             .groupBy("part").agg(F.max("id").alias("id"), F.min("text").alias("text")))
    guests = heads.select("id", "text", ((F.col("part") + parts - 1) % parts).cast("int").alias("part"), F.lit(True).alias("guest"))
    rows = dealt.withColumn("guest", F.lit(False)).unionByName(guests)
    return rows.repartition(max(n, 8), "part").sortWithinPartitions("part", "guest", F.desc_nulls_last("id"), "text"), parts


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, and its likeness to an edited text's and to the next row's.

    The edited text has the last floor(n/2) code points replaced by the first
    as many (or all) of the next row in descending id order; the first row of
    all follows the last.
    """
    rows, _ = _dealt_with_next(docs, id_col, text_col)
    schema = (f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches):
        before = None   # the row still waiting for the one after it: (part, id, text, fingerprint)
        for batch in batches:
            out = []
            for i, t, part, guest in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                           for c in ("id", "text", "part", "guest")), strict=True):
                mine = fingerprint(t.encode())
                if before is not None and before[0] == part:
                    _, b_id, b_text, b_fp = before
                    half = len(b_text) // 2
                    edited = (b_text[:len(b_text) - half] + t[:half]).encode()
                    e_fp = fingerprint(edited)
                    out.append((b_id, len(b_text), hashlib.sha256(edited).hexdigest(), b_fp, e_fp,
                                likeness(b_fp, e_fp), likeness(b_fp, mine)))
                before = None if guest else (part, i, t, mine)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)],
                    names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.select("id", "text", "part", "guest").mapInArrow(run, schema)

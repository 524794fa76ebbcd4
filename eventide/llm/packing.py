"""Packing token sequences into windows: non-negative least squares over shallow length combinations.

Tokens: every distinct unit of the corpus is encoded once. A unit is a run of
bytes between white space, also cut where two ASCII bytes of different kind
(letter, digit, other) meet, which the tokenizer's own pre-splitting always
cuts too; a special token's string is a unit of its own. The ids of a text are
those of its units in order. Units and ids are
sorted hash arrays in the shared folder, mapped into memory by the tasks.

Pieces: a document's ids, its end id last, are cut into whole windows and one
rest. Whole windows are sequences of their own. For the rests: lengths are
binned, combinations of up to three bins that fill a window are enumerated,
repeat counts are solved by non-negative least squares against the histogram
and rounded down; each repeat takes real lengths from its bins, the last one
the longest that still fits. What is left is packed greedily, largest first
and then the longest that fits. Both work on the histogram of rest lengths (at
most one entry a length, whatever the number of documents) and give runs of
equal sequences; a piece finds its place by its rank among pieces of its
length, which comes from counts per task and length. A last sequence of a power
of two tokens, or any sequence of that length, needs no padding.

Defined cases: a null text is empty and has only the end id; equal rows are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import ArrayStore, scratch, shards_for, stored, text_bytes
from eventide.llm.kneser_ney import _shard_cuts
from eventide.llm.textcode import LOWER, blocks, prefix_hash, span_hash

WINDOW = 4096
END_ID = 2
BIN = 16           # tokens a bin of the least-squares histogram
U64 = np.uint64

# kinds of bytes: white space, ASCII letter, digit, apostrophe, other ASCII, not ASCII
_KIND = np.full(256, 4, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[0x27] = 3
_KIND[128:] = 5
_CUT = np.zeros((6, 6), bool)      # between an apostrophe and a letter a contraction may lie
for _a, _b in ((1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4), (3, 2), (4, 1), (4, 2)):
    _CUT[_a, _b] = True
_CUT = _CUT.ravel()


def _special_spans(data: np.ndarray, offs: np.ndarray, special: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """Spans of the special strings, leftmost and then longest first; none reaches over a row's end."""
    raw = data.tobytes() if special else b""
    if not any(s in raw for s in special):
        return []
    any_of = re.compile(b"|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)))
    out, at = [], 0
    while found := any_of.search(raw, at):
        a = found.start()
        inside = any_of.match(raw, a, int(offs[np.searchsorted(offs, a, "right")]))
        if inside:
            out.append((a, inside.end()))
        at = inside.end() if inside else a + 1
    return out


def unit_spans(data: np.ndarray, offs: np.ndarray, special: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, units per row). A special token's string inside a row is a unit of its own, as the tokenizer takes it out first.

    A row's units do not depend on the rows around it.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs) - 1, np.int64)
    kind = _KIND[data]
    word = kind > 0
    edge = np.ones(n + 1, bool)        # a cut before byte i
    edge[1:n] = word[1:] != word[:-1]
    edge[1:n] |= _CUT[kind[:-1] * 6 + kind[1:]]
    edge[offs] = True
    for a, b in _special_spans(data, offs, special):
        edge[a + 1:b] = False
        edge[[a, b]] = True
    starts = np.flatnonzero(edge[:n] & word)
    ends = np.flatnonzero(edge[1:] & word) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class UnitIds:
    """Ids of every distinct unit of ``docs``, encoded once, as sorted hash arrays in the shared folder."""

    def __init__(self, docs: DataFrame, text_col: str, tokenizer_path: str):
        n = shards_for(text_bytes(docs, text_col), 8 << 20)
        url = scratch(docs.sparkSession, "units")
        special = tuple(t.content.encode() for t in _load(tokenizer_path).get_added_tokens_decoder().values())
        self.url, self.shards, self.special = url, n, special

        def distinct(batches):
            for _, _, _, data, offs in blocks(batches, text_col, 4 << 20):
                low = LOWER[data]
                starts, ends, _ = unit_spans(data if special else low, offs, special)
                keys, first = np.unique(span_hash(prefix_hash(low), starts, ends), return_index=True)
                raw, s, e = low.tobytes(), starts[first].tolist(), ends[first].tolist()
                cuts = _shard_cuts(keys, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(n), pa.int32()),
                     pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                     pa.array([b" ".join([raw[x:y] for x, y in zip(s[a:b], e[a:b], strict=True)]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    names=["shard", "k", "units"])

        def encode(table: pa.Table) -> pa.Table:
            tok = _load(tokenizer_path)
            shard = table.column("shard")[0].as_py()
            keys, units = [], []
            for k, u in zip(table.column("k").to_pylist(), table.column("units").to_pylist(), strict=True):
                if k:
                    keys.append(np.frombuffer(k, "<u8"))
                    units += u.split(b" ")
            keys, first = np.unique(np.concatenate(keys) if keys else np.empty(0, "<u8"), return_index=True)
            ids, sizes = [], []
            for at in range(0, len(first), 4_000):
                for e in tok.encode_batch_fast([units[i].decode() for i in first[at:at + 4_000]], add_special_tokens=False):
                    x = e.ids
                    ids += x
                    sizes.append(len(x))
            store = ArrayStore(url)
            store.write(f"unit-{shard}.key", keys)
            store.write(f"unit-{shard}.at", np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64))
            store.write(f"unit-{shard}.ids", np.array(ids, np.uint32))
            return pa.table({"n": pa.array([len(keys)], pa.int64())})

        texts = docs.select(F.col(text_col))
        self.units = sum(r["n"] for r in texts.mapInArrow(distinct, "shard int, k binary, units binary").groupBy("shard")
                         .applyInArrow(encode, "n long").collect())     # one number a shard

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_maps"}

    def row_ids(self, data: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, each followed by ``end_id``; row offsets)."""
        rows = len(offs) - 1
        low = LOWER[data]
        starts, ends, counts = unit_spans(data if self.special else low, offs, self.special)
        keys, inv = np.unique(span_hash(prefix_hash(low), starts, ends), return_inverse=True)
        if len(keys) and not hasattr(self, "_maps"):
            store = ArrayStore(self.url)
            self._maps = [(store.map(f"unit-{s}.key", "<u8"), store.map(f"unit-{s}.at", "<i8"), store.map(f"unit-{s}.ids", "<u4")) for s in range(self.shards)]
        cuts = _shard_cuts(keys, self.shards)
        size, table = [], []
        for s in range(self.shards):
            k = keys[cuts[s]:cuts[s + 1]]
            if len(k):
                key, at, ids = self._maps[s]
                i = np.searchsorted(key, k)
                if i[-1] == len(key) or (key[i] != k).any():
                    raise RuntimeError(f"shard {s} of the unit table lacks a unit of the texts")
                a, m = at[i], at[i + 1] - at[i]
                size.append(m)
                table.append(ids[np.repeat(a - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))])
        size = np.concatenate([*size, [1]])             # the last entry is the end id
        table = np.concatenate([*table, [np.uint32(end_id)]]).astype("<u4")
        first = np.cumsum(size) - size
        seq = np.full(len(inv) + rows, len(keys), np.int64)
        tail = np.cumsum(counts + 1) - 1
        inner = np.ones(len(seq), bool)
        inner[tail] = False
        seq[inner] = inv
        m = size[seq]
        stop = np.cumsum(m)
        out = table[np.repeat(first[seq] - (stop - m), m) + np.arange(int(stop[-1]) if len(stop) else 0)]
        return out, np.concatenate([[0], stop[tail]])


# ---- planning: histogram of rest lengths -> runs of equal sequences -----------------

def nnls(columns: np.ndarray, target: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Active-set least squares with x >= 0; a column of the matrix counts the bins named in its row of ``columns``.

    ``columns`` is (patterns, depth) with bin numbers, -1 for none.
    """
    n, depth = columns.shape
    bins = len(target)
    at = np.where(columns < 0, bins, columns)

    def dense(ids):
        m = np.zeros((bins + 1, len(ids)))
        for d in range(depth):
            np.add.at(m, (at[ids, d], np.arange(len(ids))), 1)
        return m[:bins]

    active: list[int] = []
    x = np.zeros(0)
    resid = target.astype(float)
    for _ in range(rounds):
        gain = np.append(resid, 0.0)[at].sum(axis=1)
        gain[active] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-6 * max(1.0, target.max(initial=0)):
            break
        active.append(j)
        x = np.append(x, 0.0)
        while True:
            z = np.linalg.lstsq(dense(active), target, rcond=None)[0]
            if (z > 0).all():
                x = z
                break
            bad = z <= 0
            step = np.min(x[bad] / np.maximum(x[bad] - z[bad], 1e-12))
            x = x + step * (z - x)
            keep = ~(bad & (x <= 1e-9))
            if keep.all():
                keep[np.argmin(np.where(bad, x, np.inf))] = False
            active, x = [a for a, k in zip(active, keep, strict=True) if k], x[keep]
        resid = target - dense(active) @ x
    out = np.zeros(n)
    out[active] = x
    return out


def combinations_filling(bins: int, present: np.ndarray) -> np.ndarray:
    """Rows of up to three bin numbers (0-based; bin b holds b+1 units) whose units sum to ``bins``."""
    rows = [(bins - 1, -1, -1)] if present[bins - 1] else []
    for a in range(bins - 1, 0, -1):                 # units of the largest part
        if not present[a - 1]:
            continue
        rest = bins - a
        if rest <= a and present[rest - 1]:
            rows.append((a - 1, rest - 1, -1))
        b = np.arange(max(1, -(-rest // 2)), min(a, rest - 1) + 1)
        c = rest - b
        b, c = b[present[b - 1] & present[c - 1]], c[present[b - 1] & present[c - 1]]
        rows += [(a - 1, int(i) - 1, int(j) - 1) for i, j in zip(b, c, strict=True)]
    return np.array(rows, np.int64).reshape(-1, 3)


class _Left:
    """What is left of the histogram, with the longest length that fits a gap."""

    def __init__(self, hist: dict[int, int]):
        self.hist = {k: v for k, v in hist.items() if v}
        self.lengths = sorted(self.hist)

    def longest(self, most: int, used: dict[int, int]) -> int:
        """The longest length up to ``most`` with a piece beyond those in ``used``; 0 if none."""
        i = bisect.bisect_right(self.lengths, most) - 1
        while i >= 0 and self.hist[self.lengths[i]] <= used.get(self.lengths[i], 0):
            i -= 1
        return self.lengths[i] if i >= 0 else 0

    def take(self, parts: list[int], most: int) -> int:
        """Take as many equal sequences of ``parts`` as there are, ``most`` at most."""
        used: dict[int, int] = {}
        for p in parts:
            used[p] = used.get(p, 0) + 1
        times = min(most, min(self.hist[p] // m for p, m in used.items()))
        for p, m in used.items():
            self.hist[p] -= times * m
            if not self.hist[p]:
                del self.hist[p]
                self.lengths.pop(bisect.bisect_left(self.lengths, p))
        return times

    def filled(self, parts: list[int], window: int) -> list[int]:
        """``parts`` and, while one fits, the longest length that does."""
        used: dict[int, int] = {}
        for p in parts:
            used[p] = used.get(p, 0) + 1
        gap = window - sum(parts)
        while gap and (p := self.longest(gap, used)):
            used[p] = used.get(p, 0) + 1
            parts.append(p)
            gap -= p
        return parts


def plan(hist: dict[int, int], window: int = WINDOW, unit: int = BIN) -> list[tuple[list[int], int]]:
    """Runs (lengths of one sequence, repeats) that use every rest of the histogram once."""
    bins = window // unit
    count = np.zeros(bins, np.int64)
    for length, c in hist.items():
        count[-(-length // unit) - 1] += c
    left, runs = _Left(hist), []
    columns = combinations_filling(bins, count > 0)
    if len(columns):
        repeats = np.floor(nnls(columns, count.astype(float)) + 1e-9).astype(np.int64)
        for row, want in sorted(zip(columns.tolist(), repeats.tolist(), strict=True), reverse=True):
            want = int(want)
            while want > 0:
                parts, used = [], {}
                for b in [x for x in row if x >= 0][:-1]:
                    p = left.longest((b + 1) * unit, used)
                    if p <= b * unit:
                        break
                    parts.append(p)
                    used[p] = used.get(p, 0) + 1
                else:
                    if not parts:
                        parts = [p] if (p := left.longest(window, {})) else []
                    got = left.take(left.filled(parts, window), want) if parts else 0
                    if got:
                        runs.append((parts, got))
                        want -= got
                        continue
                break
    while left.lengths:
        parts = left.filled([left.lengths[-1]], window)
        runs.append((parts, left.take(parts, 1 << 62)))
    return runs


def _places(runs, window: int, whole: int):
    """Arrays by (length, first rank): each run's share of the pieces of a length, whole windows first."""
    rows, nxt, rank = [], whole, {window: whole}
    if whole:
        rows.append((window, 0, 0, 1, 0))
    for parts, times in runs:
        at, seen = 0, {}
        for p in parts:
            seen.setdefault(p, [0, at])[0] += 1
            at += p
        # equal lengths stand together
        at = 0
        for p, (m, _) in sorted(seen.items(), reverse=True):
            rows.append((p, rank.get(p, 0), nxt, m, at))
            rank[p] = rank.get(p, 0) + m * times
            at += m * p
        nxt += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row a piece: id, start, length, doc_tokens, ids_crc32, sequence_id, offset, and the ids themselves if asked for."""
    units = UnitIds(docs, text_col, tokenizer_path)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, start long, length long, doc_tokens long, ids_crc32 long, task int, nth long" + (", ids binary" if with_ids else "")

    def cut(batches):
        task, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch, lo, hi, data, offs in blocks(batches, text_col):
            ids, at = units.row_ids(data, offs, end_id)
            size = np.diff(at)
            pieces = -(-size // window)
            row = np.repeat(np.arange(hi - lo), pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(window, size[row] - start)
            raw = memoryview(ids.tobytes())
            begin = (at[row] + start) * 4
            stop = begin + 4 * length
            spans = list(zip(begin.tolist(), stop.tolist(), strict=True))
            order = np.argsort(length, kind="stable")
            ls = length[order]
            first = np.flatnonzero(np.concatenate([[True], ls[1:] != ls[:-1]]))
            nth = np.empty(len(row), np.int64)
            run = np.diff(np.append(first, len(ls)))
            nth[order] = seen[ls] + np.arange(len(ls)) - np.repeat(first, run)
            seen[ls[first]] += run
            cols = [batch.column(batch.schema.get_field_index(id_col)).slice(lo, hi - lo).take(pa.array(row)),
                    pa.array(start), pa.array(length), pa.array(size[row]), pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    pa.array(np.full(len(row), task, np.int32)), pa.array(nth)]
            names = [id_col, "start", "length", "doc_tokens", "ids_crc32", "task", "nth"]
            if with_ids:
                cols.append(pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    pieces = stored(docs.select(id_col, text_col).mapInArrow(cut, schema), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.max("nth").alias("m")).select("task", "length", (F.col("m") + 1).alias("c"))
    hist = {r["length"]: r["c"] for r in counts.groupBy("length").agg(F.sum("c").alias("c")).collect()}   # at most `window` rows
    places = _places(plan({k: v for k, v in hist.items() if k < window}, window), window, hist.get(window, 0))
    before = counts.select("task", "length", (F.sum("c").over(Window.partitionBy("length").orderBy("task")) - F.col("c")).alias("before"))
    ranked = pieces.join(before, ["task", "length"])
    out = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids binary" if with_ids else "")

    def place(batches):
        key = places[:, 0] << 40 | places[:, 1]        # a length has fewer than 2^40 pieces
        for b in batches:
            get = lambda c: b.column(b.schema.get_field_index(c))  # noqa: B023, E731
            length = get("length").to_numpy()
            rank = get("nth").to_numpy() + get("before").to_numpy()
            at = np.searchsorted(key, length << 40 | rank, "right") - 1
            _, first, seq, times, off = places[at].T if len(at) else np.empty((5, 0), np.int64)
            nth = rank - first
            cols = [get(id_col), get("start"), get("length"), get("ids_crc32"), get("doc_tokens"),
                    pa.array(seq + nth // times), pa.array(off + nth % times * length)]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(get("ids"))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return ranked.mapInArrow(place, out)

"""Exact substring de-duplication over all documents with suffix arrays by induced sorting.

A byte goes if a ``length``-byte string that covers it also starts earlier: in
a document with a smaller id, or earlier in the same one. Overlaps count and
strings are judged on the input.

1. Runs. Every ``length``-byte string is named by the least hash among its
   32-byte substrings, so equal strings have equal names wherever they are.
   Consecutive string starts with one name are a run; a run covers some 130
   bytes.
2. Names. Names of all runs are counted; names of one run only cannot repeat,
   but for loose runs of periodic text (see ``runs_of``).
3. Shards. Runs with repeated names go, with their bytes, to the shard of the
   name. Identical runs are joined first in the sending task and again in the
   shard: the earliest stays, the strings of the others are repeats. So a
   passage in a third of all documents is sent once a task.
4. Suffix arrays. A shard's distinct runs of names with several contents are
   concatenated, sorted by induced sorting, and neighbours with a common
   prefix of ``length`` bytes form groups; all but the earliest start are repeats.
5. Repeats are merged per document and cut out of the text.

Identical runs are told by two independent 64-bit hashes; all else is compared
byte by byte.

Defined cases: null texts are empty; null ids come after all others; rows with
the same id are ordered by a hash of the text, rows with the same id and text
count as one document and get the same result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ArrayStore, scratch, shards_for, text_bytes
from eventide.llm.kneser_ney import _from_w48, _shard_cuts, _w48_bytes
from eventide.llm.suffix_arrays import common_prefixes, suffix_array
from eventide.llm.textcode import blocks, mix, powers, prefix_hash, span_hash

LENGTH = 100
GRAM = 32
CHUNK = 8 << 20             # text bytes whose runs a task joins before sending
SORT_BYTES = 1 << 20        # bytes of one suffix array
U64 = np.uint64
_W48 = ~np.uint64(0xFFFF)
_LAST = (1 << 63) - 1
_PLACE = np.uint64((1 << 24) - 1)


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values."""
    k = 1
    while 2 * k <= w:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    return np.minimum(h[:len(h) - (w - k)], h[w - k:]) if w > k else h


def runs_of(data: np.ndarray, offs: np.ndarray, length: int):
    """Runs of string starts with one name: (names, starts, counts, loose), and the prefix hashes used.

    A name is the high 40 bits of the least hash; the low bits hold the place
    of its leftmost substring. Two equal strings have it at the same distance
    from their starts, so a run can repeat inside itself only if that place
    moves within the run: such runs are ``loose``.
    """
    n, w = len(data), length - GRAM + 1
    s = prefix_hash(data)
    none = np.empty(0, np.int64)
    if n < length:
        return np.empty(0, U64), none, none, none.astype(bool), s
    at = np.arange(n - GRAM + 1).astype(U64)
    _, inv = powers(n)
    h = mix((s[GRAM:] - s[:-GRAM]) * inv[:n - GRAM + 1])
    h &= ~_PLACE
    h |= at & _PLACE
    least = _window_min(h, w)                                   # of the string that starts at i
    name = least & ~_PLACE
    starts = offs[:-1]
    ends = np.maximum(offs[1:] - length + 1, starts)            # starts whose string ends inside its row
    new = np.zeros(len(name) + 1, bool)
    new[0] = True
    np.not_equal(name[1:], name[:-1], out=new[1:-1])
    new[starts[starts < len(name)]] = True
    new[ends[ends < len(name)]] = True
    new[-1] = False
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(name)) - 1
    inside = first < ends[np.searchsorted(offs, first, "right") - 1]
    first, last = first[inside], last[inside]
    loose = (least[first] != least[last]) | (n > int(_PLACE))
    # least hashes crowd near zero; mixed, names spread evenly over shards
    return mix(name[first]), first, last - first + 1, loose, s


def _first_of(keys: list[np.ndarray], order_by: list[np.ndarray]):
    """Group equal keys: (index of each group's least entry, mask of the entries that are not the least)."""
    order = np.lexsort((*order_by[::-1], *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    later = np.ones(len(order), bool)
    later[order[new]] = False
    return order[new], later


_RUN = np.dtype([("name", "<u8"), ("body", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("start", "<i8"), ("count", "<i4"), ("loose", "?")])
_GONE = np.dtype([("doc", "<i8"), ("tie", "<i8"), ("start", "<i8"), ("end", "<i8")])


def _gone(runs: np.ndarray, length: int) -> np.ndarray:
    out = np.empty(len(runs), _GONE)
    out["doc"], out["tie"], out["start"] = runs["doc"], runs["tie"], runs["start"]
    out["end"] = runs["start"] + runs["count"] + length - 1
    return out


def _sorted_repeats(runs: np.ndarray, text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Repeated strings among runs with bytes ``text[at[i]:at[i+1]]``, from one suffix array."""
    size = np.diff(at)
    n = int(size.sum()) + len(runs) + 1
    s = np.ones(n, np.uint16)                                     # 1 parts runs, 0 ends the text
    s[-1] = 0
    where = at[:-1] + np.arange(len(runs))                        # places in the joined text
    inside = np.ones(n - 1, bool)
    inside[where + size] = False
    s[:-1][inside] = text.astype(np.uint16) + 2
    sa = suffix_array(s)
    run = np.searchsorted(where, sa, "right") - 1
    off = sa - where[run]
    whole = (off < runs["count"][run]) & (sa < n - 1)             # a string starts here
    sa, run, off = sa[whole], run[whole], off[whole]
    shown = np.zeros(n, np.uint8)
    shown[:-1][inside] = text
    same = common_prefixes(shown, sa, length) >= length
    # earliest start of each group of equal strings
    docs, rank = np.unique(np.stack([runs["doc"], runs["tie"]], 1), axis=0, return_inverse=True)
    pos = runs["start"][run] + off
    key = rank.reshape(-1)[run].astype(np.int64) << 40 | pos      # a text has fewer than 2^40 bytes
    group = np.cumsum(~same) - 1
    least = np.minimum.reduceat(key, np.flatnonzero(~same)) if len(key) else key
    late = np.unique(key[key != least[group]])
    # consecutive starts become one span
    new = np.flatnonzero(np.concatenate([[True], late[1:] != late[:-1] + 1])) if len(late) else np.empty(0, np.int64)
    out = np.empty(len(new), _GONE)
    lead, tail = late[new], late[np.append(new[1:], len(late)) - 1] if len(late) else late
    out["doc"], out["tie"] = docs[lead >> 40].T if len(lead) else (np.empty(0), np.empty(0))
    out["start"] = lead & ((1 << 40) - 1)
    out["end"] = (tail & ((1 << 40) - 1)) + length
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, tie, start, end) spans of repeated strings; ``docs`` has doc, tie and text. Spans may overlap."""
    spark = docs.sparkSession
    n_bytes = text_bytes(docs)
    n = shards_for(n_bytes)
    url = scratch(spark, "names")

    def name_runs(batches):
        for _, _, _, data, offs in blocks(batches, "text", 1 << 20):
            names, _, _, loose, _ = runs_of(data, offs, length)
            order = np.argsort(names)
            k = names[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
            many = np.diff(np.append(first, len(k))) > 1
            if len(k):
                many |= np.logical_or.reduceat(loose[order], first)
            k = k[first]
            cuts = _shard_cuts(k, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([_w48_bytes(k[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                 pa.array([np.packbits(many[a:b]).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=["shard", "k", "many"])

    def repeated(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        ks = [_from_w48(x) for x in table.column("k").to_pylist()]
        many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(table.column("many").to_pylist(), ks, strict=True)]
        k, times = np.concatenate(ks), np.concatenate(many).astype(np.int8) + np.int8(1)
        order = np.argsort(k)
        k, times = k[order], times[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
        total = np.add.reduceat(times, first) if len(k) else times
        ArrayStore(url).write(f"name-{shard}.key", k[first][total > 1])
        return pa.table({"runs": pa.array([int(total[total > 1].sum())], pa.int64())})

    texts = docs.select("text")
    rows = texts.mapInArrow(name_runs, "shard int, k binary, many binary").groupBy("shard").applyInArrow(repeated, "runs long").collect()  # one number a shard
    if not rows:
        return spark.createDataFrame([], "doc long, tie long, start long, `end` long")
    out_n = shards_for(sum(r["runs"] for r in rows) * 180, 2 << 20)

    def send(batches):
        store = ArrayStore(url)
        listed = [store.map(f"name-{s}.key", "<u8") for s in range(n)]
        held, held_bytes, texts_held = [], 0, []

        def flush():
            runs, body = np.concatenate(held), np.concatenate(texts_held)
            size = runs["count"].astype(np.int64) + length - 1
            at = np.cumsum(size) - size
            first, later = _first_of([runs["name"], runs["body"]], [runs["doc"], runs["tie"], runs["start"]])
            gone = _gone(runs[later], length)
            first = first[np.argsort(runs["name"][first], kind="stable")]
            cuts = _shard_cuts(runs["name"][first], out_n)
            spread = np.array_split(gone, out_n)
            rows = []
            for i in range(out_n):
                f = first[cuts[i]:cuts[i + 1]]
                if len(f) or len(spread[i]):
                    m = size[f]
                    take = np.repeat(at[f] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
                    rows.append((i, runs[f].tobytes(), body[take].tobytes(), spread[i].tobytes()))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                              names=["shard", "runs", "body", "gone"])

        for batch, lo, hi, data, offs in blocks(batches, "text", 1 << 20):
            names, starts, counts, loose, s = runs_of(data, offs, length)
            k, inv = np.unique(names & _W48, return_inverse=True)
            cuts, hit = _shard_cuts(k, n), np.zeros(len(k), bool)
            for i, key in enumerate(listed):
                x = k[cuts[i]:cuts[i + 1]]
                if len(x) and len(key):
                    p = np.minimum(np.searchsorted(key, x), len(key) - 1)
                    hit[cuts[i]:cuts[i + 1]] = key[p] == x
            keep = hit[inv]
            names, starts, counts, loose = names[keep], starts[keep], counts[keep], loose[keep]
            runs = np.empty(len(names), _RUN)
            row = np.searchsorted(offs, starts, "right") - 1
            doc = batch.column(batch.schema.get_field_index("doc")).to_numpy()[lo:hi]
            tie = batch.column(batch.schema.get_field_index("tie")).to_numpy()[lo:hi]
            size = counts + length - 1
            runs["name"], runs["count"], runs["doc"], runs["tie"], runs["start"] = names, counts, doc[row], tie[row], starts - offs[row]
            runs["loose"] = loose
            runs["body"] = mix(span_hash(s, starts, starts + size) ^ U64(0x5555555555555555))
            take = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            held.append(runs)
            texts_held.append(data[take])
            held_bytes += len(data)
            if held_bytes >= CHUNK:
                yield flush()
                held, texts_held, held_bytes = [], [], 0
        if held:
            yield flush()

    def sort_shard(table: pa.Table) -> pa.Table:
        runs = np.frombuffer(b"".join(table.column("runs").to_pylist()), _RUN)
        body = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8)
        out = [np.frombuffer(b"".join(table.column("gone").to_pylist()), _GONE)]
        size = runs["count"].astype(np.int64) + length - 1
        at = np.cumsum(size) - size
        first, later = _first_of([runs["name"], runs["body"]], [runs["doc"], runs["tie"], runs["start"]])
        out.append(_gone(runs[later], length))
        # names with several contents, or a run that can repeat inside itself
        first = first[np.argsort(runs["name"][first], kind="stable")]
        name = runs["name"][first]
        new = np.concatenate([[True], name[1:] != name[:-1]]) if len(name) else np.empty(0, bool)
        group = np.cumsum(new) - 1
        sort = (np.bincount(group)[group] > 1) | runs["loose"][first] if len(name) else new
        first, group = first[sort], group[sort]
        edge = np.cumsum(size[first])
        lo = 0
        while lo < len(first):
            hi = int(np.searchsorted(edge, edge[lo] - size[first[lo]] + SORT_BYTES, "right"))
            hi = max(hi, lo + 1)
            while hi < len(first) and group[hi] == group[hi - 1]:        # a name stays whole
                hi += 1
            f = first[lo:hi]
            m = size[f]
            take = np.repeat(at[f] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            out.append(_sorted_repeats(runs[f], body[take], np.concatenate([[0], np.cumsum(m)]), length))
            lo = hi
        gone = np.concatenate(out)
        # spans of one document that touch become one
        gone = gone[np.lexsort((gone["start"], gone["tie"], gone["doc"]))]
        if len(gone):
            other = np.concatenate([[True], (gone["doc"][1:] != gone["doc"][:-1]) | (gone["tie"][1:] != gone["tie"][:-1])])
            reach = np.cumsum(other).astype(np.int64) << 40
            end = np.maximum.accumulate(reach + gone["end"])
            new = np.concatenate([[True], reach[1:] + gone["start"][1:] > end[:-1]])
            lead = np.flatnonzero(new)
            merged = gone[lead].copy()
            merged["end"] = end[np.append(lead[1:], len(gone)) - 1] - reach[lead]
            gone = merged
        return pa.table({c: pa.array(gone[c]) for c in ("doc", "tie", "start", "end")})

    return (docs.select("doc", "tie", "text").mapInArrow(send, "shard int, runs binary, body binary, gone binary")
            .repartition(out_n, "shard").groupBy("shard").applyInArrow(sort_shard, "doc long, tie long, start long, `end` long"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """One row a document: id, n_bytes, n_removed, n_spans, kept_sha256, and the kept text (as bytes) if asked for."""
    base = docs.select(F.col(id_col), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = repeated_spans(base, length).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = base.join(spans, ["doc", "tie"], "left").select(id_col, "text", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")

    def cut(batches):
        for b in batches:
            out = []
            get = lambda c: b.column(b.schema.get_field_index(c))  # noqa: B023, E731
            texts, starts, ends = get("text"), get("starts"), get("ends")
            for i in range(b.num_rows):
                raw = texts[i].as_py().encode()
                if not starts[i].is_valid:
                    out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
                    continue
                s, e = starts[i].values.to_numpy(), ends[i].values.to_numpy()
                o = np.argsort(s, kind="stable")
                s, e = s[o], np.maximum.accumulate(e[o])
                new = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
                s, e = s[new], e[np.append(new[1:], len(e)) - 1]
                keep = b"".join([raw[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True)])
                out.append((len(raw), len(raw) - len(keep), len(s), hashlib.sha256(keep).hexdigest(), keep))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            arrays = [get(id_col), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(cols[4], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(cut, schema)

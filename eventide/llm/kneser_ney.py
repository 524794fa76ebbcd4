"""Interpolated modified Kneser-Ney bigram model, counted in Spark, stored as sorted hash arrays.

Training counts words and word pairs in two passes of packed blocks that
shuffle by hash; nothing is cut, pruned or sampled. The model is a set of
files in the shared folder, each a sorted array of 64-bit hashes or an array
beside it:

  word-S.key    words of shard S, 64-bit hashes, ascending
  word-S.cnt    c(w), occurrences in training (u32, as are the next)
  word-S.con    N1+(.w), distinct words before w
  word-S.ctx    3 x u32 a word: words that follow it once, twice, more often
  pair-S.key    pairs (u, w) of shard S, 64-bit hashes, ascending
  pair-S.cnt    min(c(u, w), 255) (u8); pair-S.big/.bigc: the larger counts

Scoring tasks map the files into memory and look up each block's distinct
words and pairs in ascending order, so no task holds the model.

  p(w|u) = max(c(u,w) - D(c(u,w)), 0) / c(u) + g(u) p1(w)
  p1(w)  = max(N1+(.w) - D'(N1+), 0) / N1+(..) + g' / (V + 1)

with three discounts a level from the counts of counts. A context not seen
gives p1(w). The probabilities of the V words and one unknown word sum to 1.

Defined cases: a null text is empty and has one token, the end; without
training rows every token has probability 1 / (V + 1) = 1. Ids may repeat or
be null; each row is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ArrayStore, scratch, shards_for, text_bytes
from eventide.llm.textcode import LOWER, blocks, mix, prefix_hash, span_hash, word_spans

CHUNK_TOKENS = 2_000_000     # counted at once by a task, in memory
U64 = np.uint64
END = np.uint64(0x5851F42D4C957F2D)       # hash of the end token
BEGIN = np.uint64(0x14057B7EF767814F)     # context of the first token
_W48 = ~np.uint64(0xFFFF)
_LOW40 = np.uint64((1 << 40) - 1)


def _tokens(data, offs):
    """Word hashes of each row with the end token after each row, and row sizes."""
    low = LOWER[data]
    starts, ends, counts = word_spans(low, offs)
    sizes = counts + 1
    out = np.empty(int(sizes.sum()), U64)
    last = np.cumsum(sizes) - 1
    is_end = np.zeros(len(out), bool)
    is_end[last] = True
    out[is_end] = END
    out[~is_end] = span_hash(prefix_hash(low), starts, ends)
    return out, sizes


def _contexts(tokens, sizes):
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    return before


def _pair_key(u, w, hot):
    """Pairs of one context lie together (high 24 bits); contexts in ``hot`` are spread over all shards."""
    u48, w48 = u & _W48, w & _W48
    both = mix(u48 * U64(0x9E3779B97F4A7C15) + w48)
    key = (mix(u48) & ~_LOW40) | (both & _LOW40)
    return np.where(np.isin(u48, hot), both, key) if len(hot) else key


def _shard_cuts(sorted_keys, n):
    """Ends of shards 0..n-1 in ascending keys; shard = high 32 bits * n >> 32."""
    edges = np.array([(-(-(i << 32) // n)) << 32 for i in range(1, n)], U64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)]]).astype(np.int64)


def _sum_by(keys, *values):
    """Distinct ascending keys and the sums of the values of each."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    return (k[starts], *(np.add.reduceat(v[order], starts, axis=0) if len(k) else v[:0] for v in values))


def _w48_bytes(w):
    return np.ascontiguousarray(w.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _from_w48(raw):
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _token_chunks(batches):
    """(tokens, row sizes) of so many rows that a chunk has about CHUNK_TOKENS tokens."""
    toks, sizes, n = [], [], 0
    for _, _, _, data, offs in blocks(batches, "text"):
        t, s = _tokens(data, offs)
        toks.append(t)
        sizes.append(s)
        n += len(t)
        if n >= CHUNK_TOKENS:
            yield np.concatenate(toks), np.concatenate(sizes)
            toks, sizes, n = [], [], 0
    if toks:
        yield np.concatenate(toks), np.concatenate(sizes)


def _discounts(n1, n2, n3, n4):
    """D1, D2, D3+ from counts of counts, kept inside [0, k] where counts are too few to say."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0] + [min(max(x, 0.05), k) for k, x in zip((0.95, 1.95, 2.95), d, strict=True)])


class Model:
    """A trained model: the folder of its files, its shard count and a few sums."""

    def __init__(self, url: str, shards: int, sums: dict, hot: np.ndarray):
        self.url, self.shards, self.hot = url, shards, hot
        self.n, self.v = sums["n"], sums["v"]
        self.docs, self.total_con = sums["docs"], sums["con"]
        self.d2 = _discounts(*sums["pair_cc"])
        self.d1 = _discounts(*sums["word_cc"])
        wc = sums["word_n"]     # words with N1+ of 1, 2, 3 or more
        self.unseen = float(np.dot(self.d1[1:], wc)) / self.total_con if self.total_con else 1.0
        self.begin_ctx = np.array(sums["begin_ctx"], np.int64)

    # -- lookups, in worker processes -------------------------------------------------
    def _files(self):
        if not hasattr(self, "_maps"):
            store = ArrayStore(self.url)
            u32 = "<u4"
            self._maps = [[store.map(f"word-{s}.key", "<u8"), store.map(f"word-{s}.cnt", u32), store.map(f"word-{s}.con", u32),
                           store.map(f"word-{s}.ctx", u32), store.map(f"pair-{s}.key", "<u8"), store.map(f"pair-{s}.cnt", np.uint8),
                           store.map(f"pair-{s}.big", "<u8"), store.map(f"pair-{s}.bigc", u32)] for s in range(self.shards)]
        return self._maps

    def words(self, keys):
        """c(w), N1+(.w) and the context counts of ascending distinct words (0 if not seen)."""
        cnt, con, ctx = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros((len(keys), 3), np.int64)
        cuts = _shard_cuts(keys, self.shards)
        for s, m in enumerate(self._files()):
            k = keys[cuts[s]:cuts[s + 1]]
            if len(k) and len(m[0]):
                at = np.minimum(np.searchsorted(m[0], k), len(m[0]) - 1)
                hit = np.flatnonzero(m[0][at] == k)
                cnt[cuts[s] + hit], con[cuts[s] + hit] = m[1][at[hit]], m[2][at[hit]]
                ctx[cuts[s] + hit] = m[3].reshape(-1, 3)[at[hit]]
        return cnt, con, ctx

    def pairs(self, keys):
        """c(u, w) of ascending distinct pair keys."""
        out = np.zeros(len(keys), np.int64)
        cuts = _shard_cuts(keys, self.shards)
        for s, m in enumerate(self._files()):
            k = keys[cuts[s]:cuts[s + 1]]
            if len(k) and len(m[4]):
                at = np.minimum(np.searchsorted(m[4], k), len(m[4]) - 1)
                c = np.where(m[4][at] == k, m[5][at], 0).astype(np.int64)
                if (full := np.flatnonzero(c == 255)).size:
                    c[full] = m[7][np.searchsorted(m[6], k[full])]
                out[cuts[s]:cuts[s + 1]] = c
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_maps"}

    def score(self, tokens, sizes):
        """For each row: tokens known, base log10 probability, model log10 probability."""
        before = _contexts(tokens, sizes)
        words, inv = np.unique(tokens, return_inverse=True)
        cnt, con, ctx = self.words(words)
        base = np.log10((cnt + 0.1) / (self.n + 0.1 * (self.v + 1)))
        p1 = (con - self.d1[np.minimum(con, 3)]) / max(self.total_con, 1) + self.unseen / (self.v + 1)
        # gamma(u) and c(u) of the words as contexts; the begin context apart
        count_u = np.append(cnt, self.docs)
        follow = np.vstack([ctx, self.begin_ctx])
        gamma = np.where(count_u > 0, follow @ self.d2[1:] / np.maximum(count_u, 1), 1.0)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        u_at = np.empty(len(tokens), np.int64)
        u_at[1:] = inv[:-1]
        u_at[np.cumsum(sizes) - sizes] = len(words)
        keys, kinv = np.unique(_pair_key(before, tokens, self.hot), return_inverse=True)
        c2 = self.pairs(keys)[kinv]
        p = (c2 - self.d2[np.minimum(c2, 3)]) / np.maximum(count_u[u_at], 1) + gamma[u_at] * p1[inv]
        n = len(sizes)
        return (np.bincount(rows, cnt[inv] > 0, n).astype(np.int64), np.bincount(rows, base[inv], n),
                np.bincount(rows, np.log10(np.maximum(p, 1e-300)), n))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count ``docs`` and store the model in the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    n_docs, n_bytes = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = shards_for(n_bytes)
    url = scratch(spark, "kn-model")

    # pass 1: words
    def count_words(batches):
        for toks, _ in _token_chunks(batches):
            keys, counts = np.unique(toks, return_counts=True)
            cuts = _shard_cuts(keys, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()),
                 pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                 pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                names=["shard", "k", "c"])

    def merge_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        k = np.frombuffer(b"".join(table.column("k").to_pylist()), "<u8")
        c = np.frombuffer(b"".join(table.column("c").to_pylist()), "<u4").astype(np.int64)
        k, c = _sum_by(k, c)
        store = ArrayStore(url)
        store.write(f"word-{shard}.key", k)
        store.write(f"word-{shard}.cnt", np.minimum(c, 0xFFFFFFFF).astype(np.uint32))
        top = np.argsort(c)[::-1][:64]
        return pa.table({"shard": pa.array([shard], pa.int32()), "v": pa.array([len(k)], pa.int64()), "n": pa.array([int(c.sum())], pa.int64()),
                         "top": pa.array([k[top].view(np.int64).tolist()], pa.list_(pa.int64())), "top_n": pa.array([c[top].tolist()], pa.list_(pa.int64()))})

    words = (texts.mapInArrow(count_words, "shard int, k binary, c binary").groupBy("shard")
             .applyInArrow(merge_words, "shard int, v long, n long, top array<long>, top_n array<long>").collect())   # one row a shard
    if not words:
        store = ArrayStore(url)
        for s in range(n):
            for f in ("word-%d.key", "word-%d.cnt"):
                store.write(f % s, np.empty(0, np.uint32))
    total, vocab = sum(r["n"] for r in words), sum(r["v"] for r in words)
    # contexts with over a quarter of a shard's mean share are dealt over all shards: fewer than 4 a shard
    hot = np.array(sorted({t for r in words for t, c in zip(r["top"], r["top_n"], strict=True) if 4 * n * c > total}), np.int64).view(U64)
    hot = np.unique(np.append(hot, BEGIN) & _W48)

    # pass 2: pairs
    def count_pairs(batches):
        for toks, sizes in _token_chunks(batches):
            u = _contexts(toks, sizes)
            keys = _pair_key(u, toks, hot)
            order = np.argsort(keys)
            keys = keys[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(at, len(keys))).astype(np.uint32)
            keys, first = keys[at], order[at]
            u, w = u[first] & _W48, toks[first] & _W48
            cuts = _shard_cuts(keys, n)
            rows = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                run = np.flatnonzero(np.concatenate([[True], u[a + 1:b] != u[a:b - 1]])) if b > a else np.empty(0, np.int64)
                rows.append((_w48_bytes(u[a:b][run]), np.diff(np.append(run, b - a)).astype(np.uint32).tobytes(),
                             _w48_bytes(w[a:b]), counts[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), *(pa.array(list(x), pa.binary()) for x in zip(*rows, strict=True))],
                                             names=["shard", "u", "run", "w", "c"])

    def merge_pairs(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        us, ws, cs = [], [], []
        for u, run, w, c in zip(*(table.column(x).to_pylist() for x in ("u", "run", "w", "c")), strict=True):
            us.append(np.repeat(_from_w48(u), np.frombuffer(run, "<u4")))
            ws.append(_from_w48(w))
            cs.append(np.frombuffer(c, "<u4"))
        u, w, c = np.concatenate(us), np.concatenate(ws), np.concatenate(cs).astype(np.int64)
        del us, ws, cs
        keys = _pair_key(u, w, hot)
        order = np.argsort(keys)
        keys = keys[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        c = np.add.reduceat(c[order], at) if len(keys) else c
        keys, u, w = keys[at], u[order[at]], w[order[at]]
        store = ArrayStore(url)
        big = c >= 255
        store.write(f"pair-{shard}.key", keys)
        store.write(f"pair-{shard}.cnt", np.minimum(c, 255).astype(np.uint8))
        store.write(f"pair-{shard}.big", keys[big])
        store.write(f"pair-{shard}.bigc", np.minimum(c[big], 0xFFFFFFFF).astype(np.uint32))
        cc = [int((c == i).sum()) for i in (1, 2, 3, 4)]
        # what the words need: continuation counts of w, follower counts of u
        w, con = np.unique(w, return_counts=True)
        u, ctx = _sum_by(u, np.stack([c == 1, c == 2, c > 2], 1).astype(np.int64))
        wc, uc = _shard_cuts(w, n), _shard_cuts(u, n)
        return pa.table({
            "shard": pa.array(range(n), pa.int32()),
            "w": pa.array([_w48_bytes(w[wc[s]:wc[s + 1]]) for s in range(n)], pa.binary()),
            "con": pa.array([con[wc[s]:wc[s + 1]].astype(np.uint32).tobytes() for s in range(n)], pa.binary()),
            "u": pa.array([_w48_bytes(u[uc[s]:uc[s + 1]]) for s in range(n)], pa.binary()),
            "ctx": pa.array([ctx[uc[s]:uc[s + 1]].astype(np.uint32).tobytes() for s in range(n)], pa.binary()),
            "cc": pa.array([cc if s == shard else [0, 0, 0, 0] for s in range(n)], pa.list_(pa.int64()))})

    def finish_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        store = ArrayStore(url)
        keys = store.map(f"word-{shard}.key", "<u8")
        high = keys & _W48
        con, ctx, begin = np.zeros(len(keys), np.int64), np.zeros((len(keys), 3), np.int64), np.zeros(3, np.int64)
        for w, c, u, x in zip(*(table.column(y).to_pylist() for y in ("w", "con", "u", "ctx")), strict=True):
            np.add.at(con, np.searchsorted(high, _from_w48(w)), np.frombuffer(c, "<u4"))
            u, x = _from_w48(u), np.frombuffer(x, "<u4").reshape(-1, 3)
            own = u != (BEGIN & _W48)
            begin += x[~own].sum(axis=0, dtype=np.int64)
            np.add.at(ctx, np.searchsorted(high, u[own]), x[own])
        store.write(f"word-{shard}.con", con.astype(np.uint32))
        store.write(f"word-{shard}.ctx", ctx.astype(np.uint32))
        cc = np.array(table.column("cc").to_pylist(), np.int64).sum(axis=0).tolist()
        wcc = [int((con == i).sum()) for i in (1, 2, 3, 4)]
        return pa.table({"pair_cc": pa.array([cc], pa.list_(pa.int64())), "word_cc": pa.array([wcc], pa.list_(pa.int64())),
                         "more": pa.array([int((con > 2).sum())], pa.int64()), "con": pa.array([int(con.sum())], pa.int64()),
                         "begin": pa.array([begin.tolist()], pa.list_(pa.int64()))})

    parts = (texts.mapInArrow(count_pairs, "shard int, u binary, run binary, w binary, c binary").groupBy("shard")
             .applyInArrow(merge_pairs, "shard int, w binary, con binary, u binary, ctx binary, cc array<long>").groupBy("shard")
             .applyInArrow(finish_words, "pair_cc array<long>, word_cc array<long>, more long, con long, begin array<long>").collect())  # one row a shard
    if not parts:
        for s in range(n):
            for f in ("word-%d.con", "word-%d.ctx", "pair-%d.key", "pair-%d.cnt", "pair-%d.big", "pair-%d.bigc"):
                ArrayStore(url).write(f % s, np.empty(0, np.uint32))
    add = lambda name, k: np.sum([r[name] for r in parts], axis=0).tolist() if parts else [0] * k
    word_cc = add("word_cc", 4)
    return Model(url, n, {"n": total, "v": vocab, "docs": n_docs, "con": sum(r["con"] for r in parts), "pair_cc": add("pair_cc", 4),
                          "word_cc": word_cc, "word_n": [*word_cc[:2], sum(r["more"] for r in parts)], "begin_ctx": add("begin", 3)}, hot)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_tokens, n_known, base_score and score of every row."""
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["n_tokens long", "n_known long", "base_score double", "score double"])

    def run(batches):
        for batch, lo, hi, data, offs in blocks(batches, text_col, 4 << 20):
            toks, sizes = _tokens(data, offs)
            known, base, prob = model.score(toks, sizes)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in keep),
                 pa.array(sizes.astype(np.int64)), pa.array(known), pa.array(base), pa.array(prob)],
                names=[*keep, "n_tokens", "n_known", "base_score", "score"])

    return docs.select(*keep, text_col).mapInArrow(run, schema)

"""Alignment of two tokenizers' tokens over the same bytes, by interval coalescing.

A text's tokens are byte intervals. All A and B tokens are sorted by start
(lexsort); a running maximum of the ends (``maximum.accumulate``) tells where
a group ends: at the first start that reaches it. Within a group the
overlapping A-B pairs are expanded; pairs that end at the same byte are the
links that the corpus counts are made of.

A text is cut where neither tokenizer can join what stands on the two sides
(before single spaces, and between bytes that no piece of either vocabulary
holds side by side), so each distinct unit of a block is encoded and aligned
once; the groups of a text are those of its units in order.

Defined cases: texts that are null or empty, or that a tokenizer does not give
back byte for byte, have no tokens: zeros and an empty digest. Rows are kept
as they are, repeated ids too; other columns are not read. No rows give no
rows. Whole texts are encoded, however long.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ArrayStore, scratch
from eventide.llm.textcode import blocks, prefix_hash, span_hash

SHARDS = 32             # of the pair counts: a fixed number, as the pairs are bounded by the two vocabularies
BLOCK_BYTES = 4 << 20   # of text whose distinct units are encoded together
# fixed value: how byte-level vocabularies of this kind split text into words
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_worker: dict = {}


def byte_level_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokenizer:
    """A byte-level BPE from a ``tokenizers`` file, encoded by ``tiktoken``, which is the faster of the two.

    The file's ids must be in the order of its merges, as they then are the ranks that ``tiktoken`` goes by.
    Added special strings are no part of it, so they are ordinary text.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        alphabet = byte_level_alphabet()
        order = [vocab["".join(m)] for m in merges]
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or order != sorted(order) or any(vocab[c] > order[0] for c in alphabet):
            raise ValueError(f"{path} is no byte-level BPE with ids in the order of its merges")
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if all(c in alphabet for c in token)}
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        used = set(order) | {vocab[c] for c in alphabet}
        ranks = {piece: i for piece, i in ranks.items() if i in used}
        self.encode_one = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text as it stands."""
        return [self.encode_one(t) for t in texts]


class PieceTokenizer:
    """A sentencepiece model; the space that it adds before a text is left to the caller."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            # a message appended to a model file overrides: normalizer_spec (3) {add_dummy_prefix (3): false}
            self.model = sentencepiece.SentencePieceProcessor(model_proto=f.read() + b"\x1a\x02\x18\x00")
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            self.pieces.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def coalesce(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of all A and of all B intervals: intervals that overlap, directly or through others, share one."""
    start = np.concatenate([a_start, b_start])
    end = np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[:len(a_start)], group[len(a_start):]


def overlaps(a_start, a_end, b_start, b_end, a_group, b_group) -> tuple[np.ndarray, np.ndarray]:
    """Indices (A, B) of all pairs that share a byte; both sides in order, pairs sought within their group."""
    first = np.searchsorted(b_group, a_group, "left")
    n = np.searchsorted(b_group, a_group, "right") - first
    i = np.repeat(np.arange(len(a_start)), n)
    j = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(i))
    meet = (a_start[i] < b_end[j]) & (b_start[j] < a_end[i])
    return i[meet], j[meet]


def _ragged(values: np.ndarray, cuts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The slices of ``values`` between ``cuts`` of the wanted rows, one after another."""
    n = (cuts[1:] - cuts[:-1])[rows]
    first = cuts[:-1][rows]
    return values[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class _Aligner:
    """Both tokenizers of a worker, and the alignment of a list of units."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokenizer(a_path), PieceTokenizer(b_path)
        self.len_a = np.array([len(p) for p in self.a.pieces], np.int64)
        self.len_b = np.array([len(p) for p in self.b.pieces], np.int64)
        self.apart = apart(self.a.pieces + self.b.pieces)
        self.names_a = [str(i) for i in range(len(self.len_a))]
        self.names_b = [str(i) for i in range(len(self.len_b))]

    def align(self, units: list[bytes]) -> tuple:
        """(good, digest texts, numbers of A and B tokens, groups, overlaps and links, link codes) of the units in order.

        A unit that a tokenizer does not give back is not good and has nothing.
        """
        texts = [u.decode() for u in units]
        ids_a, ids_b = self.a.encode(texts), self.b.encode(texts)
        of_a, of_b = self.a.pieces, self.b.pieces
        good = np.array([b"".join([of_a[i] for i in x]) == u == b"".join([of_b[i] for i in y])
                         for u, x, y in zip(units, ids_a, ids_b, strict=True)], bool)
        if not good.all():
            ids_a, ids_b = ([x if ok else [] for x, ok in zip(ids, good.tolist(), strict=True)] for ids in (ids_a, ids_b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        list_a, list_b = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        flat_a, flat_b = np.array(list_a, np.int64), np.array(list_b, np.int64)
        end_a, end_b = np.cumsum(self.len_a[flat_a]), np.cumsum(self.len_b[flat_b])
        start_a, start_b = end_a - self.len_a[flat_a], end_b - self.len_b[flat_b]
        group_a, group_b = coalesce(start_a, end_a, start_b, end_b)
        i, j = overlaps(start_a, end_a, start_b, end_b, group_a, group_b)
        joint = end_a[i] == end_b[j]
        codes = flat_b[j[joint]] * len(self.len_a) + flat_a[i[joint]]
        # first group, pair and link of each unit; a unit's bytes are nobody else's, so groups stay within it
        cut_a = np.concatenate([[0], np.cumsum(n_a)])
        n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
        cut_g, cut_o, cut_l = np.append(group_a, n_groups)[cut_a], np.searchsorted(i, cut_a), np.searchsorted(i[joint], cut_a)
        at_a = np.searchsorted(group_a, np.arange(n_groups + 1)).tolist()
        at_b = np.searchsorted(group_b, np.arange(n_groups + 1)).tolist()
        name_a, name_b = [self.names_a[k] for k in list_a], [self.names_b[k] for k in list_b]
        shown = [(name_a[p] if q - p == 1 else ",".join(name_a[p:q])) + "|" + (name_b[r] if s - r == 1 else ",".join(name_b[r:s]))
                 for p, q, r, s in zip(at_a, at_a[1:], at_b, at_b[1:], strict=False)]
        cut = cut_g.tolist()
        shown = [";".join(shown[g:h]) for g, h in zip(cut, cut[1:], strict=False)]
        return good, shown, (n_a, n_b, np.diff(cut_g), np.diff(cut_l), np.diff(cut_o)), codes, cut_l


def apart(pieces: list[bytes]) -> np.ndarray:
    """Whether no piece holds the two bytes side by side, so that no token can reach over the place between them.

    Only places between characters that are no white space count, and none before an apostrophe, which
    could begin a word of its own there. (256, 256) by left and right byte.
    """
    joined = np.zeros((256, 256), bool)
    for piece in pieces:
        b = np.frombuffer(piece, np.uint8)
        joined[b[:-1], b[1:]] = True
    out = ~joined
    white = np.flatnonzero(_WHITE)
    out[white], out[:, white], out[:, 0x80:0xC0], out[:, 0x27] = False, False, False, False
    return out


# bytes that are or may begin white space
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def unit_starts(data: np.ndarray, offs: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """First bytes of the units of rows that begin with a space each.

    A unit begins at a space after a byte that is none and before a character that is no white space,
    and between bytes that stand apart in both vocabularies, where no white space ends.
    """
    space = data == 0x20
    cut = np.zeros(len(data), bool)
    # a row's last byte looks into the next row, which begins with a space, so it is never cut
    cut[1:-1] = space[1:-1] & ~space[:-2] & ~_WHITE[data[2:]]
    lead = _WHITE[data] & (data >= 0x80)
    white_end = data >= 0x80
    white_end[:1], white_end[1:2] = False, white_end[1:2] & lead[:1]
    white_end[2:] &= lead[1:-1] | lead[:-2]
    cut[1:] |= apart[data[:-1], data[1:]] & ~white_end[:-1]
    cut[offs[:-1]] = True
    return np.flatnonzero(cut)


def _aligned(path_a: str, path_b: str, id_col: str, text_col: str):
    def run(batches):
        if (path_a, path_b) not in _worker:
            _worker[path_a, path_b] = _Aligner(path_a, path_b)
        aligner = _worker[path_a, path_b]
        for batch, lo, hi, data, offs in blocks(batches, text_col, BLOCK_BYTES):
            n = hi - lo
            full = np.flatnonzero(np.diff(offs) > 0)
            sizes = np.diff(offs)[full]
            # each text with the space before it
            at = np.concatenate([[0], np.cumsum(sizes + 1)])
            spaced = np.full(int(at[-1]), 0x20, np.uint8)
            body = np.ones(len(spaced), bool)
            body[at[:-1]] = False
            spaced[body] = data
            cells = np.zeros((5, n), np.int64)
            sha, codes, times = [""] * n, [b""] * n, [b""] * n
            if len(full):
                starts = unit_starts(spaced, at, aligner.apart)
                ends = np.append(starts[1:], len(spaced))
                raw = spaced.tobytes()
                _, first, inv = np.unique(span_hash(prefix_hash(spaced), starts, ends), return_index=True, return_inverse=True)
                good, shown, counts, links, link_cuts = aligner.align([raw[x:y] for x, y in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
                cuts = np.searchsorted(starts, at)
                # a text that a tokenizer changes somewhere has no tokens
                whole = np.logical_and.reduceat(good[inv], cuts[:-1])
                for cell, count in zip(cells, counts, strict=True):
                    cell[full] = np.where(whole, np.add.reduceat(count[inv], cuts[:-1]), 0)
                row = np.repeat(np.arange(len(full)), cells[3][full])
                own = np.repeat(whole, np.diff(cuts))
                code, count = np.unique((row.astype(np.uint64) << np.uint64(32)) | _ragged(links, link_cuts, inv[own]).astype(np.uint64), return_counts=True)
                cut = np.searchsorted(code, np.arange(len(full) + 1, dtype=np.uint64) << np.uint64(32))
                code, count = (code & np.uint64(0xFFFFFFFF)).astype("<u4"), count.astype("<u4")
                inv, cuts = inv.tolist(), cuts.tolist()
                for k, (r, ok) in enumerate(zip(full.tolist(), whole.tolist(), strict=True)):
                    if ok:
                        sha[r] = hashlib.sha256(";".join([shown[u] for u in inv[cuts[k]:cuts[k + 1]]]).encode()).hexdigest()
                        codes[r], times[r] = code[cut[k]:cut[k + 1]].tobytes(), count[cut[k]:cut[k + 1]].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)).slice(lo, n), *[pa.array(c) for c in cells],
                 pa.array(sha), pa.array(codes, pa.binary()), pa.array(times, pa.binary())],
                names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "codes", "times"])
    return run


def _cells(batch, name, dtype="<u4"):
    """(all values of a binary column of arrays, row offsets)."""
    c = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    offs = np.frombuffer(c.buffers()[1], np.int64, len(c) + 1, c.offset * 8) if len(c) else np.zeros(1, np.int64)
    raw = c.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None and raw.size else np.empty(0, np.uint8)
    return np.frombuffer(data.tobytes(), dtype), (offs - offs[0]) // np.dtype(dtype).itemsize


def _pair_counts(batches):
    for batch in batches:
        codes, _ = _cells(batch, "codes")
        times, _ = _cells(batch, "times")
        code, at = np.unique(codes, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(np.bincount(at, times, len(code)).astype(np.int64))], names=["code", "n"])


class PairCounts:
    """Corpus counts of linked id pairs as sorted arrays in the shared folder, ``SHARDS`` files by B id.

    There are at most |A| x |B| pairs, whatever the corpus; workers map the files.
    """

    def __init__(self, spark, n_a: int, n_b: int):
        self.url, self.n_a, self.n_b = scratch(spark, "pairs"), n_a, n_b

    def write(self, counts: DataFrame) -> None:
        """Store (code, n) rows, one a pair."""
        url, n_a, n_b = self.url, self.n_a, self.n_b

        def shard(table: pa.Table) -> pa.Table:
            s = table.column("shard")[0].as_py()
            code, n = (table.column(c).to_numpy() for c in ("code", "n"))
            order = np.argsort(code)
            code, n = code[order], n[order]
            first = np.flatnonzero(np.diff(code // n_a, prepend=-1))
            best = n == np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(n))))
            store = ArrayStore(url)
            store.write(f"{s}.code", code.astype("<u4"))
            store.write(f"{s}.n", n.astype("<i8"))
            store.write(f"{s}.best", best.astype(np.uint8))
            return pa.table({"pairs": pa.array([len(code)], pa.int64())})

        at = F.expr(f"CAST(code DIV {n_a} * {SHARDS} DIV {n_b} AS INT)")
        written = counts.withColumn("shard", at).groupBy("shard").applyInArrow(shard, "pairs long").collect()   # one number a shard
        self.pairs = sum(r["pairs"] for r in written)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_maps"}

    def look(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, whether it is the highest of its B id) of each code."""
        if not hasattr(self, "_maps"):
            self._maps = {}
        n, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        keys, inv = np.unique(codes, return_inverse=True)
        shard = keys.astype(np.int64) // self.n_a * SHARDS // self.n_b
        cuts = np.searchsorted(shard, np.arange(SHARDS + 1))
        key_n, key_best = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for s in np.unique(shard).tolist():
            if s not in self._maps:
                store = ArrayStore(self.url)
                self._maps[s] = store.map(f"{s}.code", "<u4"), store.map(f"{s}.n", "<i8"), store.map(f"{s}.best", np.uint8)
            code, count, top = self._maps[s]
            at = np.searchsorted(code, keys[cuts[s]:cuts[s + 1]])
            key_n[cuts[s]:cuts[s + 1]], key_best[cuts[s]:cuts[s + 1]] = count[at], top[at] == 1
        n[:], best[:] = key_n[inv], key_best[inv]
        return n, best


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's alignment: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps).

    ``a_path`` names a byte-level BPE of ``tokenizers``, ``b_path`` a sentencepiece model; their vocabularies'
    product must stay under 2^32. Texts are encoded once; the rows' distinct links are kept in the shared
    folder, counted over the corpus, and looked up again.
    """
    spark = docs.sparkSession
    n_a, n_b = len(ByteTokenizer(a_path).pieces), len(PieceTokenizer(b_path).pieces)
    if n_a * n_b >= 1 << 32:
        raise ValueError("the vocabularies have too many pairs for 32-bit codes")
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = "n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string"
    path = scratch(spark, "aligned")
    rows = docs.select(id_col, text_col).mapInArrow(_aligned(a_path, b_path, id_col, text_col), f"`{id_col}` {id_type}, {fields}, codes binary, times binary")
    rows.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    counts = PairCounts(spark, n_a, n_b)
    counts.write(rows.select("codes", "times").mapInArrow(_pair_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))

    def totals(batches):
        for batch in batches:
            codes, offs = _cells(batch, "codes")
            times, _ = _cells(batch, "times")
            n, best = counts.look(codes) if len(codes) else (np.empty(0, np.int64), np.empty(0, bool))
            sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[offs]) for v in (times * best, times.astype(np.int64) * n)]
            keep = [c for c in batch.schema.names if c not in ("codes", "times")]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in keep], *[pa.array(s.astype(np.int64)) for s in sums]],
                                             names=[*keep, "n_best", "count_sum"])

    out = rows.mapInArrow(totals, f"`{id_col}` {id_type}, {fields}, n_best long, count_sum long")
    return out.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")

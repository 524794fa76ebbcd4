"""The conversation trie, embedding near-dedup and token alignment against brute force, on small and odd tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import embedding_dedup, prefix_trie, queries, token_alignment

SF = "/root/testdata/sf0.001"


def _oracle(name: str, table: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(queries.ORACLE[name])
    return [c[0] for c in found.description], Counter(found.fetchall())


# ---- conversation trie -----------------------------------------------------

def _trie(rows) -> Counter:
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    convs = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in sorted(made.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(str(c))
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(ends[p]).encode()).hexdigest())
                   for p, m in members.items())


def _conversations():
    rng = np.random.default_rng(3)
    rows = []
    for c in [*range(-3, 60), 99, 100, 101, 250, 251, 399, 2**40, 2**40 + 1]:
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, ["user", "bot"][t % 2], f"turn {rng.integers(0, 3)} é" * int(rng.integers(0, 3))))
    rows += [(300, None, None, None), (300, None, "user", ""), (300, 1, "user", "x"), (300, 1, "user", "x"), (300, 1, "bot", "b"), (300, 1, "user", "a"), (None, 1, "user", "nobody's")]
    rows += [(600, t, "user", f"long {t % 7}") for t in range(300)] + [(600 + c, t, "user", f"long {t % 7}") for c in range(1, 9) for t in range(40)]
    return rows


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ONE_TASK", 64)
    rows = _conversations()
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, at int")
    got = Counter(tuple(r) for r in prefix_trie.trie(df).collect())
    assert got == _trie(rows)
    assert prefix_trie.trie(df.limit(0)).count() == 0


def test_trie_query(spark):
    cols, want = _oracle("op11_prefix_trie", "conversations")
    assert Counter(tuple(r[c] for c in cols) for r in queries.op11_prefix_trie(spark, SF).collect()) == want


def test_running_sums(spark):
    df = spark.range(200).selectExpr("id % 3 AS k", "id DIV 3 AS at", "id AS v").repartition(5)
    got = {(r.k, r.at): r.v for r in prefix_trie.running_sums(df, ["k"], "at", ["v"], width=4).collect()}
    assert got == {(k, a): sum(3 * x + k for x in range(a + 1)) for k in range(3) for a in range(67) if 3 * a + k < 200}


@pytest.mark.parametrize("n", [1, 2, 500])
def test_list_ranks(spark, monkeypatch, n):
    monkeypatch.setattr(prefix_trie, "ONE_TASK", 8)
    df = spark.range(n).select(F.concat(F.lit("x"), "id").alias("id"), F.when(F.col("id") < n - 1, F.concat(F.lit("x"), F.col("id") + 1)).alias("next"), F.lit(2).cast("long").alias("hop"))
    assert {r.id: r["rank"] for r in prefix_trie.list_ranks(df.repartition(3)).collect()} == {f"x{k}": 2 * (n - k) for k in range(n)}


# ---- embeddings ------------------------------------------------------------

def _links(rows, least=0.95):
    good = []
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v) / max(abs(np.array(v)))
            good.append((k, x / np.linalg.norm(x)))
    n, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(good):
        for b, y in good[i + 1:]:
            if len(x) == len(y) and x @ y >= least:
                n[a] += 1
                n[b] += 1
                root[top(a)] = top(b)
    least_id = {}
    for k, (i, _) in enumerate(rows):
        t = top(k)
        least_id[t] = min((x for x in (least_id.get(t), i) if x is not None), default=None)
    return Counter((i, n[k], least_id[top(k)], i == least_id[top(k)]) for k, (i, _) in enumerate(rows))


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(5)
    rows = [(k, rng.standard_normal(32).tolist()) for k in range(300)]
    # tight and loose groups, larger than the window
    for size, noise in ((150, 0.1), (200, 0.25), (90, 0.33)):
        centre = rng.standard_normal(32)
        centre /= np.linalg.norm(centre)
        rows += [(len(rows) + k, (centre + noise / math.sqrt(32) * rng.uniform(0.2, 1.4) * rng.standard_normal(32)).tolist()) for k in range(size)]
    rows += [(2000 + k, rows[310][1]) for k in range(40)] + [(2100, [7 * x for x in rows[310][1]]), (2101, [1e300 * x for x in rows[5][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 32), (3003, [None, 1.0]), (3004, [float("nan")] * 32), (3005, [float("inf")] * 32), (None, rows[7][1]), (None, [1.0, 2.0]),
             (3006, [1.0, 2.0]), (3006, [1.0, 2.0]), (3007, [1.0]), (3008, [-0.0, 1.0]), (3009, [0.0, 1.0]), (None, [5.0, -4.0, 3.0])]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<double>, node string, id int")
    got = Counter(tuple(r) for r in embedding_dedup.near_duplicates(df, window=16).collect())
    want = _links(rows)
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5])
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_recall(spark):
    """Lone pairs just above the bound are met by the passes."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    cos = rng.uniform(0.9501, 0.96, len(x))[:, None]
    y = cos * x + np.sqrt(1 - cos * cos) * away
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, y]))]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.where("n_links > 0").count() >= 0.995 * len(rows)


def test_embedding_query(spark):
    cols, want = _oracle("op12_embedding_dedup", "embeddings")
    assert Counter(tuple(r[c] for c in cols) for r in queries.op12_embedding_dedup(spark, SF).collect()) == want


# ---- token alignment -------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizers():
    sp = pytest.importorskip("sentencepiece")
    hf = pytest.importorskip("tokenizers")
    a = hf.Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sp.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))


def _alignment(texts, tokenizers):
    a, b = tokenizers
    alphabet, names = token_alignment.byte_level_alphabet(), {v: k for k, v in a.get_vocab().items()}
    parts, counts = [], Counter()
    for x in texts:
        x = x or ""
        ids_a, ids_b = a.encode(" " + x, add_special_tokens=False).ids, b.encode(x)
        bytes_a = [bytes(alphabet[c] for c in names[i]) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        if not x or not b"".join(bytes_a) == (" " + x).encode() == b"".join(bytes_b):
            parts.append(None)
            continue
        end_a, end_b = (np.cumsum([len(t) for t in ts]).tolist() for ts in (bytes_a, bytes_b))
        groups, links, p, q = [], [], 0, 0
        for e in sorted(set(end_a) & set(end_b)):
            i, j = end_a.index(e) + 1, end_b.index(e) + 1
            groups.append(",".join(map(str, ids_a[p:i])) + "|" + ",".join(map(str, ids_b[q:j])))
            links.append((ids_a[i - 1], ids_b[j - 1]))
            p, q = i, j
        meet = sum(max(s, u) < min(e, v) for s, e in zip([0, *end_a], end_a) for u, v in zip([0, *end_b], end_b)) if len(x) < 3000 else None
        parts.append((len(ids_a), len(ids_b), groups, links, meet))
        counts.update(links)
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(0, 0, 0, 0, 0, 0, "", 0) if p is None else
            (p[0], p[1], len(p[2]), len(p[3]), sum(counts[x] == best[x[1]] for x in p[3]), sum(counts[x] for x in p[3]), hashlib.sha256(";".join(p[2]).encode()).hexdigest(), p[4]) for p in parts]


ODD_TEXTS = [None, "", " ", "  ", "\n", " lead", "a  b   c\n\nd\te", "x \n y\r\n\r\nz ", "a▁b changed", "<|endoftext|> <s> </s><unk>", "don't we'll  x's &'s 'tis \"'re", "a\x85 b \x85c\xa0 \xa0d",
             "　x 　y  z​", "tab\x00 nul\x1c fs\x1f us", "1,234.5 12ab34", "é \U0001F600\U0001F600 中文 ال ก", "y" * 5000, "naïve,café.Èque;", "x\xa0y,z w"]


def test_alignment(spark, tokenizers):
    base = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    texts = ODD_TEXTS + ODD_TEXTS[:9] + base + ["".join(np.random.default_rng(1).choice(list("ab \n,.'é\xa0 中<>|▁1"), 400)) for _ in range(3)]
    texts += ["".join(np.random.default_rng(k).choice(list("ab \n,.'sé\xa0 中<1"), 300)) for k in range(40)]
    ids = [None if k == 3 else k // 2 for k in range(len(texts))]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, codes string, n long")
    paths = [queries.tokenizer_path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    got = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.n_overlaps if len(t or "") < 3000 else None)
                  for r, t in zip(token_alignment.align(df.coalesce(1), *paths).collect(), texts, strict=True))
    want = Counter((i, *w) for i, w in zip(ids, _alignment(texts, tokenizers), strict=True))
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
    assert token_alignment.align(df.limit(0), *paths).count() == 0


def test_alignment_query(spark, tokenizers):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(docs, _alignment(list(docs.values()), tokenizers), strict=True))
    got = queries.op13_token_alignment(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == want[r.doc_id][:7]


def test_coalesce():
    a, b = np.array([[0, 2], [2, 5], [5, 6]]), np.array([[0, 1], [1, 3], [3, 5], [5, 6]])
    ga, gb = token_alignment.coalesce(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    assert ga.tolist() == [0, 0, 1] and gb.tolist() == [0, 0, 0, 1]
    i, j = token_alignment.overlaps(a[:, 0], a[:, 1], b[:, 0], b[:, 1], ga, gb)
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 3)]

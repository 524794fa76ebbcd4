"""The text operators against brute force, on small and odd tables."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from eventide.llm import common, components, decontamination, fingerprints, html_text, kneser_ney, line_dedup, packing, queries, simhash, suffix_arrays, suffix_dedup, toxicity, url_filter

SF = "/root/testdata/sf0.001"
ODD = [(9000, None), (9001, ""), (9002, "   "), (9003, "a" * 400), (9004, "ab" * 200), (9005, "é" * 150), (9006, "one"), (9007, "one"),
       (9007, "one"), (None, "a null id"), (9008, "Don't 'tis <|endoftext|> 12a3 É\x85y\nTWO\n\nTWO\r\n" + "x" * 120)]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame([(i, t, "clash") for i, t in ODD], "doc_id long, text string, label string")
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return base.limit(120).unionByName(odd, allowMissingColumns=True).select("doc_id", "text").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def _low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffle_files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (found.apply(i) for i in range(found.length())) if f.getName().startswith("shuffle_")}

    clean_up = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    conf, before = spark.conf.get(clean_up, None), shuffle_files()
    out = common.stored(spark.range(3000).selectExpr("id % 100 AS k").groupBy("k").count(), "shuffled")
    # the files are removed in the background
    for _ in range(50):
        if left := shuffle_files() - before:
            time.sleep(0.1)
    assert not left and sorted(tuple(r) for r in out.collect()) == [(k, 30) for k in range(100)]
    assert spark.conf.get(clean_up, None) == conf


def test_fingerprints(docs, rows, empty):
    got = fingerprints.edit_likeness(docs).collect()
    assert len(got) == len(rows) and fingerprints.edit_likeness(empty).count() == 0
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter()
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = (t[:len(t) - half] + nxt[:half]).encode()
        a, e, n = (fingerprints.fingerprint(x) for x in (t.encode(), edited, nxt.encode()))
        want[i, len(t), hashlib.sha256(edited).hexdigest(), a, e, fingerprints.likeness(a, e), fingerprints.likeness(a, n)] += 1
    assert Counter(tuple(r) for r in got) == want
    long = " ".join(str(i * i) for i in range(40_000))
    a, b = fingerprints.fingerprint(long.encode()), fingerprints.fingerprint((long[:100_000] + "zzz" + long[100_003:]).encode())
    assert fingerprints.likeness(a, b) > 0.9 and fingerprints.likeness(a, a) == 1.0


def test_kneser_ney(docs, rows, empty):
    model = kneser_ney.train(docs.where("doc_id % 3 <> 0"))
    got = kneser_ney.score(docs, model, ["doc_id"]).collect()
    toks = {k: re.findall(r"[^\x20\x09-\x0D]+", _low(t)) + ["\0"] for k, (_, t) in enumerate(rows)}
    train = [toks[k] for k, (i, _) in enumerate(rows) if i is not None and i % 3]
    c1, c2 = Counter(w for d in train for w in d), Counter(p for d in train for p in zip(["\1", *d], d, strict=False))
    n, v, con = sum(c1.values()), len(c1), Counter(w for _, w in c2)
    d2, d1 = (kneser_ney._discounts(*[Counter(x.values())[k] for k in (1, 2, 3, 4)]) for x in (c2, con))
    unseen, cu, kinds = sum(d1[min(x, 3)] for x in con.values()) / len(c2), Counter(), defaultdict(lambda: [0, 0, 0, 0])
    for (u, _), c in c2.items():
        cu[u] += c
        kinds[u][min(c, 3)] += 1

    def p1(w):
        return (con[w] - d1[min(con[w], 3)]) / len(c2) + unseen / (v + 1)

    def p2(u, w):
        return p1(w) if not cu[u] else (c2[u, w] - d2[min(c2[u, w], 3)]) / cu[u] + sum(kinds[u][j] * d2[j] for j in (1, 2, 3)) / cu[u] * p1(w)

    assert math.isclose(sum(p2("\1", w) for w in c1) + p2("\1", "\2"), 1)
    want = sorted((i or -1, len(toks[k]), sum(c1[w] > 0 for w in toks[k]), round(sum(math.log10((c1[w] + .1) / (n + .1 * (v + 1))) for w in toks[k]), 5),
                   round(sum(math.log10(p2(u, w)) for u, w in zip(["\1", *toks[k]], toks[k], strict=False)), 5)) for k, (i, _) in enumerate(rows))
    assert np.allclose(want, sorted((r[0] or -1, r[1], r[2], round(r[3], 5), round(r[4], 5)) for r in got), atol=1e-4)
    none = kneser_ney.train(empty)
    assert [r.score for r in kneser_ney.score(docs.limit(3), none, ["doc_id"]).collect()] == [0.0] * 3


def test_html():
    page = """<html><head><title>t</title><body><header>Site</header><div class="cookie-notice">We use cookies on this long line of notice text.</div>
    <main><article><h1>Head</h1><p>One &amp; two\n three <a href=#>link</a> four, a line with many words in it.</p><script>if(a<b){}</script><p>Short.
    <ul><li>item 1<li>item 2</ul><aside>advert text</aside><form>Search</form><p>Last paragraph with some more words.<br>Go on.</p>
    <section id="comments"><p>Great post, a long reader comment goes here.</p></section></article></main><footer>c</footer></body></html>"""
    assert html_text.main_text(page).split("\n\n") == ["Head", "One & two three link four, a line with many words in it.", "Short.", "item 1", "item 2",
                                                       "Last paragraph with some more words. Go on."]
    assert [html_text.main_text(x) for x in (None, "", "<p>", "plain")] == ["", "", "", "plain"]
    assert html_text.main_text("<p>" + "w " * 50_000) == ("w " * 50_000).strip()


LONG = "A long paragraph of the article with many words and no links in it, number "


def test_html_layout_names():
    ps = [f"{LONG}{k}." for k in range(6)]
    body = "".join(f"<p>{x}</p>" for x in ps)
    nav = "<div class='nav-menu'><a href=#>Home</a> <a href=#>News</a></div>"
    comments = "<div id='comments'>" + f"<p>{LONG}of a reader.</p>" * 3 + "</div>"
    for page in (f"<div class='content-sidebar-wrap'><main>{body}</main></div>", f"<div class='has-sidebar'>{body}</div>", f"<div class='widget Blog'><div class='post'>{body}</div></div>",
                 f"<div id='no-comments-page'><main>{body}</main></div>", f"<div class='subscribe-page'>{body}</div>"):
        assert html_text.main_text(f"<body>{nav}{page}</body>").split("\n\n") == ps
    assert html_text.main_text(f"<body>{nav}<div class='has-sidebar'><article><h2 class='section-header'>Head</h2>{body}{comments}</article></div></body>").split("\n\n") == ["Head", *ps]


def test_html_regions():
    ps = [f"{LONG}{k}." for k in range(10)]
    p = [f"<p>{x}</p>" for x in ps]
    text = html_text.main_text
    assert text(f"<body><div><div>{''.join(p[:6])}</div><h2>Next</h2><div>{''.join(p[6:])}</div></div>").split("\n\n") == [*ps[:6], "Next", *ps[6:]]
    items = "".join(f"<li>{x}</li>" for x in ps[1:9])
    assert text(f"<body><div>{p[0]}<ul>{items}</ul>{p[9]}</div>").split("\n\n") == ps
    assert text(f"<body><div><p>Short.</p><ul>{items}</ul><p>End.</p></div>").split("\n\n") == ["Short.", *ps[1:9], "End."]
    assert text(f"<body><article>{''.join(p[:7])}</article><article>{''.join(p[7:])}</article>").split("\n\n") == ps
    assert text(f"<body><h1>Title</h1>{''.join(p)}<p>End.</p><p><a href=#>Imprint</a></p></body>").split("\n\n") == ["Title", *ps, "End."]


def test_html_table(spark):
    t = spark.createDataFrame([(1, None, None, 5), (1, "u", "<p>a", 5), (1, "u", "<p>a", 5)], "page_id long, url string, html string, text int")
    assert sorted((r.text, r.n_chars) for r in html_text.extract(t).collect()) == [("", 0), ("a", 1), ("a", 1)]


def test_decontamination(spark, docs, rows):
    base = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    extra = [(900, "one"), (901, None), (902, "!!"), (903, "ONE"), (904, rows[3][1][:300])]
    items = base.unionByName(spark.createDataFrame(extra, "item_id long, text string"))
    word, windows = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), defaultdict(set)
    for r in items.collect():
        w = word.findall(_low(r.text))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(str(r.item_id))
    want = Counter()
    for i, t in rows:
        w, hit, names = word.findall(_low(t)), set(), set()
        for ws, ids in windows.items():
            for k in range(len(w) - len(ws) + 1):
                if tuple(w[k:k + len(ws)]) == ws:
                    hit.update(range(k, k + len(ws)))
                    names |= ids
        want[i, len(w), len(hit), ",".join(sorted(names))] += 1
    found = decontamination.matches(docs, items)
    got = found.select("doc_id", "n_words", decontamination.n_hit(found.exact), decontamination.item_names(found.exact), "n_near", "exact").collect()
    assert Counter((r[0], r[1], r[2], ",".join(r[3])) for r in got) == want
    assert all(r.n_near >= len({x.start for x in r.exact}) for r in got)
    assert decontamination.matches(docs, items.limit(0)).where("size(exact) > 0").count() == 0


def test_toxicity(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefg"), 5)) for _ in range(300)]
    made = []
    for k in range(400):
        text, bad = list(rng.choice(words, int(rng.integers(5, 200)))), k % 4 == 0
        if bad:
            text.insert(int(rng.integers(len(text))), ["moronic", "idiot"][k % 8 // 4])
        made.append((" ".join(text), int(bad)))
    model = toxicity.fit([t for t, _ in made], [y for _, y in made])
    got = [r.score for r in toxicity.score(spark.createDataFrame([(None,), ("",), ("abc idiots",), ("x " * 20_000 + "moronics",), ("abcde fgabc",)], "text string").coalesce(1), model).collect()]
    assert got[0] == got[1] == 0 and got[2] > 0.5 and got[3] > 0.5 and got[4] < 0.5
    assert toxicity.fit(["a"], [1]).bias < -50 and toxicity.fit([], []).bias < -50
    # trained in a task: the same model; labels of no document, null labels and repeated ids
    docs = spark.createDataFrame([(k, t, "clash") for k, (t, _) in enumerate(made)] + [(0, made[0][0], "clash"), (None, "x", "clash")], "doc_id long, text string, y string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(made)] + [(10**6, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    sample = toxicity.sample_labelled(docs, labels)
    assert sample.count() == len(made) + 1
    rows = sample.collect()
    trained, here = toxicity.train(sample), toxicity.fit([r.text for r in rows], [r.y for r in rows])
    assert np.allclose(np.sort(trained.table), np.sort(here.table), atol=1e-3) and abs(trained.bias - here.bias) < 1e-3
    assert toxicity.train(sample.limit(0)).bias < -50


def test_lines(spark, docs, rows, empty):
    texts = [(1, "the quick brown fox jumps over the lazy dog and then runs far away from all of the other animals in the deep dark forest today"), ]
    near = texts[0][1].replace("lazy", "lazi")
    more = spark.createDataFrame([*texts, (2, "other\n" + near + "\n \nother"), (3, None), (4, "no spaces" * 0 + "z" * 30_000), (5, "z" * 30_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(more).collect()}
    assert got[2].text == "other\n " and got[2].n_removed == 2 and got[3].text is None and got[5].text == "" and got[4].n_removed == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    # whole table against all pairs
    by_id = {i: t for i, t in rows}
    first, keep = {}, {}
    for i, t in sorted(by_id.items(), key=lambda r: (r[0] is None, r[0] or 0)):
        for k, x in enumerate((t or "").split("\n") if t is not None else []):
            if x.strip(" \t\r\x0b\x0c"):
                first.setdefault(x, (i is None, i or 0, k))
    lines = list(first)
    sets = [{x[j:j + 9] for j in range(len(x) - 8)} if len(x) >= 9 else {x} for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    seen = defaultdict(list)
    for n, s in enumerate(sets):
        for o, c in Counter(o for x in s for o in seen[x]).items():
            if c >= 0.8 * (len(s) + len(sets[o]) - c):
                root[find(n)] = find(o)
        for x in s:
            seen[x].append(n)
    for n, x in enumerate(lines):
        keep[find(n)] = min(keep.get(find(n), (True, 1 << 60, 0)), first[x])
    places = set(keep.values())
    for r in line_dedup.dedup_lines(docs).collect():
        t = by_id[r.doc_id]
        assert r.text == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not x.strip(" \t\r\x0b\x0c") or (r.doc_id is None, r.doc_id or 0, k) in places))


def test_lines_of_large_groups(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(424)]
    made = []
    for k in range(420):
        free = list(rng.choice(words[24:], 8))
        line = words[:8] + free[:3] + words[8:16] + free[3:6] + words[16:24] + free[6:]
        made.append(" ".join(line))
        if k < 120:       # a near copy: one or two free words changed
            for at in rng.choice([8, 9, 19, 20, 30, 31], 1 + k % 2, replace=False):
                line[at] = line[at][:-1] + "#"
            made.append(" ".join(line))
    made = [made[i] for i in rng.permutation(len(made))]
    sets = [{x[j:j + 9] for j in range(len(x) - 8)} for x in made]
    root = list(range(len(made)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b, y in enumerate(sets):
        for a, x in enumerate(sets[:b]):
            if (c := len(x & y)) >= 0.8 * (len(x) + len(y) - c) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {k for k in range(len(made)) if find(k) == k}
    assert len(made) - len(want) > 100
    got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))
    assert {r.doc_id for r in got.where("n_removed = 0").collect()} == want
    # long posting lists in parts
    assert line_dedup.LIST_PART > 3
    line_dedup.LIST_PART, kept = 3, line_dedup.LIST_PART
    try:
        got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))
        assert {r.doc_id for r in got.where("n_removed = 0").collect()} == want
    finally:
        line_dedup.LIST_PART = kept


def test_lists_of_lines_left_apart(spark):
    from fractions import Fraction

    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7))
    common = [word() for _ in range(12)]
    made = []
    for k in range(60):
        own = [word() for _ in range(14)]
        # a phrase that a third of the lines have in the middle
        line = own[:7] + (common[4 * (k % 3):4 * (k % 3) + 4]) + own[7:]
        made.append(" ".join(line))
        if k < 12:
            made.append(" ".join([*line[:-1], word()]))
    sets = [{x[j:j + 9] for j in range(len(x) - 8)} for x in made]
    similar = {(a, b) for a in range(len(made)) for b in range(a + 1, len(made)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    texts = spark.createDataFrame(list(enumerate(made)), "line_id long, line string")
    marks, ratio = line_dedup._marks(texts), Fraction("0.8")
    for linked in (set(), set(list(sorted(similar))[:5])):
        links = spark.createDataFrame(sorted(linked), "a long, b long")
        found = {(r.a, r.b) for r in line_dedup._apart_in_lists(texts, marks, links, ratio).collect()}
        # every similar pair that is apart, and none for the phrase alone
        assert found == similar - linked and len(similar) == 12
    # shingles that one component has alone are in no list: only the phrase is left, which is beyond the prefix
    listed = line_dedup._posted_prefixes(texts, marks, components.connected_components(spark.createDataFrame(sorted(similar), "a long, b long")), ratio)
    assert listed.count() == 0


def test_lines_alone_are_left_out_of_the_lists(spark, monkeypatch):
    from fractions import Fraction

    from pyspark.sql import functions as F

    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7))
    phrase = [word() for _ in range(4)]
    own = [word() for _ in range(14)]
    # lines that share only a phrase, and two similar ones, also in characters of two, three and four bytes
    made = [" ".join([*phrase, *[word() for _ in range(14)]]) for _ in range(30)] + [" ".join([*phrase, *own]), " ".join([*phrase, *own[:-1], "é€𝄞"])]
    texts = spark.createDataFrame(list(enumerate(made)), "line_id long, line string")
    assert {r.line_id: r.g for r in texts.select("line_id", F.size(line_dedup._grams(F.col("line"))).alias("g")).collect()} == {k: len(x) - 8 for k, x in enumerate(made)}
    tables, plain = {}, line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: tables.setdefault(name, plain(df, name)))
    none = spark.createDataFrame([], "a long, b long")
    found = line_dedup._apart_in_lists(texts, line_dedup._marks(texts), none, Fraction("0.8")).collect()
    assert {(r.a, r.b) for r in found} == {(30, 31)}
    assert {r.line_id for r in tables["line-listed"].collect()} == {30, 31}


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs, path).collect()
    want = Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t in rows)
    whole = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got if r.doc_tokens == r.length)
    assert whole == Counter({k: n for k, n in want.items() if len(k[1]) <= 4096})
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    assert sum(r.length for r in got) == sum(len(k[1]) * n for k, n in want.items())
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 4096
    assert sorted(seqs) == list(range(len(seqs))) and packing.pack(empty, path).count() == 0


def test_special_strings_leave_other_rows_alone(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    # one batch of over 2 MB: the unit table is built over larger blocks than the lookup's
    texts = [f"zyxq{k}. don't {k}a'b{k} (x)" + " pad" * 60 for k in range(9_500)]
    texts[-1] = "a.b<|endoftext|>c.d <|ENDOFTEXT|><|startoftext|>'s <|endof"
    texts.append("text|> e.f")
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), path).collect()
    want = [[*e.ids, 2] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == dict(enumerate(want))
    data = np.frombuffer("".join(texts[-2:]).encode(), np.uint8)
    at = len(texts[-2].encode())
    alone = packing.unit_spans(data[:at], np.array([0, at]), (b"<|endoftext|>",))[0]
    both = packing.unit_spans(data, np.array([0, at, len(data)]), (b"<|endoftext|>",))[0]
    assert both[both < at].tolist() == alone.tolist()


def test_plan_is_tight_and_whole():
    rng = np.random.default_rng(2)
    hist = Counter(np.minimum(rng.geometric(1 / 700, 40_000), 4095).tolist())
    runs = packing.plan(dict(hist))
    used = Counter()
    for parts, times in runs:
        assert sum(parts) <= 4096 and times > 0
        for p in parts:
            used[p] += times
    assert used == hist
    assert sum(k * c for k, c in hist.items()) / (4096 * sum(t for _, t in runs)) > 0.995


def test_suffix_arrays(monkeypatch):
    rng = np.random.default_rng(1)
    for few in (0, 48, 10**9):
        monkeypatch.setattr(suffix_arrays, "_FEW", few)
        for k in range(60):
            s = rng.integers(1, 1 + int(rng.integers(1, 6)), int(rng.integers(1, 120)))
            s = np.append(np.tile(s[:5], 20)[:len(s)] if k % 3 == 0 else s, 0)
            assert suffix_arrays.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_suffix_dedup(spark, docs, rows, empty):
    base = [t for _, t in rows[:3]]
    more = [(8000, base[0][:250] + base[1][30:400] + base[0][100:300]), (8001, "xyz " * 60 + base[2][:200] + "xyz " * 60), (8002, base[2]), (8003, "\0" * 300)]
    table = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    every = {(i, t or "") for i, t in rows + more}      # rows that repeat id and text are one document
    seen, want = set(), {}
    for i, t in sorted(every, key=lambda r: (r[0] is None, r[0] or 0)):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want[i, hashlib.sha256(b).hexdigest() if i == 9007 else None] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    for r in suffix_dedup.remove_repeats(table, with_text=False).collect():
        assert tuple(r)[1:] == want[r.doc_id, r.kept_sha256 if r.doc_id == 9007 else None], r.doc_id
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_simhash(docs, rows, empty):
    got = simhash.simhash_groups(docs).collect()
    fps = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", _low(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 4]).encode(), 42) for k in range(max(1, len(w) - 3) if w else 0)]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert all(r.fingerprint == f"{fps[r.doc_id]:016x}" for r in got) and len(got) == len(rows)
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i in fps:
        least[find(i)].append(i)
    assert all(r.component_id == min((i for i in least[find(r.doc_id)] if i is not None), default=None) for r in got)
    assert simhash.simhash_groups(empty).count() == 0


def test_position_sets_meet_all_pairs():
    from itertools import combinations

    sets = simhash.position_sets(4)
    assert len(sets) == 20 and all(any(set(s) <= set(c) for s in sets) for c in combinations(range(8), 4))


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, 2), (3, 3), (5, None), (7, 2), (200, 100)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, 200: 100, 1: 1, 2: 1, 7: 1}


def test_components_need_no_round_on_stars(spark, monkeypatch):
    rounds, plain = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: (rounds.append(name), plain(df, name))[1])
    stars = [(1, 5), (9, 1), (1, 7), (2, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame([(max(e), min(e)) for e in stars], "a long, b long")).collect()}
    assert got == {1: 1, 5: 1, 9: 1, 7: 1, 2: 2, 3: 2} and len(rounds) == 1
    # not stars yet: an upward edge, a chain, two lower ends
    for edges in ([(2, 3)], [(3, 2), (2, 1)], [(3, 1), (3, 2)]):
        rounds.clear()
        got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: min(map(min, edges)) for e in edges for x in e} and len(rounds) > 1


def test_urls(spark):
    t = spark.createDataFrame([(1, None, "x"), (2, "no scheme", "x"), (3, "HTTP://WWW.Example.COM/en/1?q", "x"), (4, "http://example.com/en/1", "x"), (5, "http://a.b.net/es/#x", "x"),
                               (6, "http://net/fr/", "x"), (7, "http://xcom/", "x"), (8, "http://a.com", "x"), (8, "http://a.com/EN", "x"), (9, "http://", "x")], "page_id int, url string, key string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(t, queries.URL_RULES).collect())
    assert got == Counter([(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (4, "example.com", "/en/1", "example.com/en/", "block"),
                           (5, "a.b.net", "/es/", "net/es/", "block"), (6, "net", "/fr/", "net/fr/", "block"), (7, "xcom", "/", None, "allow"), (8, "a.com", "", None, "allow"),
                           (8, "a.com", "/EN", "com/", "allow"), (9, "", "", None, "allow")])
    assert url_filter.judge(t, []).where("rule is not null").count() == 0


def test_cascade_is_exact(spark):
    from pyspark.sql import functions as F

    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    c = url_filter.Cascade(keys, F.col("listed"))
    assert len(c.levels) > 2 and keys.where(c.contains(F.col("key")) != F.col("listed")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert Counter(map(tuple, got.select(*cols).collect())) == Counter(cur.fetchall())


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
            docs = out.cache()
            sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0 and sizes[0] == sizes[1]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}

"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontamination, embedding_dedup, fingerprints, html_text, kneser_ney, line_dedup, packing, prefix_trie, simhash, suffix_dedup, token_alignment, toxicity, url_filter
from eventide.llm.common import crc_mod, read

# (host, path, action)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, with their likeness to an edited text and to the next document."""
    return fingerprints.edit_likeness(read(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney log probabilities of all documents; rows with crc32(doc_id) mod 10 = 0 are held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod("doc_id", 10) == 0).alias("held_out"))
    model = kneser_ney.train(docs.where("not held_out"))
    return kneser_ney.score(docs, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a 10-word window of a benchmark item covers."""
    found = decontamination.matches(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"), near=None)
    names = decontamination.item_names(F.col("exact"))
    return (found.select("doc_id", "n_words", decontamination.n_hit(F.col("exact")).alias("n_hit"), names.alias("names"))
            .select("doc_id", "n_words", "n_hit", F.size("names").cast("long").alias("n_items"),
                    F.sha2(F.array_join("names", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")))


def _toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Fit on labelled rows with crc32(doc_id) mod 5 <> 0."""
    return toxicity.train(toxicity.sample_labelled(docs.where(crc_mod("doc_id", 5) != 0), read(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows with crc32(doc_id) mod 5 = 0 are held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, _toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines after fuzzy line de-duplication: counts, length and digest of what is kept."""
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents' token ids in sequences of at most 4096 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document after repeated 100-byte strings are cut."""
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), with_text=False)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the components of links at 4 or fewer bits."""
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of conversation prefixes, with its members, leaves and savings."""
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.95 and components of all embeddings."""
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of a byte-level and a sentencepiece tokenizer over all documents."""
    return token_alignment.align(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_fingerprints, op2_lm_scoring, op3_html_extraction, op4_decontamination, op5_toxicity,
                            op6_line_dedup, op7_packing, op8_suffix_dedup, op9_simhash, op10_url_filter, op11_prefix_trie, op12_embedding_dedup, op13_token_alignment)}

ORACLE: dict[str, str] = {
    "op4_decontamination": r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, list_slice(w, i, i + 9) AS ws, len(list_slice(w, i, i + 9)) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), spot AS (
  SELECT r, size, i, list_slice(w, i, i + size - 1) AS ws
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)
), hit AS (
  SELECT r, item, i, spot.size FROM spot JOIN win ON win.ws = spot.ws AND win.size = spot.size
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hit) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
""",
    "op10_url_filter": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fit AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(action, length(rule_host || rule_path)) AS action
  FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT cut.page_id, cut.host, cut.path, fit.rule, coalesce(fit.action, 'allow') AS verdict
FROM cut LEFT JOIN fit ON fit.page_id = cut.page_id
""",
    "op11_prefix_trie": r"""
WITH turn AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  -- crc32 bit by bit: each byte is mixed in, then eight steps (marked -1) follow
  SELECT c, list(struct_pack(r := role, t := text) ORDER BY i) AS ts,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten([[ascii(substr(c::VARCHAR, k::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR k IN range(1, len(c::VARCHAR) + 1)])),
             lambda v, x: CASE WHEN x >= 0 THEN xor(v, x) ELSE xor(v >> 1, 3988292384::BIGINT * (v & 1)) END), 4294967295::BIGINT) % 6 AS h
  FROM turn GROUP BY c
), made AS (
  SELECT a.c, list_concat(coalesce(list_slice(b.ts, 1, a.h), []), list_slice(a.ts, a.h + 1, len(a.ts))) AS ts
  FROM conv a LEFT JOIN conv b ON b.c = a.c - a.c % 100
), step AS (
  SELECT c, d, list_slice(ts, 1, d) AS path, d = len(ts) AS ends FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM made)
), node AS (
  SELECT path, d AS depth, min(c) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE length(path[d].t) END AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM step GROUP BY path, d
), family AS (
  SELECT node.path, node.depth, p.conv_id AS parent_conv_id, (SELECT count(*) FROM node k WHERE k.depth = node.depth + 1 AND list_slice(k.path, 1, node.depth) = node.path) AS n_children
  FROM node LEFT JOIN node p ON p.depth = node.depth - 1 AND p.path = list_slice(node.path, 1, node.depth - 1)
), tree AS (
  SELECT node.*, family.parent_conv_id, family.n_children FROM node JOIN family ON family.depth = node.depth AND family.path = node.path
)
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
       CAST(sum((b.n_convs - 1) * b.chars) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM tree a JOIN tree b ON b.depth >= a.depth AND list_slice(b.path, 1, a.depth) = a.path
GROUP BY ALL
""",
    "op12_embedding_dedup": r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT r, vec_id, e, len(e) AS dim FROM v
  WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0
), link AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.dim = b.dim AND a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
  SELECT r, r FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
), comp AS (
  SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a
), n AS (
  SELECT a AS r, count(*) AS n FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, comp.component_id, v.vec_id IS NOT DISTINCT FROM comp.component_id AS kept
FROM v JOIN comp USING (r) LEFT JOIN n USING (r)
""",
}

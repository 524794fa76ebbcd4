"""Document utilities described only at the top level of the reference
(D-*): page text extraction and chunking, a portfolio CSV loader, and exact
top-k vector search. All run as column expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Removal patterns applied in order, then entity decoding (&amp; last).
HTML_DROP = [
    r"(?is)<script\b.*?</script>",
    r"(?is)<style\b.*?</style>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]+>",
]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def html_to_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """D-1a: visible text of each page: scripts, styles, comments and tags
    removed (tags become spaces), basic entities decoded, whitespace
    collapsed."""
    t = F.col(html_col)
    for p in HTML_DROP:
        t = F.regexp_replace(t, p, " ")
    for a, b in ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return pages.select("page_id", "url", t.alias("text")).withColumn("n_chars", F.length("text"))


def chunk_text(docs: DataFrame, size: int = 1000, overlap: int = 200, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """D-1b: fixed-size character chunks with overlap covering the whole
    text: chunk i starts at i·(size-overlap); the last chunk ends at the
    text's end. One row per chunk, generated per document (no join)."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    n = F.length(F.col(text_col))
    chunks = F.when(n <= size, F.lit(1)).otherwise(
        F.lit(1) + F.ceil((n - F.lit(size)) / F.lit(step)).cast("int"))
    # the chunks are cut before the rows are made, so that no row carries the whole text
    cut = F.transform(F.sequence(F.lit(0), chunks - 1), lambda i: F.struct(
        i.alias("chunk_no"), (i * step).alias("start"), F.substring(F.col(text_col), i * step + 1, F.lit(size)).alias("chunk")))
    return (docs.select(id_col, F.explode(cut).alias("_c")).select(id_col, "_c.*")
                .withColumn("chunk_chars", F.length("chunk")))


PORTFOLIO_SCHEMA = "ticker string, shares long, price double, date date"


def read_portfolios(spark: SparkSession, path: str) -> DataFrame:
    """D-2: portfolio CSV files (ticker, shares, price, date); the portfolio
    id is the file name without extension, or the ``portfolio_id=`` folder
    of a partitioned write."""
    df = (spark.read.schema(PORTFOLIO_SCHEMA).option("header", True)
               .option("recursiveFileLookup", True).csv(path))
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"portfolio_id=([^/]+)/", 1)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    return df.select(F.when(folder != "", folder).otherwise(name).alias("portfolio_id"), *df.columns)


def portfolio_summary(positions: DataFrame) -> DataFrame:
    """D-2: per portfolio: positions, distinct tickers, market value
    (shares × price), first and last date."""
    return positions.groupBy("portfolio_id").agg(
        F.count(F.lit(1)).alias("positions"), F.countDistinct("ticker").alias("tickers"),
        # decimals: exact sums in any order, for prices of up to six places
        F.sum(F.col("shares").cast("decimal(20,0)") * F.col("price").cast("decimal(18,6)")).cast("double").alias("market_value"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def cosine_top_k(vectors: DataFrame, query: list[float], k: int = 10, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """D-3: exact top-k by cosine similarity to one query vector. The query
    (a fixed-length list) is a literal; scores are built-in higher-order
    expressions; ``orderBy().limit(k)`` keeps a k-row heap per task."""
    q = F.array(*[F.lit(float(x)) for x in query])
    qn = float(sum(x * x for x in query)) ** 0.5
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    norm = F.sqrt(F.aggregate(F.transform(v, lambda a: a * a), F.lit(0.0), lambda acc, x: acc + x))
    score = F.when((norm > 0) & F.lit(qn > 0), dot / (norm * F.lit(qn)))
    rest = [c for c in vectors.columns if c != vec_col]
    return (vectors.select(*rest, score.alias("score"))
                   .orderBy(F.col("score").desc_nulls_last(), F.col(id_col)).limit(k)
                   .withColumn("score", F.round("score", 6)))


class VectorIndex:
    """D-3 at scale: a stored index of random-projection buckets (``pyspark.ml``), beside the exact scan.

    Every vector has ``tables`` keys, each of ``hashes`` bucketed projections of its unit vector. A search
    meets the vectors that share a key with a query and ranks them by exact cosine. What is far from every
    query is never read with its vector; what is near is missed with a probability that falls with
    ``tables`` (a test measures the recall). All rows are indexed.
    """

    def __init__(self, spark: SparkSession, path: str, id_col: str = "vec_id", vec_col: str = "embedding"):
        self.spark, self.path, self.id_col, self.vec_col = spark, path, id_col, vec_col

    def _unit(self, df: DataFrame) -> DataFrame:
        """(id, unit vector) of the vectors that have a direction."""
        v = F.transform(F.col(self.vec_col), lambda x: x.cast("double"))
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
        return (df.select(self.id_col, v.alias("_v"), norm.alias("_n")).where(F.col("_n") > 0)
                  .select(self.id_col, F.transform("_v", lambda x: x / F.col("_n")).alias("unit")))

    def _keys(self, model, df: DataFrame, tables: int, hashes: int) -> DataFrame:
        """(id, table, key) rows: each key is the buckets of its ``hashes`` projections."""
        from pyspark.ml.functions import array_to_vector, vector_to_array
        h = model.transform(df.withColumn("_x", array_to_vector("unit"))).select(
            self.id_col, F.transform("_h", lambda x: x).alias("_h"))
        flat = h.select(self.id_col, F.array(*[vector_to_array(F.col("_h")[k])[0] for k in range(tables * hashes)]).alias("_b"))
        keys = F.array(*[F.xxhash64(F.lit(t), F.slice("_b", t * hashes + 1, hashes)) for t in range(tables)])
        return flat.select(self.id_col, F.explode(keys).alias("key"))

    def build(self, vectors: DataFrame, tables: int = 24, hashes: int = 6, width: float = 0.12, seed: int = 7) -> None:
        """Index all vectors. ``width`` is a bucket's length on a projection; unit vectors of d dimensions
        at distance r stand about r / sqrt(d) apart there."""
        import json

        from pyspark.ml.feature import BucketedRandomProjectionLSH
        from pyspark.ml.functions import array_to_vector
        unit = self._unit(vectors)
        unit.write.mode("overwrite").parquet(f"{self.path}/vectors")
        unit = self.spark.read.parquet(f"{self.path}/vectors")
        lsh = BucketedRandomProjectionLSH(inputCol="_x", outputCol="_h", numHashTables=tables * hashes, bucketLength=width, seed=seed)
        model = lsh.fit(unit.limit(1).withColumn("_x", array_to_vector("unit")))         # it only asks for the dimension
        model.write().overwrite().save(f"{self.path}/model")
        self._keys(model, unit, tables, hashes).write.mode("overwrite").parquet(f"{self.path}/keys")
        self.spark.createDataFrame([(json.dumps([tables, hashes]),)], "shape string").coalesce(1).write.mode("overwrite").text(f"{self.path}/shape")

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        """(query_id, id, score, rank) of up to ``k`` vectors per query row, by exact cosine among the
        candidates. A query is not its own neighbour."""
        import json

        from pyspark.ml.feature import BucketedRandomProjectionLSHModel
        from pyspark.sql import Window
        tables, hashes = json.loads(self.spark.read.text(f"{self.path}/shape").first()[0])
        model = BucketedRandomProjectionLSHModel.load(f"{self.path}/model")
        q = self._unit(queries)
        asked = self._keys(model, q, tables, hashes).withColumnRenamed(self.id_col, "query_id")
        found = (self.spark.read.parquet(f"{self.path}/keys").join(asked, "key").where(F.col(self.id_col) != F.col("query_id"))
                 .select("query_id", self.id_col).distinct())
        both = (found.join(self.spark.read.parquet(f"{self.path}/vectors"), self.id_col)
                     .join(q.select(F.col(self.id_col).alias("query_id"), F.col("unit").alias("_q")), "query_id"))
        score = F.aggregate(F.zip_with("unit", "_q", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(self.id_col))
        return (both.select("query_id", self.id_col, score.alias("score")).withColumn("rank", F.row_number().over(w))
                    .where(F.col("rank") <= k).withColumn("score", F.round("score", 6)))


# ----------------------------------------------------------------- D-4
SHINGLE_WORDS = 8
KEYWORD_MIN_CHARS = 6
PUNCTUATION = r"""[.,;:!?()"']"""


def words(text):
    """Whitespace tokens of the whole text (case kept, empties dropped)."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def shingles(df: DataFrame, id_col: str, text_col: str = "text", n: int = SHINGLE_WORDS,
             distinct: bool = True) -> DataFrame:
    """n-word shingles of every text, one row each (the whole text, every
    window); distinct per text unless ``distinct`` is off."""
    # the token array is projected once per row; the lambda then slices the
    # column instead of re-tokenizing the text for every window
    tok = df.select(id_col, words(F.col(text_col)).alias("_w"))
    w = F.col("_w")
    starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(
        F.array().cast("array<int>"))
    sh = F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))
    out = tok.select(id_col, F.explode(sh).alias("shingle"))
    return out.distinct() if distinct else out


def passage_top_k(queries: DataFrame, docs: DataFrame, k: int = 3, query_id: str = "item_id",
                  doc_id: str = "doc_id") -> DataFrame:
    """D-4 retrieval: documents sharing the most shingles with each query
    text; exact (no candidate cap). The corpus keeps only shingles that some
    query has (a semi join; runtime sizes decide how), and meets the queries
    in the salted split join, as boilerplate shingles shared by many documents
    are hot keys; ``row_number() <= k`` keeps a partial top-k per task."""
    from pyspark.sql import Window

    from ..functions.skew import split_join
    qs = shingles(queries, query_id)
    found = shingles(docs, doc_id, distinct=False).join(qs.select("shingle").distinct(), "shingle", "left_semi").distinct()
    pairs = split_join(found, qs, ["shingle"], how="inner")
    scores = pairs.groupBy(query_id, doc_id).agg(F.count(F.lit(1)).alias("shared_shingles"))
    w = Window.partitionBy(query_id).orderBy(F.col("shared_shingles").desc(), F.col(doc_id))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def keyword_recall_at_k(queries: DataFrame, docs: DataFrame, k: int = 3, query_id: str = "item_id",
                        doc_id: str = "doc_id") -> DataFrame:
    """D-4: per query, the share of its expected keywords (distinct words of
    at least 6 characters, punctuation stripped) present anywhere in the
    full text of its top-k retrieved documents."""
    kw = (queries.select(query_id, F.explode(words(F.col("text"))).alias("w"))  # one tokenization per row
                 .select(query_id, F.regexp_replace("w", PUNCTUATION, "").alias("keyword"))
                 .where(F.length("keyword") >= KEYWORD_MIN_CHARS).distinct())
    top = passage_top_k(queries, docs, k, query_id, doc_id)
    retrieved = top.join(docs.select(doc_id, F.col("text").alias("_doc_text")), doc_id)
    hits = (kw.join(retrieved, query_id, "left")
              .groupBy(query_id, "keyword")
              .agg(F.max(F.coalesce(F.col("_doc_text").contains(F.col("keyword")), F.lit(False)).cast("int"))
                   .alias("found")))
    per = hits.groupBy(query_id).agg(F.count(F.lit(1)).alias("keywords"),
                                     F.sum("found").cast("long").alias("found"))
    n = top.groupBy(query_id).agg(F.count(F.lit(1)).alias("retrieved"))
    return (per.join(n, query_id, "left")
               .select(query_id, "keywords", "found", F.coalesce("retrieved", F.lit(0).cast("long")).alias("retrieved"),
                       F.round(F.col("found").cast("double") / F.col("keywords"), 4).alias("recall_at_k")))

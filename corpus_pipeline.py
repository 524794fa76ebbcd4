"""A training corpus from raw documents: drop toxic ones, repeated lines, near copies and benchmark leaks, then pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes each result as Parquet in
the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontamination, line_dedup, packing, simhash, toxicity
from eventide.llm.common import crc_mod, read, scratch
from eventide.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fit on labelled rows with crc32(doc_id) mod 5 <> 0, scores below 0.5."""
    model = toxicity.train(toxicity.sample_labelled(docs.where(crc_mod("doc_id", 5) != 0), read(spark, sf_dir, "labels")))
    return toxicity.score(docs, model, name="toxicity_").where("toxicity_ < 0.5").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with one line of each group of similar lines left in the whole corpus; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of SimHash links."""
    kept = simhash.simhash_groups(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("kept_")).distinct()
    return docs.join(kept, docs.doc_id.eqNullSafe(kept.kept_), "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    found = decontamination.matches(docs, read(spark, sf_dir, "benchmark"), near=None)
    return found.where(F.size("exact") == 0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most 4096."""
    return packing.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Training, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch(spark, f"stage-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

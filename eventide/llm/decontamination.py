"""Benchmark decontamination with a distributed positional inverted index.

Postings are (word, document, position), made by exploding the documents and
kept for the words that the windows of the benchmark ask for. A window is
looked up from its rarest word (by the corpus's own counts): each posting,
shifted by the word's place in the window, is a candidate start. Candidates
are then intersected with the positions of the window's other words in that
document: all at their places is an exact match, at least ``near`` of the
distinct words within ``slop`` words around is a proximity match. Document
text moves once, to meet its own candidates; the windows are broadcast only
below a checked size, else joined by shuffle.

Word positions come from a cheap full lower-casing for the candidates; exact
matches are verified on the words with only A-Z lower-cased.

Defined cases: null texts have no words; items without words have no window;
items of fewer words than a window are one window; repeated windows and items
count once an item id; rows that repeat a document id are judged each on their
own text; null ids are documents like others. Empty tables give no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import let, stored

WINDOW = 10
NEAR = 8            # distinct words of a window that a proximity match has at least
SLOP = 2            # words around the window that it may use
BROADCAST_BYTES = 64 << 20
# the fixed pattern of a word after lower-casing; before it, A-Z are word characters too
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """Words in their own case, in order; no words for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD_ANY_CASE), F.lit(0)), F.array().cast("array<string>"))


def _small(df: DataFrame, n_bytes: int) -> DataFrame:
    return F.broadcast(df) if n_bytes <= BROADCAST_BYTES else df


def windows_of(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows (win, words, items): ``size`` consecutive words, or all of a shorter item."""
    w = items.select(F.col(id_col).cast("string").alias("item"), F.transform(_words(F.col(text_col)), lambda x: F.translate(x, _UPPER, _LOWER)).alias("w")).where("size(w) > 0")
    each = w.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))), lambda i: F.slice("w", i, size))).alias("words"))
    # a null id is an item like others, without a name
    return each.groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("win", F.monotonically_increasing_id())


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, near: int | None = NEAR, slop: int = SLOP, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each document with its words' number and its matches.

    Adds n_words, ``exact`` (array of start, end, items: words [start, end) are
    an item's window) and n_near (starts of proximity matches, exact ones too;
    0 if ``near`` is None, which leaves them out).
    """
    wins = stored(windows_of(items, size, item_col, item_text), "windows")
    n_bytes = int(wins.agg(F.coalesce(F.sum(F.octet_length(F.array_join("words", " ")) + 64), F.lit(0))).first()[0])
    asked = wins.select(F.explode("words").alias("word")).select(F.lower("word").alias("word")).distinct()
    tokens = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD), F.lit(0))).alias("t"))
    counts = tokens.join(_small(asked, n_bytes), F.col("t") == F.col("word"), "left_semi").groupBy("t").agg(F.count(F.lit(1)).alias("c"))
    # the rarest word of each window and its place; words that no document has make no candidate
    rarest = (wins.select("win", F.posexplode("words").alias("place", "w")).withColumn("w", F.lower("w"))
              .join(counts, F.col("w") == F.col("t"), "left").groupBy("win")
              .agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "place", "w")).alias("r")).where("r.c > 0")
              .select("win", F.col("r.place").alias("place"), F.col("r.w").alias("w")))
    look = stored(wins.join(rarest, "win"), "rarest")
    postings = docs.select(F.col(id_col).alias("doc"), F.posexplode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD), F.lit(0))).alias("pos", "t"))
    asked_for = look.select("w", "win", "place")
    starts = (postings.join(_small(asked_for, n_bytes), F.col("t") == F.col("w")).where("pos >= place")
              .select("doc", (F.col("pos") - F.col("place")).alias("start"), "win"))
    found = starts.join(_small(look.select("win", "words", "items"), n_bytes), "win")
    per_doc = found.groupBy("doc").agg(F.collect_list(F.struct("start", "words", "items")).alias("cand"))
    at = docs.join(per_doc, docs[id_col].eqNullSafe(per_doc.doc), "left").drop("doc")
    none = F.array().cast("array<struct<start:int,end:int,items:array<string>>>")

    def judged(w: Column) -> Column:
        """Words, exact matches and proximity matches of a document with words ``w``."""

        def is_exact(c: Column) -> Column:
            return F.translate(F.array_join(F.slice(w, c["start"] + 1, F.size(c["words"])), " "), _UPPER, _LOWER) == F.array_join(c["words"], " ")

        def is_near(c: Column) -> Column:
            lo = F.greatest(c["start"] + 1 - slop, F.lit(1))
            around = F.transform(F.slice(w, lo, c["start"] + 1 + F.size(c["words"]) + slop - lo), lambda x: F.lower(x))
            return F.size(F.array_intersect(c["words"], around)) >= F.least(F.lit(near), F.size(F.array_distinct(c["words"])))

        exact = F.transform(F.filter("cand", is_exact), lambda c: F.struct(c["start"].alias("start"), (c["start"] + F.size(c["words"])).alias("end"), c["items"].alias("items")))
        close = F.lit(None) if near is None else F.size(F.array_distinct(F.transform(F.filter("cand", is_near), lambda c: c["start"])))
        return F.struct(F.size(w).cast("long").alias("n_words"), F.coalesce(exact, none).alias("exact"), F.coalesce(close, F.lit(0)).cast("long").alias("n_near"))

    return (at.withColumn("judged", let(_words(F.col(text_col)), judged))
            .select(*docs.columns, "judged.n_words", "judged.exact", "judged.n_near"))


def n_hit(exact: Column) -> Column:
    """Words inside any match: the union of the spans."""
    spans = F.array_sort(F.array_distinct(F.transform(exact, lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e")))))
    empty = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n"))
    return F.aggregate(spans, empty, lambda a, x: F.struct(
        F.greatest(a["reach"], x["e"]).alias("reach"),
        (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["reach"]), F.lit(0))).alias("n")))["n"].cast("long")


def item_names(exact: Column) -> Column:
    """Distinct item ids with a match, sorted as strings."""
    return F.sort_array(F.array_distinct(F.flatten(F.transform(exact, lambda x: x["items"]))))

"""Fuzzy line de-duplication by MinHash over character shingles.

Equal lines are one line first. A line's signature is taken over hashed
character shingles that start at its words (for lines of few words: at every
character; lines in between have both). One hash per shingle serves for all
permutations: permutation j orders the hashes with their high four bits
xor-ed by j, so the least hash of each of the sixteen bins is all a signature
needs. Two permutations make a band. Lines that share a band are sorted by
their other bands; each is paired with the ones just before it and with the
band's first, so a band's pairs grow with its lines, not with their square.
That is every pair of a small band. The lines of a larger one are grouped again
by each set of two bands they share, those of still large groups by three bands
and so on, so a line is in a bounded number of groups. Lines of large groups that
these links leave in different components are then met exactly: two similar
lines share one of the first fifth of their shingles in any fixed order of all
shingles, so the pairs of those posting lists hold every similar pair of them.
The order here is that of the number of lines, after shingles that only lines
of one component have, which need no list; the first shared shingle must
have enough shingles after it in both; and lines that have too few shingles in
common with other components are left out before. Long lists are split over tasks by both
lines. Pairs are verified by the exact Jaccard similarity of all
their character shingles, after two bounds that no similar pair can miss: their
numbers of shingles, and the classes of hashes that hold an odd number in one
line and an even one in the other. Verified links go through distributed connected
components, and the first line (by document id, then place) of each component
stays. Blank lines are never removed.

All of it is DataFrame functions. Lines are told apart by a 64-bit hash.

Defined cases: null texts stay null and have no lines; null ids come after
all others; rows that repeat a document id count as one document (the same
places stay in each); lines shorter than a shingle are compared whole; ties
cannot arise, as places differ; an empty table gives no rows.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import let, stored
from eventide.llm.components import connected_components

SHINGLE = 9           # characters of a shingle that similarity is defined on
WORD_SHINGLE = 16     # characters of a shingle at a word's start, for signatures
BANDS = 6             # of two permutations each
FEW, MANY = 6, 10     # words: below FEW all places, above MANY word starts, both between
SIMILAR = 0.8
BEFORE = 3            # lines of a band that each line is compared with, beside the first
DEEPER = 8            # the same in groups of lines that share several bands
PARITY_WORDS = 8      # of 64 classes of shingle hashes each
LIST_PART = 1000      # lines of a posting list that meet in one task


def _least_of_bins(hashes: Column) -> Column:
    """The least hash of each value of the high four bits."""
    return let(F.sort_array(hashes), lambda s: F.filter(s, lambda h, i: (i == 0) | (F.shiftright(h, 60) != F.shiftright(F.get(s, i - 1), 60))))


def _bands(bins: Column, salt: int) -> Column:
    def least(j: int) -> Column:
        order = F.lit(j << 60 if j < 8 else (j << 60) - (1 << 64))
        return F.array_min(F.transform(bins, lambda h: h.bitwiseXOR(order)))

    sig = [least(j) for j in range(2 * BANDS)]
    return F.array(*[F.xxhash64(F.lit(salt + b), sig[2 * b], sig[2 * b + 1]) for b in range(BANDS)])


def _shingles(line: Column, n: int = SHINGLE) -> Column:
    """Hashes of all character shingles, or of the line if it is shorter."""
    whole = F.when(F.char_length(line) < n, F.array(line)).otherwise(F.regexp_extract_all(line, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))
    return F.transform(whole, lambda x: F.xxhash64(x))


def _grams(line: Column) -> Column:
    """Hashes of all character shingles, or of the line if it is shorter; cut from four bytes a character, not by an expression."""
    size = 4 * SHINGLE
    return let(F.encode(line, "UTF-32"), lambda b: F.transform(
        F.sequence(F.lit(1), F.greatest(F.octet_length(b) - size + 1, F.lit(1)), F.lit(4)), lambda i: F.xxhash64(F.substring(b, i, F.lit(size)))))


def _blank(line: Column) -> Column:
    return F.ltrim(line, F.lit(" \t\n\x0b\f\r")) == ""


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, place, line) of every line that is not blank."""
    # the outer forms here and below: the others add a filter on the array's size, which makes the array a second time
    return (docs.select(F.col(id_col).alias("doc"), F.posexplode_outer(F.split(F.col(text_col), "\n")).alias("place", "line"))
            .where(~_blank(F.col("line"))))


def _after() -> Column:
    """The band that follows place ``at`` in a line's bands, for lines of a group to be sorted by."""
    return F.get("bands", F.pmod(F.col("at") + 1, F.size("bands")))


def _met(posted: DataFrame, before: int, name: str) -> DataFrame:
    """Rows of the groups of two or more lines, with the group's size ``n`` and ``near``: the ``before`` lines before each and the group's first."""
    sizes = posted.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    by = Window.partitionBy("band").orderBy("next", "line_id")
    near = F.array(*[F.lag("line_id", i).over(by) for i in range(1, before + 1)], F.first("line_id").over(by))
    met = posted.join(sizes, "band").withColumn("near", F.array_except(near, F.array("line_id"))).drop("next")
    # the others are done with
    return stored(met.withColumns({c: F.when(F.col("n") > before + 1, F.col(c)) for c in ("at", "band", "bands") if c in met.columns}), name)


def _pairs(met: DataFrame) -> DataFrame:
    """(a, b) of each group's lines with those of ``near``."""
    return (met.select("line_id", F.explode("near").alias("o")).where("o is not null")
            .select(F.least("line_id", "o").alias("a"), F.greatest("line_id", "o").alias("b")))


def _marks(texts: DataFrame) -> DataFrame:
    """(line_id, n, parity): the number of distinct shingles, and of each of 512 classes of hashes whether it holds an odd number of them."""
    words = (texts.select("line_id", F.explode_outer(F.array_distinct(_grams(F.col("line")))).alias("h"))
             .groupBy("line_id", F.shiftrightunsigned("h", 61).cast("int").alias("k"))
             .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("w")))
    word = [F.coalesce(F.max(F.when(F.col("k") == k, F.col("w"))), F.lit(0).cast("long")) for k in range(PARITY_WORDS)]
    return words.groupBy("line_id").agg(F.sum("n").alias("n"), F.array(*word).alias("parity"))


def _unlike(x: Column, y: Column) -> Column:
    """Classes of unlike parity: each holds a shingle that only one of the two lines has."""
    return reduce(Column.__add__, [F.bit_count(F.get(x, k).bitwiseXOR(F.get(y, k))) for k in range(PARITY_WORDS)])


def _between(rooted: DataFrame) -> DataFrame:
    """(line_id, h, c): the shingles that lines of several components have, and how many lines."""
    # half of the hash, as the exchanges hold all shingles: those that fall together only make a list longer
    hashes = F.transform(F.array_distinct(_grams(F.col("line"))), lambda h: F.shiftright(h, 32).cast("int"))
    # a line without links is its own root
    posted, of, root = rooted.select("line_id", "root", F.explode_outer(hashes).alias("h")), Window.partitionBy("h"), F.coalesce("root", "line_id")
    return (posted.select("line_id", "h", F.count(F.lit(1)).over(of).alias("c"), F.min(root).over(of).alias("r0"), F.max(root).over(of).alias("r1"))
            .where("r0 <> r1").select("line_id", "h", "c"))


def _posted_prefixes(texts: DataFrame, marks: DataFrame, roots: DataFrame, ratio: Fraction) -> DataFrame:
    """(line_id, n, root, h, at): the shingles of each line of which similar lines of two components share one, and their places.

    A line has most of its shingles in common with a similar one, so lines with fewer in other components have none
    there and are left out first. The shingles of the others stand in one order for all lines: first those that lines
    of only one component have, which bring no two components together and are not listed, then the rest, those in
    fewer lines first.
    """
    rooted = (texts.join(marks.select("line_id", "n"), "line_id").join(roots, F.col("line_id") == F.col("node"), "left")
              .select("line_id", "n", "line", "root"))
    many = _between(rooted).groupBy("line_id").agg(F.count(F.lit(1)).alias("listed")).join(marks.select("line_id", "n"), "line_id")
    many = stored(many.where(F.col("listed") * ratio.denominator >= F.col("n") * ratio.numerator).select("line_id"), "line-listed")
    rooted = rooted.join(many, "line_id", "left_semi")
    # one exchange on the shingle counts its lines, one on the line sorts its shingles
    mine = Window.partitionBy("line_id")
    listed = (_between(rooted).select("line_id", "h", F.row_number().over(mine.orderBy("c", "h")).alias("k"), F.count(F.lit(1)).over(mine).alias("listed"))
              .join(rooted.select("line_id", "n", F.coalesce("root", "line_id").alias("root")), "line_id").withColumn("at", F.col("n") - F.col("listed") + F.col("k") - 1))
    # the first n - ceil(ratio * n) + 1
    return listed.where(F.col("at") <= F.floor(F.col("n") * (ratio.denominator - ratio.numerator) / ratio.denominator)).select("line_id", "n", "root", "h", "at")


def _apart_in_lists(texts: DataFrame, marks: DataFrame, links: DataFrame, ratio: Fraction, roots: DataFrame | None = None) -> DataFrame:
    """(a, b): every pair of lines in different components of ``links`` that can be similar, by shared rare shingles, their places and sizes."""
    posted = stored(_posted_prefixes(texts, marks, connected_components(links) if roots is None else roots, ratio), "line-prefixes")
    lists = posted.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
    met = (posted.join(lists.select("h", F.ceil(F.col("c") / LIST_PART).cast("int").alias("parts")), "h")
           .withColumn("mine", F.pmod(F.xxhash64("line_id"), F.col("parts")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    x = met.select("h", F.col("mine").alias("p"), F.col("other").alias("q"), F.col("line_id").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"), F.col("at").alias("ia"))
    y = met.select("h", F.col("other").alias("p"), F.col("mine").alias("q"), F.col("line_id").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"), F.col("at").alias("ib"))
    # the first shingle that similar lines share has enough shingles after it in both
    enough = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) * (ratio.denominator + ratio.numerator) >= (F.col("na") + F.col("nb")) * ratio.numerator
    return (x.join(y, ["h", "p", "q"]).where("a < b and ra <> rb")
            .where(F.least("na", "nb") * ratio.denominator >= F.greatest("na", "nb") * ratio.numerator).where(enough).select("a", "b").distinct())


def similar_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(first occurrences: line_id, doc, place; links: verified pairs a, b of similar lines, enough of them to connect each component)."""
    lines = lines_of(docs, id_col, text_col).withColumn("line_id", F.xxhash64("line"))
    order = F.struct(F.col("doc").isNull().alias("n"), "doc", "place")
    # at each word: as many characters from its start on
    at_words = F.transform(F.regexp_extract_all("line", F.lit(rf"(?s)(?=(\S.{{0,{WORD_SHINGLE - 1}}}))\S+"), F.lit(1)), lambda x: F.xxhash64(x))
    none = F.array().cast("array<bigint>")
    marked = lines.withColumn("at", at_words)
    marked = marked.withColumn("wide", F.when(F.size("at") >= FEW, _least_of_bins(F.col("at"))).otherwise(none)).withColumn(
        "fine", F.when(F.size("at") <= MANY, _least_of_bins(_shingles(F.col("line")))).otherwise(none))
    # bands, not the longer lists of hashes, go through the exchange
    marked = marked.withColumn("bands", F.concat(F.when(F.size("wide") > 0, _bands(F.col("wide"), 0)).otherwise(none),
                                                 F.when(F.size("fine") > 0, _bands(F.col("fine"), BANDS)).otherwise(none)))
    firsts = stored(marked.groupBy("line_id").agg(F.min(order).alias("o"), F.first("bands").alias("bands"))
                    .select("line_id", F.col("o.doc").alias("doc"), F.col("o.place").alias("place"), "bands"), "lines")
    posted = firsts.select("line_id", F.posexplode("bands").alias("at", "band"), "bands").select("line_id", "at", "band", _after().alias("next"))
    met_first = met = _met(posted, BEFORE, "line-bands")
    found = [_pairs(met)]
    # lines of a group too large for every pair meet again in the groups of one band more
    large = met.where(F.col("n") > BEFORE + 1).join(firsts.select("line_id", "bands"), "line_id")
    for level in range(1, BANDS):
        if large.isEmpty():
            break
        more = (large.select("line_id", F.col("at").alias("last"), F.col("band").alias("so_far"), "bands", F.posexplode("bands").alias("at", "one"))
                # each set of bands once, by rising places of one of the two signatures
                .where((F.col("at") > F.col("last")) & (F.floor(F.col("at") / BANDS) == F.floor(F.col("last") / BANDS))))
        met = _met(more.select("line_id", "at", F.xxhash64("so_far", "one").alias("band"), _after().alias("next"), "bands"), DEEPER, f"line-bands-{level + 1}")
        found.append(_pairs(met))
        large = met.where(F.col("n") > DEEPER + 1)
    pairs = stored(reduce(DataFrame.union, found).distinct(), "line-pairs")
    # texts of the lines in a pair, from their first occurrence
    wanted = pairs.select(F.col("a").alias("line_id")).union(pairs.select("b")).distinct()
    places = (firsts.join(wanted, "line_id", "left_semi").groupBy("doc").agg(F.collect_list(F.struct("place", "line_id")).alias("places"))
              .select(F.col("doc").alias("d"), "places"))
    texts = (docs.select(F.col(id_col).alias("doc"), F.split(F.col(text_col), "\n").alias("lines_")).join(places, F.col("doc").eqNullSafe(F.col("d")))
             .select(F.explode_outer(F.transform("places", lambda p: F.struct(p.line_id.alias("line_id"), F.get("lines_", p.place).alias("line")))).alias("x"))
             .select("x.*").where(F.xxhash64("line") == F.col("line_id")))
    texts = stored(texts.dropDuplicates(["line_id"]), "line-texts")
    ratio = Fraction(str(threshold))
    marks = stored(_marks(texts), "line-marks")

    def bounded(pairs: DataFrame) -> DataFrame:
        return (pairs.join(marks.select(F.col("line_id").alias("a"), F.col("n").alias("nx"), F.col("parity").alias("px")), "a")
                .join(marks.select(F.col("line_id").alias("b"), F.col("n").alias("ny"), F.col("parity").alias("py")), "b")
                # similar sets have like numbers of shingles, and few that only one of them has
                .where(F.least("nx", "ny") * ratio.denominator >= F.greatest("nx", "ny") * ratio.numerator)
                .where(_unlike(F.col("px"), F.col("py")) * (ratio.denominator + ratio.numerator) <= (F.col("nx") + F.col("ny")) * (ratio.denominator - ratio.numerator))
                .select("a", "b", "nx", "ny"))

    likely = stored(bounded(pairs), "line-likely")

    def verified(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(texts.select(F.col("line_id").alias("a"), F.col("line").alias("x")), "a")
                .join(texts.select(F.col("line_id").alias("b"), F.col("line").alias("y")), "b"))
        # the common shingles stand once in the condition, in whole numbers, so they are found once a pair
        common = F.size(F.array_intersect(_grams(F.col("x")), _grams(F.col("y"))))
        return both.where(common * (ratio.numerator + ratio.denominator) >= (F.col("nx") + F.col("ny")) * ratio.numerator).select("a", "b")

    links = stored(verified(likely), "line-links")
    roots = connected_components(links)
    # lines of large groups were not all compared: every similar pair that is still apart
    rest = met_first.where(F.col("n") > BEFORE + 1).select("line_id").distinct()
    if not rest.isEmpty():
        more = stored(verified(bounded(_apart_in_lists(texts.join(rest, "line_id", "left_semi"), marks, links, ratio, roots))), "line-list-links")
        # what is new joins whole components
        links = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).where("a <> b").union(more)
    return firsts, links


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILAR) -> DataFrame:
    """``docs`` with ``text`` left with the kept lines, and n_lines and n_removed (blank lines not counted)."""
    firsts, links = similar_lines(docs, id_col, text_col, threshold)
    roots = connected_components(links)
    order = F.struct(F.col("doc").isNull().alias("n"), "doc", "place")
    kept = (firsts.join(roots, firsts.line_id == roots.node, "left").groupBy(F.coalesce("root", "line_id").alias("root"))
            .agg(F.min(order).alias("o")).groupBy(F.col("o.doc").alias("kept_doc")).agg(F.collect_list("o.place").alias("kept")))
    # places in groups of 256, so a text of many lines is not searched line by line in all places
    joined = docs.join(kept, docs[id_col].eqNullSafe(kept.kept_doc), "left").withColumn("all_", F.split(F.col(text_col), "\n")).withColumn(
        "places_", F.coalesce(F.col("kept"), F.array().cast("array<int>")))
    grouped = F.transform(F.sequence(F.lit(0), F.floor(F.size("all_") / 256).cast("int")), lambda g: F.filter("places_", lambda p: F.floor(p / 256) == g))
    # of each line: 0 blank, 1 kept, 2 removed
    marks = let(grouped, lambda by: F.transform("all_", lambda x, i: F.when(_blank(x), 0).when(
        F.array_contains(F.get(by, F.floor(i / 256).cast("int")), i), 1).otherwise(2)))
    out = joined.withColumn("marks_", F.when(F.col(text_col).isNull(), F.array().cast("array<int>")).otherwise(marks))
    return (out.withColumn("n_lines", F.size(F.filter("marks_", lambda m: m > 0)).cast("long"))
            .withColumn("n_removed", F.size(F.filter("marks_", lambda m: m == 2)).cast("long"))
            .withColumn(text_col, F.array_join(F.filter("all_", lambda x, i: F.get("marks_", i) < 2), "\n"))
            .drop("kept_doc", "kept", "places_", "all_", "marks_"))

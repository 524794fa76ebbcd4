"""URL filters by Bloom filter cascades over the complete key universe of the corpus.

A rule is (host, path, action); it fits its host and all subdomains if the
url's path starts with the rule's, and the longest fitting rule wins (the
longer host on a tie). The keys of a url are its host's last k labels followed
by the first p characters of its path, for each (k, p) some rule has, so a rule
fits exactly if its own key is among the url's.

All distinct keys of the corpus are the universe. Level 1 of a cascade is a
Bloom filter of the listed keys, level 2 one of the universe's false positives
of level 1, level 3 one of the listed keys that pass level 2, and so on until
a level has no false positive. A key's membership is the parity of the first
level that it does not pass: exact for every key of the universe, with no
join. There is one cascade for blocked and one for allowed keys. A filter's
size follows from the number of listed keys and its share of the universe
(about 1.44 log2(universe / listed) + 3 bits a listed key); filters larger than
``MAX_BITS`` are refused before any is built.

All of it is DataFrame functions: hashes are xxhash64, bits are set by
bitmap_construct_agg and tested with getbit on a constant array.

Defined cases: a null url, or one without ``://``, has empty host and path and
no rule; urls without a fitting rule are not listed, so they are allowed;
repeated rows are judged each; no rules or no pages give no listed key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import let

MAX_BITS = 1 << 27          # of one filter that tasks hold as a constant: 16 MB
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Cascade:
    """Levels of (bits, hashes, words); ``contains`` is exact on the universe it was built over."""

    def __init__(self, universe: DataFrame, listed: Column, salt: int = 0, key: str = "key"):
        """``universe`` has distinct keys; ``listed`` is true for the keys to encode."""
        self.levels: list[tuple[int, int, Column]] = []
        keys = universe.select(F.col(key).alias("k"), listed.alias("in"))
        n_in, n_out = (int(x or 0) for x in keys.agg(F.sum(F.col("in").cast("long")), F.sum((~F.col("in")).cast("long"))).first())
        encoded, other, inside = n_in, n_out, True
        while encoded:
            rate = min(0.5, encoded / max(other, 1) * math.sqrt(0.5)) if not self.levels else 0.5
            hashes = max(1, round(-math.log2(rate)))
            bits = max(64, 64 * math.ceil(encoded * hashes / math.log(2) / 64))
            if bits > MAX_BITS:
                raise ValueError(f"a filter of {encoded} keys needs {bits} bits; {MAX_BITS} are allowed")
            level = len(self.levels)
            at = F.explode(F.array(*[self._place(F.col("k"), salt, level, j, bits) for j in range(hashes)])).alias("at")
            alive = keys.where(F.col("in") == inside).where(self._passes(F.col("k"), salt))
            # a bitmap bucket has 32768 bits; partial bitmaps are joined before and after the shuffle
            rows = alive.select(at).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).collect()      # the filter itself
            words = [0] * (bits // 64 + 512)
            for r in rows:
                # bit_position p of bucket b (counted from 1) is value (b - 1) * 32768 + p + 1, values from 1
                base = (r["b"] - 1) * 512
                for w in range(512):
                    v = int.from_bytes(r["m"][8 * w:8 * w + 8], "little")
                    if v:
                        words[base + w] |= v
            signed = [w - (1 << 64) if w >> 63 else w for w in words[:bits // 64 + 1]]
            self.levels.append((bits, hashes, F.split(F.lit(",".join(map(str, signed))), ",").cast("array<bigint>")))
            # what passes this level wrongly is encoded by the next
            wrong = keys.where(F.col("in") != inside).where(self._passes(F.col("k"), salt))
            encoded, other, inside = wrong.count(), encoded, not inside
        self.salt = salt

    @staticmethod
    def _place(k: Column, salt: int, level: int, j: int, bits: int) -> Column:
        """A bit place from 1 to ``bits``."""
        return F.pmod(F.xxhash64(F.lit(salt), F.lit(level), F.lit(j), k), F.lit(bits)) + 1

    def _test(self, k: Column, salt: int, level: int) -> Column:
        bits, hashes, words = self.levels[level]
        out = F.lit(True)
        for j in range(hashes):
            at = self._place(k, salt, level, j, bits) - 1
            out = out & (F.getbit(F.get(words, F.floor(at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1)
        return out

    def _passes(self, k: Column, salt: int) -> Column:
        out = F.lit(True)
        for level in range(len(self.levels)):
            out = out & self._test(k, salt, level)
        return out

    def contains(self, k: Column) -> Column:
        """True if the key is listed: the first level it fails is an even one (or the last passed is odd)."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(~self._test(k, self.salt, level), F.lit(level % 2 == 1)).otherwise(out)
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    some = at > 0
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(some, host).otherwise(""), F.when(some, path).otherwise("")


def _keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """A url's keys, longest first."""
    labels = F.split(host, r"\.")
    made = []
    for k, p in shapes:
        fits = (F.size(labels) >= k) & (F.length(path) >= p)
        name = F.array_join(F.slice(labels, -k, k), ".")
        made.append(F.when(fits, F.struct((-F.length(name) - p).alias("n"), (-F.length(name)).alias("h"), F.concat(name, F.substring(path, 1, p)).alias("key"))))
    if not made:
        return F.array().cast("array<string>")
    return F.transform(F.array_sort(F.filter(F.array(*made), lambda x: x.isNotNull())), lambda x: x["key"])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict."""
    shapes = sorted({(len(h.split(".")), len(p)) for h, p, _ in rules})
    host, path = host_and_path(F.coalesce(F.col(url_col), F.lit("")))
    urls = pages.withColumn("host", host).withColumn("path", path)
    keys = _keys(F.col("host"), F.col("path"), shapes)
    universe = urls.select(F.explode(keys).alias("key")).distinct()
    # the longest rule of a key's text is the rule: keys name rules one to one
    by = {a: sorted({h + p for h, p, x in rules if x == a}) for a in ("block", "allow")}
    block, allow = (Cascade(universe, F.col("key").isin(by[a]) if by[a] else F.lit(False), salt) for salt, a in enumerate(("block", "allow")))
    marked = F.filter(F.transform(keys, lambda k: F.struct(k.alias("key"), block.contains(k).alias("blocked"), allow.contains(k).alias("allowed"))),
                      lambda x: x["blocked"] | x["allowed"])
    judged = let(F.get(marked, 0), lambda x: F.struct(x["key"].alias("rule"), F.when(x["blocked"], "block").otherwise("allow").alias("verdict")))
    return urls.withColumn("judged", judged).select(*urls.columns, "judged.rule", "judged.verdict")

"""Toxicity from subword bags: character n-gram vectors averaged into a linear softmax.

A span (one word; its bytes between two blanks) is the bag of its character
n-grams of 3 to 5 bytes, hashed into a table of vectors. The mean of a span's
vectors goes through a linear softmax of two classes. Vectors and softmax are
trained jointly, in numpy in one task, from a bounded sample of labelled
rows: a text is toxic if any of its spans is (noisy-or), so a few toxic words
count the same in a short and in a very long text, and a misspelling shares
n-grams with the words that were seen.

Scoring needs one number per n-gram (vector times softmax difference), so
tasks look n-grams up in that table and take means by prefix sums.

Defined cases: null and empty texts have no spans and score the probability of
the empty noisy-or, 0; rows without label, or with a null label, are not
learnt from; without labelled rows of both classes all texts score 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.textcode import LOWER, SPACE, blocks, prefix_hash, span_hash, word_spans

SIZES = (3, 4, 5)
BUCKETS = 1 << 18
DIM = 4
SAMPLE_ROWS = 1500           # labelled toxic rows, at most, that the model is fit on; twice as many clean ones
ROUNDS = 80
_SHOWN = LOWER.copy()
_SHOWN[SPACE] = 32


def _blanked(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased rows with a blank around each and blanks for all white space: (bytes, word starts, ends, words per row)."""
    rows = len(offs) - 1
    out = np.full(len(data) + rows + 1, 32, np.uint8)
    shown = _SHOWN[data]
    at = offs + np.arange(rows + 1) + 1
    for a, b, to in zip(offs[:-1].tolist(), offs[1:].tolist(), at.tolist(), strict=False):
        out[to:to + b - a] = shown[a:b]
    starts, ends, _ = word_spans(out, np.array([0, len(out)]))
    return out, starts, ends, np.diff(np.searchsorted(starts, at))


def _gram_ids(text: np.ndarray):
    """(n, table place of the n-gram at each byte) for each size."""
    h = np.zeros(len(text), np.uint32)
    for k in range(max(SIZES)):
        h = h[:max(0, len(text) - k)]
        h = h * np.uint32(0x01000193)
        h ^= text[k:]
        if k + 1 in SIZES:
            g = h ^ np.uint32((k + 1) * 0x9E3779B1 & 0xFFFFFFFF)
            g ^= g >> np.uint32(15)
            g *= np.uint32(0x2C1B3C6D)
            g ^= g >> np.uint32(13)
            g &= np.uint32(BUCKETS - 1)
            yield k + 1, g


def span_values(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """Softmax logit (toxic over clean) of each word of blanked text: the mean over its n-grams, blanks included."""
    total, grams = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
    for n, ids in _gram_ids(text):
        c = np.zeros(len(text) + 1)
        np.cumsum(table[ids], dtype=np.float64, out=c[1:len(ids) + 1])
        stop = np.maximum(ends + 2 - n, starts - 1)
        total += c[stop] - c[starts - 1]
        grams += stop - starts + 1
    return total / grams + bias


class ToxicityModel:
    """``table``: per n-gram, its vector times the difference of the softmax columns; ``bias`` likewise."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table.astype(np.float32), float(bias)


def fit(texts: list[str], toxic: list[int], seed: int = 7, rounds: int = ROUNDS) -> ToxicityModel:
    """Train vectors and softmax jointly on labelled texts."""
    y = np.array(toxic, np.float64)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(np.zeros(BUCKETS), -60.0)
    # distinct words of the sample, their n-grams, and the words of each text
    keys, spans, docs = [], [], []
    for i, t in enumerate(texts):
        data = np.frombuffer((t or "").encode(), np.uint8)
        s, e, _ = word_spans(data, np.array([0, len(data)]))
        k, first = np.unique(span_hash(prefix_hash(LOWER[data]), s, e), return_index=True)
        keys.append(k)
        spans += [data[a:b].tobytes() for a, b in zip(s[first].tolist(), e[first].tolist(), strict=True)]
        docs.append(np.full(len(k), i))
    words, first, word = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    word, docs = word.astype(np.int32), np.concatenate(docs).astype(np.int32)
    del keys
    if not len(words):
        return ToxicityModel(np.zeros(BUCKETS), -60.0)
    data = np.frombuffer(b" ".join([spans[i] for i in first]), np.uint8)
    del spans
    text, starts, ends, _ = _blanked(data, np.array([0, len(data)]))
    of_word, gram = [], []
    for n, ids in _gram_ids(text):
        m = np.maximum(ends + 3 - n - starts, 0)
        at = np.repeat(starts - 1 - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        of_word.append(np.repeat(np.arange(len(words), dtype=np.int32), m))
        gram.append(ids[at])
    of_word = np.concatenate(of_word)
    used, gram = np.unique(np.concatenate(gram), return_inverse=True)
    gram = gram.astype(np.int32)
    per_word = np.bincount(of_word, minlength=len(words)).astype(np.float32)
    order = np.argsort(gram, kind="stable")
    gram_first, word_of_gram = np.searchsorted(gram[order], np.arange(len(used))), of_word[order]
    order = np.argsort(of_word, kind="stable")
    word_first, gram_of_word = np.searchsorted(of_word[order], np.arange(len(words))), gram[order]
    del order, gram, of_word

    rng = np.random.default_rng(seed)
    vec = rng.normal(0, 0.3, (len(used), DIM))
    soft = rng.normal(0, 0.5, (DIM, 2))
    bias = np.array([4.0, -4.0])
    params = [vec, soft, bias]
    mean = [np.zeros_like(p) for p in params]
    var = [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        # the mean of vectors times the softmax difference is the mean of one number a vector
        way = soft[:, 1] - soft[:, 0]
        z = np.add.reduceat((vec @ way).astype(np.float32)[gram_of_word], word_first) / per_word + (bias[1] - bias[0])
        p_word = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        # noisy-or: p(text) = 1 - prod(1 - p(word))
        clean = np.bincount(docs, np.logaddexp(0, z)[word], len(y))
        slope = np.where(y == 1, -np.exp(-clean) / np.maximum(-np.expm1(-clean), 1e-9), 1.0) / len(y)
        dz = np.bincount(word, slope[docs], len(words)) * p_word
        dgram = np.add.reduceat((dz / per_word).astype(np.float32)[word_of_gram], gram_first).astype(np.float64)
        dway = vec.T @ dgram
        grads = [np.outer(dgram, way) + 1e-7 * vec, np.stack([-dway, dway], 1) + 1e-5 * soft, np.array([-dz.sum(), dz.sum()])]
        for q, g, m, v in zip(params, grads, mean, var, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= 0.08 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    table = np.zeros(BUCKETS)
    table[used] = vec @ (soft[:, 1] - soft[:, 0])
    return ToxicityModel(table, bias[1] - bias[0])


def sample_labelled(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, y) of up to ``rows`` toxic and twice as many clean labelled ids, in the order of a hash of the id.

    Ids may repeat: at most ``6 * rows`` rows are taken, by id and text, so what repeats beyond that under the
    largest ids is not learnt from. Bounded by the parameter.
    """
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    order = [F.xxhash64(id_col), F.col(id_col)]
    picked = None
    for y in (0, 1):
        ids = marks.where(F.col("y") == y).orderBy(*order).limit(rows * (2 - y))
        picked = ids if picked is None else picked.unionByName(ids)
    return (docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(picked), id_col)
            .orderBy(id_col, "text").limit(6 * rows).select("text", F.col("y").cast("long").alias("y")))


def train(sample: DataFrame) -> ToxicityModel:
    """``fit`` on a bounded sample of (text, y) rows, in one task; only the finished table comes to the driver."""
    def one(batches):
        texts, y = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
        model = fit(texts, y)
        yield pa.RecordBatch.from_pydict({"table": pa.array([model.table.astype("<f4").tobytes()], pa.binary()), "bias": pa.array([model.bias])})

    got = sample.select("text", "y").repartition(1).mapInArrow(one, "table binary, bias double").first()
    if got is None:
        # an empty plan has no task
        return fit([], [])
    return ToxicityModel(np.frombuffer(got["table"], "<f4"), got["bias"])


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a toxicity between 0 and 1 of every row's whole text."""
    from pyspark.sql.functions import pandas_udf

    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.bias))     # 1 MB, whatever the input

    @pandas_udf("double")
    def toxic(texts):
        import pandas as pd

        table, bias = shared.value
        parts = []
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], names=["t"])
        for _, lo, hi, data, offs in blocks([batch], "t", 1 << 20):
            text, starts, ends, counts = _blanked(data, offs)
            z = span_values(text, starts, ends, table, bias)
            parts.append(-np.expm1(-np.bincount(np.repeat(np.arange(hi - lo), counts), np.logaddexp(0, z), hi - lo)))
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.withColumn(name, toxic(F.col(text_col)))

"""The vector index against the exact scan."""
import tempfile

import numpy as np

from eventide.operators.docs import VectorIndex


def test_recall_of_near_neighbours(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 64))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    x = np.concatenate([centres + 0.2 / 8 * rng.standard_normal(centres.shape) for _ in range(12)] + [rng.standard_normal((700, 64))])
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(5000, None), (5001, []), (5002, [0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = VectorIndex(spark, tempfile.mkdtemp(prefix="vec-", dir="/tmp"))
    index.build(df)
    got = index.search(df.where("vec_id < 60"), k=10).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    cos = unit[:60] @ unit.T
    cos[np.arange(60), np.arange(60)] = -2
    want = {(q, int(k)) for q in range(60) for k in np.argsort(-cos[q])[:10]}
    found = {(r.query_id, r.vec_id) for r in got}
    assert len(found & want) >= 0.9 * len(want)
    assert all(abs(r.score - cos[r.query_id, r.vec_id]) < 1e-5 for r in got)
    # candidates are few: most pairs of vectors share no bucket
    asked = spark.read.parquet(f"{index.path}/keys")
    pairs = asked.where("vec_id < 60").withColumnRenamed("vec_id", "q").join(asked, "key").select("q", "vec_id").distinct().count()
    assert pairs < 0.5 * 60 * len(x)

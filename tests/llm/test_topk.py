import math

import numpy as np
from pyspark.sql import functions as F

from quillgraph.llm.topk import Cells, bounds, top_k

from .helpers import rows


def brute(data, k=20, every=20):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
            out |= {(q, r + 1, i, -x) for r, (x, i) in enumerate(s)}
    return out


def table(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("v", F.lit("x"))


def test_agrees_with_brute_force(spark):
    rng = np.random.default_rng(0)
    data = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(0, 0.3, (300, 6)))]
    data += [(i, [0.25] * 6) for i in range(300, 500)]  # one common vector
    data += [(500, None), (520, [0.1, None, 0.0]), (540, [float("nan")] * 6), (560, [float("inf")] * 6), (580, [1.0, 2.0]), (581, [2.0, 1.0]), (600, []), (601, [])]
    for block in (2048, 5):
        assert set(rows(top_k(table(spark, data).repartition(3), "vec_id", "embedding", block=block))) == brute(data)
    assert set(rows(top_k(table(spark, data[:7]), "vec_id", "embedding"))) == brute(data[:7])
    assert rows(top_k(table(spark, data[:1]).limit(0), "vec_id", "embedding")) == []


def test_repeated_rows_count_as_candidates(spark):
    data = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0]), (0, [1.0, 0.0])]
    assert sorted(rows(top_k(table(spark, data), "vec_id", "embedding"))) == [(0, 1, 1, 2048), (0, 2, 1, 2048)]


def test_large_components_take_part(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.normal(0, 0.3, 4)]) for i in range(60)]
    data += [(i, [float(x) for x in rng.normal(0, 1, 4) * 10.0**e]) for i, e in zip(range(60, 81), [3, 6, 9, 10, 11, 12, 15] * 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    most = (1 << 63) - 1
    want = {(q, r, i, max(-most - 1, min(most, s))) for q, r, i, s in brute(data)}
    assert set(rows(top_k(df, "vec_id", "embedding"))) == want


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for spread, outlier in ((20, 0), (3000, 0), (20, 1e9)):
        v = np.floor(rng.normal(0, spread, (500, 8)))
        v[3, 2] += outlier
        cells = Cells(v.min(), float(np.floor(-4 * spread)), float(4 * spread), v.max())
        low, high = bounds(v[:10], cells.codes(v), cells)
        exact = v[:10] @ v.T
        assert (low <= exact).all() and (exact <= high).all()
        assert spread > 20 or outlier or (low == high).all()

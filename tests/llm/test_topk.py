import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import topk


def _brute(rows, queries, k=5):
    rows = {(i, tuple(v)) for i, v in rows}
    out = set()
    for qi, qv in {(i, tuple(v)) for i, v in queries}:
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != qi and len(v) == len(qv))[:k]
        out |= {(qi, r + 1, i, -x) for r, (x, i) in enumerate(s)}
    return out


@pytest.mark.parametrize("page_rows,block", [(2048, 1024), (40, 3)])
def test_equals_brute_force(spark, page_rows, block):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 0.3, (400, 8))
    x[50:150] = x[50]  # a third alike: ties everywhere
    x[200:210] *= 6
    rows = [(i, [math.floor(256 * c) for c in v]) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    v = topk.integer_vectors(df)
    got = topk.top_k(v, v.filter("vec_id % 10 = 0"), page_rows=page_rows, query_block=block, routing_vectors=6)
    got = [tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(rows, [r for r in rows if r[0] % 10 == 0])


def test_odd_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]),
                                (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0, 0.0, 0.0]), (1, [0.5, 0.5]), (50, [0.1, 0.2]), (7, [])],
                               "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    v = topk.integer_vectors(df)
    assert {r["vec_id"] for r in v.collect()} == {0, 1, 6, 50} and v.count() == 4
    got = {tuple(r) for r in topk.top_k(v, v.filter("vec_id % 50 = 0")).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == _brute([tuple(r) for r in v.collect()], [(0, [256, 0]), (50, [25, 51])])
    assert topk.top_k(v.filter("false"), v).count() == 0 and topk.top_k(v, v.filter("false")).count() == 0


def test_negative_components_floor(spark):
    df = spark.createDataFrame([(0, [-0.001])], "vec_id long, embedding array<float>")
    assert topk.integer_vectors(df).first()["v"] == [-1]


def test_pages_skip_work():
    """A known k-th score rules a far leaf node out: its vectors are never read."""
    import pandas as pd
    near, far = np.array([[9, 9]] * 6), np.array([[-900, -900]] * 6)
    m2 = 2 * 900.0 ** 2
    pivot = topk.augmented(np.array([[0, 0]]), m2)[0]
    rows = []
    for j, v in enumerate((near, far)):
        c = topk.augmented(v[:1], m2)[0]
        rows.append((2, 0, 0, j, c.tobytes(), float(np.linalg.norm(c - pivot)), 0.0, (np.arange(6) + 10 * j).tobytes(),
                     np.zeros(6).tobytes(), v.astype(np.int64).tobytes() if j == 0 else np.full((6, 2), 10 ** 6).tobytes()))
    nodes = pd.DataFrame(rows, columns=[c.split()[0] for c in topk.NODE.split(", ")])
    got = topk.search_page(nodes, pivot, np.array([[5, 5]]), np.array([-1]), np.array([90.0]), m2, 5)
    assert [g[1] for g in got] == [0, 1, 2, 3, 4]

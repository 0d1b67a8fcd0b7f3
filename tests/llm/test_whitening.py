import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelane.llm import whitening as W


def _matrix(rng, d, values):
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    return (q * values) @ q.T


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10 ** 6), st.booleans())
def test_inertia_counts_signs(d, seed, holes):
    rng = np.random.default_rng(seed)
    a = rng.integers(-3, 4, (d, d)).astype(float)
    a = a + a.T
    if holes:
        np.fill_diagonal(a, 0)  # needs 2 x 2 blocks
    w = np.linalg.eigvalsh(a)
    if (np.abs(w) > 1e-9).all():
        assert W.inertia(a) == ((w > 0).sum(), (w < 0).sum(), 0)


@pytest.mark.parametrize("values", [
    [9.0, 7, 5, 3, 1, 0.5], [9, 9 - 1e-6, 9 - 2e-6, 4, 1, 1], [9, 9, 9, 9, 1, 0], [5, 1, 1, 1, 1, 1], [2, 0, 0, 0, 0, 0],
    [1e12, 1e6, 1, 1e-3, 0, 0], list(np.linspace(10, 9.99, 40))])
def test_leading_pairs(values):
    rng = np.random.default_rng(3)
    v = _matrix(rng, len(values), np.array(values, float))
    e, x = W.leading(v, 4)
    size = max(values)
    assert np.allclose(e, sorted(values, reverse=True)[:4], atol=1e-12 * size)
    assert np.allclose(x @ x.T, np.eye(4), atol=1e-10)
    assert np.abs(v @ x.T - x.T * e).max() < 1e-10 * size


def _rows(rng, n=300, d=12):
    x = rng.normal(0, 1, (n, d)) * np.linspace(1, 0.2, d)
    x[50:150] = x[50]  # a third alike: once in the fit
    return [(i, v) for i, v in enumerate(x.tolist())]


def test_equals_eigh(spark):
    rows = _rows(np.random.default_rng(1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = W.whitened_digest(df.withColumns({c: F.lit(1) for c in ("x", "dim", "n", "component")}))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["n"] == "bigint" and dict(got.dtypes)["component"] == "int"
    got = got.collect()
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    w, vec = np.linalg.eigh((u - s / n).T @ (u - s / n) / n)
    w, vec = w[::-1], vec[:, ::-1]
    white = (x - s / n) @ vec[:, :4] / np.sqrt(w[:4])
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    assert len(got) == 4 * len(rows) and len({r["identity_error"] for r in got}) == 1
    for k in range(4):
        mine = {r["vec_id"]: r for r in got if r["component"] == k + 1}
        a = np.array([mine[i]["whitened"] for i in range(len(rows))])
        sign = np.sign(a @ white[:, k])
        assert np.allclose(a, sign * white[:, k], atol=1e-9)
        assert all(r["n"] == n and r["deviation"] == dev[i] and abs(r["explained"] - w[k] / w.sum()) < 1e-12 and r["identity_error"] < 1e-9
                   for i, r in mine.items())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [-inf, 1.0]), (6, [0.5, 0.5]), (6, [0.5, 0.5]), (None, [0.25, -0.0]),
            (7, [0.0, 1.0]), (8, [1.0, 1.0, 1.0]), (9, [0.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = W.whiten(df).collect()
    at = {}
    for r in got:
        at.setdefault(r["vec_id"], []).append(r)
    assert sorted((str(k), len(v)) for k, v in at.items()) == [("6", 4), ("7", 2), ("8", 3), ("9", 1), ("None", 2)]
    assert {r["n"] for r in at[6] + at[7] + at[None]} == {3} and all(r["whitened"] is not None for r in at[6])
    assert all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in at[8] + at[9])  # one vector: no spread
    assert W.whiten(df.filter("false")).count() == 0


def test_deviation_beyond_a_long(spark):
    """Exact as a decimal; the digest has null where a long can't hold it."""
    big = [(1, [2.0 ** 30, 0.0]), (2, [-2.0 ** 30, 1.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    want = (2 * 2 ** 38) ** 2 + 256 ** 2
    assert {int(r["deviation"]) for r in W.whiten(df).collect()} == {want}
    assert {r["deviation"] for r in W.whitened_digest(df).collect()} == {None}

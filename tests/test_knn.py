"""KNN imputation against plain loops over all donors."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.operators import knn as K

COLS = ["a", "b", "c"]


def brute(rows, fit, k=5):
    """rows, fit: (key, a, b, c), None where missing."""
    out = {}
    for i, r in enumerate(rows):
        got = list(r[1:])
        for t in range(3):
            if r[1 + t] is not None:
                continue
            near = []
            for d in fit:
                both = [j for j in range(3) if j != t and r[1 + j] is not None and d[1 + j] is not None]
                if d[1 + t] is not None and both:
                    near.append((sum((r[1 + j] - d[1 + j]) ** 2 for j in both) * (3 / len(both)), d[0], d[1 + t]))
            near = sorted(near, key=lambda x: x[:2])[:k]
            have = [d[1 + t] for d in fit if d[1 + t] is not None]
            got[t] = np.mean([v for *_, v in near]) if near else np.mean(have) if have else None
        out[i] = (r[0], *got)
    return sorted(out.values(), key=str)


def check(spark, rows, fit=None, **options):
    schema = "id long, a double, b double, c double"
    df = spark.createDataFrame(rows, schema).withColumns({"rid": F.lit("mine")} if options.pop("clash", False) else {})
    got = K.knn_impute(df, COLS, "id", spark.createDataFrame(fit, schema) if fit else None, **options)
    got = sorted((tuple(r)[:4] for r in got.collect()), key=str)
    want = brute(rows, fit or rows)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and all((x is None and y is None) or abs(x - y) < 1e-9 for x, y in zip(g[1:], w[1:]))


def _rows(rng, n, gaps=0.1):
    x = rng.normal(0, 1, (n, 3)).round(1)           # a coarse lattice: many ties
    x[: n // 3] = x[0]                              # a third at one point
    return [(int(i), *(None if rng.random() < gaps else float(v) for v in r)) for i, r in zip(rng.permutation(n), x)]


def test_equals_all_donors_with_small_cells(spark):
    """Crowded cells split, sparse patterns stay whole, rows meet cells in blocks."""
    check(spark, _rows(np.random.default_rng(1), 300), cell_rows=24, block_rows=7)


def test_fit_on_other_rows(spark):
    rng = np.random.default_rng(2)
    check(spark, _rows(rng, 80, 0.4), _rows(rng, 150, 0.2), cell_rows=20)


def test_few_donors_and_empty(spark):
    check(spark, [(1, None, 2.0, 3.0), (2, 1.0, None, None), (3, 4.0, 5.0, 6.0), (4, None, None, None), (5, float("7"), 1.0, None)])
    schema = "id long, a double, b double, c double"
    lone = K.knn_impute(spark.createDataFrame([(1, None, 2.0, 3.0), (2, None, None, 3.0)], schema), COLS, "id").collect()
    assert {r["id"]: (r["a"], r["b"]) for r in lone} == {1: (None, 2.0), 2: (None, 2.0)}  # no value of a anywhere
    assert K.knn_impute(spark.createDataFrame([], schema), COLS, "id").count() == 0
    one = K.knn_impute(spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 2.0)], "id long, a double"), ["a"], "id")
    assert sorted(tuple(r) for r in one.collect()) == [(1, 1.0), (2, 1.5), (3, 2.0)]


def test_a_hot_point_keeps_k_donors():
    """nearest() takes ties by key; the search sends at most k donors of a point."""
    y = np.zeros((9, 2))
    (at, d2), = K.nearest(np.array([[0.0, np.nan]]), y, np.array([9, 8, 7, 6, 5, 4, 3, 2, 1]), 3)
    assert at.tolist() == [8, 7, 6] and d2.tolist() == [0, 0, 0]


@pytest.mark.parametrize("want", [1, 2, 8])
def test_directory_bounds_hold(want):
    rng = np.random.default_rng(want)
    y = rng.normal(0, 1, (400, 2))
    y[100:200] = y[0]
    tree = K.cut_cells(y[:200], [0, 1], want, 5)
    cell = tree.of(y)
    assert cell.min() >= 5 and cell.max() < 5 + want
    rows = [{"cell": c, "n": int((cell == c).sum()), "lo": y[cell == c].min(axis=0), "hi": y[cell == c].max(axis=0)} for c in np.unique(cell)]
    d = K.Directory(rows, 2)
    x = rng.normal(0, 2, (50, 2))
    x[::7, 1] = np.nan
    least, most = d.ranges(x)
    for i, p in enumerate(x):
        ok = ~np.isnan(p)
        d2 = ((y[:, ok] - p[ok]) ** 2).sum(axis=1) * (3 / ok.sum())
        for j, r in enumerate(rows):
            inside = d2[cell == r["cell"]]
            assert least[i, j] <= inside.min() * K.ROOM and inside.max() <= most[i, j] * K.ROOM
        assert np.sort(d2)[4] <= d.bound(most[i], 5) * K.ROOM

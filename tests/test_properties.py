"""Property tests (hypothesis) for the driver-side pieces of the operators."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from farelane.operators import split as S
from farelane.operators import stacking as ST


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 10_000), min_size=1, max_size=50),
       st.integers(1, 1_000_000))
def test_quotas_bounded_and_proportional(counts, n):
    q = S.quotas_from_counts(counts, n)
    total = sum(counts.values())
    for b, c in counts.items():
        assert 0 <= q[b] <= c
        assert q[b] == min(c, round(c / total * n))      # half-even, like the original
    if n <= total:
        assert abs(sum(q.values()) - n) <= len(counts)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.floats(0.0, 5.0))
def test_ridge_from_sums_matches_numpy(seed, alpha):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(60, 2)) * [3.0, 0.5] + [10.0, -2.0]
    y = X @ [0.7, -1.3] + rng.normal(size=60)
    cols = ["a", "b"]
    s = {"n": 60, "s_0": X[:, 0].sum(), "s_1": X[:, 1].sum(), "s_2": y.sum()}
    Z = np.column_stack([X, y])
    for i in range(3):
        for j in range(i, 3):
            s[f"p_{i}_{j}"] = float(Z[:, i] @ Z[:, j])
    got = ST.ridge_from_sums(s, cols, cols, "y", alpha)
    Xc, yc = X - X.mean(0), y - y.mean()
    coef = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(2), Xc.T @ yc)
    assert [got["a"], got["b"]] == pytest.approx(coef.tolist(), rel=1e-7, abs=1e-9)
    one = ST.ridge_from_sums(s, cols, ["b"], "y", alpha)      # subset fit from the same sums
    xb = X[:, 1] - X[:, 1].mean()
    assert one["b"] == pytest.approx(float(xb @ yc / (xb @ xb + alpha)), rel=1e-7)


@pytest.fixture(scope="module")
def _spark():
    from farelane.session import get_spark
    return get_spark(master="local[4]", shuffle_partitions=4)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 40)), st.integers(0, 10 ** 6)),
                min_size=1, max_size=60, unique_by=lambda t: t[1]))
def test_half_split_matches_brute_force(_spark, rows):
    """Random timestamps with many ties and nulls: val is exactly the first
    n // 2 rows of (ts nulls last, key), as a full sort would give."""
    import datetime as dt
    from pyspark.sql import functions as F
    base = dt.datetime(2024, 3, 10, 1, 59, 58)
    data = [(k, None if s is None else base + dt.timedelta(seconds=s // 4, microseconds=(s % 4) * 250))
            for s, k in rows]
    df = _spark.createDataFrame(data, "trip_id long, Trip_Pickup_DateTime timestamp_ntz")
    got = sorted(r["trip_id"] for r in S.half_split(df).filter(F.col("split") == "val").collect())
    order = sorted(data, key=lambda r: (r[1] is None, r[1] or base, r[0]))
    assert got == sorted(k for k, _ in order[: len(data) // 2])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.floats(0.1, 10), st.floats(0.1, 10), st.floats(-1, 1), st.floats(1, 50),
                          st.floats(0.1, 10)), min_size=2, max_size=5))
def test_mcdm_matches_direct_computation(_spark, cands):
    from farelane.config import METRICS_ORDER, SELECTION_WEIGHTS
    from farelane.operators import selection as SEL
    rows = [(f"c{i}", m, float(v)) for i, c in enumerate(cands) for m, v in zip(METRICS_ORDER, c)]
    df = _spark.createDataFrame(rows, "candidate string, metric string, value double")
    got = {r["candidate"]: r["score"] for r in SEL.mcdm_scores(df).collect()}
    M = np.array(cands, dtype=float)
    w = np.array([SELECTION_WEIGHTS[m] for m in METRICS_ORDER]) / sum(SELECTION_WEIGHTS.values())
    norm = np.full_like(M, 0.5)
    for j, m in enumerate(METRICS_ORDER):
        lo, hi = M[:, j].min(), M[:, j].max()
        if hi > lo:
            norm[:, j] = (hi - M[:, j]) / (hi - lo) if m == "r2" else (M[:, j] - lo) / (hi - lo)
    expect = norm @ w
    for i in range(len(cands)):
        assert got[f"c{i}"] == pytest.approx(expect[i], abs=1e-9)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=250, max_size=900),
       st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4))
def test_bracketed_quantiles_match_numpy(_spark, values, probs):
    from farelane.functions.quantiles import quantiles
    xs = [v / 7.0 for v in values]                       # many duplicates
    df = _spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r["p"]: r["value"] for r in quantiles(df, ["x"], probs).collect()}
    for p in set(probs):
        assert got[float(p)] == pytest.approx(float(np.percentile(xs, p * 100)), rel=1e-9, abs=1e-9)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=5, max_size=300), st.lists(st.integers(0, 30), min_size=5, max_size=300))
def test_bucketed_w1_matches_numpy(_spark, a, b):
    from farelane.operators import drift as D
    ra = _spark.createDataFrame([(float(v),) for v in a], "x double")
    rb = _spark.createDataFrame([(float(v),) for v in b], "x double")
    got = D.wasserstein(ra, rb, ["x"]).first()["w1"]
    grid = np.unique(np.concatenate([a, b])).astype(float)
    Fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    Fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    expect = float(np.sum(np.abs(Fa - Fb)[:-1] * np.diff(grid)))
    assert got == pytest.approx(expect, rel=1e-9, abs=1e-12)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=20, max_size=400), st.integers(1, 300))
def test_quota_draw_matches_brute_force(_spark, groups, n):
    """Per group, the quota rows with the smallest (md5 prefix, key): the
    bracketed draw equals a full sort."""
    import hashlib
    rows = [(i, g) for i, g in enumerate(groups)]
    df = _spark.createDataFrame(rows, "trip_id long, g long")
    counts = {}
    for _, g in rows:
        counts[g] = counts.get(g, 0) + 1
    quotas = S.quotas_from_counts(counts, n)
    got = sorted(r["trip_id"] for r in S.sample_by_quota(df, "g", quotas, seed=42).collect())

    def h(k):
        return int(hashlib.md5(f"{k}|42".encode()).hexdigest()[:8], 16)

    expect = []
    for g, q in quotas.items():
        members = sorted((h(k), k) for k, gg in rows if gg == g)
        expect += [k for _, k in members[:q]]
    assert got == sorted(expect)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.floats(0.5, 5.0), st.floats(0.0, 6.28)), min_size=3, max_size=12,
                unique_by=lambda t: round(t[1], 3)),
       st.lists(st.tuples(st.floats(-6, 6), st.floats(-6, 6)), min_size=1, max_size=60),
       st.sampled_from([0.05, 0.5, 3.0]))
def test_banded_polygon_matches_ray_casting(_spark, ring, pts, band):
    import math
    from farelane.operators import polygon as PG
    ring = sorted(ring, key=lambda t: t[1])                 # star-shaped: a simple polygon
    poly = [(r * math.cos(a), r * math.sin(a)) for r, a in ring]
    edges = PG.edges_from_rings(_spark, {1: [poly]})
    df = _spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id long, x double, y double")
    got = {r["id"]: r["inside"] for r in PG.point_in_polygon(df, edges, "x", "y", cell=band).collect()}
    closed = poly + [poly[0]]

    def inside(x, y):
        c = 0
        for (x1, y1), (x2, y2) in zip(closed[:-1], closed[1:]):
            if y1 != y2 and ((y1 <= y) != (y2 <= y)) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                c += 1
        return c % 2 == 1

    for i, (x, y) in enumerate(pts):
        assert got[i] == inside(x, y)

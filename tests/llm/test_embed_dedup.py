import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farelane.llm import embed_dedup as E
from farelane.llm.graph import components


def _brute(rows, threshold=0.9):
    def ok(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cos(a, b):
        a, b = (np.array(v, float) / np.abs(np.array(v, float)).max() for v in (a, b))
        return a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok(rows[i][1]) and ok(rows[j][1]) and len(rows[i][1]) == len(rows[j][1])
             and cos(rows[i][1], rows[j][1]) >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def _got(df, **options):
    got = E.near_duplicate_vectors(df, **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=str)


def _clustered(rng, n, dim):
    x = rng.normal(0, 1, (n, dim))
    x[n // 3:2 * n // 3] = x[0] + rng.normal(0, 0.45, (2 * n // 3 - n // 3, dim))  # a third close to the threshold
    x[-20:-10] = x[5]  # copies
    x[-10:] = 3 * x[6] + rng.normal(0, 0.05, (10, dim))
    return x


def test_equals_brute_force(spark):
    x = _clustered(np.random.default_rng(2), 240, 16)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = _brute(rows)
    assert _got(df, group_rows=60) == want  # the links of one cluster lie in many tasks
    assert sum(r[1] for r in want) > 500


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),
            (7, [-2.0, 1.0]), (8, [2.0, 4.0]), (None, [1.0, 2.1]), (None, [-9.0, -9.0]), (9, [1.0, 2.0, 0.0]), (10, [-0.0, 1.0]),
            (11, [0.0, 1.0]), (12, [1e200, 2e200]), (13, [1e-300, 2e-300]), (14, [-0.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("cid", "key", "g", "links", "raw")})
    assert _got(df) == _brute(rows)
    assert _got(df.filter("false")) == []


def test_quantisation_bound_holds():
    rng = np.random.default_rng(4)
    for dim in (1, 3, 64, 1500):
        x = rng.normal(0, 1, (60, dim)) * rng.exponential(1, (60, 1)) + rng.choice([0, 5], (60, 1))
        x[:20] *= rng.random((20, dim)) ** 8  # few large entries
        q, s, e, n = E.quantised(x)
        u = x / np.linalg.norm(x, axis=1)[:, None]
        got = E.exact_products(q, q)
        assert np.array_equal(got, q.astype(np.int64) @ q.astype(np.int64).T)
        lost = np.abs(u @ u.T - got * s[:, None] * s[None, :])
        assert (lost <= np.minimum(n[:, None] * e[None, :] + e[:, None], n[None, :] * e[:, None] + e[None, :]) + 1e-12).all()


def test_only_pairs_in_between_are_recomputed(monkeypatch):
    """Pairs above and below the bounds never reach the full precision."""
    rng = np.random.default_rng(6)
    x = _clustered(rng, 300, 64)
    q, s, e, n = E.quantised(x)
    pdf = pd.DataFrame({"cid": np.arange(300), "copies": 1, "q": [v.tobytes() for v in q], "s": s, "e": e, "len": n, "g": 0, "gi": 0, "gj": 0,
                        "raw": [v.tobytes() for v in x]})
    seen = []
    monkeypatch.setattr(E, "cosines", lambda a, b, f=E.cosines: (seen.append(f(a, b)), seen[-1])[1])
    sure, close = E._tiles(0.9)(pdf), E._recompute(0.9)(pdf)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = np.triu(u @ u.T >= 0.9, 1)
    links = near.sum(axis=0) + near.sum(axis=1)
    got = pd.concat([sure, close]).groupby("cid")["links"].sum().reindex(range(300), fill_value=0)
    assert (got.to_numpy() == links).all()
    seen = np.concatenate(seen)
    assert len(seen) < 0.05 * 300 * 299 / 2 and (np.abs(seen - 0.9) < 0.04).all()


def test_threshold_must_fit(spark):
    with pytest.raises(ValueError):
        E.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>"), threshold=0)


def test_components_of_stars_and_chains(spark):
    """A hub with a third of all nodes, smallest or largest of them, and a long chain."""
    edges = [(0, i) for i in range(1, 200)] + [(999, i) for i in range(300, 500)] + [(i, i + 1) for i in range(500, 540)] + [(5, 6), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), salts=8).collect()}
    assert got == {**{i: 0 for i in range(200)}, **{i: 300 for i in [*range(300, 500), 999]}, **{i: 500 for i in range(500, 541)}} | {500: 500}

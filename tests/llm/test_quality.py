import numpy as np

from farelane.llm import quality, queries
from tests.llm import frames


def _auc(s, y):
    r = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    n1 = y.sum()
    return (r[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_quality(spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").filter("held_out").collect()
    s, y = np.array([r["score"] for r in rows]), np.array([r["quality"] for r in rows])
    assert len(rows) > 80 and _auc(s, y) > 0.95
    assert np.mean([(r["predicted"] == 1) == (r["quality"] == 1) for r in rows]) > 0.85
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in rows)


def test_prior_and_risk():
    rng = np.random.default_rng(1)
    pos = rng.normal(1.5, 1, (1500, 2))
    unl = np.concatenate([rng.normal(1.5, 1, (1200, 2)), rng.normal(-1.5, 1, (800, 2))])
    first = quality.fit_nnpu(pos, unl, 0.5, epochs=10)
    prior = quality.estimate_prior(first.score(pos), first.score(unl))
    assert 0.55 < prior < 0.72  # 0.6
    net = quality.fit_nnpu(pos, unl, prior, epochs=30)
    truth = np.repeat([1, 0], [1200, 800])
    assert ((net.score(unl) >= 0.5) == truth).mean() > 0.93 and _auc(net.score(unl), truth) > 0.97


def test_odd_rows(spark):
    df = frames.with_clashes(frames.docs(spark, frames.odd_rows()))
    net = quality.fit(frames.docs(spark, [(1, "some words here"), (2, None)]), frames.docs(spark, [(3, "$$$ $$$"), (4, "")]), epochs=3)
    got = quality.scored(df, net)
    assert got.columns[:len(df.columns)] == df.columns and got.count() == len(frames.odd_rows())
    assert all(0 <= r["score_"] <= 1 and r["predicted_"] in (0, 1) for r in got.collect())
    assert quality.fit(frames.docs(spark, []), df) is None
    assert {r["score"] for r in quality.scored(frames.docs(spark, [(1, "a")]), None).collect()} == {0.5}
    assert quality.scored(frames.docs(spark, []), net).count() == 0


def test_features_are_finite():
    for t in (None, "", " ", "\n\n", "a", "\U0001f600" * 5, "\x00\ud800x", "word " * 10_000):
        x = quality.features(t)
        assert x.shape == (quality.N_FEATURES,) and np.isfinite(x).all()


def test_bounded_sample(spark):
    df = frames.docs(spark, [(i, f"t{i}") for i in range(3000)])
    ids = df.filter("doc_id < 2000").select("doc_id")
    some = quality.bounded_sample(df, ids, max_rows=300)
    assert 220 < some.count() < 380 and some.agg({"doc_id": "max"}).first()[0] < 2000 and some.columns == df.columns
    assert quality.bounded_sample(df, ids, max_rows=5000).count() == 2000

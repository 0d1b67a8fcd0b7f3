import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import langid, queries
from tests.llm import frames

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_held_out_accuracy(spark):
    got = queries.op5_langid(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95
    assert got.count() == docs.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_only_the_text_counts(spark, model):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    a = langid.identify(df.select("doc_id", "text"), model)
    b = langid.identify(df.withColumns({"lang": F.lit("xx"), "source": F.lit("y")}), model)
    key = lambda d: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in d.collect())
    assert key(a) == key(b)


def test_mixture(spark, model):
    by = {r["lang"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").filter("n_chars between 1500 and 4000").collect()}
    en, fr = by["en"][:1500], by["fr"][:700]
    got = langid.identify(frames.docs(spark, [(1, en + "\n" + fr), (2, en), (3, fr)]), model).collect()
    both = {x["lang"]: x["share"] for x in got[0]["languages"]}
    assert set(both) == {"en", "fr"} and got[0]["lang_pred"] == "en"
    share = len(en.split()) / (len(en.split()) + len(fr.split()))
    assert abs(both["en"] - share) < 0.08 and abs(sum(both.values()) - 1) < 1e-6
    assert [x["lang"] for x in got[1]["languages"]] == ["en"] and got[2]["lang_pred"] == "fr"


def test_em_equals_plain_loops():
    rng = np.random.default_rng(0)
    ll = rng.normal(0, 3, (60, 3))
    doc = np.repeat([0, 1, 3], [10, 30, 20])
    got = langid.infer(ll, doc, 4)
    assert got[2].sum() == 0
    for d in (0, 1, 3):
        p = np.maximum(np.exp(ll[doc == d] - ll[doc == d].max(axis=1, keepdims=True)), 1e-12)
        order = np.argsort(-langid._em(p, np.array([0]), np.array([len(p)]), np.ones((1, 3)), 6)[0][0])
        best = (-2 * np.log(p).sum(axis=0).max(), np.eye(3)[np.log(p).sum(axis=0).argmax()])
        for k in (2, 3):
            pi = np.zeros(3)
            pi[order[:k]] = 1 / k
            for _ in range(20):
                r = pi * p
                pi = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
            crit = -2 * np.log((pi * p).sum(axis=1)).sum() + (k - 1) * np.log(len(p))
            if crit < best[0]:
                best = (crit, pi)
        assert np.allclose(got[d], best[1], atol=1e-9)


def test_chunks_do_not_change_results(spark, model, monkeypatch):
    texts = [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    run = langid.predictor(model).func
    import pandas as pd
    whole = next(run(iter([pd.Series(texts)])))
    monkeypatch.setattr(langid, "CHUNK", 3000)
    parts = next(run(iter([pd.Series(texts)])))
    assert whole["lang_pred"].tolist() == parts["lang_pred"].tolist() and np.allclose(whole["score"], parts["score"])


def test_odd_rows(spark, model):
    df = frames.with_clashes(frames.docs(spark, frames.odd_rows()))
    got = langid.identify(df, model)
    assert got.columns[:len(df.columns)] == df.columns
    by = {(r["doc_id"], r["text"]): r for r in got.collect()}
    for k in ((1, None), (2, ""), (4, "?!? ... ---")):
        assert by[k]["lang_pred_"] == "und" and by[k]["score_"] == 0
    assert by[(7, "short text")]["lang_pred_"] in model.langs
    assert langid.identify(frames.docs(spark, []), model).count() == 0
    none = langid.fit(frames.docs(spark, [(1, None)]))
    assert none.langs == [] and langid.identify(frames.docs(spark, [(1, "a b")]), none).first()["lang_pred"] == "und"


def test_stage_drops_only_what_has_no_letter(spark):
    df = frames.with_clashes(frames.docs(spark, frames.odd_rows()))
    kept = langid.identified_only(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["None", "6", "7", "7", "8", "9", "10"])
    assert langid.identified_only(frames.docs(spark, [])).count() == 0


def test_words_of_a_batch_stay_in_their_document():
    texts = ["ab cd", "", "e", "ef"]
    g, first, doc = langid.trigrams(texts)
    assert doc.tolist() == [0, 0, 2, 3] and len(g) == 7 and first.tolist() == [0, 2, 4, 5]
    assert os.path.exists(SF001)


def test_a_text_alone_and_in_any_batch():
    """Mixed texts: the search over language sets ends for each on its own."""
    rng = np.random.default_rng(12)
    ll = []
    for d in range(40):
        n = int(rng.integers(3, 40))
        own = rng.choice(6, size=int(rng.integers(1, 5)), replace=False)
        x = rng.normal(-9, 1, (n, 6))
        x[np.arange(n), rng.choice(own, n)] += rng.exponential(2.5, n)
        ll.append(x)
    doc = np.repeat(np.arange(40), [len(x) for x in ll])
    together = langid.infer(np.concatenate(ll), doc, 40)
    for d, x in enumerate(ll):
        assert np.allclose(langid.infer(x, np.zeros(len(x), int), 1)[0], together[d], atol=1e-12)
    assert ((together > 0).sum(axis=1) > 1).any()


def test_labels_are_put_right(spark):
    en, de = "the cat and the dog went to the house of the man ", "der hund und die katze gehen in das haus von dem mann "
    rows = [(i, en * 3, "en") for i in range(6)] + [(10 + i, de * 3, "de") for i in range(6)]
    rows += [(20, en * 4, None), (21, de * 4, "en"), (22, en * 2, "xx"), (23, "12 ?!", "en"), (24, None, "en"), (25, en * 2 + de * 2, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("got", F.lit(1))
    out = langid.labelled(df)
    got = {r["doc_id"]: r["lang"] for r in out.collect()}
    assert out.columns == df.columns and set(got) == {r[0] for r in rows} - {23, 24}
    assert got[20] == "en" and got[21] == "de" and got[25] == "de" and all(got[i] == "en" for i in range(6))
    assert langid.labelled(df.filter("false")).count() == 0

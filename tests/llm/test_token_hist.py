from collections import Counter

from farelane.llm import token_hist as th
from tests.llm import frames


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    enc = th.encoder(th.VOCABULARY)
    lengths = [len(enc.encode_ordinary(r["text"])) for r in docs.collect()]
    hist = th.length_histogram(docs)
    rows = {r["n_tokens"]: r for r in hist.collect()}
    assert {k: r["docs"] for k, r in rows.items()} == Counter(lengths)
    for n, r in rows.items():
        assert r["tokens"] == n * r["docs"]
        assert r["docs_from"] == sum(x >= n for x in lengths) and r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["docs_to"] == sum(x <= n for x in lengths) and abs(r["share_to"] - r["docs_to"] / len(lengths)) < 1e-12
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
    assert th.total_tokens(hist) == sum(lengths)
    for limit in (0, 1, 77, 2048, 10 ** 7):
        assert th.truncated_total(hist, limit) == sum(min(x, limit) for x in lengths)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        k = max(1, -(-int(round(q * 1e6)) * len(lengths) // 10 ** 6))
        assert th.quantile(hist, q) == sorted(lengths)[k - 1]


def test_tokens_decode_to_the_text():
    enc = th.encoder(th.VOCABULARY)
    for t in ("It's 2024, été\n\n  x", "a" * 10_000, "\U0001f600\u0000"):
        assert enc.decode(enc.encode_ordinary(t)) == t


def test_odd_rows(spark):
    hist = {r["n_tokens"]: r["docs"] for r in th.length_histogram(frames.with_clashes(frames.docs(spark, frames.odd_rows()))).collect()}
    assert sum(hist.values()) == len(frames.odd_rows()) and hist[0] == 4
    empty = th.length_histogram(frames.docs(spark, []))
    assert empty.count() == 0 and th.total_tokens(empty) == 0 and th.quantile(empty, 0.5) is None

import math
import re

import numpy as np
import pytest

from farelane.llm import decontam
from tests.llm import frames


def _grams(t):
    w = re.findall(r"[^\W_]+", t.lower()) if t else []
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _brute(rows, items, threshold=0.8):
    grams = {}
    for i, t in items:
        grams.setdefault(i, set()).update(_grams(t))
    return sorted({(d, t, i) for d, t in rows for i, g in grams.items() if g and len(g & _grams(t)) >= threshold * len(g) - 1e-9}, key=str)


def _case(spark, seed=5):
    rng = np.random.default_rng(seed)
    items = [(i, frames.words(rng, int(n))) for i, n in enumerate(rng.integers(5, 60, 30))]
    rows = [(i, frames.words(rng, int(rng.integers(0, 200)))) for i in range(60)]
    for i, t in items:
        w = t.split()
        rows.append((100 + i, frames.words(rng, 50) + " " + t.upper() + ". " + frames.words(rng, 3000)))  # in a long text
        cut = max(0, int(len(w) * rng.choice([0.1, 0.15, 0.3])))
        rows.append((200 + i, frames.words(rng, 20) + " " + " ".join(w[cut:])))  # a part of it
    rows += [(300 + i, rows[60][1]) for i in range(40)]  # a group of copies
    bench = spark.createDataFrame(items, "item_id long, text string")
    return rows, items, bench


@pytest.mark.parametrize("small", [True, False])
def test_equals_brute_force(spark, small, monkeypatch):
    if not small:  # the way without broadcasts
        monkeypatch.setattr(decontam, "broadcast_if_small", lambda df: df)
    rows, items, bench = _case(spark)
    got = decontam.contained_items(frames.docs(spark, rows), bench).collect()
    assert sorted({(r["doc_id"], r["item_id"]) for r in got}) == sorted({(d, i) for d, _, i in _brute(rows, items)})
    assert len(got) == len(_brute(rows, items))


def test_decontaminate_keeps_clean(spark):
    rows, items, bench = _case(spark)
    df = frames.with_clashes(frames.docs(spark, rows + frames.odd_rows()))
    kept = decontam.decontaminate(df, bench)
    bad = {d for d, _, _ in _brute(rows, items)}
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in rows + frames.odd_rows() if r[0] not in bad)


def test_odd_rows(spark):
    odd = frames.with_clashes(frames.docs(spark, frames.odd_rows()))
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "short text"), (4, "two three four five six"), (None, "one two three four five"), (4, "two three four five six"), (5, "?")],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["item_shingles"]) for r in decontam.contained_items(odd, bench).collect()}
    assert got == {(7, 3, 1), (None, 4, 1), (6, 4, 1), (None, None, 1), (6, None, 1)}
    assert decontam.contained_items(frames.docs(spark, []), bench).count() == 0
    assert decontam.contained_items(odd, bench.filter("false")).count() == 0
    assert decontam.decontaminate(odd, bench.filter("false")).count() == len(frames.odd_rows())


@pytest.mark.parametrize("small", [True, False])
def test_texts_of_one_id_are_items_of_their_own(spark, small, monkeypatch):
    if not small:
        monkeypatch.setattr(decontam, "broadcast_if_small", lambda df: df)
    rng = np.random.default_rng(8)
    a, b, c, d = (frames.words(rng, n) for n in (30, 40, 25, 35))
    bench = spark.createDataFrame([(1, a), (1, b), (None, c), (None, d), (2, None)], "item_id long, text string")
    docs = [(1, a), (2, frames.words(rng, 90) + " " + b), (3, c), (4, d + " " + frames.words(rng, 9)),
            (5, a + " " + " ".join(b.split()[:36])), (6, frames.words(rng, 60))]
    got = decontam.contained_items(frames.docs(spark, docs), bench).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["matched"], r["item_shingles"]) for r in got), key=str) == [
        (1, 1, 26, 26), (2, 1, 36, 36), (3, None, 21, 21), (4, None, 31, 31), (5, 1, 26, 26)]
    assert [r["doc_id"] for r in decontam.decontaminate(frames.docs(spark, docs), bench).collect()] == [6]


def test_hits_keep_recall():
    rng = np.random.default_rng(0)
    for p in decontam.size_partitions():
        n = min(2 ** p["size_class"], 5000)
        k = min(n, p["sample"])
        inside = int(np.ceil(0.8 * n))
        got = rng.hypergeometric(inside, n - inside, k, 20_000) if n > inside else np.full(10, k)
        assert (got >= p["hits"]).mean() > 0.9998 and p["hits"] >= 1


def test_native_plan(spark):
    rows, _, bench = _case(spark)
    plan = decontam.contained_items(frames.docs(spark, rows), bench)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_miss_bound_holds_at_every_size():
    """P(fewer hits than asked for | containment 0.8) by the plain hypergeometric sum."""
    for p in decontam.size_partitions()[:12]:
        for n in range(2 ** p["size_class"], 2 ** (p["size_class"] + 1)):
            k, inside = min(n, p["sample"]), math.ceil(0.8 * n - 1e-9)
            short = sum(math.comb(inside, h) * math.comb(n - inside, k - h) for h in range(p["hits"]))
            assert p["hits"] == 1 or short <= 1e-6 * math.comb(n, k), n


def test_sql_has_one_item_per_text(spark, tmp_path):
    """Two texts under one id, and under a null one: operator and SQL agree."""
    import duckdb

    from farelane.llm import queries
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    docs = frames.docs(spark, [(1, f"x y z {a} end"), (2, f"start {b}"), (3, f"{c} {a}"), (4, "nothing of it"), (3, f"{c} {a}")])
    items = spark.createDataFrame([(7, a), (7, b), (None, b), (None, c), (7, a), (8, None)], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op7_decontamination(spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(queries.SQL["op7_decontamination"]).fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select("doc_id", "item_id", "matched", "item_shingles", "containment").collect())) == sorted(map(key, want))
    assert {(r[0], r[1]) for r in want} == {(1, 7), (2, 7), (2, None), (3, 7), (3, None)}

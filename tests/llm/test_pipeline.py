import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import frames
from tests.llm.test_decontam import _brute as contained
from tests.llm.test_jaccard_join import _brute as groups


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    rng = np.random.default_rng(8)
    items = [(i, frames.words(rng, 30)) for i in range(5)]
    rows = [(i, frames.words(rng, 80), f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "s0") for i in range(10)]  # exact copies
    for i in range(10, 20):  # near copies
        w = rows[i][1].split()
        w[3] = "changed"
        rows.append((100 + i, " ".join(w), "s1"))
    rows += [(200 + i, frames.words(rng, 40) + " " + t + " " + frames.words(rng, 40), "s2") for i, t in items]
    rows += [(300, "12 34 !!", "s0"), (301, None, "s0"), (302, "", "s1"), (303, "a few words", None), (None, "no id but words here in it", "s1")]
    frames.docs(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows, items


def test_run_equals_brute_force(spark, sf_dir):
    d, rows, items = sf_dir
    left = [(i, t) for i, t, *_ in rows if t is not None and any(c.isalpha() for c in t)]
    want = groups(left)
    left = [(i, t) for i, t in left if i in {w[4] for w in want} or i is None]
    bad = {i for i, _, _ in contained(left, items)}
    left = sorted(str(i) for i, _ in left if i not in bad)
    got = corpus_pipeline.run(spark, d).collect()
    assert sorted(str(r["doc_id"]) for r in got) == left
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def _mixed(spark, tmp_path):
    """A hot source and five small ones, too many rows for one window."""
    rng = np.random.default_rng(3)
    rows = [(i, frames.words(rng, 12, 5000), "hot" if i % 3 else f"s{i % 5}") for i in range(1800)]
    frames.docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, frames.words(rng, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")


def test_every_shard_prefix_holds_the_mix(spark, tmp_path, monkeypatch):
    """The weights (root of the rows) hold in the first half of every shard of the final result; in a plain shuffle they don't."""
    from farelane.llm import mixing, sharding
    _mixed(spark, tmp_path)
    deal = sharding.shards_in_order
    monkeypatch.setattr(sharding, "shards_in_order", lambda df: deal(df, shards=4, window_rows=100))
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    mix = mixing.mix(spark.read.parquet(f"{tmp_path}/documents.parquet")).toPandas().sort_values("mix_position")
    want = (mix["source"][: len(mix) // 3] == "hot").mean()
    assert abs(want - 2 / 3) > 0.1  # the mix is not the table's own
    for _, s in got.groupby("shard"):
        s = s.sort_values("slot")
        assert s["slot"].tolist() == list(range(len(s))) and abs(len(s) - 450) <= 1
        assert abs((s["source"][: len(s) // 3] == "hot").mean() - want) < 0.08


@pytest.mark.parametrize("left_out", range(5))
def test_no_stage_can_be_left_out(spark, sf_dir, left_out, monkeypatch):
    """Each stage has its mark on the final result."""
    d, rows, items = sf_dir
    stages = [s for i, s in enumerate(corpus_pipeline.STAGES) if i != left_out]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    got = corpus_pipeline.run(spark, d)
    if left_out == 4:
        assert "shard" not in got.columns
        return
    got = got.collect()
    ids = {r["doc_id"] for r in got}
    marks = [300 in ids, len(ids & set(range(100, 110))) > 0 and len(ids & set(range(10))) == 10, len(ids & set(range(200, 205))) > 0,
             None]
    if left_out < 3:
        assert marks[left_out]
    assert [m for i, m in enumerate(marks[:3]) if i != left_out] == [False] * (3 - (left_out < 3))


def test_stage_tables_are_deleted(spark, sf_dir):
    from farelane import session
    before = set(session._STAGES)
    out = corpus_pipeline.run(spark, sf_dir[0])
    reads = {p.rsplit("/", 1)[0].split("/")[-1] for p in out.inputFiles()}
    left = {p.split("/")[-1] for p in set(session._STAGES) - before}
    assert left == reads and len(left) == 1


def test_stages(spark, sf_dir):
    d, rows, _ = sf_dir
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{d}/documents.parquet").withColumns({"node": F.lit(1), "cell": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        assert out.columns[:len(docs.columns)] == docs.columns and (name == "sharding" or len(out.columns) == len(docs.columns))
        assert stage(spark, docs.filter("false"), d).count() == 0
    for name, stage in corpus_pipeline.STAGES[3:]:
        assert stage(spark, docs, d).count() == len(rows)

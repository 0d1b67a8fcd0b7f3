import zlib
from collections import Counter

import numpy as np

from farelane.llm import sharding
from tests.llm import frames


def _check(rows, shards, total):
    by = Counter(r["shard"] for r in rows)
    sizes = [by.get(s, 0) for s in range(shards)]
    assert sum(sizes) == total and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_sizes_and_slots(spark):
    df = frames.docs(spark, [(i, f"text {i % 7}", "hot" if i % 3 else "s") for i in range(1003)])
    rows = sharding.shuffle_to_shards(df, 40, rows_per_partition=50).collect()
    _check(rows, 40, 1003)
    assert sorted(r["doc_id"] for r in rows) == list(range(1003))
    again = sharding.shuffle_to_shards(df, 40, rows_per_partition=50).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in again)


def test_odd_rows_and_clashing_names(spark):
    df = frames.with_clashes(frames.docs(spark, frames.odd_rows()))
    out = sharding.shuffle_to_shards(df, 5, rows_per_partition=3)
    assert out.columns[:len(df.columns)] == df.columns and out.columns[-2:] == ["shard_", "slot_"]
    rows = [r.asDict() | {"shard": r["shard_"], "slot": r["slot_"]} for r in out.collect()]
    _check(rows, 5, len(frames.odd_rows()))


def test_rows_alike_are_spread(spark):
    df = frames.docs(spark, [(1, "same text")] * 500 + [(i, "x") for i in range(2, 502)])
    rows = sharding.shuffle_to_shards(df, 10, rows_per_partition=100).collect()
    _check(rows, 10, 1000)
    assert all(25 <= n <= 75 for n in Counter(r["shard"] for r in rows if r["doc_id"] == 1).values())


def test_fewer_rows_than_shards_and_empty(spark):
    _check(sharding.shuffle_to_shards(frames.docs(spark, [(1, "a"), (2, "b")]), 40).collect(), 40, 2)
    assert sharding.shuffle_to_shards(frames.docs(spark, []), 40).collect() == []


def test_matrix_is_hypergeometric():
    sizes, shards = [30, 0, 50, 20], [25, 25, 25, 25]
    draws = np.array([sharding.communication_matrix(sizes, shards, s) for s in range(2000)])
    assert (draws.sum(axis=2) == sizes).all() and (draws.sum(axis=1) == shards).all()
    mean, var = draws[:, 0, 0].mean(), draws[:, 0, 0].var()
    assert abs(mean - 7.5) < 0.15  # 30 * 25 / 100
    assert abs(var - 30 * 0.25 * 0.75 * 70 / 99) < 0.35


def test_large_populations_by_inversion():
    rng = np.random.default_rng(0)
    x = np.array([sharding.hypergeometric(rng, 10 ** 10, 3 * 10 ** 10, 40_000) for _ in range(400)])
    assert abs(x.mean() - 10_000) < 15 and abs(x.std() - (40_000 * 0.25 * 0.75) ** 0.5) < 12
    assert sharding.hypergeometric(rng, 10 ** 10, 0, 5) == 5 and sharding.hypergeometric(rng, 0, 10 ** 10, 5) == 0


def test_any_row_reaches_any_shard(spark):
    df = frames.docs(spark, [(i, str(i)) for i in range(60)])
    seen = Counter()
    for seed in range(12):
        seen.update(r["shard"] for r in sharding.shuffle_to_shards(df, 6, seed=seed, rows_per_partition=20).collect() if r["doc_id"] < 10)
    assert len(seen) == 6 and max(seen.values()) < 45


def test_digest_columns(spark):
    out = {r["doc_id"]: r for r in sharding.shard_digest(frames.docs(spark, [(1, "été"), (2, None), (3, "")]), 2).collect()}
    assert (out[1]["size"], out[2]["size"], out[3]["size"]) == (5 + 16, 16, 16)
    assert out[1]["text_crc32"] == zlib.crc32("été".encode()) and out[2]["text_crc32"] == out[3]["text_crc32"] == 0
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in out.values())

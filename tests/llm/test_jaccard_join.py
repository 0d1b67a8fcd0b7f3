import numpy as np
import pytest

from farelane.llm import jaccard_join as jj
from farelane.llm.common import WordHashes, shingle_set
from farelane.llm.graph import components
from tests.llm import frames


def _brute(rows, threshold=0.8):
    h = WordHashes()
    texts = sorted({t for _, t in rows if t is not None})
    sets = {t: set(shingle_set(t, h).tolist()) for t in texts}
    near = {t: {u for u in texts if u != t and sets[t] and sets[u]
                and len(sets[t] & sets[u]) >= threshold * len(sets[t] | sets[u]) - 1e-9} for t in texts}
    least = {t: min((i for i, u in rows if u == t and i is not None), default=None) for t in texts}
    group = {}
    for t in texts:
        if t not in group:
            seen, todo = {t}, [t]
            while todo:
                for u in near[todo.pop()] - seen:
                    seen.add(u)
                    todo.append(u)
            for u in seen:
                group[u] = seen
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, i, 1, 0, i, 1))
        else:
            n = sum(u == t for _, u in rows)
            g = min((least[u] for u in group[t] if least[u] is not None), default=None)
            out.append((i, least[t] if least[t] is not None else i, n, len(near[t]), g if g is not None else i,
                        sum(u in group[t] for _, u in rows)))
    return sorted(out, key=str)


def _planted(seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, frames.words(rng, int(rng.integers(1, 120)))) for i in range(60)]
    base = frames.words(rng, 150).split()
    for i in range(100, 160):  # a hot group of near copies with 0 to 5 edits
        w = list(base)
        for _ in range(int(rng.integers(0, 6))):
            w[int(rng.integers(0, len(w)))] = f"e{rng.integers(0, 10 ** 6)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(base).upper() + "!") for i in range(20)]  # same words, other text
    rows += [(300 + i, rows[i][1]) for i in range(30)]
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_equals_brute_force(spark, block):
    rows = _planted()
    got = jj.near_duplicate_groups(frames.docs(spark, rows), recall=0.99999, block_classes=block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(rows)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in frames.odd_rows()]
    df = frames.with_clashes(frames.docs(spark, frames.odd_rows()))
    assert sorted((tuple(r) for r in jj.near_duplicate_groups(df).collect()), key=str) == _brute(rows)
    assert jj.near_duplicate_groups(frames.docs(spark, [])).count() == 0


def test_keep_one_per_group(spark):
    rows = _planted()
    df = frames.with_clashes(frames.docs(spark, rows + frames.odd_rows()))
    kept = jj.keep_one_per_group(df, recall=0.99999)
    assert kept.columns == df.columns
    got = kept.select("doc_id", "text").collect()
    want = _brute(rows)
    ids = {r["doc_id"] for r in got}
    assert {w[4] for w in want} <= ids and not ({w[0] for w in want} - {w[4] for w in want}) & ids
    odd = [(r["doc_id"], r["text"]) for r in got if r["doc_id"] is None or r["doc_id"] <= 10]
    assert sum(t is None for _, t in odd) == 2  # null texts stay
    assert sum(t == "" for _, t in odd) == 1 and sum(t == "short text" for _, t in odd) == 1
    assert jj.keep_one_per_group(frames.docs(spark, [])).count() == 0


def test_bands_reach_recall():
    bands, rows = jj.choose_bands(0.8, 0.999)
    assert bands * rows <= 320 and 1 - (1 - 0.8 ** rows) ** bands >= 0.999
    rng = np.random.default_rng(2)
    found = 0
    for _ in range(200):
        x = rng.integers(0, 2 ** 63, 360, dtype=np.uint64)
        a, b = x[:324], x[36:]  # similarity 0.8
        found += bool((jj.band_hashes(a, bands, rows) == jj.band_hashes(b, bands, rows)).any())
    assert found >= 197
    with pytest.raises(ValueError):
        jj.choose_bands(0.1, 0.999, 4)


def test_overlaps_across_chunks():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 50, 4000, 6000, 6000)]
    got = jj.overlaps(sets, sets[2:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets]


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: root(x) for x in parent}

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import merkle
from tests.llm import frames

COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _sha(s):
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}"


def _leaf(r, text):
    return _sha("".join(map(_field, (r["doc_id"], r["source"], r["lang"], r["n_chars"]))) + _field(text))


def _up(level):
    return [_sha("".join(level[i:i + 8])) for i in range(0, len(level), 8)]


def _tree(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append(_up(out[-1]))
    return out


def _siblings(tree, i):
    out = ""
    for level in tree[:-1]:
        a = i - i % 8
        out += "".join(x for j, x in enumerate(level[a:a + 8], a) if j != i)
        i //= 8
    return out


def _brute(rows):
    """Every version is a whole new tree."""
    rows = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r, _leaf(r, r["text"])))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))

    def whole(leaves):
        trees = {g: _tree(leaves[g]) for g in langs}
        return trees, _tree([trees[g][-1][0] for g in langs])

    leaves = {g: [x for _, x in groups[g]] for g in langs}
    trees, top = whole(leaves)
    root, out = top[-1][0], []
    for k, g in enumerate(langs):
        for i, (r, leaf) in enumerate(groups[g]):
            folded = root
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                bad = dict(leaves)
                bad[g] = [*leaves[g][:i], _leaf(r, low), *leaves[g][i + 1:]]
                folded = whole(bad)[1][-1][0]
            out.append((r["doc_id"], leaf, trees[g][-1][0], root, _sha(_siblings(trees[g], i) + _siblings(top, k)), folded, folded == root))
    return out


def _rows(rng, n, langs):
    return [(i, frames.words(rng, 6).replace("w1", "W1Ä"), f"l{i * i % langs}", "s", 9) for i in range(n)]


def _check(spark, rows, depth):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = merkle.document_manifest(df, depth)
    assert got.columns == COLS
    key = lambda t: tuple(map(str, t))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_brute(rows), key=key)


@pytest.mark.parametrize("n,langs,depth", [(300, 3, 1), (120, 20, 1), (64, 1, 2), (1, 1, 4)])
def test_equals_whole_new_trees(spark, n, langs, depth):
    _check(spark, _rows(np.random.default_rng(n), n, langs), depth)


def test_odd_rows(spark):
    rows = [(r[0], r[1], r[3] if len(r) > 3 else None, r[2], 5) for r in frames.odd_rows()]
    rows += [(None, "AB", None, None, None)] * 2 + [(9, "Other TEXT", "en", None, None), (12, "ÄÖ only", "EN", "s", 1), (15, "X", "", "s", 1)]
    _check(spark, rows, 1)


def test_clashing_columns_and_empty_table(spark):
    rows = _rows(np.random.default_rng(3), 40, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = df.withColumns({c: F.lit(1) for c in ("leaf", "digest", "changed", "tree", "pos", "root", "rank_", "block")})
    assert sorted(map(tuple, merkle.document_manifest(extra).collect())) == sorted(_brute(rows))
    none = merkle.document_manifest(df.filter("false"))
    assert none.columns == COLS and none.count() == 0


def test_versions_share_all_but_their_path(spark):
    """A version's copied nodes are the ancestors of its leaf; all else is the stored tree's."""
    rows = _rows(np.random.default_rng(5), 100, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    leaves = df.select("doc_id", "lang", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                       F.when(F.col("doc_id") == 77, F.sha2(F.lit("x").cast("binary"), 256)).alias("changed"))
    m = merkle.build_manifest(leaves, "lang", "doc_id", "digest", "changed", 1)
    got = {r["doc_id"]: r for r in merkle.versions(m, ["doc_id"]).collect()}
    assert [i for i, r in got.items() if r["copied"] is not None] == [77] and not got[77]["verified"]
    new = _tree([_sha("x") if i == 77 else got[i]["digest"] for i in range(100)])
    old = _tree([got[i]["digest"] for i in range(100)])
    assert got[77]["copied"] == [new[1][9], new[2][1], new[3][0]]
    assert sum(a != b for x, y in zip(new, old) for a, b in zip(x, y)) == 1 + len(got[77]["copied"])

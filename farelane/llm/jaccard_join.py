"""Near-duplicate join: Jaccard similarity of word 5-gram sets, by MinHash bands.

1. Rows of equal text form a class (MD5 of the text); one task pass over the
   whole texts makes a class's MinHash signature and folds it into bands.
2. Band hashes are shuffled; in each bucket every class is tied to the smallest
   one.  Ties, not pairs: a bucket of m classes gives m - 1.
3. Connected components of the ties gather all classes that share a bucket
   with one another, directly or through others, so every candidate pair lies
   in one component.  Most classes are in none.
4. The texts of those classes are read once more; within a component all pairs
   are verified on the full n-gram sets.  A component is cut into blocks of
   ``block_classes``; a task holds two blocks, counts the links of their
   classes and keeps a spanning forest of them.  No pair is ever a row.
5. Components of the forest edges are the groups of near duplicates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm.common import WordHashes, fresh, quoted, shingle_set
from farelane.llm.graph import components
from farelane.session import materialize

SHINGLE = 5
THRESHOLD = 0.8


def choose_bands(threshold: float = THRESHOLD, recall: float = 0.999, max_hashes: int = 320) -> tuple[int, int]:
    """(bands, rows): the most rows per band (fewest chance candidates) whose
    bands reach ``recall`` for a pair right at ``threshold`` within
    ``max_hashes`` hash functions."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for this threshold and recall")
    return best


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature of a shingle set."""
    rng = np.random.default_rng(5)
    k = bands * rows
    a = rng.integers(0, 2 ** 32, k, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 2 ** 32, k, dtype=np.uint32)
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(k, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        low = np.minimum(low, (a[:, None] * x[None, i:i + 512] + b[:, None]).min(axis=1))
    out = np.arange(bands, dtype=np.uint64)
    sig = low.reshape(bands, rows).astype(np.uint64)
    for j in range(rows):
        out = (out ^ sig[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def _signatures(bands: int, rows: int):
    @F.pandas_udf("array<bigint>")
    def signature(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for batch in texts:
            sets = (shingle_set(t, hashes, SHINGLE) for t in batch)
            yield pd.Series([band_hashes(s, bands, rows).view(np.int64) if len(s) else None for s in sets], dtype=object)
    return signature


@F.pandas_udf(T.BinaryType())
def _grams(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    hashes = WordHashes()
    for batch in texts:
        yield pd.Series([shingle_set(t, hashes, SHINGLE).tobytes() for t in batch], dtype=object)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    la, ra = np.concatenate(left), np.concatenate(right)
    li = np.repeat(np.arange(len(left)), [len(x) for x in left])
    ri = np.repeat(np.arange(len(right)), [len(x) for x in right])
    shared, lc = np.unique(la, return_counts=True)
    keep = np.isin(shared, ra)
    shared = shared[keep]
    out = np.zeros((len(left), len(right)), np.int64)
    lm, rm = np.isin(la, shared), np.isin(ra, shared)
    la, li, ra, ri = np.searchsorted(shared, la[lm]), li[lm], np.searchsorted(shared, ra[rm]), ri[rm]
    lo, ro = np.argsort(la, kind="stable"), np.argsort(ra, kind="stable")
    la, li, ra, ri = la[lo], li[lo], ra[ro], ri[ro]
    step = 4096  # shared n-grams at a time, as 0/1 matrices
    for at in range(0, len(shared), step):
        i0, i1 = np.searchsorted(la, [at, at + step])
        j0, j1 = np.searchsorted(ra, [at, at + step])
        x = np.zeros((len(left), min(step, len(shared) - at)), np.float32)
        y = np.zeros((len(right), x.shape[1]), np.float32)
        x[li[i0:i1], la[i0:i1] - at] = 1
        y[ri[j0:j1], ra[j0:j1] - at] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def _verify(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links of the classes of one block pair (i, j): within the block if
        i = j, else across.  Output: links, and the smallest class of the tree
        that a class has in the spanning forest of these links."""
        i, j = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
        pdf = pdf.sort_values("node", key=lambda s: s.map(bytes))
        names = [bytes(x) for x in pdf["node"]]
        sets = [np.frombuffer(x, np.uint64) for x in pdf["grams"]]
        blocks = pdf["block"].to_numpy()
        a = np.flatnonzero(blocks == i)
        b = a if i == j else np.flatnonzero(blocks == j)
        links, parent = np.zeros(len(sets), np.int64), list(range(len(sets)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if len(a) and len(b):
            n = np.array([len(s) for s in sets])
            both = overlaps([sets[x] for x in a], [sets[x] for x in b])
            near = both >= threshold * (n[a][:, None] + n[b][None, :] - both) - 1e-9
            if i == j:
                np.fill_diagonal(near, False)
                links[a] = near.sum(axis=1)
            else:
                links[a], links[b] = near.sum(axis=1), near.sum(axis=0)
            for x, y in zip(*np.nonzero(near)):
                p, q = root(a[x]), root(b[y])
                if p != q:
                    parent[max(p, q)] = min(p, q)
        return pd.DataFrame({"node": names, "links": links, "tree": [names[root(x)] for x in range(len(sets))],
                             "blocks": pdf["blocks"].to_numpy()})
    return run


def near_duplicate_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD,
                           recall: float = 0.999, max_hashes: int = 320, block_classes: int = 256) -> DataFrame:
    """One row per class of equal texts: ``node`` (MD5 of the text, binary),
    ``class_id`` (smallest doc_id), ``n_copies``, ``n_links`` (other classes
    with similarity of ``threshold`` or more), ``tree`` (smallest node of its
    group of linked classes).  Null texts have no class."""
    bands, rows = choose_bands(threshold, recall, max_hashes)
    src = docs.filter(quoted(text).isNotNull()).select(
        F.unhex(F.md5(quoted(text))).alias("node"), quoted(doc_id).alias("id"), quoted(text).alias("t"))
    signed = src.select("node", "id", _signatures(bands, rows)("t").alias("bands"))
    classes = materialize(signed.groupBy("node").agg(
        F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"), F.any_value("bands").alias("bands")))
    buckets = classes.filter(F.col("bands").isNotNull()).select("node", F.posexplode("bands").alias("band", "hash"))
    low = buckets.groupBy("band", "hash").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    ties = materialize(buckets.join(low, ["band", "hash"]).filter(F.col("node") != F.col("low"))
                       .select("node", "low").distinct())
    found = materialize(components(ties, "node", "low"))
    # blocks of about block_classes, by a hash of the class
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    n_blocks = F.ceil(F.col("m") / block_classes).cast("int")
    placed = (found.join(sizes, "component")
              .select("node", "component", n_blocks.alias("blocks"),
                      F.pmod(F.xxhash64("node"), n_blocks).cast("int").alias("block")))
    reps = classes.join(placed, "node").select("node", F.col("class_id").alias("id"), "component", "blocks", "block")
    texts = (src.join(reps.withColumnRenamed("node", "rep"), (F.col("node") == F.col("rep")) & src["id"].eqNullSafe(reps["id"]))
             .select("component", "node", "block", "blocks", "t").dropDuplicates(["node"]))
    sets = texts.select("component", "node", "block", "blocks", _grams("t").alias("grams"))
    pairs = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "component", "node", "block", "blocks", "grams",
        F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
    checked = materialize(pairs.groupBy("component", "bi", "bj").applyInPandas(
        _verify(threshold), "node binary, links long, tree binary, blocks int"))
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"), F.min("tree").alias("tree"), F.max("blocks").alias("blocks"))
    edges = checked.filter((F.col("blocks") > 1) & (F.col("node") != F.col("tree"))).select("node", "tree").distinct()
    wide = materialize(components(edges, "node", "tree"))
    links = (links.join(wide, "node", "left")
             .select("node", "n_links", F.when(F.col("blocks") > 1, F.coalesce("component", "node"))
                     .otherwise(F.col("tree")).alias("tree")))
    return (classes.drop("bands").join(links, "node", "left")
            .select("node", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("tree", "node").alias("tree")))


def near_duplicate_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``class_id`` (smallest doc_id of
    the equal texts), ``n_copies`` (rows of that text), ``n_links`` (other texts
    with similarity of 0.8 or more), ``group_id`` (smallest doc_id of all texts
    that links connect) and ``group_size`` (rows of the group).

    Null texts are each on their own: class and group are the row's own doc_id,
    one copy, no links.  Texts without a word (empty, signs only) are alike
    only to equal texts.  Texts of 1 to 4 words have one n-gram of all their
    words.  Repeated rows are copies.  An empty table gives an empty one."""
    classes = materialize(near_duplicate_classes(docs, text, doc_id, **options))
    groups = classes.groupBy("tree").agg(F.min("class_id").alias("group_id"), F.sum("n_copies").alias("group_size"))
    per_class = classes.join(groups, "tree").drop("tree")
    rows = docs.select(quoted(doc_id).alias("doc_id"), F.unhex(F.md5(quoted(text))).alias("node"))
    return rows.join(per_class, "node", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))


def keep_one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: a row with the
    smallest doc_id of the group.  Null texts all stay."""
    node, tree, rid = fresh(docs, "node", "tree", "rep_id")
    classes = materialize(near_duplicate_classes(docs, text, doc_id, **options))
    first = classes.groupBy("tree").agg(
        F.min(F.struct(F.col("class_id").isNull().alias("z"), F.col("class_id").alias("i"), F.col("node").alias("n"))).alias("first"))
    reps = first.select(F.col("first.n").alias(node), F.col("first.i").alias(rid))
    marked = docs.withColumn(node, F.unhex(F.md5(quoted(text))))
    cond = (marked[node] == reps[node]) & quoted(doc_id).eqNullSafe(quoted(rid))
    kept = marked.join(reps.select(quoted(node), quoted(rid)), cond, "left_semi").dropDuplicates([node]).drop(node)
    return kept.unionByName(docs.filter(quoted(text).isNull()))

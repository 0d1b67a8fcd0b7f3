"""Embedding near-dedup: int8 quantised tile products with per-vector error bounds.

1. A vector x is made a unit vector u and quantised: scale s = max |u_i| / 127,
   int8 codes q = round(u / s), and the length of what is lost, e = |u - s q|,
   measured, not estimated.  For two vectors (Cauchy-Schwarz)
       |u.v - s_u s_v q_u.q_v| <= min(|s_u q_u| e_v + e_u, |s_v q_v| e_u + e_v).
   Equal vectors are one class; copies link with each other by definition.
2. Classes are dealt to groups; every pair of groups is a task, which multiplies
   int8 codes tile by tile (exact integers, by a float32 matrix product).  Only
   the codes travel to the tasks.  A pair whose lower bound reaches the threshold is a link, one whose
   upper bound does not is none; classes with a pair in between are flagged.
3. The full vectors of flagged classes go to the same pairs of groups, where
   only the pairs in between are computed in double precision.
4. A task returns link counts and a spanning forest of its links, never pairs.
   Connected components of the forests are the groups of near duplicates.

The work is a tile product for every pair of classes (64 dimensions: some 4 ns
of one core a thousand pairs), so it grows with the square of the classes; a
class is copied to (classes / ``group_rows``) tasks, 90 bytes each.  No task
holds more than two groups.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm.graph import components
from farelane.session import materialize

THRESHOLD = 0.9
#: Rows of a tile; a product is TILE x TILE float32.
TILE = 2048
#: Dimensions whose int8 products sum up exactly in float32 (127 * 127 * 1040 < 2 ** 24).
EXACT_DIMS = 1040
#: For rounding in double precision (a bound's own rounding is some 1e-15).
SLACK = 1e-12


def norms(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows scaled by a power of two where their squares would leave the range
    of doubles, lengths of the scaled rows)."""
    top = np.abs(x).max(axis=1)
    far = (top > 1e100) | (top < 1e-100)
    if far.any():
        x = x.copy()
        x[far] = np.ldexp(x[far], -np.frexp(top[far])[1][:, None])
    return x, np.sqrt((x * x).sum(axis=1))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes int8, scales, errors, lengths of the quantised vectors) of the
    rows of ``x`` (finite, none zero)."""
    x, n = norms(x)
    u = x / n[:, None]
    s = np.abs(u).max(axis=1) / 127
    q = np.rint(u / s[:, None])
    back = s[:, None] * q
    return (q.astype(np.int8), s, np.sqrt(((u - back) ** 2).sum(axis=1)) + SLACK, np.sqrt((back * back).sum(axis=1)) + SLACK)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of two sets of int8 codes."""
    if a.shape[1] <= EXACT_DIMS:
        return a.astype(np.float32) @ b.astype(np.float32).T
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, i:i + EXACT_DIMS].astype(np.float32) @ b[:, i:i + EXACT_DIMS].astype(np.float32).T
    return out


class Side:
    """The codes of one group in a task, sorted by scale so that a tile's
    scales are alike."""

    def __init__(self, pdf: pd.DataFrame, at: np.ndarray):
        s = pdf["s"].to_numpy()[at]
        order = np.argsort(s, kind="stable")
        self.at = at[order]
        self.s = s[order]
        self.e = pdf["e"].to_numpy()[self.at]
        self.n = pdf["len"].to_numpy()[self.at]
        self.q = np.frombuffer(b"".join(pdf["q"].to_numpy()[self.at]), np.int8).reshape(len(at), -1) if len(at) else np.empty((0, 1), np.int8)

    def tile(self, i: int) -> slice:
        return slice(i, min(i + TILE, len(self.at)))


def tile_pairs(a: Side, b: Side, same: bool, threshold: float):
    """(left rows, right rows, sure) of all pairs possibly at ``threshold``, a
    tile at a time; ``sure`` says that the lower bound reaches it."""
    for i in range(0, len(a.at), TILE):
        ta = a.tile(i)
        for j in range(i if same else 0, len(b.at), TILE):
            tb = b.tile(j)
            g = exact_products(a.q[ta], b.q[tb])
            # rows none of whose products could do, by the tile's largest scale and error
            need = (threshold - SLACK - a.e[ta] - a.n[ta] * b.e[tb].max()) / (a.s[ta] * b.s[tb][-1])
            rows = np.flatnonzero((g.max(axis=1) >= need * (1 - 1e-6)) | (need <= 0))
            if not len(rows):
                continue
            la, cos = np.arange(ta.start, ta.stop)[rows], g[rows].astype(np.float64)
            cos *= a.s[la][:, None] * b.s[tb][None, :]
            err = np.minimum(a.n[la][:, None] * b.e[tb][None, :] + a.e[la][:, None],
                             b.n[tb][None, :] * a.e[la][:, None] + b.e[tb][None, :]) + SLACK
            hit = cos + err >= threshold
            if same and i == j:
                hit &= np.arange(tb.start, tb.stop)[None, :] > la[:, None]
            x, y = np.nonzero(hit)
            if len(x):
                yield a.at[la[x]], b.at[tb.start + y], (cos - err)[x, y] >= threshold


class Links:
    """Link counts and a spanning forest over the rows of a task."""

    def __init__(self, copies: np.ndarray):
        self.copies = copies.astype(np.float64)
        self.count = np.zeros(len(copies))
        self.tree = np.arange(len(copies))

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        n = len(self.count)
        self.count += np.bincount(x, self.copies[y], n) + np.bincount(y, self.copies[x], n)
        while True:
            p, q = self.tree[x], self.tree[y]
            new = p != q
            if not new.any():
                return
            x, y, p, q = x[new], y[new], p[new], q[new]
            np.minimum.at(self.tree, np.maximum(p, q), np.minimum(p, q))
            while not np.array_equal(up := self.tree[self.tree], self.tree):
                self.tree = up


RESULT = "cid long, links long, root long"


def _sides(pdf: pd.DataFrame) -> tuple[Side, Side, bool]:
    i, j, g = int(pdf["gi"].iloc[0]), int(pdf["gj"].iloc[0]), pdf["g"].to_numpy()
    a = Side(pdf, np.flatnonzero(g == i))
    return a, a if i == j else Side(pdf, np.flatnonzero(g == j)), i == j


def _tiles(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Sure links of a pair of groups; flags of the rows with a pair in between."""
        a, b, same = _sides(pdf)
        links, flag = Links(pdf["copies"].to_numpy()), np.zeros(len(pdf), bool)
        for x, y, sure in tile_pairs(a, b, same, threshold):
            links.add(x[sure], y[sure])
            flag[x[~sure]] = flag[y[~sure]] = True
        out, cid = (links.count > 0) | flag, pdf["cid"].to_numpy()
        return pd.DataFrame({"cid": cid[out], "links": links.count[out].astype(np.int64), "root": cid[links.tree[out]],
                             "flag": flag[out], "gi": pdf["gi"].to_numpy()[out], "gj": pdf["gj"].to_numpy()[out]})
    return run


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x, nx = norms(x)
    y, ny = norms(y)
    return (x * y).sum(axis=1) / (nx * ny)


def _recompute(threshold: float, step: int = 32_768):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links among the pairs in between, in double precision."""
        a, b, same = _sides(pdf)
        links, cid = Links(pdf["copies"].to_numpy()), pdf["cid"].to_numpy()
        full = np.frombuffer(b"".join(pdf["raw"]), np.float64).reshape(len(pdf), -1)
        for x, y, sure in tile_pairs(a, b, same, threshold):
            x, y = x[~sure], y[~sure]
            for k in range(0, len(x), step):
                ok = cosines(full[x[k:k + step]], full[y[k:k + step]]) >= threshold
                links.add(x[k:k + step][ok], y[k:k + step][ok])
        out = links.count > 0
        return pd.DataFrame({"cid": cid[out], "links": links.count[out].astype(np.int64), "root": cid[links.tree[out]]})
    return run


_CODES = T.StructType([T.StructField("raw", T.BinaryType()), T.StructField("q", T.BinaryType()),
                       *[T.StructField(c, T.DoubleType()) for c in ("s", "e", "len")]])


@F.pandas_udf(_CODES)
def _quantise(vectors: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({"raw": None, "q": None, "s": 0.0, "e": 0.0, "len": 0.0}, index=range(len(vectors)), dtype=object)
    dims = np.fromiter((0 if v is None else len(v) for v in vectors), np.int64, len(vectors))
    for dim in np.unique(dims[dims > 0]):
        at = np.flatnonzero(dims == dim)
        x = np.stack(vectors.iloc[at].to_list()).astype(np.float64) + 0.0  # -0.0 is 0.0
        at, x = (z[np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)] for z in (at, x))
        if len(at):
            q, s, e, n = quantised(x)
            for c, col in enumerate(([v.tobytes() for v in x], [v.tobytes() for v in q], s, e, n)):
                out.iloc[at, c] = pd.Series(col, index=at, dtype=object)
    return out.astype({"s": float, "e": float, "len": float})


def near_duplicate_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
                           group_rows: int = 131_072, least_groups: int = 6) -> DataFrame:
    """One row per row of ``df``: ``vec_id``, ``n_links`` (other rows whose
    cosine is ``threshold`` or more), ``component_id`` (smallest vec_id that
    links reach, its own included), ``kept`` (vec_id is component_id).

    Vectors that are null, empty, all zero or hold null or non-finite entries
    link with nothing, nor do vectors of different lengths.  Equal vectors
    link, rows that repeat an id too (each row counts).  A null vec_id counts
    as a row but names no component; it is kept only if no row with an id is
    reached.  An empty table gives an empty one."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    x = F.col(embedding).cast("array<double>")
    whole = F.when(F.forall(x, lambda v: v.isNotNull()), x)
    coded = df.select(F.col(vec_id).cast("long").alias("vec_id"), _quantise(whole).alias("c"))
    rows = materialize(coded.select("vec_id", "c.*", F.md5("c.raw").alias("key")))
    found = rows.filter(F.col("raw").isNotNull()).groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"),
        F.any_value(F.struct("raw", "q", "s", "e", "len")).alias("c"))
    # numbered once written: the numbers hang on the tasks that make them
    classes = materialize(found.select(F.monotonically_increasing_id().alias("cid"), "key", "first", "copies", "c.*",
                                       F.octet_length("c.q").alias("dim")))
    n = classes.count()
    groups = max(least_groups, math.ceil(n / group_rows))
    group = F.pmod(F.xxhash64("cid"), F.lit(groups)).cast("int")
    codes = classes.select("cid", "copies", "q", "s", "e", "len", "dim", group.alias("g"))
    sent = codes.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
        "cid", "copies", "q", "s", "e", "len", "dim", "g", F.least("g", "o").alias("gi"), F.greatest("g", "o").alias("gj"))
    sure = materialize(sent.groupBy("dim", "gi", "gj").applyInPandas(_tiles(threshold), RESULT + ", flag boolean, gi int, gj int"))
    doubt = sure.filter("flag").select("cid", "gi", "gj").join(
        classes.select("cid", "copies", "raw", "q", "s", "e", "len", "dim", group.alias("g")), "cid")
    close = materialize(doubt.groupBy("dim", "gi", "gj").applyInPandas(_recompute(threshold), RESULT))
    both = sure.select("cid", "links", "root").unionByName(close)
    links = both.groupBy("cid").agg(F.sum("links").alias("links"))
    trees = components(both.filter(F.col("cid") != F.col("root")), "cid", "root")
    named = materialize(classes.select("key", "cid", "first", "copies").join(links, "cid", "left")
                        .join(trees.withColumnRenamed("node", "cid"), "cid", "left")
                        .withColumn("component", F.coalesce("component", "cid")))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    per_class = materialize(named.join(least, "component").select(
        "key", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    rows = rows.select("vec_id", "key")
    # classes with over a thousandth of the rows each: fewer than 1,000, sent to the rows instead of gathering them
    hot = F.col("copies") > rows.count() // 1000 + 1
    big = rows.join(F.broadcast(per_class.filter(hot).drop("copies")), "key")
    rest = rows.join(F.broadcast(per_class.filter(hot).select("key")), "key", "left_anti").join(per_class.filter(~hot).drop("copies"), "key", "left")
    return big.unionByName(rest).select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))

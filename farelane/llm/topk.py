"""Exact top-k inner products by an M-tree of paged metric nodes.

An inner product becomes a distance by one more component: with M the largest
norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have
|q' - x'|^2 = |q|^2 + M^2 - 2 <q, x>, so the nearest x' has the largest score.

Index: routing vectors from a bounded sample (``sample`` rows) form the top
level; every row goes to its nearest one.  The rows of a routing vector are cut
into pages of about ``page_rows`` (by a hash of the id, so copies of one vector
spread too), and each page into leaf nodes with centre, covering radius,
distance to the parent, and the distance of every entry to the centre.  The
nodes are a written table.

Search: a query first searches its home page, which bounds its k-th score.
With that bound it goes to the pages of all routing vectors that may hold
better rows.  In a page, leaf nodes are visited best first; the stored
distances rule out nodes (|d(q, parent) - d(centre, parent)| - radius) and
entries (|d(q, centre) - d(x, centre)|) before their distances are computed.
Scores are exact integers; bounds have a margin for rounding, so ties stay.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.session import materialize

LEAF_ROWS = 128
MARGIN = 1e-6


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(256 x) of each component, as longs.  Rows with a null
    id or vector, or a null or non-finite component, are left out; rows alike
    in both count once."""
    x = F.col(embedding).cast("array<double>")
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return (df.select(F.col(vec_id).alias("vec_id"), x.alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).filter(
                F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
            .select("vec_id", F.transform("x", lambda e: F.floor(e * 256)).alias("v")).distinct())


def augmented(v: np.ndarray, m2: float) -> np.ndarray:
    v = v.astype(np.float64)
    rest = np.sqrt(np.maximum(0.0, m2 - (v * v).sum(axis=1)))
    return np.concatenate([v, rest[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, d2))


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``x`` far from each other: each next one is the farthest."""
    chosen = [0]
    d = distances(x, x[:1])[:, 0]
    while len(chosen) < n and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def _nearest(routing: dict[int, np.ndarray], m2: float):
    @F.pandas_udf("struct<pivot:int,dist:double>")
    def nearest(vs: pd.Series) -> pd.DataFrame:
        piv, dist = np.zeros(len(vs), np.int32), np.zeros(len(vs))
        dims = np.fromiter(map(len, vs), np.int64, len(vs))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            d = distances(augmented(np.stack(vs.iloc[at].to_list()), m2), routing[int(dim)])
            piv[at] = d.argmin(axis=1)
            dist[at] = d.min(axis=1)
        return pd.DataFrame({"pivot": piv, "dist": dist})
    return nearest


def _leaves(routing: dict[int, np.ndarray], m2: float):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        v = np.stack(pdf["v"].to_list()).astype(np.int64)
        ids, x = pdf["vec_id"].to_numpy(np.int64), augmented(v, m2)
        dim, pivot, slot = v.shape[1], int(pdf["pivot"].iloc[0]), int(pdf["slot"].iloc[0])
        centres = _spread(x, math.ceil(len(x) / LEAF_ROWS))
        d = distances(x, x[centres])
        own = d.argmin(axis=1)
        parent = distances(x[centres], routing[dim][pivot:pivot + 1])[:, 0]
        rows = []
        for j in range(len(centres)):
            m = np.flatnonzero(own == j)
            if len(m):
                m = m[np.argsort(d[m, j], kind="stable")]
                rows.append((dim, pivot, slot, j, x[centres[j]].tobytes(), float(parent[j]), float(d[m, j].max()),
                             ids[m].tobytes(), d[m, j].tobytes(), v[m].tobytes()))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in NODE.split(", ")])
    return build


NODE = ("dim int, pivot int, slot int, node int, centre binary, parent_dist double, radius double, "
        "ids binary, dists binary, vectors binary")


def search_page(nodes: pd.DataFrame, pivot: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, m2: float, k: int) -> list:
    """Best-first search of one page: per query, (row, vec_id, score) of its k
    best rows with a score of ``floor`` or more."""
    dim = queries.shape[1]
    centre = np.stack([np.frombuffer(x, np.float64) for x in nodes["centre"]])
    radius, parent = nodes["radius"].to_numpy(), nodes["parent_dist"].to_numpy()
    ids = [np.frombuffer(x, np.int64) for x in nodes["ids"]]
    dists = [np.frombuffer(x, np.float64) for x in nodes["dists"]]
    vecs = [np.frombuffer(x, np.int64).reshape(-1, dim) for x in nodes["vectors"]]
    q = queries.astype(np.float64)
    q2 = (q * q).sum(axis=1)
    qa = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
    to_pivot = distances(qa, pivot[None, :])[:, 0]
    eps = MARGIN * (math.sqrt(m2) + np.sqrt(q2) + 1)
    bound = np.abs(to_pivot[:, None] - parent[None, :]) - radius[None, :]
    out = []
    for i in range(len(q)):
        best_s, best_i = np.empty(0, np.int64), np.empty(0, np.int64)
        least = floor[i]
        limit = math.sqrt(max(0.0, q2[i] + m2 - 2 * least)) + eps[i] if least > -math.inf else math.inf
        for j in np.argsort(bound[i], kind="stable"):
            if bound[i, j] > limit:
                break
            dc = math.sqrt(max(0.0, float(((qa[i] - centre[j]) ** 2).sum())))
            if dc - radius[j] > limit:
                continue
            lo, hi = np.searchsorted(dists[j], [dc - limit - eps[i], dc + limit + eps[i]])  # entries are sorted
            if lo == hi:
                continue
            s, who = vecs[j][lo:hi] @ queries[i], ids[j][lo:hi]
            ok = (who != own[i]) & (s >= least)
            if not ok.any():
                continue
            best_s, best_i = np.concatenate([best_s, s[ok]]), np.concatenate([best_i, who[ok]])
            order = np.lexsort((best_i, -best_s))[:k]
            best_s, best_i = best_s[order], best_i[order]
            if len(best_s) == k and best_s[-1] > least:
                least = best_s[-1]
                limit = math.sqrt(max(0.0, q2[i] + m2 - 2 * least)) + eps[i]
        out.extend((i, a, b) for a, b in zip(best_i.tolist(), best_s.tolist()))
    return out


def _search(routing: dict[int, np.ndarray], m2: float, k: int):
    def run(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        cols = ["query_id", "qhash", "vec_id", "score"]
        if not len(nodes) or not len(queries):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in cols})
        dim, p = int(nodes["dim"].iloc[0]), int(nodes["pivot"].iloc[0])
        v = np.stack(queries["v"].to_list()).astype(np.int64)
        qid, qh = queries["query_id"].to_numpy(np.int64), queries["qhash"].to_numpy(np.int64)
        got = search_page(nodes, routing[dim][p], v, qid, queries["floor"].to_numpy(np.float64), m2, k)
        return pd.DataFrame([(qid[i], qh[i], a, s) for i, a, s in got], columns=cols)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, routing_vectors: int = 32, sample: int = 256,
          page_rows: int = 2048, query_block: int = 1024) -> DataFrame:
    """The ``k`` rows of ``vectors`` (vec_id long, v array<long>) with the
    largest integer inner product with each query (same columns), but for rows
    of the query's own id: ``query_id``, ``rank`` (from 1), ``vec_id``,
    ``score``.  Ties go to the smaller vec_id.

    Vectors of another length than the query's take no part in its result.  A
    query with fewer candidates gets all of them.  Components are expected
    within +-2^26, so that scores fit a long.  Empty tables give an empty
    result."""
    spark = vectors.sparkSession
    out = "query_id long, qhash long, vec_id long, score long"
    vectors = materialize(vectors)
    norm2 = F.aggregate("v", F.lit(0).cast("long"), lambda a, e: a + e * e)
    m2 = vectors.agg(F.max(norm2)).first()[0]
    if m2 is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    routing: dict[int, np.ndarray] = {}
    first = vectors.withColumn("o", F.row_number().over(Window.partitionBy(F.size("v"), F.pmod(F.xxhash64("vec_id"), F.lit(64)))
                                                        .orderBy(F.xxhash64(F.lit(7), "vec_id"), "vec_id")))
    for r in first.filter(F.col("o") <= max(1, sample // 64)).select("v").collect():
        routing.setdefault(len(r[0]), []).append(r[0])
    routing = {d: augmented(np.array(sorted(v)), m2) for d, v in routing.items()}
    routing = {d: x[_spread(x, routing_vectors)] for d, x in routing.items()}
    near = F.col("near")
    placed = vectors.withColumn("near", _nearest(routing, m2)("v")).select(
        "vec_id", "v", F.size("v").alias("dim"), near.pivot.alias("pivot"), near.dist.alias("dist"))
    placed = materialize(placed)
    tops = placed.groupBy("dim", "pivot").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("top_radius"))
    tops = tops.withColumn("slots", F.ceil(F.col("n") / page_rows).cast("int")).drop("n")
    paged = placed.drop("dist").join(F.broadcast(tops), ["dim", "pivot"])  # routing vectors: bounded
    paged = paged.withColumn("slot", F.pmod(F.xxhash64("vec_id"), F.col("slots")).cast("int"))
    nodes = materialize(paged.select("vec_id", "v", "dim", "pivot", "slot").groupBy("dim", "pivot", "slot")
                        .applyInPandas(_leaves(routing, m2), NODE))
    # queries: home page first
    asked = materialize(queries.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("qhash"), "v",
                                       F.size("v").alias("dim"))
                        .filter(F.col("dim").isin(list(routing))).withColumn("near", _nearest_query(routing)("v")))
    tops = materialize(tops)
    home = (asked.withColumn("pivot", F.col("near.pivot")).join(F.broadcast(tops), ["dim", "pivot"])
            .select("dim", "pivot", F.pmod(F.xxhash64("query_id"), F.col("slots")).cast("int").alias("slot"),
                    F.lit(0).alias("block"), "query_id", "qhash", "v", F.lit(float("-inf")).alias("floor")))
    keys = ["dim", "pivot", "slot", "block"]
    found = (nodes.withColumn("block", F.lit(0)).groupBy(*keys).cogroup(home.groupBy(*keys))
             .applyInPandas(_search(routing, m2, k), out))
    floors = materialize(found.groupBy("query_id", "qhash").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")))
    # then the pages of all routing vectors whose ball may hold as good a row
    blocks = max(1, math.ceil(asked.count() / query_block))
    q2 = F.aggregate("v", F.lit(0).cast("long"), lambda a, e: a + e * e).cast("double")
    bounded = (asked.join(floors, ["query_id", "qhash"], "left")
               .withColumn("floor", F.when(F.col("n") >= k, F.col("kth").cast("double")).otherwise(F.lit(float("-inf"))))
               .withColumn("limit", F.when(F.col("n") >= k, F.sqrt(F.greatest(F.lit(0.0), q2 + m2 - 2 * F.col("kth")))
                                           + MARGIN * (F.sqrt(q2) + math.sqrt(m2) + 1))
                           .otherwise(F.lit(float("inf"))))
               .select("dim", "query_id", "qhash", "v", "floor", "limit", F.posexplode("near.all").alias("pivot", "d")))
    reach = (bounded.join(F.broadcast(tops), ["dim", "pivot"])
             .filter(F.col("d") - F.col("top_radius") <= F.col("limit"))
             .select("dim", "pivot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
                     F.pmod(F.xxhash64(F.lit(3), "query_id"), F.lit(blocks)).cast("int").alias("block"),
                     "query_id", "qhash", "v", "floor"))
    # a page travels to the blocks with a query that reaches it, to no others
    reach = materialize(reach)
    wanted = reach.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(*[F.col(c).alias(f"to_{c}") for c in keys])
    at = (F.col("to_dim") == F.col("dim")) & (F.col("to_pivot") == F.col("pivot")) & (F.col("to_slot") == F.col("slot"))
    copies = nodes.join(wanted, at).select(*nodes.columns, F.col("to_block").alias("block"))
    hits = copies.groupBy(*keys).cogroup(reach.groupBy(*keys)).applyInPandas(_search(routing, m2, k), out)
    w = Window.partitionBy("query_id", "qhash").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _nearest_query(routing: dict[int, np.ndarray]):
    @F.pandas_udf("struct<pivot:int,all:array<double>>")
    def nearest(vs: pd.Series) -> pd.DataFrame:
        rows = []
        for v in vs:
            q = np.concatenate([np.asarray(v, np.float64), [0.0]])
            d = distances(q[None, :], routing[len(v)])[0]
            rows.append((int(d.argmin()), d))
        return pd.DataFrame(rows, columns=["pivot", "all"])
    return nearest

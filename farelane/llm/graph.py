"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.session import materialize

#: Parts, at least, that the edges of one node are cut into.
SALTS = 64


def _with_smallest(edges: DataFrame, salts: int) -> DataFrame:
    """``edges`` (u, v) with ``m``, the smallest v of each u.  A node's edges
    are cut into ``salts`` parts by their other end: each part finds its
    smallest v, and the smallest of those goes back to the parts, so a node
    with a third of all edges is no task of its own."""
    cut = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
    parts = cut.groupBy("u", "part").agg(F.min("v").alias("m"))
    low = parts.groupBy("u").agg(F.min("m").alias("m"))
    back = parts.select("u", "part").join(low, "u")
    return cut.join(back, ["u", "part"]).select("u", "v", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b", salts: int | None = None) -> DataFrame:
    """(node, component): the smallest node that is reachable, for every node
    of an edge; edges have no direction, repeats and loops don't matter.

    Alternating large-star and small-star rounds; each round is two
    aggregations, written to the shared stage folder, until the edges point at
    the smallest nodes only (a few rounds: their number grows with the
    logarithm of the longest path).  Nothing but the change count reaches the
    driver."""
    if salts is None:
        salts = max(SALTS, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    nodes = None
    last = None
    while True:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours join the smallest one
        large = (_with_smallest(both, salts).filter(F.col("v") >= F.col("u"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # small star: a node and its smaller neighbours join the smallest one
        down = _with_smallest(large.filter(F.col("u") != F.col("v")), salts)
        small = (down.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v")))).distinct()
        cur = materialize(small)
        if nodes is None:
            nodes = edges.select(F.col(a).alias("node")).union(edges.select(F.col(b).alias("node"))).distinct()
        now = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    roots = cur.filter(F.col("u") != F.col("v"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select(
        "node", F.coalesce("v", "node").alias("component"))

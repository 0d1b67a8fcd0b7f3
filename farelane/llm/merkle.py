"""Merkle manifest of a table: a persistent, path-copying hash tree.

A row is a leaf.  The leaves of a group (a language), in the order of the key,
are the lowest level of its tree; every ``ARITY`` consecutive nodes have one
parent, until one node, the group's subroot, is left.  The subroots, in the
order of the groups, are the leaves of the upper tree, whose root is the
table's.

Building.  A node's place in its level is its rank, counted by range
partitions.  An aligned block, the ``ARITY ** DEPTH`` nodes below one node,
is one group of a task, whatever the group's size; a round of blocks turns
rows into a 4,096th of them, so a tree of 1e11 leaves has three rounds, and the
upper tree is built by the same rounds.

Paths.  Each block gets its path to the root (the siblings on every level) as
one row, from the top round down.

Versions.  A changed leaf makes a new version of the tree that shares every
node with the old one but the leaf's ancestors.  In the leaf's block those are
copied next to the block's stored nodes; above it the version goes on over the
block's path, so that the versions of a hot group never meet in one task: a
task holds a block's 4,096 leaves and their versions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.ranges import range_rank
from farelane.session import materialize

ARITY = 8
#: Levels of a block.
DEPTH = 4


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def field_text(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon, the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(c) for c in columns]).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed."""
    upper = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
    return F.translate(text, upper, upper.lower())


def levels_of(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    k = 0
    while n > 1:
        n, k = -(-n // ARITY), k + 1
    return k


def block_levels(leaves: list[str], levels: int) -> list[list[str]]:
    """The stored nodes of a block: its leaves and ``levels`` levels above."""
    out = [leaves]
    for _ in range(levels):
        low = out[-1]
        out.append([sha("".join(low[i:i + ARITY])) for i in range(0, len(low), ARITY)])
    return out


def path_of(nodes: list[list[str]], at: int) -> list[tuple[str, str]]:
    """Digests left and right of the node in its run, level by level."""
    out = []
    for level in nodes[:-1]:
        run = at - at % ARITY
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + ARITY])))
        at //= ARITY
    return out


def copied_path(leaf: str, path: list[tuple[str, str]]) -> list[str]:
    """The new nodes of a version: the changed leaf's ancestors, bottom up, made
    from its own digest and the shared siblings."""
    out = []
    for left, right in path:
        leaf = sha(left + leaf + right)
        out.append(leaf)
    return out


def _stored(nodes: pd.DataFrame, depth: int) -> list[list[str]]:
    """Levels of the block that ``nodes`` (sorted) are the leaves of.  One that
    isn't its tree's only block is always as deep as a whole one."""
    return block_levels(nodes["digest"].to_list(), depth if nodes["block"].iloc[0] > 0 else levels_of(len(nodes)))


def _roots(depth: int):
    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        return pd.DataFrame({"tree": [nodes["tree"].iloc[0]], "pos": [nodes["block"].iloc[0]], "digest": _stored(nodes, depth)[-1]})
    return run


def _paths(depth: int):
    def run(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        """Path of every node of a block: within the block, then the block's own."""
        nodes = nodes.sort_values("pos")
        levels = _stored(nodes, depth)
        up_l, up_r = (list(above[c].iloc[0]) for c in ("lefts", "rights"))
        own = [path_of(levels, i) for i in range(len(nodes))]
        return pd.DataFrame({"tree": nodes["tree"], "pos": nodes["pos"], "lefts": [[a for a, _ in p] + up_l for p in own],
                             "rights": [[b for _, b in p] + up_r for p in own]})
    return run


NODE = "tree string, pos long, digest string"
PATH = "tree string, pos long, lefts array<string>, rights array<string>"


def _blocked(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY ** depth}"))


def build(leaves: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """Rounds of ``leaves`` (tree, pos from 0, digest): the leaves themselves,
    the roots of their blocks, the roots of blocks of those, ... until every
    tree has one node.  Each round but the first is a written table."""
    rounds = [leaves]
    while (rounds[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        rounds.append(materialize(_blocked(rounds[-1], depth).groupBy("tree", "block").applyInPandas(_roots(depth), NODE)))
    return rounds


def paths(rounds: list[DataFrame], tops: DataFrame, stop: int = 0, depth: int = DEPTH) -> DataFrame:
    """Path to the root of every node of round ``stop``.  ``tops`` has the path
    of every tree's one node: (tree, pos = 0, lefts, rights)."""
    cur = tops.select("tree", "pos", "lefts", "rights")
    for nodes in reversed(rounds[stop:-1]):
        above = cur.withColumnRenamed("pos", "block").groupBy("tree", "block")
        cur = materialize(_blocked(nodes, depth).groupBy("tree", "block").cogroup(above).applyInPandas(_paths(depth), PATH))
    return cur


@dataclass
class Manifest:
    """``leaves``: the rows' columns kept, ``tree``, ``pos``, ``digest`` (and
    ``changed``, null where the row isn't).  ``blocks``: nodes over the rows'
    blocks with their path to the root.  ``subroots``: (tree, digest).
    ``root``: the table's digest, null for an empty table.  ``depth``: levels
    of a block."""

    leaves: DataFrame
    blocks: DataFrame
    subroots: DataFrame
    root: str | None
    depth: int


def build_manifest(leaves: DataFrame, group: str, key: str, digest: str, changed: str, depth: int = DEPTH) -> Manifest:
    """Manifest of ``leaves``: a row a leaf, ``digest`` its hash, ``changed``
    the hash of its changed form or null.  Groups and keys may be null (first);
    rows of one key follow each other by digest, so repeated rows are leaves of
    their own whose order doesn't matter."""
    empty = F.expr("CAST(array() AS array<string>)")
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    own = [c for c in leaves.columns if c not in (group, digest, changed)]
    # written first: the range bounds are sampled, which would hash every text once more
    rows = materialize(leaves.select(*own, tree.alias("tree"), F.col(digest).alias("digest"), F.col(changed).alias("changed")))
    placed = materialize(range_rank(rows, ["tree"], [key, "digest"], "rank_").withColumn("pos", F.col("rank_") - 1).drop("rank_"))
    rounds = build(placed.select("tree", "pos", "digest"), depth)
    subroots = rounds[-1].select("tree", "digest")
    upper = materialize(range_rank(subroots, [], ["tree"], "rank_")
                        .select(F.lit("").alias("tree"), (F.col("rank_") - 1).alias("pos"), "digest", F.col("tree").alias("of")))
    above = build(upper.select("tree", "pos", "digest"), depth)
    root = above[-1].first()
    tops = above[-1].select("tree", "pos", empty.alias("lefts"), empty.alias("rights"))
    of_tree = paths(above, tops, depth=depth).join(upper.select("pos", "of"), "pos").select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "lefts", "rights")
    # every tree's blocks of leaves; a tree of one leaf is its own block root
    if len(rounds) == 1:
        blocks = of_tree
    else:
        blocks = paths(rounds, of_tree, 1, depth)
    return Manifest(placed, materialize(blocks), subroots, root["digest"] if root else None, depth)


PROOF = "digest string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied array<string>"


def _versions(root: str, keep: list[str], depth: int):
    def run(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        leaves, changed = nodes["digest"].to_list(), nodes["changed"].to_list()
        levels = _stored(nodes, depth)
        up = list(zip(above["lefts"].iloc[0], above["rights"].iloc[0]))
        proof, folded, copies = [], [], []
        for i, leaf in enumerate(leaves):
            path = path_of(levels, i) + up
            proof.append(sha("".join(a + b for a, b in path)))
            new = changed[i] if isinstance(changed[i], str) else leaf
            copied = copied_path(new, path)
            folded.append(copied[-1] if copied else new)
            copies.append(copied if isinstance(changed[i], str) else None)
        out = nodes[keep + ["digest"]].copy()
        return out.assign(subroot=above["subroot"].iloc[0], root=root, proof_sha256=proof, folded_root=folded,
                          verified=[f == root for f in folded], copied=copies)
    return run


def versions(m: Manifest, keep: list[str]) -> DataFrame:
    """One row per leaf: the columns ``keep``, ``digest``, ``subroot``,
    ``root``, ``proof_sha256`` (hash of the siblings, level by level, left to
    right), ``folded_root`` (root of the version that the changed leaf makes; of
    the leaf itself if it isn't changed), ``verified`` (equals the root) and
    ``copied`` (the version's new nodes, bottom up; null if nothing changed)."""
    spark = m.leaves.sparkSession
    types = {f.name: f.dataType.simpleString() for f in m.leaves.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", " + PROOF
    if m.root is None:
        return spark.createDataFrame([], schema)
    leaves = _blocked(m.leaves, m.depth).select(*keep, "digest", "changed", "tree", "pos", "block")
    above = m.blocks.join(m.subroots.select("tree", F.col("digest").alias("subroot")), "tree").withColumnRenamed("pos", "block")
    return leaves.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInPandas(_versions(m.root, keep, m.depth), schema)


def document_manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The manifest of ``documents``, with every third document (where 3
    divides the unsigned CRC-32 of its decimal doc_id) tampered with: A-Z of
    its text are lower-cased.  Columns: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    Every row is a leaf.  Nulls are hashed as ``-``; a null lang is a group of
    its own, the first; null doc_ids come first in their group and aren't
    tampered with.  Repeated rows are leaves of their own; rows of one doc_id
    stand in the order of their leaf digests.  Texts are hashed whole, of any
    length; an empty one is ``0:``.  A table of one row is its own root, and
    its proof the hash of nothing.  Columns other than doc_id, source, lang,
    n_chars and text play no part.  An empty table gives an empty result."""
    names = ["doc_id", "source", "lang", "n_chars"]
    plain = [F.col(c) for c in names]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("doc_id", "lang", leaf_digest([*plain, F.col("text")]).alias("digest"),
                         F.when(hit, leaf_digest([*plain, lower_ascii(F.col("text"))])).alias("changed"))
    m = build_manifest(leaves, "lang", "doc_id", "digest", "changed", depth)
    return versions(m, ["doc_id"]).select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256",
                                          "folded_root", "verified")

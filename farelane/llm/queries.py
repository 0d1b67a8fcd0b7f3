"""Registered queries of the corpus operators: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import (decontam, embed_dedup, html_extract, jaccard_join, langid, licenses, merkle, mixing, quality, sharding,
                          token_hist, topk, whitening)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _fold(n: int):
    """The remainder that says whether a document is held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_read(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(_read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"), licenses.train())


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_groups(_read(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held = F.coalesce(_fold(5) == 0, F.lit(False))
    model = langid.fit(docs.filter(_fold(5) != 0))
    return langid.identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_hist.length_histogram(_read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("text_hash")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _read(spark, sf_dir, "labels").select("doc_id", "quality").filter("quality is not null and doc_id is not null")
    learn = docs.filter(_fold(3) != 1).select("doc_id").distinct()
    good = learn.join(labels.filter("quality = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    rest = learn.join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    net = quality.fit(quality.bounded_sample(docs, good), quality.bounded_sample(docs, rest))
    held = F.coalesce(_fold(3) == 1, F.lit(False))
    return quality.scored(docs.select("doc_id", held.alias("held_out"), "text"), net).drop("text")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents").select("doc_id", "source"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_digest(_read(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(_read(spark, sf_dir, "documents"))


def op13_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicate_vectors(_read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding, "op2_topk": op2_topk, "op3_licenses": op3_licenses,
    "op4_jaccard_join": op4_jaccard_join, "op5_langid": op5_langid, "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination, "op8_quality": op8_quality, "op9_html": op9_html,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening, "op12_merkle": op12_merkle, "op13_embed_dedup": op13_embed_dedup, "pipeline": pipeline,
}

SQL: dict[str, str] = {}

SQL["op2_topk"] = """
WITH ok AS (
  SELECT DISTINCT vec_id, [floor(x::DOUBLE * 256)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM ok q JOIN ok c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_SHINGLES = """
  SELECT {key}, unnest(CASE WHEN len(w) >= 5
      THEN [array_to_string(w[i:i + 4], chr(1)) for i in range(1, len(w) - 3)]
      WHEN len(w) >= 1 THEN [array_to_string(w, chr(2))] ELSE [] END) AS g
  FROM {table}"""

SQL["op7_decontamination"] = f"""
WITH d AS (SELECT DISTINCT doc_id, md5(text) AS h, [x for x in regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] AS w
           FROM documents WHERE text IS NOT NULL),
b AS (SELECT DISTINCT item_id, md5(text) AS ih, [x for x in regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] AS w
      FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT * FROM ({_SHINGLES.format(key="doc_id, h", table="d")})),
bs AS (SELECT DISTINCT * FROM ({_SHINGLES.format(key="item_id, ih", table="b")})),
n AS (SELECT item_id, ih, count(*) AS item_shingles FROM bs GROUP BY ALL),
m AS (SELECT doc_id, h, item_id, ih, count(*) AS matched FROM ds JOIN bs USING (g) GROUP BY ALL),
found AS (SELECT doc_id, h, m.item_id, matched, item_shingles, matched::DOUBLE / item_shingles AS containment
          FROM m JOIN n ON m.ih = n.ih AND m.item_id IS NOT DISTINCT FROM n.item_id WHERE matched >= 0.8 * item_shingles - 1e-9)
SELECT doc_id, item_id, matched, item_shingles, containment FROM found
QUALIFY row_number() OVER (PARTITION BY doc_id, h, item_id ORDER BY containment DESC, matched DESC) = 1
"""

SQL["op4_jaccard_join"] = f"""
WITH RECURSIVE c AS (
  SELECT md5(text) AS node, any_value(text) AS text, min(doc_id) AS class_id, count(*) AS n_copies
  FROM documents WHERE text IS NOT NULL GROUP BY 1),
w AS (SELECT node, [x for x in regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] AS w FROM c),
s AS MATERIALIZED (SELECT DISTINCT * FROM ({_SHINGLES.format(key="node", table="w")})),
n AS (SELECT node, count(*) AS n FROM s GROUP BY node),
both_ AS (SELECT a.node AS x, b.node AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.node <> b.node GROUP BY ALL),
link AS MATERIALIZED (SELECT x, y FROM both_ JOIN n nx ON nx.node = x JOIN n ny ON ny.node = y WHERE k >= 0.8 * (nx.n + ny.n - k) - 1e-9),
reach AS (SELECT node AS x, node AS y FROM c UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
grp AS (SELECT r.x AS node, min(c.class_id) AS group_id, sum(c.n_copies) AS group_size FROM reach r JOIN c ON c.node = r.y GROUP BY r.x),
deg AS (SELECT x AS node, count(*) AS n_links FROM link GROUP BY x)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(c.n_copies, 1)::BIGINT AS n_copies,
       coalesce(deg.n_links, 0)::BIGINT AS n_links, coalesce(grp.group_id, d.doc_id) AS group_id,
       coalesce(grp.group_size, 1)::BIGINT AS group_size
FROM documents d LEFT JOIN c ON c.node = md5(d.text) LEFT JOIN grp ON grp.node = c.node LEFT JOIN deg ON deg.node = c.node
"""

_FIELD = "CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"
_LEAF = " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars"))
_ASCII = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
#: CRC-32 of a decimal number's text, bit by bit.
_CRC = """xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT for c in string_split(CAST(doc_id AS VARCHAR), '')],
         lambda a, x: list_reduce([xor(a, x)] || range(8), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295)"""

SQL["op12_merkle"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, lang, sha256({_LEAF} || {_FIELD.format(c="text")}) AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN sha256({_LEAF} || {_FIELD.format(c=f"translate(text, '{_ASCII}', '{_ASCII.lower()}')")}) END AS changed
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
low AS MATERIALIZED (
  WITH RECURSIVE n AS (
    SELECT tree, 0 AS level, pos, leaf AS digest FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, max(pos) OVER (PARTITION BY tree) AS last FROM n) WHERE last > 0 GROUP BY tree, level, pos // 8)
  SELECT * FROM n),
height AS MATERIALIZED (SELECT tree, max(level) AS h FROM low GROUP BY tree),
sub AS MATERIALIZED (
  SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM low JOIN height USING (tree) WHERE level = h),
high AS MATERIALIZED (
  WITH RECURSIVE n AS (
    SELECT 0 AS level, pos, digest FROM sub
    UNION ALL
    SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, max(pos) OVER () AS last FROM n) WHERE last > 0 GROUP BY level, pos // 8)
  SELECT * FROM n),
root AS (SELECT digest AS root FROM high ORDER BY level DESC LIMIT 1),
numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM leaves),
-- (leaf, level up to the root, own place there, node of the run)
runs AS MATERIALIZED (
  SELECT l.id, n.level, l.pos // (8 ** n.level)::BIGINT AS own, n.pos, n.digest
  FROM numbered l JOIN height t ON t.tree = l.tree
  JOIN low n ON n.tree = l.tree AND n.level < t.h AND n.pos // 8 = l.pos // (8 ** (n.level + 1))::BIGINT
  UNION ALL
  SELECT l.id, t.h + n.level, s.pos // (8 ** n.level)::BIGINT, n.pos, n.digest
  FROM numbered l JOIN height t ON t.tree = l.tree JOIN sub s ON s.tree = l.tree
  JOIN high n ON n.level < (SELECT max(level) FROM high) AND n.pos // 8 = s.pos // (8 ** (n.level + 1))::BIGINT),
proofs AS (SELECT id, string_agg(digest, '' ORDER BY level, pos) AS p FROM runs WHERE pos <> own GROUP BY id),
sides AS MATERIALIZED (
  SELECT id, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < own), '') AS l,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > own), '') AS r
  FROM runs GROUP BY id, level),
fold AS (
  SELECT id, 0::BIGINT AS level, coalesce(changed, leaf) AS digest FROM numbered
  UNION ALL
  SELECT f.id, f.level + 1, sha256(s.l || f.digest || s.r) FROM fold f JOIN sides s ON s.id = f.id AND s.level = f.level),
folded AS (SELECT id, arg_max(digest, level) AS folded_root FROM fold GROUP BY id)
SELECT n.doc_id, n.leaf, s.digest AS subroot, root.root, sha256(coalesce(p.p, '')) AS proof_sha256, f.folded_root,
       f.folded_root = root.root AS verified
FROM numbered n JOIN sub s ON s.tree = n.tree JOIN folded f ON f.id = n.id LEFT JOIN proofs p ON p.id = n.id, root
"""

SQL["op13_embed_dedup"] = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS x, row_number() OVER () AS id FROM embeddings),
ok AS MATERIALIZED (
  SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len([e for e in x if e IS NULL OR isnan(e) OR isinf(e)]) = 0
    AND len([e for e in x if e <> 0]) > 0),
link AS MATERIALIZED (
  SELECT a.id AS p, b.id AS q FROM ok a JOIN ok b ON a.id <> b.id AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) / (sqrt(list_inner_product(a.x, a.x)) * sqrt(list_inner_product(b.x, b.x))) >= 0.9),
reach AS (SELECT id AS p, id AS q FROM v UNION SELECT r.p, l.q FROM reach r JOIN link l ON l.p = r.q),
comp AS (SELECT r.p, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.id = r.q GROUP BY r.p),
deg AS (SELECT p, count(*) AS n FROM link GROUP BY p)
SELECT v.vec_id, coalesce(deg.n, 0)::BIGINT AS n_links, comp.component_id, v.vec_id IS NOT DISTINCT FROM comp.component_id AS kept
FROM v JOIN comp ON comp.p = v.id LEFT JOIN deg ON deg.p = v.id
"""

"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents may be very long, so their Jaccard similarity
is near 0 even for a full copy; containment of the item is what counts.  The
share of an item's MinHash sample (the k smallest hashes of its shingles) that
occurs in a document estimates it, whatever the document's length.

1. Items are partitioned by size (powers of two of their shingle count).  Each
   partition gets its sample size k and the least number of hits at which an
   item of containment ``threshold`` is missed with a chance under ``miss``.
2. All shingles of all whole documents meet the samples in one join; documents
   with enough hits are candidates for the item.
3. Candidates are verified on all shingles: exact containment.

SQL functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import broadcast_if_small, fresh, quoted, shingle_hashes, small_table, words
from farelane.session import materialize

THRESHOLD = 0.8
SHINGLE = 5
#: Items and sizes fit a long; partitions by powers of two, so 40 cover any item.
SIZE_CLASSES = 40


def least_hits(n: int, k: int, threshold: float, miss: float) -> int:
    """The most hits h to ask for among a sample of ``k`` of ``n`` shingles, if
    ceil(threshold n) of the n are in the document: fewer than h with a chance
    of ``miss`` at most (hypergeometric); at least 1."""
    inside = math.ceil(threshold * n - 1e-9)
    total, h = math.comb(n, k), 0
    below = 0
    while h < k:
        below += math.comb(inside, h) * math.comb(n - inside, k - h)
        if below > miss * total:
            break
        h += 1
    return max(1, h)


def size_partitions(sample: int = 16, threshold: float = THRESHOLD, miss: float = 1e-6) -> list[dict]:
    """Sample size and least hits of each size class (class c: 2^c <= n < 2^(c+1))."""
    out = []
    for c in range(SIZE_CLASSES):
        sizes = range(2 ** c, 2 ** (c + 1)) if c < 12 else [2 ** 12]
        out.append({"size_class": c, "sample": sample,
                    "hits": min(least_hits(n, min(n, sample), threshold, miss) for n in sizes)})
    return out


def _item_shingles(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_hash, shingle, n, nth): distinct shingles, nth by hash within
    the item, which is an id and a text."""
    s = items.select(quoted(item_id).alias("item"), F.xxhash64(quoted(text)).alias("item_hash"),
                     words(quoted(text)).alias("w")).filter(F.col("w").isNotNull())
    s = s.select("item", "item_hash", F.explode(shingle_hashes(F.col("w"), SHINGLE)).alias("shingle")).distinct()
    by = Window.partitionBy("item", "item_hash")
    return s.select("item", "item_hash", "shingle", F.count(F.lit(1)).over(by).alias("n"),
                    F.row_number().over(by.orderBy(F.xxhash64(F.lit(11), "shingle"), "shingle")).alias("nth"))


def contained_items(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
                    sample: int = 16, miss: float = 1e-6) -> DataFrame:
    """Pairs of a document and an item with containment of ``threshold`` or
    more: ``doc_id``, ``text_hash`` (of the document's text), ``item_id``,
    ``matched``, ``item_shingles``, ``containment``.

    Null and wordless texts and items match nothing; an item of fewer than five
    words matches only a document of the same words.  Texts of the same id, or of
    a null id, are items of their own; a document gives one row per id, that of
    the text contained most.  Rows alike in doc_id and text give one row.  Empty
    tables give an empty one."""
    spark = docs.sparkSession
    grams = materialize(_item_shingles(items, item_id, item_text))
    plan = small_table(spark, size_partitions(sample, threshold, miss), "size_class int, sample int, hits int")
    sized = grams.withColumn("size_class", F.floor(F.log2(F.col("n").cast("double"))).cast("int")).join(
        F.broadcast(plan), "size_class")
    sketch = sized.filter(F.col("nth") <= F.col("sample")).select("item", "item_hash", "shingle", "hits")
    src = docs.select(quoted(doc_id).alias("doc"), F.xxhash64(quoted(text)).alias("text_hash"),
                      words(quoted(text)).alias("w")).filter(F.col("w").isNotNull())
    hits = (src.select("doc", "text_hash", F.explode(shingle_hashes(F.col("w"), SHINGLE)).alias("shingle"))
            .join(broadcast_if_small(sketch), "shingle")
            .groupBy("doc", "text_hash", "item", "item_hash", "hits").agg(F.count_distinct("shingle").alias("found")))
    near = materialize(hits.filter(F.col("found") >= F.col("hits")).select("doc", "text_hash", "item", "item_hash"))
    ids = near.select(F.col("doc").alias("d2"), F.col("text_hash").alias("h2")).distinct()
    again = src.join(broadcast_if_small(ids), src["doc"].eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("h2")), "left_semi")
    whole = (again.select("doc", "text_hash", F.explode(F.array_distinct(shingle_hashes(F.col("w"), SHINGLE))).alias("shingle"))
             .join(broadcast_if_small(grams.select("item", "item_hash", "shingle", "n")), "shingle")
             .groupBy("doc", "text_hash", "item", "item_hash", "n").agg(F.count_distinct("shingle").alias("matched")))
    cand = near.select(F.col("doc").alias("d2"), F.col("text_hash").alias("h2"), F.col("item").alias("i2"), F.col("item_hash").alias("ih2"))
    found = (whole.filter(F.col("matched") >= F.col("n") * threshold - 1e-9)
             .join(cand, whole["doc"].eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("h2"))
                   & F.col("item").eqNullSafe(F.col("i2")) & (F.col("item_hash") == F.col("ih2")), "left_semi"))
    best = F.max(F.struct((F.col("matched") / F.col("n")).alias("containment"), "matched", "n")).alias("best")
    return (found.groupBy("doc", "text_hash", "item").agg(best)
            .select(F.col("doc").alias("doc_id"), "text_hash", F.col("item").alias("item_id"), F.col("best.matched").alias("matched"),
                    F.col("best.n").alias("item_shingles"), F.col("best.containment").alias("containment")))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows whose text contains a test item."""
    h, = fresh(docs, "text_hash")
    bad = materialize(contained_items(docs, items, text, doc_id, **options).select(
        F.col("doc_id").alias("bad_doc"), F.col("text_hash").alias("bad_hash")).distinct())
    marked = docs.withColumn(h, F.xxhash64(quoted(text)))
    cond = quoted(doc_id).eqNullSafe(F.col("bad_doc")) & (quoted(h) == F.col("bad_hash"))
    return marked.join(broadcast_if_small(bad), cond, "left_anti").drop(h)

"""Corpus pipeline: documents through five of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's ``docs``; then the tables before it
are deleted.  All but the last return the columns of ``documents``.

Rows may hold nulls, empty, wordless and very long texts, ties and repeats: each
stage says what becomes of them.  An empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelane.llm import decontam, jaccard_join, langid, mixing, sharding
from farelane.session import drop_frame, settled


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can be told, with ``lang`` put right; null texts and
    texts without a letter go, repeated rows stay."""
    return langid.labelled(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (of repeated rows, one);
    null texts all stay, texts without a word go with equal ones only."""
    return jaccard_join.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null, empty and wordless texts
    hold none, repeated rows fare alike."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: sources (null is one) interleaved
    by weight; repeated rows all stay."""
    return mixing.in_mix_order(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it.  The mix holds in
    every shard: windows of the mixed order are dealt to all shards, and a shard
    keeps their order."""
    return sharding.shards_in_order(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: MinHash signatures, EDF schedules and hypergeometric draws aren't SQL; the
#: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        done = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        drop_frame(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)

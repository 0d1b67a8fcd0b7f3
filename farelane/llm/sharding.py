"""Uniform sharding by a hypergeometric communication matrix.

A uniform random permutation, cut into shards of given sizes, puts a
multivariate hypergeometric number of each partition's rows into each shard.
So the counts are drawn first, and rows follow them:

1. every row gets random keys and a partition (an equal range of the first
   key); one aggregation counts the partitions;
2. the driver draws the partition x shard matrix: row by row, each entry a
   hypergeometric draw from what is left of the shards;
3. each partition is permuted by the second key and dealt to the shards by its
   row of the matrix;
4. rows are exchanged, and each shard is permuted by the third key, in cells,
   so no task sorts a whole shard.

Shard sizes are exact: they differ by one row at most.  The matrix has
rows / rows_per_partition x shards entries (1e10 rows: 200,000 x 40).
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import cells_for, fresh, quoted, random_key, ranked, told_apart, unit
from farelane.session import materialize


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good items among ``n`` drawn from ``good + bad``.  NumPy's sampler ends
    at 1e9 items; beyond, the distribution is inverted around its mode."""
    if n <= 0 or good <= 0:
        return 0
    if bad <= 0:
        return n
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n))
    lo, hi = max(0, n - bad), min(n, good)
    total = good + bad
    sd = math.sqrt(max(1.0, n * (good / total) * (bad / total) * (total - n) / max(1, total - 1)))
    mode = min(hi, max(lo, (n + 1) * (good + 1) // (total + 2)))
    a, b = max(lo, int(mode - 40 * sd) - 1), min(hi, int(mode + 40 * sd) + 1)
    k = np.arange(a, b, dtype=np.float64)
    logp = np.concatenate([[0.0], np.cumsum(np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1)))])
    p = np.exp(logp - logp.max())
    return a + int(np.searchsorted(np.cumsum(p), rng.random() * p.sum()))


def communication_matrix(sizes: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Counts of rows from each partition (``sizes``) to each shard
    (``shards``), as a uniform permutation would give them; rows sum to the
    partitions, columns to the shards."""
    if sum(sizes) != sum(shards):
        raise ValueError("partitions and shards must hold the same number of rows")
    rng = np.random.default_rng(seed)
    left, out = list(shards), np.zeros((len(sizes), len(shards)), np.int64)
    total = sum(left)
    for i, n in enumerate(sizes):
        rest = total
        for j, room in enumerate(left):
            take = hypergeometric(rng, room, rest - room, n)
            out[i, j], left[j] = take, room - take
            rest, n, total = rest - room, n - take, total - take
    return out


def shuffle_to_shards(df: DataFrame, shards: int = 40, seed: int = 17, rows_per_partition: int = 50_000) -> DataFrame:
    """``df`` with ``shard`` (int, 0 to shards - 1) and ``slot`` (long, gapless
    from 0 in each shard), names extended by ``_`` if ``df`` has them.

    Every row is kept, nulls, empty texts and repeated rows too (rows that are
    alike get keys of their own).  Shards differ by one row at most; fewer
    rows than shards leave the last shards empty, an empty table gives none."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = df.sparkSession
    k1, k2, k3, part, rank, bounds, mp, shard, slot = fresh(
        df, "key1", "key2", "key3", "partition", "rank", "bounds", "matrix_partition", "shard", "slot")
    rows, salt = told_apart(df)
    keyed = rows.withColumn(k1, random_key(df, seed, salt)).withColumns(
        {k2: F.xxhash64(F.lit(2), k1), k3: F.xxhash64(F.lit(3), k1)})
    total = keyed.count()
    parts = cells_for(total, rows_per_partition)
    dealt = keyed.withColumn(part, F.least(F.floor(unit(quoted(k1)) * parts), F.lit(parts - 1)).cast("int"))
    counts = {r[0]: r[1] for r in dealt.groupBy(part).agg(F.count(F.lit(1))).collect()}
    ids = sorted(counts)
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([counts[i] for i in ids], sizes, seed)
    table = spark.createDataFrame([(i, row) for i, row in zip(ids, np.cumsum(matrix, axis=1).tolist())],
                                  f"{mp} int, {bounds} array<long>")
    local = dealt.withColumn(rank, F.row_number().over(Window.partitionBy(part).orderBy(k2)) - 1)
    sent = (local.join(table, quoted(part) == quoted(mp))
            .withColumn(shard, F.size(F.filter(bounds, lambda b: b <= quoted(rank))).cast("int"))
            .drop(k1, k2, part, mp, rank, bounds))
    cells = cells_for(math.ceil(total / shards), rows_per_partition)
    return ranked(sent, [shard], k3, cells, slot).drop(k3)


def _in_order(df: DataFrame) -> tuple[DataFrame, Column, Column]:
    """``df`` with the names and row indexes of its files, in whose order its
    rows stand; a frame that doesn't read files directly is written first."""
    try:
        meta = df.metadataColumn("_metadata")
        df.select(meta["row_index"])
    except AnalysisException:
        df = materialize(df)
        meta = df.metadataColumn("_metadata")
    return df, meta["file_name"], meta["row_index"]


def shards_in_order(df: DataFrame, shards: int = 40, seed: int = 17, window_rows: int = 50_000) -> DataFrame:
    """:func:`shuffle_to_shards` that keeps the order of ``df`` on the large:
    the partitions of the communication matrix are windows of at most
    ``window_rows`` consecutive rows (files by name, rows by index), and a shard
    holds its rows window by window, permuted within each.  So the rows of a
    window go to all shards in hypergeometric numbers, and what a prefix of the
    table is made of, a prefix of every shard is made of, to the draw.

    Every row is kept, nulls, empty texts and repeated rows too.  Shards differ
    by one row at most; fewer rows than shards leave the last shards empty, an
    empty table gives none.  Names get ``_`` appended if ``df`` has them."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = df.sparkSession
    k2, k3, win, rank, bounds, offs, mw, file, first, shard, slot = fresh(
        df, "key2", "key3", "window", "rank", "bounds", "offsets", "matrix_window", "file", "first_window", "shard", "slot")
    columns = df.columns
    rows, name, index = _in_order(df)
    rows = rows.withColumns({file: name, win: index})
    key = F.xxhash64(F.lit(seed), quoted(file), quoted(win))
    # one row per file: its rows, and so its windows, are known from the last index
    sizes = {r[0]: r[1] + 1 for r in rows.groupBy(file).agg(F.max(win)).collect()}
    order = sorted(sizes, key=lambda f: (int(m[1]) if (m := re.match(r"part-(\d+)", f)) else -1, f))
    starts, windows = [], []
    for f in order:
        starts.append((f, len(windows)))
        windows += [min(window_rows, sizes[f] - at) for at in range(0, sizes[f], window_rows)]
    total = sum(windows)
    matrix = communication_matrix(windows, [total // shards + (j < total % shards) for j in range(shards)], seed)
    upto = np.cumsum(matrix, axis=1)
    before = np.cumsum(matrix, axis=0) - matrix
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(upto.tolist(), before.tolist()))],
                                  f"{mw} long, {bounds} array<long>, {offs} array<long>")
    files = F.broadcast(spark.createDataFrame(starts, f"{file} string, {first} long"))  # one row per file
    # the random number hangs on the place, so it is the same in every run of a task
    placed = (rows.withColumns({k2: key, k3: F.xxhash64(F.lit(3), key)}).join(files, file)
              .withColumn(win, quoted(first) + F.floor(quoted(win) / window_rows)).drop(file, first))
    local = placed.withColumn(rank, F.row_number().over(Window.partitionBy(win).orderBy(k2)) - 1)
    sent = (local.join(table, quoted(win) == quoted(mw))
            .withColumn(shard, F.size(F.filter(bounds, lambda b: b <= quoted(rank))).cast("int")))
    inside = F.row_number().over(Window.partitionBy(win, shard).orderBy(k3))
    done = sent.withColumn(slot, (F.get(quoted(offs), quoted(shard)) + inside - 1).cast("long"))
    return done.select(*[quoted(c) for c in columns], quoted(shard), quoted(slot))


def shard_digest(docs: DataFrame, shards: int = 40, seed: int = 17, rows_per_partition: int = 50_000) -> DataFrame:
    """The shard of every document with the digest columns of its text: size
    (UTF-8 bytes, 0 for null, plus 16) and CRC-32 (of nothing for null)."""
    digest = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"))
    out = shuffle_to_shards(digest, shards, seed, rows_per_partition)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))

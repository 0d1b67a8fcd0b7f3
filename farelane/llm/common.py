"""Helpers shared by the corpus operators: column names that cannot clash,
row keys, ranks that never gather a group in one task, word shingles."""

from __future__ import annotations

import json
import math

import numpy as np
import regex
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from farelane.session import materialize

#: Words are maximal runs of letters and digits, lower-cased.
WORD_SEPARATORS = r"[^\p{L}\p{N}]+"
WORD = regex.compile(r"[\p{L}\p{N}]+")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def quoted(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def hashable_columns(df: DataFrame) -> list[Column]:
    """The columns that xxhash64 takes (maps and variants have no hash)."""
    def ok(t):
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        return not isinstance(t, (T.MapType, T.VariantType))
    return [quoted(f.name) for f in df.schema.fields if ok(f.dataType)]


def random_key(df: DataFrame, seed: int, *salts: Column) -> Column:
    """64 pseudo-random bits of a row: a hash of the seed and all its columns.
    Rows that are alike in every column need a salt to get different keys."""
    return F.xxhash64(F.lit(seed), *hashable_columns(df), *salts)


def told_apart(df: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` and a hash that tells its rows apart, even rows alike in every
    column, and stays the same whenever it is evaluated: of the file and the
    row's index in it.  A frame that doesn't read files directly is written
    first (a number of the row in its task would change with the tasks)."""
    try:
        meta = df.metadataColumn("_metadata")
        df.select(meta["row_index"])
        file = meta["file_path"]
    except AnalysisException:
        df = materialize(df)
        meta = df.metadataColumn("_metadata")
        file = F.regexp_extract(meta["file_name"], r"part-(\d+)", 1)  # the rest of the name is new in each run
    return df, F.xxhash64(file, meta["row_index"])


def unit(key: Column) -> Column:
    """A hash as a number in [0, 1), in the order of its unsigned value."""
    return F.shiftrightunsigned(key, 11).cast("double") / F.lit(float(1 << 53))


def cells_for(rows: int, rows_per_cell: int) -> int:
    return max(1, math.ceil(rows / rows_per_cell))


def ranked(df: DataFrame, groups: list[str], key: str, cells: int, out: str) -> DataFrame:
    """Add ``out``, the rank from 0 of each row in its group by ``key``; group
    columns must not be null (plain equality keeps the window's partitioning
    for the join with the offsets, so rows are shuffled once).

    A window over the group alone would sort a hot group in one task.  The
    key's range is cut into ``cells`` equal parts; rows are ranked within
    (group, cell), and the cell's offset is the sum of the counts of the cells
    before it.  ``key`` is a hash, so a cell holds about a ``cells``-th of the
    group, whatever the group's size."""
    cell, n, off, r = fresh(df, "cell", "n_rows", "offset", "rank_in_cell")
    df = df.withColumn(cell, F.least(F.floor(unit(quoted(key)) * cells), F.lit(cells - 1)).cast("int"))
    by = [quoted(g) for g in groups] + [quoted(cell)]
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*[quoted(g) for g in groups]).orderBy(cell).rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.select(*[quoted(g).alias(f"{off}{i}") for i, g in enumerate(groups)], quoted(cell).alias(f"{off}c"),
                           F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off))
    inner = df.withColumn(r, F.row_number().over(Window.partitionBy(*by).orderBy(quoted(key))))
    cond = quoted(cell) == quoted(f"{off}c")
    for i, g in enumerate(groups):
        cond = cond & (quoted(g) == quoted(f"{off}{i}"))
    return (inner.join(counts, cond)
            .withColumn(out, (quoted(off) + quoted(r) - 1).cast("long"))
            .drop(cell, off, r, f"{off}c", *[f"{off}{i}" for i in range(len(groups))]))


def words(text: Column) -> Column:
    """Lower-cased words as an array (null for null)."""
    return F.array_remove(F.split(F.lower(text), WORD_SEPARATORS), "")


def shingle_hashes(w: Column, n: int = 5) -> Column:
    """Hashes of all word n-grams, in order and with repeats.  A text of 1 to
    n - 1 words has one shingle of all its words, one without words has none."""
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)),
                        lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(n)]))
    return (F.when(F.size(w) >= n, grams)
            .when(F.size(w) >= 1, F.array(F.xxhash64(F.array_join(w, "\u0001"))))
            .otherwise(F.array().cast("array<bigint>")))


class WordHashes(dict):
    """word -> 64-bit hash, remembered; alike on every machine."""

    LIMIT = 1_000_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingle_set(text: str | None, hashes: WordHashes, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text, by
    the same rule as :func:`shingle_hashes` (another hash)."""
    w = WORD.findall(text.lower()) if text else []
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    if len(h) < n:
        h = np.concatenate([h, np.full(n - len(h), 0x9E3779B97F4A7C15, np.uint64)])
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def small_table(spark, rows: list[dict], schema: str) -> DataFrame:
    """A table of a bounded number of driver-made rows, by SQL functions only."""
    text = json.dumps(rows)
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


#: Rows up to which a candidate table may be broadcast (16 to 40 bytes a row).
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it is small; beyond
    that the join shuffles both sides.  ``df`` should be cheap to count."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df

"""Running sums and ranks over a total order, without gathering a group.

Rows are range-partitioned by (keys, value) and written with their partition's
number, so a group of any size is a run of partitions.  Partition totals (one
row per partition and key) give each partition's offset; windows run inside
one (partition, key) only.  The same path serves every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.session import materialize


def _ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    # written before use: the bounds are sampled, so a second evaluation might
    # deal the rows differently
    return materialize(df.repartitionByRange(*keys, *order).withColumn("_pid", F.spark_partition_id()))


def _with_parts(df: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    cond = F.col("_pid") == F.col("_p_pid")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_p_{i}"))
    return df.join(parts, cond).drop("_p_pid", *[f"_p_{i}" for i in range(len(keys))])


def running_counts(counts: DataFrame, keys: list[str], value: str, cols: list[str]) -> DataFrame:
    """``counts``: one row per (keys, value) with number columns ``cols``.
    Adds, per key in the order of ``value`` (nulls first), ``before_<c>`` (sum
    over smaller values), ``total_<c>`` and ``next_value``."""
    d = _ranged(counts, keys, [value])
    parts = d.groupBy("_pid", *keys).agg(*[F.sum(c).alias(f"_s_{c}") for c in cols], F.min(value).alias("_first"),
                                         F.count_if(F.col(value).isNull()).alias("_nulls"))
    over = Window.partitionBy(*keys) if keys else Window.partitionBy()
    by_pid = over.orderBy("_pid")
    first = F.when(F.col("_nulls") > 0, None).otherwise(F.col("_first"))
    parts = parts.select(
        F.col("_pid").alias("_p_pid"), *[F.col(k).alias(f"_p_{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"_s_{c}").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_o_{c}")
          for c in cols],
        *[F.sum(f"_s_{c}").over(over).alias(f"total_{c}") for c in cols],
        F.lead(first).over(by_pid).alias("_next"))
    inside = Window.partitionBy("_pid", *keys).orderBy(value)
    d = d.withColumns({f"_r_{c}": F.coalesce(F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                       for c in cols} | {"_lead": F.lead(value).over(inside)})
    d = _with_parts(d, parts, keys)
    return (d.withColumns({f"before_{c}": F.col(f"_o_{c}") + F.col(f"_r_{c}") for c in cols}
                          | {"next_value": F.coalesce("_lead", "_next")})
            .drop("_pid", "_lead", "_next", *[f"_o_{c}" for c in cols], *[f"_r_{c}" for c in cols]))


def range_rank(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Add ``out``, each row's rank from 1 in its key by ``order`` (which
    should tell all rows apart)."""
    d = _ranged(df, keys, order)
    parts = d.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    over = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_pid")
    parts = parts.select(F.col("_pid").alias("_p_pid"), *[F.col(k).alias(f"_p_{i}") for i, k in enumerate(keys)],
                         F.coalesce(F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    return _with_parts(d, parts, keys).withColumn(out, (F.col("_o") + F.col("_rn")).cast("long")).drop("_pid", "_o", "_rn")

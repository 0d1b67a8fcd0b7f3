"""Splits and samples, all deterministic and free of global windows.

* month split: distinct months (a calendar-bounded table) ranked and joined
  back with a broadcast;
* half split: the cut row of the time order is found by running counts, then
  rows are labelled by a plain predicate;
* folds / samples: the first 32 bits of ``md5(key || '|' || seed)``, the same
  number in Spark and in SQL engines;
* stratified sample: quantile bins of ``log1p(target)``, per-bin quotas, and
  the quota-th smallest hash per bin found from a histogram of hash prefixes,
  so only the rows of one prefix are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions.columns import ntz_micros
from farelane.functions.quantiles import quantiles
from farelane.functions.ranges import range_rank, running_counts

PICKUP = "Trip_Pickup_DateTime"


# ---------------------------------------------------------------------------
# hashing helpers
# ---------------------------------------------------------------------------
def hash32(key, seed: int) -> Column:
    """First 8 hex digits of md5(key|seed) as an unsigned 32-bit integer."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(k.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def hash_unit(key, seed: int) -> Column:
    """Uniform number in [0, 1) from ``hash32``."""
    return hash32(key, seed) / F.lit(float(2 ** 32))


def hash_folds(df: DataFrame, k: int = 5, key: str = "trip_id", seed: int = 42,
               out: str = "fold") -> DataFrame:
    return df.withColumn(out, (hash32(key, seed) % k).cast("int"))


def exact_folds(df: DataFrame, k: int = 5, key: str = "trip_id", seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds 0 to k - 1 whose sizes differ by one row at most: the rank of
    (hash, key), counted by range partitions, modulo ``k``.  Rows alike in key
    (nulls too) share a hash; each takes a rank of its own."""
    d = df.withColumn("_h", F.coalesce(hash32(key, seed), F.lit(-1)))
    return range_rank(d, [], ["_h", key], "_rank").withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank")


def hash_sample(df: DataFrame, fraction: float = 0.8, key: str = "trip_id", seed: int = 42) -> DataFrame:
    """Deterministic Bernoulli sample: rows whose hash falls below ``fraction``."""
    return df.filter(hash32(key, seed) < F.lit(int(fraction * 2 ** 32)))


# ---------------------------------------------------------------------------
# month discovery and month split
# ---------------------------------------------------------------------------
def month_from_path(path_col: Column) -> Column:
    """``YYYY-MM`` from a file name like ``yellow_tripdata_2009-01.parquet``."""
    return F.regexp_extract(path_col, r"(\d{4})-(\d{2})(?:\D*)$", 0).substr(1, 7)


def month_table(df: DataFrame, month_col: str = "month") -> DataFrame:
    """Distinct months with year, month number and order (a tiny table)."""
    months = df.select(month_col).where(F.col(month_col).isNotNull()).distinct()
    return (months.withColumn("year", F.substring(month_col, 1, 4).cast("int"))
                  .withColumn("month_num", F.substring(month_col, 6, 2).cast("int"))
                  .withColumn("month_rank", F.dense_rank().over(Window.orderBy("year", "month_num"))))


def month_findings(df: DataFrame, month_col: str = "month", window: int = 3, strict: bool = False) -> DataFrame:
    """Checks on the discovered months as rows ``(check, ok, detail)``:
    one year only, ``window`` months, consecutive months.  ``strict`` raises
    on any failed check instead of only reporting it."""
    if strict:
        bad = [r["check"] for r in month_findings(df, month_col, window).collect() if not r["ok"]]
        if bad:
            raise ValueError(f"month checks failed: {bad}")
    mt = month_table(df, month_col)
    s = mt.agg(F.countDistinct("year").alias("years"), F.count(F.lit(1)).alias("months"),
               F.sort_array(F.collect_list("month_num")).alias("nums"),
               F.sort_array(F.collect_list(month_col)).alias("list"))
    consecutive = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size("nums") - 1, F.lit(1))), F.lit(True),
        lambda acc, i: acc & (F.coalesce(F.element_at("nums", i + 1) - F.element_at("nums", i), F.lit(1)) == 1))
    return s.select(F.inline(F.array(
        F.struct(F.lit("single_year").alias("check"), (F.col("years") == 1).alias("ok"),
                 F.concat_ws(",", "list").alias("detail")),
        F.struct(F.lit("month_count").alias("check"), (F.col("months") == window).alias("ok"),
                 F.col("months").cast("string").alias("detail")),
        F.struct(F.lit("consecutive").alias("check"), consecutive.alias("ok"),
                 F.concat_ws(",", "list").alias("detail")),
    )))


def month_split(df: DataFrame, month_col: str = "month", n_train: int = 2,
                out: str = "split") -> DataFrame:
    """First ``n_train`` months -> ``train``, the next one -> ``valtest``;
    later months -> ``extra``.  The month table is broadcast (its size is
    bounded by the calendar, not by the data)."""
    mt = month_table(df, month_col).select(month_col, "month_rank")
    lab = (F.when(F.col("month_rank") <= n_train, "train")
            .when(F.col("month_rank") == n_train + 1, "valtest").otherwise("extra"))
    return df.join(F.broadcast(mt), month_col, "left").withColumn(out, lab).drop("month_rank")


# ---------------------------------------------------------------------------
# exact time-ordered half split
# ---------------------------------------------------------------------------
_NULL_TIME = 2 ** 62


def half_split(df: DataFrame, ts: str = PICKUP, key: str = "trip_id", out: str = "split",
               first: str = "val", second: str = "test") -> DataFrame:
    """Order rows by (ts nulls last, key nulls first); the first ``n // 2``
    rows get ``first``, the rest ``second``.  Keys of any type that sorts; rows
    alike in time and key stay together.

    No global sort and no window over all rows: running counts by distinct
    microsecond find the cut time, running counts by key among the rows of that
    time find the cut key (both by range partitions, so one timestamp that a
    third of all rows share is spread too), and the label is a predicate."""
    us = F.when(F.col(ts).isNull(), F.lit(_NULL_TIME)).otherwise(
        ntz_micros(ts) if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else F.unix_micros(ts)).cast("long")
    from farelane.session import materialize
    d = materialize(df.withColumn("_us", us))       # three passes read it: write it once

    def cut(rows, col, target):
        run = running_counts(rows.groupBy(col).agg(F.count(F.lit(1)).alias("n")), [], col, ["n"])
        t = F.floor(F.col("total_n") / 2) if target is None else F.lit(target)
        return run.filter((F.col("before_n") < t) & (t <= F.col("before_n") + F.col("n"))).first()

    c = cut(d, "_us", None)
    if c is None:                                   # fewer than two rows: nothing goes first
        return d.withColumn(out, F.lit(second)).drop("_us")
    need = c["total_n"] // 2 - c["before_n"]
    tied = F.col("_us") == c["_us"]
    if need == c["n"]:                              # the cut falls between two times
        upto = F.lit(True)
    else:
        last = cut(d.filter(tied), key, need)[key]
        upto = F.col(key).isNull() if last is None else F.col(key).isNull() | (F.col(key) <= F.lit(last))
    is_first = (F.col("_us") < c["_us"]) | (tied & upto)
    return d.withColumn(out, F.when(is_first, first).otherwise(second)).drop("_us")


def left_out_months(df: DataFrame, month_col: str = "month") -> DataFrame:
    """``(month, rows)`` that :func:`split_train_val_test` has no part for:
    months after the third, and rows without a month."""
    ms = month_split(df, month_col)
    return (ms.filter(F.coalesce(~F.col("split").isin("train", "valtest"), F.lit(True)) | F.col(month_col).isNull())
              .groupBy(month_col).agg(F.count(F.lit(1)).alias("rows")))


def split_train_val_test(df: DataFrame, month_col: str = "month", ts: str = PICKUP,
                         key: str = "trip_id") -> DataFrame:
    """Month split then half split of the third month into val / test.  The
    rows of other months have no part (:func:`left_out_months` counts them)."""
    ms = month_split(df, month_col)
    vt = ms.filter(F.col("split") == "valtest").drop("split")
    return ms.filter(F.col("split") == "train").unionByName(half_split(vt, ts, key))


# ---------------------------------------------------------------------------
# quantile bins and stratified sample
# ---------------------------------------------------------------------------
def quantile_edges(df: DataFrame, value: Column, n_bins: int = 50) -> list[float]:
    """Distinct quantile edges of ``value`` at i / n_bins (a few dozen numbers)."""
    t = df.select(value.alias("_v"))
    q = quantiles(t, ["_v"], [i / n_bins for i in range(n_bins + 1)]).orderBy("p").collect()
    edges: list[float] = []
    for r in q:
        if r["value"] is not None and (not edges or r["value"] != edges[-1]):
            edges.append(float(r["value"]))
    return edges


def bin_column(value: Column, edges: list[float]) -> Column:
    """Right-closed bins over sorted edges, the lowest edge included:
    bin = number of edges below the value, at least 1; null stays null."""
    arr = F.array(*[F.lit(e) for e in edges])
    b = F.greatest(F.size(F.filter(arr, lambda e: e < value)), F.lit(1))
    return F.when(value.isNull() | F.isnan(value) | (value > F.lit(edges[-1])), None).otherwise(b)


def quantile_bins(df: DataFrame, target: str = "Fare_Amt", n_bins: int = 50,
                  out: str = "bin") -> DataFrame:
    v = F.log1p(F.col(target))
    edges = quantile_edges(df, v, n_bins)
    return df.withColumn(out, bin_column(v, edges) if edges else F.lit(None).cast("int"))


def bin_counts(df: DataFrame, bin_col: str = "bin") -> dict:
    """Rows per bin (null bin included): a few dozen rows to the driver."""
    return {r[bin_col]: r["count"] for r in df.groupBy(bin_col).count().collect()}


def quotas_from_counts(counts: dict, n_samples: int) -> dict:
    """Quota per bin = half-even round(bin share * n), capped by the bin size;
    the share is over all rows (rows without a bin count in the total but get
    no quota)."""
    total = sum(counts.values())
    return {b: min(c, int(round(c / total * n_samples))) for b, c in counts.items() if b is not None}


def stratified_sample(df: DataFrame, target: str = "Fare_Amt", n_samples: int = 600_000,
                      n_bins: int = 50, seed: int = 42, key: str = "trip_id") -> DataFrame:
    from farelane.session import materialize
    # edges, counts, the bracket check and the draw all read the input: write it once
    binned = quantile_bins(materialize(df), target, n_bins, out="_bin")
    counts = bin_counts(binned, "_bin")
    quotas = quotas_from_counts(counts, n_samples)
    sizes = {b: c for b, c in counts.items() if b is not None}
    return sample_by_quota(binned, "_bin", quotas, seed, key, sizes).drop("_bin")


def sample_by_quota(df: DataFrame, group_col: str, quotas: dict, seed: int = 42,
                    key: str = "trip_id", sizes: dict | None = None) -> DataFrame:
    """Per group, the ``quota`` rows with the smallest (hash, key).

    Rows below the 16-bit hash prefix that holds the quota-th row are taken
    whole; only the rows of that prefix are ranked, by range partitions, so a
    key that repeats without limit is sampled too."""
    if not quotas:
        return df.limit(0)
    d = df.withColumn("_h", hash32(key, seed))
    if sizes is None:
        sizes = {r[group_col]: r["count"] for r in d.groupBy(group_col).count().collect()
                 if r[group_col] is not None}
    taken = {g: min(quotas.get(g, 0), n) for g, n in sizes.items()}
    # the hash's upper 16 bits: at most 65,536 counts per group, whose running
    # sum finds the prefix that holds the quota-th row
    d = d.withColumn("_pre", F.floor(F.col("_h") / 65536).cast("int"))

    def of_group(values: dict):
        return F.element_at(F.create_map(*[x for g, v in values.items() for x in (F.lit(g), F.lit(v))]), F.col(group_col))

    run = Window.partitionBy(group_col).orderBy("_pre").rowsBetween(Window.unboundedPreceding, 0)
    hist = (d.filter(F.col(group_col).isNotNull()).groupBy(group_col, "_pre").agg(F.count(F.lit(1)).alias("_c"))
             .withColumn("_cum", F.sum("_c").over(run)).withColumn("_q", of_group(taken)))
    cuts = {r[group_col]: (r["_pre"], r["_q"] - (r["_cum"] - r["_c"])) for r in hist.filter(
        (F.col("_cum") >= F.col("_q")) & (F.col("_cum") - F.col("_c") < F.col("_q"))).collect()}
    if not cuts:
        return df.limit(0)
    d = d.withColumn("_cut", of_group({g: c for g, (c, _) in cuts.items()}))
    sure = d.filter(F.col("_pre") < F.col("_cut")).drop("_h", "_pre", "_cut")
    edge = d.filter(F.col("_pre") == F.col("_cut")).withColumn("_row", F.monotonically_increasing_id())
    edge = range_rank(edge, [group_col], ["_h", key, "_row"], "_rank")
    edge = edge.filter(F.col("_rank") <= of_group({g: n for g, (_, n) in cuts.items()}))
    return sure.unionByName(edge.drop("_h", "_pre", "_cut", "_row", "_rank"))

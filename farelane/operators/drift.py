"""Data drift (Wasserstein-1 per feature) and regression-quality drift.

W1 between two empirical distributions is ``sum |F(x) - G(x)| * (x' - x)``
over the sorted distinct values of their union.  Rows are counted per (feature,
value); the running sums of the counts go by range partitions, so no task holds
a feature.  The result is exact.

For many months there are sketches: counts in buckets that are the same for all
data, so a new month is compared with the merged sketches of the old ones, within
a bound that comes with the result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.ranges import running_counts
from farelane.operators.metrics import melt_predictions, regression_metrics
from farelane.session import materialize


def _melt(df: DataFrame, features: list[str], is_ref: int) -> DataFrame:
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features]
    return (df.select(F.inline(F.array(*items)))
              .where(F.col("x").isNotNull() & ~F.isnan("x"))
              .withColumn("_r", F.lit(is_ref)))


def wasserstein(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, w1, n_ref, n_cur, ref_std)``."""
    long = _melt(reference, features, 1).unionByName(_melt(current, features, 0))
    # one row per distinct value: its counts in each set
    cnt = materialize(long.groupBy("feature", "x").agg(F.sum("_r").alias("r"), F.sum(1 - F.col("_r")).alias("c")))
    return _from_counts(cnt)


def _from_counts(cnt: DataFrame) -> DataFrame:
    """W1 of (feature, x, r, c): rows of the reference and of the current set
    per distinct value."""
    run = running_counts(cnt, ["feature"], "x", ["r", "c"])
    dx = F.coalesce(F.col("next_value") - F.col("x"), F.lit(0.0))
    gap = F.abs((F.col("before_r") + F.col("r")) / F.col("total_r") - (F.col("before_c") + F.col("c")) / F.col("total_c"))
    w1 = run.groupBy("feature").agg(F.sum(gap * dx).alias("w1"), F.max("total_r").alias("n_ref"), F.max("total_c").alias("n_cur"))
    # weighted moments around the mean, from the counts
    mean = cnt.groupBy("feature").agg((F.sum(F.col("x") * F.col("r")) / F.sum("r")).alias("_m"))
    std = (cnt.join(mean, "feature").groupBy("feature")
           .agg(F.sqrt(F.sum(F.col("r") * (F.col("x") - F.col("_m")) ** 2) / F.sum("r")).alias("ref_std")))
    return w1.join(std, "feature").select("feature", "w1", "n_ref", "n_cur", "ref_std")


# -- sketches ----------------------------------------------------------------
#: Values of a bucket lie within a factor GAMMA of each other.
GAMMA = 1.01


def sketch(df: DataFrame, features: list[str], by: tuple[str, ...] = (), gamma: float = GAMMA) -> DataFrame:
    """A mergeable sketch of each feature, per value of ``by`` (say the month):
    ``(*by, feature, sign, bucket, n, total, squares, moved)``.

    Buckets are powers of ``gamma`` (zero has its own), the same for every
    data set, so sketches merge by adding up, exactly and in any order; all
    doubles together have 143,000 buckets a sign, trips a few hundred.
    ``moved`` is how far the bucket's values are, in sum, from the value
    that stands for them: what the sketch can be wrong by."""
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features]
    long = df.select(*by, F.inline(F.array(*items))).where(F.col("x").isNotNull() & ~F.isnan("x"))
    sign = F.signum("x").cast("int")
    bucket = F.when(sign == 0, F.lit(0)).otherwise(F.floor(F.log(F.abs("x")) / math.log(gamma)))
    d = long.withColumns({"sign": sign, "bucket": bucket.cast("long")})
    return d.groupBy(*by, "feature", "sign", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares"),
        F.sum(F.abs(F.col("x") - _stands_for(gamma))).alias("moved"))


def _stands_for(gamma: float):
    return F.col("sign") * F.pow(F.lit(gamma), F.col("bucket")) * F.lit((1 + gamma) / 2)


def merge_sketches(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One sketch of all rows, or one per value of ``by``."""
    return sketches.groupBy(*by, "feature", "sign", "bucket").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares", "moved")])


def wasserstein_sketch(reference: DataFrame, current: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """:func:`wasserstein` from two merged sketches, without a look at the
    rows: ``(feature, w1, n_ref, n_cur, ref_std, error_bound)``.  The exact
    distance is within ``error_bound`` (the mean way the values were moved, of
    both sets together); ``ref_std`` is exact."""
    def side(s, r):
        return s.select("feature", _stands_for(gamma).alias("x"), F.lit(r).alias("r_"), "n")

    cnt = materialize(side(reference, 1).unionByName(side(current, 0)).groupBy("feature", "x").agg(
        F.sum(F.col("n") * F.col("r_")).alias("r"), F.sum(F.col("n") * (1 - F.col("r_"))).alias("c")))

    def sums(s, name):
        return s.groupBy("feature").agg((F.sum("moved") / F.sum("n")).alias(f"_m{name}"), F.sum("n").alias(f"_n{name}"),
                                        F.sum("total").alias(f"_t{name}"), F.sum("squares").alias(f"_q{name}"))

    mean = F.col("_tr") / F.col("_nr")
    return (_from_counts(cnt).drop("ref_std").join(sums(reference, "r"), "feature").join(sums(current, "c"), "feature")
            .select("feature", "w1", "n_ref", "n_cur", F.sqrt(F.greatest(F.lit(0.0), F.col("_qr") / F.col("_nr") - mean * mean)).alias("ref_std"),
                    (F.col("_mr") + F.col("_mc")).alias("error_bound")))


def drift_report(w1: DataFrame, threshold: float = 0.1, share: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Per feature: normalised distance (W1 / reference std) and drift flag;
    summary: share of drifted features and the dataset-level decision."""
    norm = F.when(F.col("ref_std") > 0, F.col("w1") / F.col("ref_std")).otherwise(
        F.when(F.col("w1") > 0, F.lit(float("inf"))).otherwise(0.0))
    per = w1.withColumn("score", norm).withColumn("drifted", F.col("score") >= threshold)
    summary = per.agg(F.count(F.lit(1)).alias("n_features"), F.count_if("drifted").alias("n_drifted")) \
        .withColumn("share_drifted", F.col("n_drifted") / F.col("n_features")) \
        .withColumn("dataset_drift", F.col("share_drifted") >= share)
    return per, summary


def regression_drift(reference: DataFrame, current: DataFrame, label: str, prediction: str,
                     tolerance: float = 0.1) -> DataFrame:
    """Quality on the reference vs the current set, and a relative-change test
    per metric: lower-is-better metrics and the error spread may grow by
    ``tolerance``, r2 may fall by it, and the mean error may move by
    ``tolerance`` of the reference's error spread."""
    long = (melt_predictions(reference.withColumn("dataset", F.lit("reference")), label,
                             {"model": prediction}, ["dataset"])
            .unionByName(melt_predictions(current.withColumn("dataset", F.lit("current")), label,
                                          {"model": prediction}, ["dataset"])))
    wide = regression_metrics(long, ["dataset"])
    metrics = ["rmse", "mae", "mape", "medae", "r2", "mean_error", "error_std"]
    lm = wide.select("dataset", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))
    rows = lm.groupBy("metric").agg(
        F.max(F.when(F.col("dataset") == "reference", F.col("value"))).alias("reference"),
        F.max(F.when(F.col("dataset") == "current", F.col("value"))).alias("current"))
    ok = (F.when(F.col("metric") == "r2", F.col("current") >= F.col("reference") - tolerance)
           .when(F.col("metric") == "mean_error",
                 F.abs(F.col("current") - F.col("reference")) <= tolerance * F.col("_spread"))
           .otherwise(F.col("current") <= F.col("reference") * (1 + tolerance)))
    spread = rows.filter("metric = 'error_std'").select(F.col("reference").alias("_spread"))  # one row
    return rows.join(F.broadcast(spread)).withColumn("passed", ok).drop("_spread")

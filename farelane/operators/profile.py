"""Data profile: describe, equal-width histogram, box-plot outliers, extras
variance.  Each is one or two aggregation passes; quantiles are the exact
bounded ones from ``functions.quantiles``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.columns import nan_to_null
from farelane.functions.quantiles import quantiles


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per column, long:
    ``(column, stat, value)``."""
    aggs = []
    for i, c in enumerate(columns):
        x = nan_to_null(F.col(c).cast("double"))          # NaN is missing, as in describe()
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    names = [("count", "n"), ("mean", "m"), ("std", "s"), ("min", "lo"), ("max", "hi")]
    moments = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(st).alias("stat"), F.col(f"{k}{i}").cast("double").alias("value"))
        for i, c in enumerate(columns) for st, k in names])))
    q = quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"), "value")
    return moments.unionByName(q)


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed):
    ``(bin, lo, hi, count)``, empty bins included."""
    x = nan_to_null(F.col(column).cast("double"))
    rng = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    mn, mx = rng["mn"], rng["mx"]
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin long, lo double, hi double, count long")
    width = (mx - mn) / bins if mx > mn else 1.0
    b = F.least(F.floor((x - F.lit(mn)) / F.lit(mx - mn if mx > mn else 1.0) * bins), F.lit(bins - 1)) + 1
    counts = df.where(x.isNotNull()).groupBy(b.cast("long").alias("bin")).count()
    grid = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return (grid.join(F.broadcast(counts), "bin", "left")
                .select("bin", (F.lit(mn) + (F.col("bin") - 1) * F.lit(width)).alias("lo"),
                        (F.lit(mn) + F.col("bin") * F.lit(width)).alias("hi"),
                        F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def iqr_fences(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Q1, Q3, IQR and the k·IQR fences per column."""
    q = quantiles(df, columns, [0.25, 0.75])
    w = q.groupBy("column").agg(F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
                                F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    return (w.withColumn("iqr", F.col("q3") - F.col("q1"))
             .withColumn("lower", F.col("q1") - k * F.col("iqr"))
             .withColumn("upper", F.col("q3") + k * F.col("iqr")))


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """(summary with outlier count, outlier rows)."""
    f = iqr_fences(df, [column], k).first()
    x = F.col(column)
    rows = df.filter((x < F.lit(f["lower"])) | (x > F.lit(f["upper"])))
    summary = df.agg(F.count_if((x < F.lit(f["lower"])) | (x > F.lit(f["upper"]))).alias("n_outliers")).select(
        F.lit(column).alias("column"), F.lit(f["q1"]).alias("q1"), F.lit(f["q3"]).alias("q3"),
        F.lit(f["iqr"]).alias("iqr"), F.lit(f["lower"]).alias("lower"), F.lit(f["upper"]).alias("upper"),
        "n_outliers")
    return summary, rows


def extras_variance(df: DataFrame, total: str = "Total_Amt", fare: str = "Fare_Amt") -> DataFrame:
    """Sample variance of Total - Fare and its root (an error floor when the
    target is Total but only Fare is predictable)."""
    e = F.col(total).cast("double") - F.col(fare).cast("double")
    return df.agg(F.var_samp(e).alias("extras_var"), F.sqrt(F.var_samp(e)).alias("rmse_floor"),
                  F.avg(e).alias("extras_mean"))

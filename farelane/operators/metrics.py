"""Regression metrics (RMSE, MAE, R², MAPE, MedAE), several models and splits
in one grouped aggregation.

Predictions of several candidates are melted into ``(candidate, y, p)`` rows
(a narrow projection), then one ``groupBy`` computes the four moment-based
metrics with partial aggregation; MedAE is an exact grouped quantile of
``|y - p|`` (bounded, see ``functions.quantiles``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.config import MAPE_EPS
from farelane.functions.quantiles import quantiles


def mape_denominator(y: Column, zero_rule: str = "abs", eps: float = MAPE_EPS) -> Column:
    """``abs``: |y| < eps -> eps (evaluation);  ``zero``: y == 0 -> eps (retraining)."""
    if zero_rule == "abs":
        return F.when(F.abs(y) < eps, F.lit(eps)).otherwise(y)
    if zero_rule == "zero":
        return F.when(y == 0, F.lit(eps)).otherwise(y)
    raise ValueError(zero_rule)


def melt_predictions(df: DataFrame, label: str, predictions: dict[str, str],
                     group_cols=()) -> DataFrame:
    """``{candidate: prediction column}`` -> rows ``(*group_cols, candidate, y, p)``."""
    items = [F.struct(F.lit(k).alias("candidate"), F.col(v).cast("double").alias("p"))
             for k, v in predictions.items()]
    return df.select(*group_cols, F.col(label).cast("double").alias("y"), F.inline(F.array(*items)))


def regression_metrics(long: DataFrame, group_cols=("candidate",), zero_rule: str = "abs",
                       with_medae: bool = True) -> DataFrame:
    """Wide metrics per group: n, rmse, mae, r2, mape, medae (+ mean error, error std)."""
    g = list(group_cols)
    e = F.col("y") - F.col("p")
    base = long.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_ssr"),
        F.var_pop("y").alias("_vy"),
        (F.avg(F.abs(e / mape_denominator(F.col("y"), zero_rule))) * 100.0).alias("mape"),
        F.avg(e).alias("mean_error"),
        F.stddev_pop(e).alias("error_std"),
    )
    sst = F.col("_vy") * F.col("n")
    r2 = (F.when(sst == 0, F.when(F.col("_ssr") == 0, 1.0).otherwise(0.0))
           .otherwise(1.0 - F.col("_ssr") / sst))
    out = base.withColumn("r2", r2).drop("_ssr", "_vy")
    if with_medae:
        med = (quantiles(long.withColumn("_ae", F.abs(e)), ["_ae"], [0.5], group_cols=g)
               .select(*g, F.col("value").alias("medae")))
        out = out.join(med, g, "left")
    return out


def metrics_long(wide: DataFrame, group_cols=("candidate",),
                 metrics=("rmse", "mae", "r2", "mape", "medae")) -> DataFrame:
    """Wide -> the metrics table layout ``(*group_cols, metric, value)``."""
    items = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
             for m in metrics if m in wide.columns]
    return wide.select(*group_cols, F.inline(F.array(*items)))

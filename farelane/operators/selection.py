"""Model selection, promotion and the version registry, as SQL-shaped
operators over the metrics table ``(candidate, metric, value)`` and the
registry / ledger tables.  All inputs are small (one row per model and
metric); nothing here touches trip rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.config import LOWER_IS_BETTER, METRICS_ORDER, PROMOTION_METRICS, SELECTION_WEIGHTS


def mcdm_scores(metrics: DataFrame, weights: dict = SELECTION_WEIGHTS, order_col: str | None = None,
                candidate: str = "candidate") -> DataFrame:
    """Weighted min-max score (0 best) per candidate and its rank.

    Per metric: ``(x - min) / (max - min)`` (inverted for r2), clipped to
    [0, 1]; equal values, no finite value, an absent (candidate, metric) row or
    a result that isn't finite count 0.5.  An infinite value takes part in min
    and max, NaN and null don't.  Weights are normalised (non-positive sum ->
    uniform).  Ties keep evaluation order (``order_col`` if given, else
    candidate name)."""
    w = {m: float(weights.get(m, 0.0)) for m in METRICS_ORDER}
    tot = sum(w.values())
    w = {m: (v / tot if tot > 0 else 1.0 / len(METRICS_ORDER)) for m, v in w.items()}
    keys = [candidate] + ([order_col] if order_col else [])
    # every candidate has a row for every metric
    grid = metrics.select(*keys).distinct().withColumn("metric", F.explode(F.array(*[F.lit(x) for x in METRICS_ORDER])))
    got = (metrics.filter(F.col("metric").isin(METRICS_ORDER)).groupBy(candidate, "metric")
           .agg(F.max("value").cast("double").alias("_v")))
    m = grid.join(got, [candidate, "metric"], "left").withColumn("_v", F.when(~F.isnan("_v"), F.col("_v")))

    def finite(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    by = Window.partitionBy("metric")
    mn, mx = F.min("_v").over(by), F.max("_v").over(by)
    any_finite = F.max(finite(F.col("_v")).cast("int")).over(by) == 1
    raw = F.when(F.col("metric").isin(LOWER_IS_BETTER), F.try_divide(F.col("_v") - mn, mx - mn)) \
           .otherwise(F.try_divide(mx - F.col("_v"), mx - mn))
    norm = F.when(any_finite & (mx != mn) & finite(raw), F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))).otherwise(0.5)
    wmap = F.create_map(*[x for k, v in w.items() for x in (F.lit(k), F.lit(v))])
    scored = (m.withColumn("norm", norm).groupBy(*keys)
               .agg(F.sum(F.col("norm") * F.element_at(wmap, F.col("metric"))).alias("score")))
    rank_w = Window.orderBy("score", order_col or candidate)
    return scored.withColumn("rank", F.row_number().over(rank_w).cast("long"))


def promotion_choice(metrics: DataFrame, metric: str = "rmse", candidate: str = "candidate") -> DataFrame:
    """One row: which of ``new`` / ``stacked`` replaces ``old`` (or none).

    Strictly better than old is required; both better -> new if new <= stacked.
    Metric must be one of rmse, mae, mape, medae."""
    if metric not in PROMOTION_METRICS:
        raise ValueError(f"metric must be one of {PROMOTION_METRICS}")

    def pick(c, mname):
        return F.max(F.when((F.col(candidate) == c) & (F.col("metric") == mname), F.col("value")))

    row = metrics.agg(
        pick("old", metric).alias("old_val"), pick("new", metric).alias("new_val"),
        pick("stacked", metric).alias("stacked_val"), pick("old", "rmse").alias("rmse_old"),
        pick("new", "rmse").alias("rmse_new"), pick("stacked", "rmse").alias("rmse_stacked"))
    imp_new = F.coalesce(F.col("new_val") < F.col("old_val"), F.lit(False))
    imp_st = F.coalesce(F.col("stacked_val") < F.col("old_val"), F.lit(False))
    chosen = (F.when(imp_new & imp_st, F.when(F.col("new_val") <= F.col("stacked_val"), "new").otherwise("stacked"))
               .when(imp_new, "new").when(imp_st, "stacked"))
    return row.select(chosen.alias("chosen_on_val"), F.lit(metric).alias("metric"), "old_val", "new_val",
                      "stacked_val", "rmse_old", "rmse_new", "rmse_stacked")


def version_number(col: str = "version"):
    return F.regexp_extract(F.col(col), r"(\d+)", 1).cast("long")


def latest_version(registry: DataFrame, col: str = "version") -> DataFrame:
    """Latest, previous and next version from the registry's version names."""
    v = registry.select(col).distinct().withColumn("_num", version_number(col)).filter(F.col("_num").isNotNull())
    return v.agg(F.max_by(col, "_num").alias("latest"),
                 F.max("_num").alias("latest_num"),
                 F.concat(F.lit("v"), (F.coalesce(F.max("_num"), F.lit(0)) + 1).cast("string")).alias("next"),
                 F.count(F.lit(1)).alias("n_versions"))


def versions_ordered(registry: DataFrame, col: str = "version") -> DataFrame:
    """Versions with their previous version (for stacked scoring)."""
    v = registry.select(col).distinct().withColumn("num", version_number(col))
    return v.withColumn("previous", F.lag(col).over(Window.orderBy("num")))


def newest_artifact(artifacts: DataFrame, key: str = "model_key", path: str = "path",
                    ts: str = "created_at") -> DataFrame:
    """Newest artefact path per model key."""
    return artifacts.groupBy(key).agg(F.max_by(path, ts).alias(path), F.max(ts).alias(ts))


def scoring_resolution(registry: DataFrame, promotions: DataFrame, col: str = "version") -> DataFrame:
    """How each version scores: ``(version, num, previous, chosen_on_val, method)``.

    ``stacked`` if that was promoted, its meta-model is registered, and both
    this and the previous version have a final model; ``old`` if that was
    chosen and the previous version has a final model; else ``latest`` (a
    meta-model that wasn't chosen doesn't matter)."""
    v = registry.groupBy(col).agg(F.max((F.col("kind") == "meta").cast("int")).alias("_meta"),
                                  F.max((F.col("model_key") == "final").cast("int")).alias("_final"))
    by = Window.orderBy("num")          # one row per version
    v = (v.withColumn("num", version_number(col)).withColumn("previous", F.lag(col).over(by))
          .withColumn("_prev_final", F.lag("_final").over(by)))
    p = promotions.groupBy(col).agg(F.max("chosen_on_val").alias("chosen_on_val"))
    both = (F.col("_final") == 1) & F.coalesce(F.col("_prev_final") == 1, F.lit(False))
    method = (F.when((F.col("chosen_on_val") == "stacked") & (F.col("_meta") == 1) & both, "stacked")
               .when((F.col("chosen_on_val") == "old") & F.coalesce(F.col("_prev_final") == 1, F.lit(False)), "old")
               .otherwise("latest"))
    return v.join(p, col, "left").select(col, "num", "previous", "chosen_on_val", method.alias("method"))


# -- ledger and month window ----------------------------------------------------
def month_window(start_month: str, n: int = 3) -> str:
    """SQL expression for ``n`` consecutive ``YYYY-MM`` months from a start
    month, wrapping over year end."""
    return (f"transform(sequence(0, {n - 1}), i -> date_format(add_months(to_date('{start_month}-01'), i), "
            f"'yyyy-MM'))")


def months_to_read(spark, ledger: DataFrame, start_month: str, n: int = 3, month_col: str = "month") -> DataFrame:
    """Months of the window not already used by any version (left anti join)."""
    w = spark.range(1).select(F.explode(F.expr(month_window(start_month, n))).alias(month_col))
    return w.join(ledger.select(month_col).distinct(), month_col, "left_anti")


def ledger_from(df: DataFrame, version: str, month_col: str = "month") -> DataFrame:
    """Ledger rows ``(version, month)`` for the distinct months in ``df``."""
    return df.select(F.lit(version).alias("version"), F.col(month_col).alias("month")).distinct()

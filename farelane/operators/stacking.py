"""Ridge meta-model from sufficient statistics, and stacking.

The ridge fit needs only ``n``, the feature and label sums and the
(k+1)² cross products: one aggregation over the rows (partial sums combined
map-side), then a k×k solve on the driver.  The intercept is not penalised
(features and label are centred by their means), which is exactly what the
closed-form ridge with an intercept computes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.operators.models import FITS_AT_ONCE, concurrently, training_table
from farelane.operators.split import hash32, hash_folds
from farelane.session import materialize


def gram_sums(df: DataFrame, features: list[str], label: str) -> dict:
    cols = features + [label]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)]
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            aggs.append(F.sum(F.col(a).cast("double") * F.col(cols[j]).cast("double")).alias(f"p_{i}_{j}"))
    return df.agg(*aggs).first().asDict()


def ridge_from_sums(s: dict, all_cols: list[str], features: list[str], label: str,
                    alpha: float = 1.0) -> dict:
    """Ridge coefficients from ``gram_sums(df, all_cols, label)`` for any
    subset of ``all_cols``: one pass over the rows serves several fits."""
    n = s["n"]
    if not n:
        raise ValueError("no rows to fit")
    cols = all_cols + [label]
    idx = [cols.index(f) for f in features] + [len(all_cols)]
    k = len(features)

    def P(i, j):
        a, b = sorted((idx[i], idx[j]))
        return s[f"p_{a}_{b}"]

    mean = np.array([s[f"s_{idx[i]}"] / n for i in range(k + 1)])
    C = np.array([[P(i, j) for j in range(k + 1)] for i in range(k + 1)]) - n * np.outer(mean, mean)
    coef = np.linalg.solve(C[:k, :k] + alpha * np.eye(k), C[:k, k]) if k else np.zeros(0)
    out = {"intercept": float(mean[k] - mean[:k] @ coef)}
    out.update({f: float(c) for f, c in zip(features, coef)})
    return out


def ridge_fit(df: DataFrame, features: list[str], label: str, alpha: float = 1.0) -> dict:
    """Returns ``{"intercept": b0, feature: coef, ...}``; alpha = 0 is OLS."""
    return ridge_from_sums(gram_sums(df, features, label), features, features, label, alpha)


def ridge_predict(df: DataFrame, coefs: dict, out: str = "prediction") -> DataFrame:
    expr = F.lit(coefs["intercept"])
    for f, c in coefs.items():
        if f != "intercept":
            expr = expr + F.lit(c) * F.col(f).cast("double")
    return df.withColumn(out, expr)


def coef_table(spark, coefs: dict, artefact: str = "meta"):
    """Coefficients as params-table rows."""
    rows = [(artefact, k, "coef" if k != "intercept" else "intercept", float(v)) for k, v in coefs.items()]
    return spark.createDataFrame(rows, "artefact string, column string, stat string, value double")


def stack_in_sample(df: DataFrame, base_cols: list[str], label: str, alpha: float = 1.2,
                    fraction: float = 0.8, key: str = "trip_id", seed: int = 42) -> dict:
    """Meta-model on base predictions over a deterministic sample of the rows
    the base models were trained on."""
    sample = df.filter(hash32(key, seed) < F.lit(int(fraction * 2 ** 32)))
    return ridge_fit(sample, base_cols, label, alpha)


def stack_oof(df: DataFrame, fit_predict, old_col: str, label: str, k: int = 5, alpha: float = 0.5,
              key: str = "trip_id", seed: int = 42, pred_col: str = "pred_new", at_once: int = FITS_AT_ONCE,
              also: dict | None = None, folds=hash_folds) -> tuple[DataFrame, dict]:
    """Out-of-fold stacking: for each fold i, ``fit_predict(train_df, apply_df)``
    fits the new learner on rows with fold != i and predicts the fold-i rows;
    the union of fold predictions and the old model's column feed the ridge.

    ``fit_predict`` returns ``apply_df`` with ``pred_col`` added.  The folds are
    fitted side by side, ``at_once`` at a time, each on its own training table.
    ``folds``: how rows are dealt (``hash_folds`` or ``exact_folds``); the dealt
    rows are written once, so that all fits see the same folds.
    ``also``: other fits (name -> call) to run with them; the dict gets their
    results."""
    d = materialize(folds(df, k, key, seed, "_fold"), ["_fold"])

    def fold(i):
        return lambda: fit_predict(training_table(d.filter(F.col("_fold") != i).drop("_fold"), key), d.filter(F.col("_fold") == i))

    also = {} if also is None else also
    done = concurrently(df.sparkSession, dict(also) | {i: fold(i) for i in range(k)}, at_once)
    also.update({n: done[n] for n in also})
    oof = done[0]
    for i in range(1, k):
        oof = oof.unionByName(done[i])
    coefs = ridge_fit(oof, [old_col, pred_col], label, alpha)
    return oof.drop("_fold"), coefs

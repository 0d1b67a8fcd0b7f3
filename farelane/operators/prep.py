"""Fitted preprocessing: scalers and imputers as (fit -> params table ->
transform).

``fit_*`` runs one aggregation over the training rows (all statistics of all
columns in the same pass, partial aggregates combined map-side) and returns a
long params table ``(artefact, column, stat, value)`` that can be persisted
with :func:`save_params` and reused by later runs.  ``transform`` turns the
params (a few dozen numbers) into literals, so applying them is a plain
projection that Catalyst constant-folds into the codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.columns import as_float, nan_to_null
from farelane.functions.quantiles import quantiles

PARAMS_SCHEMA = "artefact string, column string, stat string, value double"


def _wide_to_long(wide: DataFrame, artefact: str, names: dict[str, tuple[str, str]]) -> DataFrame:
    """Unpivot a one-row stats frame into the long params table, lazily."""
    items = [F.struct(F.lit(artefact).alias("artefact"), F.lit(c).alias("column"),
                      F.lit(s).alias("stat"), F.col(k).cast("double").alias("value"))
             for k, (c, s) in names.items()]
    return wide.select(F.inline(F.array(*items)))


def fit_scaler(df: DataFrame, columns: list[str], method: str = "standard",
               artefact: str = "scaler") -> DataFrame:
    """Fit ``standard`` (mean, population std), ``minmax`` or ``robust``
    (median, IQR).  Unknown names raise."""
    method = method.lower().replace("scaler", "")
    aggs, names = [], {}
    # NaN counts as missing in the statistics (as in the original scalers)
    df = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    if method == "standard":
        for i, c in enumerate(columns):
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
            names[f"m{i}"] = (c, "center")
            names[f"s{i}"] = (c, "scale")
        wide = df.agg(*aggs)
        # zero spread -> scale 1 (the value is then only centred)
        wide = wide.withColumns({f"s{i}": F.when(F.col(f"s{i}") == 0, 1.0).otherwise(F.col(f"s{i}"))
                                 for i in range(len(columns))})
    elif method == "minmax":
        for i, c in enumerate(columns):
            aggs += [F.min(c).alias(f"m{i}"), (F.max(c) - F.min(c)).alias(f"s{i}")]
            names[f"m{i}"] = (c, "center")
            names[f"s{i}"] = (c, "scale")
        wide = df.agg(*aggs).withColumns(
            {f"s{i}": F.when(F.col(f"s{i}") == 0, 1.0).otherwise(F.col(f"s{i}")) for i in range(len(columns))})
    elif method == "robust":
        q = quantiles(df, columns, [0.25, 0.5, 0.75])
        center = q.filter(F.col("p") == 0.5).select("column", F.lit("center").alias("stat"), "value")
        iqr = (q.groupBy("column")
                .agg((F.max(F.when(F.col("p") == 0.75, F.col("value")))
                      - F.max(F.when(F.col("p") == 0.25, F.col("value")))).alias("value"))
                .select("column", F.lit("scale").alias("stat"),
                        F.when(F.col("value") == 0, 1.0).otherwise(F.col("value")).alias("value")))
        return center.unionByName(iqr).select(F.lit(artefact).alias("artefact"), "column", "stat", "value")
    else:
        raise ValueError(f"unknown scaler {method!r}")
    return _wide_to_long(wide, artefact, names)


def fit_imputer(df: DataFrame, columns: list[str], strategy: str = "mean",
                artefact: str = "imputer") -> DataFrame:
    """Mean (or median) of every column over the training rows."""
    df = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    if strategy == "mean":
        wide = df.agg(*[F.avg(c).alias(f"v{i}") for i, c in enumerate(columns)])
        return _wide_to_long(wide, artefact, {f"v{i}": (c, "fill") for i, c in enumerate(columns)})
    if strategy == "median":
        q = quantiles(df, columns, [0.5])
        return q.select(F.lit(artefact).alias("artefact"), "column", F.lit("fill").alias("stat"), "value")
    raise ValueError(f"unknown imputer {strategy!r}")


def params_dict(params: DataFrame, artefact: str | None = None) -> dict[str, dict[str, float]]:
    """Bring the fitted params (one value per column and stat) to the driver."""
    if artefact is not None:
        params = params.filter(F.col("artefact") == artefact)
    out: dict[str, dict[str, float]] = {}
    for r in params.collect():
        out.setdefault(r["column"], {})[r["stat"]] = r["value"]
    return out


def transform_scaler(df: DataFrame, params, float_out: bool = True) -> DataFrame:
    """(x - center) / scale with fitted literals."""
    p = params if isinstance(params, dict) else params_dict(params)
    cols = {}
    for c, st in p.items():
        if c in df.columns:
            e = (F.col(c) - F.lit(st["center"])) / F.lit(st["scale"])
            cols[c] = as_float(e) if float_out else e
    return df.withColumns(cols)


def transform_imputer(df: DataFrame, params) -> DataFrame:
    """Null (or NaN) -> fitted value, column by column."""
    p = params if isinstance(params, dict) else params_dict(params)
    return df.withColumns({c: F.coalesce(nan_to_null(c), F.lit(st["fill"]).cast(df.schema[c].dataType))
                           for c, st in p.items() if c in df.columns})


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column and in total, one pass: ``(column, nulls)``."""
    columns = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    items.append(F.struct(F.lit("__total__").alias("column"),
                          sum((F.col(f"n{i}") for i in range(len(columns))), F.lit(0)).alias("nulls")))
    return wide.select(F.inline(F.array(*items)))


def save_params(params: DataFrame, path: str, mode: str = "overwrite") -> None:
    params.write.mode(mode).parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMS_SCHEMA).parquet(path)

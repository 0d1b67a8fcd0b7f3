"""Learners on MLlib: estimator registry, feature assembly, fit, predict,
feature importances.

MLlib trains distributed (tree learners aggregate split statistics per
partition), so the feature table is never brought to the driver.  The three
boosted-tree libraries of the original are not available here; the registry
maps their roles to ``GBTRegressor`` (two settings) and a random forest as the
third, diverse learner.
"""

from __future__ import annotations

import importlib
import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.config import ModelParams
from farelane.operators import boosting
from farelane.session import materialize

BASE_FEATURES = [
    "Passenger_Count", "Start_Lon", "Start_Lat", "End_Lon", "End_Lat", "haversine_distance_m",
    "pickup_distance_to_nyc_m", "dropoff_distance_to_nyc_m", "pickup_distance_to_jfk_m",
    "dropoff_distance_to_jfk_m", "pickup_distance_to_lga_m", "dropoff_distance_to_lga_m",
    "pickup_distance_to_nla_m", "dropoff_distance_to_nla_m", "pickup_distance_to_chp_m",
    "dropoff_distance_to_chp_m", "pickup_distance_to_exp_m", "dropoff_distance_to_exp_m",
    "pickup_hour_sin", "pickup_hour_cos", "pickup_weekday_sin", "pickup_weekday_cos",
]
ROUTE_FEATURES = ["route_distance_m", "route_duration_s", "average_speed_m_s", "ratio_haversine_osrm"]
DROP_BEFORE_TRAINING = ["Real_time", "Real_distance"]
COMPLEMENT = {"Fare_Amt": "Total_Amt", "Total_Amt": "Fare_Amt"}
#: Fits that run at once: each holds its training rows in the executors' memory.
FITS_AT_ONCE = 6
#: Lineage is cut every 3 rounds: each of a round's jobs carries what isn't.  (Node
#: ids kept between levels cost a sixth more here than finding them again.)
TREE_SETTINGS = dict(checkpointInterval=3)


def estimator(name_or_class: str, params: dict | None = None, features_col: str = "features",
              label: str = "Fare_Amt", prediction: str = "prediction"):
    """By registry name (gbt_a, gbt_b, forest, linear) or dotted class path."""
    p = dict(params or {})
    reg = {"gbt_a": GBTRegressor, "gbt_b": GBTRegressor, "forest": RandomForestRegressor,
           "linear": LinearRegression}
    if name_or_class in reg:
        cls = reg[name_or_class]
        if not p:
            mp = ModelParams()
            p = {"gbt_a": mp.gbt_a, "gbt_b": mp.gbt_b, "forest": mp.forest, "linear": {}}[name_or_class]
    else:
        mod, _, attr = name_or_class.rpartition(".")
        cls = getattr(importlib.import_module(mod), attr)
    if cls in (GBTRegressor, RandomForestRegressor):
        p = TREE_SETTINGS | p
    return cls(featuresCol=features_col, labelCol=label, predictionCol=prediction, **p)


def detect_target(df: DataFrame, configured: str | None = "Fare_Amt") -> str:
    """Configured target if present, else Fare_Amt, else the last column."""
    if configured and configured in df.columns:
        return configured
    if "Fare_Amt" in df.columns:
        return "Fare_Amt"
    return df.columns[-1]


def training_frame(df: DataFrame, target: str = "Fare_Amt") -> DataFrame:
    """Drop the measure columns and the complementary target (if present)."""
    drop = DROP_BEFORE_TRAINING + [COMPLEMENT.get(target, "")]
    return df.drop(*[c for c in drop if c in df.columns])


def feature_columns(df: DataFrame, target: str, exclude=("trip_id", "split", "month", "fold")) -> list[str]:
    order = BASE_FEATURES + ROUTE_FEATURES
    present = [c for c in order if c in df.columns]
    return present or [c for c in df.columns if c != target and c not in exclude]


def fit(df: DataFrame, name: str, features: list[str], label: str, params: dict | None = None,
        prediction: str = "prediction") -> PipelineModel:
    """Boosted trees grow in one task where its memory holds the binned rows
    (``boosting``), the others, and all larger ones, in MLlib's jobs."""
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    est = estimator(name, params, label=label, prediction=prediction)
    if isinstance(est, GBTRegressor) and boosting.fits_here(est, df, features):
        model = boosting.fit(est, asm.transform(df), features)
        if model is not None:
            return PipelineModel([asm, model])
    return Pipeline(stages=[asm, est]).fit(df)


def training_table(df: DataFrame, key: str = "trip_id", rows_per_partition: int = 50_000) -> DataFrame:
    """``df`` written once for all fits that read it.  Rows are dealt and sorted
    by ``key`` into partitions of about ``rows_per_partition``, so that sampled
    rows, and with them the fitted trees, don't hang on the cluster's size.
    ``df`` is read twice, to count and to deal, so it should read a written table."""
    n = max(1, -(-df.count() // rows_per_partition))
    return materialize(df.repartition(n, F.col(key)).sortWithinPartitions(key))


def concurrently(spark: SparkSession, fits: dict[str, Callable[[], object]], at_once: int = FITS_AT_ONCE) -> dict:
    """Results of ``fits`` by name, at most ``at_once`` at a time.

    A fit of trees is a chain of small jobs, one or more per level, that leaves
    most of a cluster idle, so fits that don't need each other run side by side.
    Each thread has the caller's job properties and a pool of its own, to share
    the cores evenly where the scheduler is FAIR.  The first error is raised
    when all have ended."""
    def run(name: str):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
        return fits[name]()

    with ThreadPoolExecutor(max(1, min(at_once, len(fits)))) as pool:
        # the caller's properties are taken when a fit is handed over
        running = {k: pool.submit(inheritable_thread_target(spark)(run), k) for k in fits}
    return {k: f.result() for k, f in running.items()}


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    stage = model.stages[-1]
    pcol = stage.getOrDefault("predictionCol")
    res = model.transform(df).drop("features")
    return res.withColumnRenamed(pcol, out) if pcol != out else res


def feature_importances(spark: SparkSession, model: PipelineModel, features: list[str],
                        top: int | None = None) -> DataFrame:
    """``(feature, importance)`` sorted descending (optionally the top n)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), F.col("feature"))
    return df.limit(top) if top else df


def fit_with_validation(df: DataFrame, features: list[str], label: str, is_val: str = "is_val",
                        params: dict | None = None, prediction: str = "prediction") -> PipelineModel:
    """Boosted trees that watch a validation subset (rows with ``is_val``
    true) and stop adding trees once its error stops improving."""
    p = dict(params or ModelParams().gbt_a)
    p["validationIndicatorCol"] = is_val
    return fit(df, "gbt_a", features, label, p, prediction)


def training_curve(model: PipelineModel, sets: dict[str, DataFrame], label: str) -> DataFrame:
    """``(round, set, rmse)``: the error of the first 1, 2, ... rounds of
    boosted trees on every set of rows.  One pass per set: each row's
    predictions are summed up tree by tree, in the task that holds it."""
    asm, trees = model.stages[0], model.stages[-1]
    rows = []
    for name, df in sets.items():
        if df.isEmpty():
            continue
        data = asm.transform(df.withColumn(label, F.col(label).cast("double")))
        rows += [(i + 1, name, math.sqrt(mse)) for i, mse in enumerate(trees.evaluateEachIteration(data, "squared"))]
    some = next(iter(sets.values()))
    return some.sparkSession.createDataFrame(rows, "round int, set string, rmse double")


def best_round(curve: DataFrame, on: str = "val") -> int:
    """The first round with the smallest error on a set: what a watched
    training keeps."""
    return curve.filter(F.col("set") == on).orderBy("rmse", "round").first()["round"]

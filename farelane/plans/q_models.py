"""Registered queries for learners (no SQL oracle: rows-only checks).

They train on the processed feature table of the derived trips (training
months), so the work grows with the trips.  The settings are the shipped ones,
``ModelParams()``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from farelane.config import ModelParams
from farelane.operators import metrics as M
from farelane.operators import models as ML
from farelane.operators import selection as SEL
from farelane.operators import split as S
from farelane.operators import stacking as ST
from farelane.plans import pipeline
from farelane.session import materialize
from farelane.sources.tables import load_monthly_trips

Q, SQL = {}, {}
MP = ModelParams()
TARGET = "Fare_Amt"


def processed(spark, sf):
    raw = materialize(S.split_train_val_test(pipeline.ingest(load_monthly_trips(spark, sf))))
    t, art = pipeline.processed_table(raw)
    t = ML.training_frame(t, TARGET)
    return materialize(t), art


def boosted(t, feats):
    """``gbt_a`` on the training rows, dealt out by key: as the processed
    table's files lie, a single task may hold them all."""
    return ML.fit(ML.training_table(t.filter(F.col("split") == "train")), "gbt_a", feats, TARGET, MP.gbt_a)


def gbt_predict(spark, sf):
    t, _ = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    model = boosted(t, feats)
    return ML.predict(model, t.filter(F.col("split") == "val")).select("trip_id", "prediction")


def feature_importances(spark, sf):
    t, _ = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    model = boosted(t, feats)
    return ML.feature_importances(spark, model, feats, top=30)


def model_selection(spark, sf):
    """Three learners + in-sample ridge stack, evaluated on val, MCDM-ranked."""
    t, _ = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    train = ML.training_table(t.filter(F.col("split") == "train"))
    params = {"gbt_a": MP.gbt_a, "gbt_b": MP.gbt_b, "forest": MP.forest}
    models = ML.concurrently(spark, {k: lambda k=k, p=p: ML.fit(train, k, feats, TARGET, p, prediction=f"pred_{k}")
                                     for k, p in params.items()})
    scored = t
    for k, m in models.items():
        scored = m.transform(scored).drop("features")
    scored = materialize(scored)
    meta = ST.stack_in_sample(scored.filter(F.col("split") == "train"), [f"pred_{k}" for k in params], TARGET,
                              alpha=MP.ridge_alpha_base, fraction=MP.meta_train_frac)
    scored = ST.ridge_predict(scored, meta, "pred_stacked")
    preds = {k: f"pred_{k}" for k in params} | {"stacked": "pred_stacked"}
    long = M.melt_predictions(scored.filter(F.col("split") == "val"), TARGET, preds)
    return SEL.mcdm_scores(M.metrics_long(M.regression_metrics(long, ["candidate"]), ["candidate"]))


def stack_oof(spark, sf):
    """Old model = linear, new = boosted trees refit per fold; ridge on both."""
    t, _ = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    train = t.filter(F.col("split") == "train")
    old = ML.fit(train, "linear", feats, TARGET, {}, prediction="pred_old")
    base = materialize(old.transform(train).drop("features"))

    def fit_predict(tr, ap):
        m = ML.fit(tr, "gbt_b", feats, TARGET, MP.gbt_b, prediction="pred_new")
        return m.transform(ap).drop("features")

    _, coefs = ST.stack_oof(base, fit_predict, "pred_old", TARGET, k=MP.oof_folds, alpha=MP.ridge_alpha_ct, folds=S.exact_folds)
    return ST.coef_table(spark, coefs)


def score_trips(spark, sf):
    """Scoring job: stored params + model applied to raw request rows (the
    third month, fare unknown) without outlier rules; a missing pickup time
    counts as now."""
    t, art = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    model = boosted(t, feats)
    req = (S.month_split(load_monthly_trips(spark, sf)).filter(F.col("split") == "valtest")
           .select("trip_id", "Trip_Pickup_DateTime", "Passenger_Count", "Start_Lon", "Start_Lat",
                   "End_Lon", "End_Lat", F.lit(None).cast("double").alias("Fare_Amt")))
    f = pipeline.score_features(pipeline.ingest_requests(req), art)
    return ML.predict(model, f).select("trip_id", F.round("prediction", 2).alias("fare"))


def gbt_validation_watch(spark, sf):
    """Boosted trees on train + val rows, watching the val rows (early stop)."""
    t, _ = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    tv = t.filter(F.col("split").isin("train", "val")).withColumn("is_val", F.col("split") == "val")
    model = ML.fit_with_validation(tv, feats, TARGET, "is_val", MP.gbt_a)
    return ML.predict(model, t.filter(F.col("split") == "test")).select("trip_id", "prediction")


def training_curve(spark, sf):
    """Training and validation error after every round that the watch kept."""
    t, _ = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    tv = ML.training_table(t.filter(F.col("split").isin("train", "val")).withColumn("is_val", F.col("split") == "val"))
    model = ML.fit_with_validation(tv, feats, TARGET, "is_val", MP.gbt_a)
    return ML.training_curve(model, {s: tv.filter(F.col("split") == s) for s in ("train", "val")}, TARGET)


def learner_relations(spark, sf):
    """Relations that hold for any sound fit: rows per split, a prediction for
    every validation row, training errors below the train mean's, fold sizes,
    importances that sum to one."""
    t, _ = processed(spark, sf)
    feats = ML.feature_columns(t, TARGET)
    train = ML.training_table(t.filter(F.col("split") == "train"))
    mean = train.agg(F.avg(TARGET)).first()[0]
    scored = train.withColumn("pred_mean", F.lit(mean))
    params = {"gbt_a": MP.gbt_a, "forest": MP.forest, "linear": {}}
    models = ML.concurrently(spark, {k: lambda k=k, p=p: ML.fit(train, k, feats, TARGET, p, prediction=f"pred_{k}")
                                     for k, p in params.items()})
    for m in models.values():
        scored = m.transform(scored).drop("features")
    long = M.melt_predictions(scored, TARGET, {k: f"pred_{k}" for k in ("mean", *models)})
    rmse = {r["candidate"]: r["rmse"] for r in M.regression_metrics(long, with_medae=False).collect()}
    val = ML.predict(models["gbt_a"], t.filter(F.col("split") == "val"))
    n = {r["split"]: r["count"] for r in t.groupBy("split").count().collect()}
    folds = {r["fold"]: r["count"] for r in S.hash_folds(train, MP.oof_folds).groupBy("fold").count().collect()}
    imp = ML.feature_importances(spark, models["gbt_a"], feats).agg(F.sum("importance")).first()[0]
    rows = [(f"rows_{s}", n.get(s, 0)) for s in ("train", "val", "test")]
    rows += [(f"fold_{i}", folds.get(i, 0)) for i in range(MP.oof_folds)]
    rows += [("val_predicted", val.filter(F.col("prediction").isNotNull()).count())]
    rows += [(f"{k}_beats_mean", int(rmse[k] < rmse["mean"])) for k in models]
    rows += [("importances_sum_to_one", int(abs(imp - 1) < 1e-6))]
    return spark.createDataFrame(rows, "relation string, value long")


def _learner_relations_sql():
    from farelane.plans.q_routes import _dist
    from farelane.plans.q_select import _base_sql
    from farelane.plans.q_split import hash_sql
    return _base_sql() + f""",
kept AS (SELECT c.trip_id, l.split FROM cleaned c JOIN labels l USING (trip_id)
         WHERE {_dist} > 0 AND c.haversine_distance_m <> 0 AND l.split <> 'extra'
           AND c.Passenger_Count IS NOT NULL AND c.Start_Lon IS NOT NULL AND c.Start_Lat IS NOT NULL)
SELECT 'rows_' || s AS relation, (SELECT count(*) FROM kept WHERE split = s)::BIGINT AS value
FROM (VALUES ('train'), ('val'), ('test')) t(s)
UNION ALL SELECT 'fold_' || f, (SELECT count(*) FROM kept WHERE split = 'train' AND {hash_sql()} % 5 = f)::BIGINT FROM range(5) t(f)
UNION ALL SELECT 'val_predicted', (SELECT count(*) FROM kept WHERE split = 'val')::BIGINT
UNION ALL SELECT k || '_beats_mean', 1::BIGINT FROM (VALUES ('gbt_a'), ('forest'), ('linear')) t(k)
UNION ALL SELECT 'importances_sum_to_one', 1::BIGINT"""


Q["learner_relations"] = learner_relations
SQL["learner_relations"] = _learner_relations_sql()
Q.update(gbt_validation_watch=gbt_validation_watch, training_curve=training_curve)
Q.update(gbt_predict=gbt_predict, feature_importances=feature_importances, model_selection=model_selection,
         stack_oof=stack_oof, score_trips=score_trips)

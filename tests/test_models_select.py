"""Selection, promotion, ridge, scalers, imputers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.config import SCALED_COLUMNS
from farelane.operators import prep
from farelane.operators import selection as SEL
from farelane.operators import stacking as ST
from farelane.plans import pipeline
from farelane.sources.tables import load_trips

from conftest import SF01


def _metrics(spark, d):
    return spark.createDataFrame([(c, m, float(v)) for c, ms in d.items() for m, v in ms.items()],
                                 "candidate string, metric string, value double")


def test_promotion_golden_values(spark):
    m = _metrics(spark, {"old": {"rmse": 1.7586855}, "new": {"rmse": 1.7449095}, "stacked": {"rmse": 1.7394913}})
    r = SEL.promotion_choice(m, "rmse").first()
    assert r["chosen_on_val"] == "stacked"
    m2 = _metrics(spark, {"old": {"rmse": 1.0}, "new": {"rmse": 1.5}, "stacked": {"rmse": 1.2}})
    assert SEL.promotion_choice(m2).first()["chosen_on_val"] is None
    m3 = _metrics(spark, {"old": {"rmse": 2.0}, "new": {"rmse": 1.5}, "stacked": {"rmse": 1.5}})
    assert SEL.promotion_choice(m3).first()["chosen_on_val"] == "new"
    with pytest.raises(ValueError):
        SEL.promotion_choice(m, "r2")


def test_mcdm_equal_and_order(spark):
    m = _metrics(spark, {"a": {"rmse": 1.0, "mae": 1.0, "r2": 0.5, "mape": 10, "medae": 1},
                         "b": {"rmse": 2.0, "mae": 1.0, "r2": 0.9, "mape": 10, "medae": 2}})
    r = {x["candidate"]: (x["score"], x["rank"]) for x in SEL.mcdm_scores(m).collect()}
    # a: rmse 0, mae .5, r2 1, mape .5, medae 0 -> .25*.5 + .05*1 + .1*.5 = .225
    assert r["a"][0] == pytest.approx(0.225) and r["a"][1] == 1
    assert r["b"][0] == pytest.approx(0.5 + 0.125 + 0.0 + 0.05 + 0.1)


def test_registry_versions(spark):
    reg = spark.createDataFrame([("v1",), ("v2",), ("v10",)], "version string")
    r = SEL.latest_version(reg).first()
    assert r["latest"] == "v10" and r["next"] == "v11"
    prev = {x["version"]: x["previous"] for x in SEL.versions_ordered(reg).collect()}
    assert prev == {"v1": None, "v2": "v1", "v10": "v2"}


def test_ridge_equals_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([1.5, -2.0, 0.3]) + 4 + rng.normal(scale=0.1, size=400)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)], "a double, b double, c double, y double")
    for alpha in (0.0, 1.2):
        got = ST.ridge_fit(df, ["a", "b", "c"], "y", alpha)
        Xc, yc = X - X.mean(0), y - y.mean()
        coef = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
        assert [got[k] for k in "abc"] == pytest.approx(coef.tolist(), rel=1e-8)
        assert got["intercept"] == pytest.approx(y.mean() - X.mean(0) @ coef, rel=1e-8)


def test_standard_scaler_properties(spark):
    f = pipeline.base_features(pipeline.clean_trips(load_trips(spark, SF01)))
    p = prep.fit_scaler(f, SCALED_COLUMNS[:3])
    out = prep.transform_scaler(f, p, float_out=False)
    for c in SCALED_COLUMNS[:3]:
        r = out.agg(F.avg(c), F.stddev_pop(c)).first()
        assert r[0] == pytest.approx(0.0, abs=1e-9) and r[1] == pytest.approx(1.0, rel=1e-9)
    with pytest.raises(ValueError):
        prep.fit_scaler(f, SCALED_COLUMNS[:1], "nope")


def test_imputer_and_params_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "trip_id long, Passenger_Count double")
    p = prep.fit_imputer(df, ["Passenger_Count"])
    prep.save_params(p, str(tmp_path / "params"))
    loaded = prep.load_params(spark, str(tmp_path / "params"))
    out = {r["trip_id"]: r["Passenger_Count"] for r in prep.transform_imputer(df, loaded).collect()}
    assert out == {1: 1.0, 2: 2.0, 3: 3.0}
    nc = {r["column"]: r["nulls"] for r in prep.null_counts(df).collect()}
    assert nc == {"trip_id": 0, "Passenger_Count": 1, "__total__": 1}


def test_scoring_resolution_and_newest_artifact(spark):
    import datetime as dt
    rows = [(v, "final", "x") for v in ("v1", "v2", "v3", "v4", "v10")] + [(v, "stacked", "meta") for v in ("v1", "v2", "v3")]
    reg = spark.createDataFrame(rows, "version string, model_key string, kind string")
    promo = spark.createDataFrame([("v2", "stacked"), ("v3", "new"), ("v4", "old"), ("v10", "stacked")], "version string, chosen_on_val string")
    m = {r["version"]: (r["previous"], r["method"]) for r in SEL.scoring_resolution(reg, promo).collect()}
    # v1 has a meta-model but no promotion, v3 has one but "new" was chosen, v10 was promoted stacked without one
    assert m == {"v1": (None, "latest"), "v2": ("v1", "stacked"), "v3": ("v2", "latest"), "v4": ("v3", "old"), "v10": ("v4", "latest")}
    arts = spark.createDataFrame([("gbt", "/a", dt.datetime(2024, 1, 1)), ("gbt", "/b", dt.datetime(2024, 2, 1)),
                                  ("rf", "/c", dt.datetime(2024, 1, 5))],
                                 "model_key string, path string, created_at timestamp")
    got = {r["model_key"]: r["path"] for r in SEL.newest_artifact(arts).collect()}
    assert got == {"gbt": "/b", "rf": "/c"}


def test_learners_beat_the_mean(spark):
    """On a target that depends on the features, each learner and the stack
    beat the train-mean predictor on the validation rows."""
    from farelane.config import ModelParams
    from farelane.operators import metrics as M
    from farelane.operators import models as ML
    from farelane.operators import split as S
    from farelane.sources.tables import load_monthly_trips
    raw = S.split_train_val_test(pipeline.ingest(load_monthly_trips(spark, SF01)))
    t, _ = pipeline.processed_table(raw)
    t = ML.training_frame(t).withColumn(
        "Fare_Amt", F.lit(2.5) + F.col("route_distance_m") * 1.7 + F.col("pickup_hour_sin") * 0.8)
    feats = ML.feature_columns(t, "Fare_Amt")
    mp = ModelParams.quick()
    train = t.filter(F.col("split") == "train")
    mean = train.agg(F.avg("Fare_Amt")).first()[0]
    scored = t.withColumn("pred_mean", F.lit(mean))
    for k, p in (("gbt_a", mp.gbt_a), ("forest", mp.forest), ("linear", {})):
        scored = ML.fit(train, k, feats, "Fare_Amt", p, prediction=f"pred_{k}").transform(scored).drop("features")
    meta = ST.stack_in_sample(scored.filter(F.col("split") == "train"), ["pred_gbt_a", "pred_forest"], "Fare_Amt")
    scored = ST.ridge_predict(scored, meta, "pred_stacked")
    preds = {k: f"pred_{k}" for k in ("mean", "gbt_a", "forest", "linear", "stacked")}
    long = M.melt_predictions(scored.filter(F.col("split") == "val"), "Fare_Amt", preds)
    rmse = {r["candidate"]: r["rmse"] for r in M.regression_metrics(long, with_medae=False).collect()}
    for k in ("gbt_a", "forest", "linear", "stacked"):
        assert rmse[k] < 0.5 * rmse["mean"], (k, rmse)


def test_month_window_wraps_year(spark):
    led = spark.createDataFrame([("v1", "2009-11")], "version string, month string")
    got = [r["month"] for r in SEL.months_to_read(spark, led, "2009-11", 3).orderBy("month").collect()]
    assert got == ["2009-12", "2010-01"]


def test_estimator_by_dotted_path_and_target_detection(spark):
    from farelane.operators import models as ML
    est = ML.estimator("pyspark.ml.regression.LinearRegression", {"regParam": 0.1}, label="y")
    assert est.getRegParam() == 0.1 and est.getLabelCol() == "y"
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    assert ML.detect_target(df, "b") == "b"
    assert ML.detect_target(df, "missing") == "c"
    assert ML.training_frame(spark.createDataFrame([(1.0, 2.0, 3.0)], "Fare_Amt double, Total_Amt double, Real_time double"),
                             "Fare_Amt").columns == ["Fare_Amt"]


def test_nan_is_missing_in_fits_and_profile(spark):
    from farelane.operators import profile as P
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    sc = prep.params_dict(prep.fit_scaler(df, ["v"]))
    assert sc["v"]["center"] == pytest.approx(2.0) and sc["v"]["scale"] == pytest.approx(1.0)
    filled = [r["v"] for r in prep.transform_imputer(df, prep.fit_imputer(df, ["v"])).collect()]
    assert filled == [1.0, 2.0, 3.0, 2.0]
    d = {r["stat"]: r["value"] for r in P.describe(df, ["v"]).collect()}
    assert d["count"] == 2 and d["mean"] == pytest.approx(2.0) and d["max"] == 3.0
    h = P.histogram(df, "v", 2).collect()
    assert sum(r["count"] for r in h) == 2


def test_stack_oof_matches_numpy(spark):
    import hashlib
    from farelane.operators import models as ML
    rng = np.random.default_rng(7)
    n = 300
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = 2.0 * a - 1.0 * b + 0.5 + rng.normal(scale=0.3, size=n)
    old = 1.8 * a + rng.normal(scale=0.5, size=n)
    df = spark.createDataFrame([(i, float(a[i]), float(b[i]), float(y[i]), float(old[i])) for i in range(n)],
                               "trip_id long, a double, b double, y double, pred_old double")

    def fit_predict(tr, ap):
        m = ML.fit(tr, "pyspark.ml.regression.LinearRegression", ["a", "b"], "y",
                   {"solver": "normal", "regParam": 0.0}, prediction="pred_new")
        return m.transform(ap).drop("features")

    _, coefs = ST.stack_oof(df, fit_predict, "pred_old", "y", k=5, alpha=0.5)
    fold = np.array([int(hashlib.md5(f"{i}|42".encode()).hexdigest()[:8], 16) % 5 for i in range(n)])
    X = np.column_stack([np.ones(n), a, b])
    new = np.empty(n)
    for f in range(5):
        tr, te = fold != f, fold == f
        beta = np.linalg.lstsq(X[tr], y[tr], rcond=None)[0]
        new[te] = X[te] @ beta
    Z = np.column_stack([old, new])
    Zc, yc = Z - Z.mean(0), y - y.mean()
    c = np.linalg.solve(Zc.T @ Zc + 0.5 * np.eye(2), Zc.T @ yc)
    assert [coefs["pred_old"], coefs["pred_new"]] == pytest.approx(c.tolist(), rel=1e-6)
    assert coefs["intercept"] == pytest.approx(y.mean() - Z.mean(0) @ c, rel=1e-6, abs=1e-9)


def test_rows_are_dealt_to_folds_once(spark):
    import os
    dealt = F.udf(lambda: os.urandom(1)[0] % 3, "int").asNondeterministic()
    df = spark.range(60).select(F.col("id").alias("trip_id"), F.col("id").cast("double").alias("y"), F.sin("id").alias("pred_old"))
    seen = []

    def fit_predict(tr, ap):
        seen.append(tuple({r["trip_id"] for r in d.collect()} for d in (tr, ap)))
        return ap.withColumn("pred_new", F.cos("trip_id"))

    oof, _ = ST.stack_oof(df, fit_predict, "pred_old", "y", k=3, folds=lambda d, k, key, seed, out: d.withColumn(out, dealt()))
    assert len(seen) == 3 and all(tr | ap == set(range(60)) and not tr & ap for tr, ap in seen)
    assert sorted(r["trip_id"] for r in oof.collect()) == list(range(60))


def test_metric_edge_rules(spark):
    from farelane.operators import metrics as M
    const = spark.createDataFrame([(2.0, 2.0, 2.5), (2.0, 2.0, 1.5)], "y double, exact double, off double")
    long = M.melt_predictions(const, "y", {"exact": "exact", "off": "off"})
    r2 = {r["candidate"]: r["r2"] for r in M.regression_metrics(long).collect()}
    assert r2 == {"exact": 1.0, "off": 0.0}
    tiny = spark.createDataFrame([(1e-9, 0.0)], "y double, p double")
    lt = M.melt_predictions(tiny, "y", {"m": "p"})
    abs_rule = M.regression_metrics(lt, zero_rule="abs").first()["mape"]
    zero_rule = M.regression_metrics(lt, zero_rule="zero").first()["mape"]
    assert abs_rule == pytest.approx(1e-9 / 1e-8 * 100) and zero_rule == pytest.approx(100.0)


def test_registered_queries_use_the_shipped_settings():
    from farelane.config import ModelParams
    from farelane.plans import q_models
    assert q_models.MP == ModelParams()
    assert (q_models.MP.gbt_a["maxIter"], q_models.MP.gbt_b["maxIter"], q_models.MP.forest["numTrees"]) == (550, 400, 60)


def _toy(spark, n=400):
    return spark.range(n).select(F.col("id").alias("trip_id"), (F.col("id") % 17).cast("double").alias("a"),
                                 (F.col("id") * 7919 % 101).cast("double").alias("b")).withColumn(
        "y", F.col("a") * F.col("a") + F.sin("b")).withColumn("is_val", F.col("trip_id") % 4 == 0)


def test_concurrent_fits_equal_sequential_ones(spark):
    from farelane.operators import models as ML
    table = ML.training_table(_toy(spark))
    p = dict(maxIter=4, maxDepth=3, subsamplingRate=0.7, seed=3)

    def fit(name, depth):
        return ML.fit(table, name, ["a", "b"], "y", p | {"maxDepth": depth} if name == "gbt_a" else dict(numTrees=3, maxDepth=depth, seed=1))
    fits = {f"{n}{d}": (lambda n=n, d=d: fit(n, d)) for n in ("gbt_a", "forest") for d in (2, 3)}
    together = ML.concurrently(spark, fits, at_once=3)
    assert list(together) == list(fits)
    for k, f in fits.items():
        assert together[k].stages[-1].toDebugString.split("\n", 1)[1] == f().stages[-1].toDebugString.split("\n", 1)[1]

    def bad():
        raise RuntimeError("no fit")
    with pytest.raises(RuntimeError):
        ML.concurrently(spark, {"x": bad, "y": lambda: 1})


def test_training_table_is_written_once(spark):
    from farelane import session
    from farelane.operators import models as ML
    before = len(session._STAGES)
    table = ML.training_table(_toy(spark), rows_per_partition=150)
    assert len(session._STAGES) == before + 1 and table.count() == 400
    per_file = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 3 and sum(per_file) == 400


def test_training_curve_is_the_error_of_every_round(spark):
    from farelane.operators import models as ML
    df = _toy(spark)
    model = ML.fit_with_validation(df, ["a", "b"], "y", "is_val", dict(maxIter=6, maxDepth=3, seed=1))
    sets = {"train": df.filter("not is_val"), "val": df.filter("is_val"), "none": df.filter("false")}
    curve = ML.training_curve(model, sets, "y")
    gbt = model.stages[-1]
    got = {(r["round"], r["set"]): r["rmse"] for r in curve.collect()}
    assert set(got) == {(i + 1, s) for i in range(gbt.getNumTrees) for s in ("train", "val")}
    for s in ("train", "val"):
        data, pred = model.stages[0].transform(sets[s]), 0.0
        rows = data.select("y").collect()
        total = [0.0] * len(rows)
        for i, (tree, w) in enumerate(zip(gbt.trees, gbt.treeWeights)):
            part = [r["prediction"] for r in tree.transform(data.drop("prediction")).collect()]
            total = [t + w * x for t, x in zip(total, part)]
            rmse = (sum((r["y"] - t) ** 2 for r, t in zip(rows, total)) / len(rows)) ** 0.5
            assert got[i + 1, s] == pytest.approx(rmse, rel=1e-9)
    assert ML.best_round(curve) == gbt.getNumTrees  # the watch keeps the rounds up to the best one


def test_exact_folds(spark):
    from farelane.operators import split as S
    df = spark.range(103).select(F.when(F.col("id") > 5, F.col("id")).alias("trip_id"))
    n = [r["count"] for r in S.exact_folds(df, 5).groupBy("fold").count().collect()]
    assert sorted(n) == [20, 20, 21, 21, 21] and S.exact_folds(df.filter("false"), 5).count() == 0


@pytest.fixture
def layouts(spark, monkeypatch):
    """The model queries with quick settings on the same toy rows, in files of
    two layouts: a call's results for both."""
    from farelane.config import ModelParams
    from farelane.plans import q_models
    monkeypatch.setattr(q_models, "MP", ModelParams(gbt_a=dict(maxIter=4, maxDepth=3, subsamplingRate=0.6, seed=3)))
    toy = _toy(spark).select("trip_id", "a", "b", F.col("y").alias("Fare_Amt"), F.when(F.col("is_val"), "val").otherwise("train").alias("split"))
    frames = [toy.repartition(1).sortWithinPartitions(F.col("trip_id").desc()), toy.repartition(5, "a")]

    def both(query):
        out = []
        for f in frames:
            monkeypatch.setattr(q_models, "processed", lambda *_, f=f: (f, {}))
            out.append(sorted(map(tuple, getattr(q_models, query)(spark, "").collect())))
        return out
    return both


def test_importances_dont_hang_on_the_files(layouts):
    one, other = layouts("feature_importances")
    assert one == other and {f for f, _ in one} == {"a", "b"}


def test_predictions_dont_hang_on_the_files(layouts):
    one, other = layouts("gbt_predict")
    assert one == other and len(one) == 100


def test_fares_dont_hang_on_the_files(spark, layouts, monkeypatch):
    from farelane.plans import q_models
    from farelane.sources.tables import monthly_trips_from_events
    events = spark.range(60).selectExpr("id AS event_id", "TIMESTAMP_NTZ '2024-01-05 10:00:00' AS ts", "CAST(id AS DOUBLE) AS value")
    monkeypatch.setattr(q_models, "load_monthly_trips", lambda *_: monthly_trips_from_events(events))
    monkeypatch.setattr(q_models.pipeline, "score_features", lambda req, _: req.select(
        "trip_id", (F.col("trip_id") % 17).cast("double").alias("a"), (F.col("trip_id") * 7919 % 101).cast("double").alias("b")))
    one, other = layouts("score_trips")
    assert one == other and len(one) == 20


def _mllib(df, params, prediction="prediction"):
    """MLlib's own fit of ``gbt_a``, assembled as in ``models.fit``."""
    from pyspark.ml.feature import VectorAssembler
    from farelane.operators import models as ML
    asm = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep")
    return ML.estimator("gbt_a", params, label="y", prediction=prediction).fit(asm.transform(df))


def _jobs(spark, call):
    import uuid
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = call()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("params", [dict(maxIter=12, maxDepth=5, subsamplingRate=0.7, stepSize=0.09, seed=3),
                                    dict(maxIter=6, maxDepth=4, seed=1, minInstancesPerNode=4, minInfoGain=0.01)])
def test_boosted_trees_are_mllibs_in_few_jobs(spark, params):
    """On one partition all trees are MLlib's to the last bit, without a job for every level."""
    from farelane.operators import models as ML
    df = _toy(spark).coalesce(1)
    model, jobs = _jobs(spark, lambda: ML.fit(df, "gbt_a", ["a", "b"], "y", params, prediction="p"))
    ours, own = model.stages[-1], _mllib(df, params, "p")
    assert jobs < params["maxIter"] * params["maxDepth"] / 2
    assert ours.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
    assert ours.featureImportances == own.featureImportances and ours.treeWeights == own.treeWeights
    assert {p.name: v for p, v in ours.extractParamMap().items()} == {p.name: v for p, v in own.extractParamMap().items()}


def test_boosted_trees_on_more_partitions(spark):
    """Sums in another order than MLlib's: the same fit up to rounding."""
    from farelane.operators import models as ML
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(size=(900, 3))], "a double, b double, e double").select(
        "a", "b", (F.col("a") * F.col("b") + F.col("e") / 3).alias("y")).repartition(3, "a").sortWithinPartitions("a").cache()
    params = dict(maxIter=5, maxDepth=4, stepSize=0.3, seed=3, minInstancesPerNode=5)
    ours, own = ML.fit(df, "gbt_a", ["a", "b"], "y", params), _mllib(df, params)
    assert ours.stages[-1].totalNumNodes == own.totalNumNodes
    both = own.transform(ours.transform(df).withColumnRenamed("prediction", "ours")).select("ours", "prediction").collect()
    assert [r["ours"] for r in both] == pytest.approx([r["prediction"] for r in both], rel=1e-9, abs=1e-9)
    again = ML.fit(df, "gbt_a", ["a", "b"], "y", params)
    assert again.stages[-1].toDebugString.split("\n", 1)[1] == ours.stages[-1].toDebugString.split("\n", 1)[1]
    df.unpersist()


def test_large_tables_are_fitted_by_mllib(spark, monkeypatch):
    from farelane.operators import boosting
    from farelane.operators import models as ML
    params, df = dict(maxIter=3, maxDepth=3, seed=3), _toy(spark).coalesce(1)
    few, jobs_few = _jobs(spark, lambda: ML.fit(df, "gbt_a", ["a", "b"], "y", params))
    monkeypatch.setattr(boosting, "CELLS_IN_A_TASK", 799)
    many, jobs_many = _jobs(spark, lambda: ML.fit(df, "gbt_a", ["a", "b"], "y", params))
    assert jobs_many > jobs_few and many.stages[-1].toDebugString.split("\n", 1)[1] == few.stages[-1].toDebugString.split("\n", 1)[1]


def test_a_fitted_model_is_saved_and_read(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from farelane.operators import models as ML
    df = _toy(spark)
    model = ML.fit(df, "gbt_b", ["a", "b"], "y", dict(maxIter=3, maxDepth=3, seed=3), prediction="p")
    model.write().save(str(tmp_path / "m"))
    read = PipelineModel.load(str(tmp_path / "m"))
    assert sorted(r["p"] for r in read.transform(df).collect()) == sorted(r["p"] for r in model.transform(df).collect())
    assert {p.name: v for p, v in read.stages[-1].extractParamMap().items()} == {p.name: v for p, v in model.stages[-1].extractParamMap().items()}

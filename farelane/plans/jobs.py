"""End-to-end jobs: base training, continuous training (CT), continuous
monitoring (CM).

Every stage writes its table under ``root`` (split trips, processed features,
params, routes cache, models, metrics, ledger, registry, promotions, drift).
With ``resume=True`` a re-run reuses every stage table whose write completed
(Spark's ``_SUCCESS`` marker), so a job lost half-way restarts at the first
missing stage; later jobs reuse the fitted params and the route cache.
Between stages the data moves only through those tables; within a stage
Spark plans the whole step.
"""

from __future__ import annotations

import datetime as _dt
import functools
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.config import ModelParams
from farelane.operators import drift as D
from farelane.operators import metrics as M
from farelane.operators import models as ML
from farelane.operators import prep
from farelane.operators import routes as R
from farelane.operators import selection as SEL
from farelane.operators import split as S
from farelane.operators import stacking as ST
from farelane.plans import pipeline
from farelane.plans import scoring as SC
from farelane.session import materialize, stage_scope
from farelane.sources import files, sinks

TARGET = "Fare_Amt"
LEARNERS = ("gbt_a", "gbt_b", "forest")


@dataclass
class Layout:
    root: str

    def __getattr__(self, name):          # root/<name>
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


@dataclass
class JobResult:
    version: str
    tables: dict = field(default_factory=dict)
    info: dict = field(default_factory=dict)


def _job(run):
    """A job's stage tables go when it ends, well or not."""
    @functools.wraps(run)
    def scoped(spark, *args, **kwargs):
        with stage_scope(spark):
            return run(spark, *args, **kwargs)
    return scoped


def _save_artefacts(spark: SparkSession, art: dict, path: str, version: str) -> None:
    rows = [(version, a, c, s, float(v)) for a, d in art.items() for c, st in d.items() for s, v in st.items()]
    df = spark.createDataFrame(rows, "version string, artefact string, column string, stat string, value double")
    sinks.write_table(df, path, ["version"])


def _save_meta(spark: SparkSession, coefs: dict, path: str, version: str) -> None:
    _save_artefacts(spark, {"meta": {k: {"coef": v} for k, v in coefs.items()}}, path, version)


def load_artefacts(spark: SparkSession, path: str, version: str) -> dict:
    out: dict = {}
    for r in spark.read.parquet(path).filter(F.col("version") == version).collect():
        out.setdefault(r["artefact"], {}).setdefault(r["column"], {})[r["stat"]] = r["value"]
    return out


def _registry_rows(spark, version, entries):
    return spark.createDataFrame([(version, k, kind, p) for k, kind, p in entries],
                                 "version string, model_key string, kind string, path string") \
        .withColumn("created_at", F.current_timestamp())


def _done(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to ``path`` completed (its _SUCCESS marker exists)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _inputs_mark(raw: DataFrame) -> str:
    """What a stage was built from: the input's files and columns."""
    import hashlib
    return hashlib.md5(repr((sorted(raw.inputFiles()), raw.columns)).encode()).hexdigest()


def _prepare(spark, raw: DataFrame, lay: Layout, provider, artefacts=None, routes_path: str | None = None,
             resume: bool = False, polygon: DataFrame | None = None):
    """Validate, split, clean, features, routes (cached), params.

    ``resume`` reuses the written split, processed table and params, if they
    came from the same input."""
    mark = _inputs_mark(raw)
    same = resume and _done(spark, lay.input_mark) and spark.read.text(lay.input_mark).first()[0] == mark
    if same and _done(spark, lay.processed) and _done(spark, lay.prepared_params):
        return spark.read.parquet(lay.processed), load_artefacts(spark, lay.prepared_params, "prepared")
    files.schema_findings(spark, raw).withColumn("stage", F.lit("validation")) \
        .write.mode("overwrite").parquet(lay.findings)
    S.month_findings(raw).write.mode("overwrite").parquet(lay.month_findings)
    if not (same and _done(spark, lay.split_trips)):
        ingested = pipeline.ingest(raw, polygon)
        # months that have no part in the split are recorded, not silently lost
        S.left_out_months(ingested).write.mode("overwrite").parquet(lay.left_out)
        sinks.write_splits(S.split_train_val_test(ingested), lay.split_trips, sort_col=S.PICKUP)
        spark.createDataFrame([(mark,)], "value string").coalesce(1).write.mode("overwrite").text(lay.input_mark)
    split = spark.read.parquet(lay.split_trips)
    table, art = pipeline.processed_table(split, provider=provider, artefacts=artefacts,
                                          route_cache=routes_path or lay.routes)
    sinks.write_splits(ML.training_frame(table, TARGET), lay.processed)
    _save_artefacts(spark, art, lay.prepared_params, "prepared")
    return spark.read.parquet(lay.processed), art


def _score_all(models: dict, df: DataFrame) -> DataFrame:
    for k, m in models.items():
        df = m.transform(df).drop("features")
    return df


def _metrics(df: DataFrame, preds: dict, split: str, zero_rule: str = "abs") -> DataFrame:
    long = M.melt_predictions(df.filter(F.col("split") == split), TARGET, preds)
    return M.metrics_long(M.regression_metrics(long, ["candidate"], zero_rule), ["candidate"]).withColumn("split", F.lit(split))


@_job
def run_base(spark: SparkSession, raw: DataFrame, root: str, params: ModelParams = ModelParams(),
             provider=R.taxicab_provider, version: str = "v1", resume: bool = False,
             polygon: DataFrame | None = None) -> JobResult:
    """Validation -> split -> preprocess -> routes -> 3 learners + stack ->
    evaluation and multi-criteria selection -> registry and ledger."""
    lay = Layout(root)
    t, art = _prepare(spark, raw, lay, provider, resume=resume, polygon=polygon)
    _save_artefacts(spark, art, lay.params, version)
    feats = ML.feature_columns(t, TARGET)
    train = ML.training_table(t.filter(F.col("split") == "train"))
    lp = {"gbt_a": params.gbt_a, "gbt_b": params.gbt_b, "forest": params.forest}
    models = ML.concurrently(spark, {k: lambda k=k: ML.fit(train, k, feats, TARGET, lp[k], prediction=f"pred_{k}") for k in LEARNERS})
    entries = []
    for k, m in models.items():
        p = f"{lay.models}/{version}/{k}"
        m.write().overwrite().save(p)
        entries.append((k, "base", p))
        sinks.write_table(ML.feature_importances(spark, m, feats).withColumn("model_key", F.lit(k))
                          .withColumn("version", F.lit(version)), f"{lay.importances}/{k}", ["version"])
    scored = _score_all(models, t)
    scored.write.mode("overwrite").parquet(lay.scored)
    scored = spark.read.parquet(lay.scored)
    meta = ST.stack_in_sample(scored.filter(F.col("split") == "train"), [f"pred_{k}" for k in LEARNERS],
                              TARGET, params.ridge_alpha_base, params.meta_train_frac, seed=params.seed)
    _save_meta(spark, meta, lay.meta, version)
    entries.append(("stacked", "meta", lay.meta))
    scored = ST.ridge_predict(scored, meta, "pred_stacked")
    preds = {k: f"pred_{k}" for k in LEARNERS} | {"stacked": "pred_stacked"}
    val = _metrics(scored, preds, "val")
    sinks.append_metrics(val, lay.metrics, version)
    # ties keep the order of evaluation: the learners, then their stack
    order = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(preds) for x in (k, i)]), F.col("candidate"))
    ranked = SEL.mcdm_scores(spark.read.parquet(lay.metrics).filter(
        (F.col("version") == version) & (F.col("split") == "val")).withColumn("evaluated", order), order_col="evaluated")
    best = ranked.orderBy("rank").first()["candidate"]
    # what a retraining fits: the best candidate, or its best learner if that is the stack
    learner = best if best in LEARNERS else ranked.filter(F.col("candidate") != "stacked").orderBy("rank").first()["candidate"]
    test = _metrics(scored, {best: preds[best]}, "test")
    SC.publish(spark, lay.root, version, "base", best, learner, raw.inputFiles(), [
        lambda: sinks.append_metrics(val.unionByName(test), lay.metrics, version),
        lambda: sinks.write_table(_registry_rows(spark, version, entries + [("final", best, learner)]), lay.registry, ["version"]),
        lambda: sinks.write_ledger(SEL.ledger_from(raw, version), lay.ledger)])
    return JobResult(version, {k: getattr(lay, k) for k in ("split_trips", "processed", "metrics", "registry")},
                     {"best": best, "meta": meta})


@_job
def run_ct(spark: SparkSession, raw_new: DataFrame, root: str, params: ModelParams = ModelParams(),
           provider=R.taxicab_provider, metric: str = "rmse", polygon: DataFrame | None = None) -> JobResult:
    """Retrain on a new window with the stored params: out-of-fold stacking of
    the previous version's final model and a new learner of its kind, promotion
    if better."""
    lay = Layout(root)
    latest = SEL.latest_version(SC.registry(spark, root)).first()
    old_version, version = latest["latest"], latest["next"]
    art = load_artefacts(spark, lay.params, old_version)
    t, _ = _prepare(spark, raw_new, Layout(f"{root}/ct_{version}"), provider, artefacts=art,
                    routes_path=lay.routes, polygon=polygon)
    feats = ML.feature_columns(t, TARGET)
    old = SC.final_model(spark, root, old_version)
    t = old.predict(t, "pred_old")
    t.write.mode("overwrite").parquet(f"{lay.root}/ct_{version}/with_old")
    t = spark.read.parquet(f"{lay.root}/ct_{version}/with_old")
    train = t.filter(F.col("split") == "train")
    new_params = {"gbt_a": params.gbt_a, "gbt_b": params.gbt_b, "forest": params.forest}[old.learner]

    def fit_predict(tr, ap):
        return ML.fit(tr, old.learner, feats, TARGET, new_params, prediction="pred_new").transform(ap).drop("features")

    # the refit on all rows doesn't wait for the folds
    refit = {"refit": lambda: ML.fit(ML.training_table(train), old.learner, feats, TARGET, new_params, prediction="pred_new")}
    _, coefs = ST.stack_oof(train, fit_predict, "pred_old", TARGET, params.oof_folds, params.ridge_alpha_ct,
                            seed=params.seed, also=refit, folds=S.exact_folds)
    new_model = refit["refit"]
    p = f"{lay.models}/{version}/{old.learner}"
    new_model.write().overwrite().save(p)
    scored = ST.ridge_predict(new_model.transform(t).drop("features"), coefs, "pred_stacked")
    preds = {"old": "pred_old", "new": "pred_new", "stacked": "pred_stacked"}
    val = _metrics(scored, preds, "val", "zero")
    promo = SEL.promotion_choice(val, metric)
    chosen = promo.first()["chosen_on_val"]
    test = _metrics(scored, preds, "test", "zero")
    sinks.append_metrics(val.unionByName(test), lay.metrics, version)
    if chosen is not None:
        rows = _registry_rows(spark, version, [(old.learner, "base", p), ("stacked", "meta", lay.meta), ("final", chosen, old.learner)])
        SC.publish(spark, root, version, "ct", chosen, old.learner, raw_new.inputFiles(), [
            lambda: _save_artefacts(spark, art, lay.params, version),
            lambda: _save_meta(spark, coefs, lay.meta, version),
            lambda: sinks.write_table(rows, lay.registry, ["version"]),
            lambda: sinks.write_promotion(promo, lay.promotions, version),
            lambda: sinks.write_ledger(SEL.ledger_from(raw_new, version), lay.ledger)])
    return JobResult(version, {"promotions": lay.promotions}, {"chosen": chosen, "coefs": coefs, "learner": old.learner,
                                                                 "old_version": old_version})


def monitored_columns(df: DataFrame) -> list[str]:
    """Numeric columns that drift is measured on: every feature, the target and
    the prediction; not keys."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in R.BOOKKEEPING]


@_job
def run_cm(spark: SparkSession, raw_month: DataFrame, reference: DataFrame, root: str,
           n_current: int = 600_000, n_reference: int = 500_000, seed: int = 42, provider=R.taxicab_provider,
           polygon: DataFrame | None = None) -> JobResult:
    """Score a new month and a reference set the way the latest version scores,
    then data drift (W1, all numeric features, target and prediction) and
    regression-quality drift, on stratified samples.  Routes that the cache
    lacks are fetched first; trips without one are counted."""
    lay = Layout(root)
    if "source_file" in raw_month.columns:
        n = files.single_file_check(raw_month).first()
        if not n["ok"]:
            raise ValueError(f"the monitored month must be one file, not {n['n_files']}")
    scorer = SC.resolve(spark, root)
    version = scorer.version
    art = load_artefacts(spark, lay.params, version)
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    coverage = {}

    def prepared(raw, n, name):
        cl = pipeline.clean_trips(pipeline.ingest(raw, polygon))
        smp = materialize(S.stratified_sample(cl, TARGET, n, 50, seed))
        routes = R.update_route_cache(spark, smp, provider, lay.routes)
        cov = R.route_coverage(smp, routes).withColumn("dataset", F.lit(name))
        cov.write.mode("overwrite").parquet(f"{lay.drift}/{stamp}/coverage/{name}")
        coverage[name] = cov.first().asDict()
        f = pipeline.base_features(smp, art["imputer"])
        f = prep.transform_scaler(f, art["scaler"])
        f = pipeline.features.passenger_scale(f)
        f = pipeline.features.route_ratios(R.route_filter(R.join_routes(f, routes)))
        f = prep.transform_scaler(f, art["route_scaler"])
        # drift, quality and summary read the scored rows: write them once
        return materialize(scorer.predict(f, "prediction"))

    cur, ref = prepared(raw_month, n_current, "current"), prepared(reference, n_reference, "reference")
    cols = [c for c in monitored_columns(ref) if c in cur.columns]
    w1 = D.wasserstein(ref, cur, cols)
    per, summary = D.drift_report(w1)
    quality = D.regression_drift(ref, cur, TARGET, "prediction")
    per.write.mode("overwrite").parquet(f"{lay.drift}/{stamp}/features")
    summary.write.mode("overwrite").parquet(f"{lay.drift}/{stamp}/summary")
    quality.write.mode("overwrite").parquet(f"{lay.drift}/{stamp}/quality")
    info = {"summary": spark.read.parquet(f"{lay.drift}/{stamp}/summary").first().asDict(), "coverage": coverage,
            "method": scorer.method}
    return JobResult(version, {"drift": f"{lay.drift}/{stamp}"}, info)


@_job
def run_score(spark: SparkSession, requests: DataFrame, root: str, output: str, provider=R.taxicab_provider) -> JobResult:
    """Score request rows the way the latest version scores, routes fetched
    where the cache lacks them; a request without a route has a null fare."""
    from farelane.streaming.scoring_stream import score
    lay = Layout(root)
    scorer = SC.resolve(spark, root)
    art = load_artefacts(spark, lay.params, scorer.version)
    # a missing coordinate is filled before its route is looked up
    requests = materialize(prep.transform_imputer(pipeline.ingest_requests(requests), art["imputer"]))
    routes = R.update_route_cache(spark, requests, provider, lay.routes)
    score(requests, art, scorer, routes=routes).write.mode("overwrite").parquet(output)
    n = R.route_coverage(requests, routes).first()
    return JobResult(scorer.version, {"scores": output}, {"method": scorer.method, "requests": n["trips"],
                                                          "without_route": n["without_route"]})

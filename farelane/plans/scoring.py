"""The models that score a version, as its registry rows and promotion say.

Registry rows of a version: ``(learner, "base", path)`` per learner, ``("stacked",
"meta", name)`` if there is a meta-model, and ``("final", candidate, learner)``:
the final candidate and the learner a later version trains anew.  The final
model of the first version is its best candidate, a single learner or the ridge
stack of all; of a retrained version it is its new learner.

A version is written in many tables and published by one record, the last write
(``commits``).  Readers see the rows of published versions only, so a job that
dies before its record leaves the version before it in force.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.operators import models as ML
from farelane.operators import selection as SEL
from farelane.operators import stacking as ST
from farelane.sources import sinks


@dataclass
class FinalModel:
    """One learner, or several with ridge coefficients over ``pred_<learner>``."""

    version: str
    learner: str                                    # what a retraining fits
    models: dict[str, PipelineModel] = field(default_factory=dict)
    stack: dict | None = None

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        if self.stack is None:
            return ML.predict(self.models[self.learner], df, out)
        cols = []
        for k, m in self.models.items():
            df = ML.predict(m, df, f"pred_{k}")
            cols.append(f"pred_{k}")
        return ST.ridge_predict(df, self.stack, out).drop(*cols)


@dataclass
class Scorer:
    """How a version scores: ``latest``, ``old`` or ``stacked``."""

    version: str
    method: str
    latest: FinalModel
    previous: FinalModel | None = None
    meta: dict | None = None

    def predict(self, df: DataFrame, out: str = "prediction", breakdown: bool = False) -> DataFrame:
        """``df`` with ``out``; with ``breakdown`` also ``pred_latest`` and, if
        the method uses it, ``pred_previous``."""
        if self.method == "latest":
            df = self.latest.predict(df, "pred_latest").withColumn(out, F.col("pred_latest"))
        elif self.method == "old":
            df = self.previous.predict(df, "pred_previous").withColumn(out, F.col("pred_previous"))
        else:
            df = self.latest.predict(self.previous.predict(df, "pred_previous"), "pred_latest")
            m = self.meta
            df = df.withColumn(out, F.lit(m["intercept"]) + F.lit(m.get("pred_old", 0.0)) * F.col("pred_previous")
                               + F.lit(m.get("pred_new", 0.0)) * F.col("pred_latest"))
        return df if breakdown else df.drop("pred_latest", "pred_previous")


def _meta(spark: SparkSession, root: str, version: str) -> dict:
    rows = spark.read.parquet(f"{root}/meta").filter(F.col("version") == version).collect()
    return {r["column"]: r["value"] for r in rows}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def publish(spark: SparkSession, root: str, version: str, kind: str, final: str, learner: str, sources: list[str],
            writes: list[Callable[[], None]]) -> None:
    """Run ``writes`` (each replaces the version's rows of a table), then write
    the record that publishes the version."""
    for write in writes:
        write()
    sinks.write_commit(spark, f"{root}/commits", version, kind, final, learner, sources)


def published(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The rows of ``root/table`` that belong to published versions; None if
    no version is."""
    if not _exists(spark, f"{root}/commits") or not _exists(spark, f"{root}/{table}"):
        return None
    versions = spark.read.parquet(f"{root}/commits").select("version")
    # a row per version
    return spark.read.parquet(f"{root}/{table}").join(F.broadcast(versions), "version", "left_semi")


def registry(spark: SparkSession, root: str) -> DataFrame:
    reg = published(spark, root, "registry")
    if reg is None:
        raise ValueError(f"no version is published under {root}")
    return reg


def promotions(spark: SparkSession, root: str) -> DataFrame:
    p = published(spark, root, "promotions")
    if p is not None:
        return p.select("version", "chosen_on_val")
    return spark.createDataFrame([], "version string, chosen_on_val string")


def final_model(spark: SparkSession, root: str, version: str) -> FinalModel:
    rows = registry(spark, root).filter(F.col("version") == version)
    reg = rows.collect()
    final = [r for r in reg if r["model_key"] == "final"]
    if not final:
        raise ValueError(f"{version} has no final model in the registry")
    base = {r["model_key"]: r["path"] for r in SEL.newest_artifact(rows.filter("kind = 'base'")).collect()}
    learner = final[0]["path"]
    if final[0]["kind"] == "stacked" and len(base) > 1:     # the first version's stack of all learners
        return FinalModel(version, learner, {k: PipelineModel.load(p) for k, p in sorted(base.items())}, _meta(spark, root, version))
    return FinalModel(version, learner, {learner: PipelineModel.load(base[learner])})


def resolve(spark: SparkSession, root: str, version: str | None = None) -> Scorer:
    """The scorer of a version (default: the latest)."""
    reg = registry(spark, root)
    version = version or SEL.latest_version(reg).first()["latest"]
    r = SEL.scoring_resolution(reg, promotions(spark, root)).filter(F.col("version") == version).first()
    if r is None:
        raise ValueError(f"{version} is not in the registry")
    latest = final_model(spark, root, version)
    prev = final_model(spark, root, r["previous"]) if r["method"] in ("old", "stacked") else None
    return Scorer(version, r["method"], latest, prev, _meta(spark, root, version) if r["method"] == "stacked" else None)

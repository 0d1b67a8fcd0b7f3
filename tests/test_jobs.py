"""Base -> continuous training -> monitoring, end to end on a small table."""

import os

import pytest
from pyspark.sql import functions as F

from farelane.config import ModelParams
from farelane.operators import selection as SEL
from farelane.operators import split as S
from farelane.plans import jobs
from farelane.plans import scoring as SC
from farelane.sources.tables import load_monthly_trips

from conftest import SF001


def _shifted(raw, metres: float, month: str):
    """The same trips elsewhere and in another month: no route key in common."""
    d = F.lit(metres / 111_000)
    return raw.withColumns({"Start_Lat": F.col("Start_Lat") + d, "End_Lat": F.col("End_Lat") + d, "month": F.lit(month)})


def test_base_ct_cm(spark, tmp_path):
    root = str(tmp_path / "root")
    raw = load_monthly_trips(spark, SF001)
    # the fare follows the way between the ends, and the boosted learners are
    # kept poor, so that the forest or the stack wins
    raw = raw.withColumn("Fare_Amt", F.lit(2.5) + 100 * (F.abs(F.col("End_Lon") - F.col("Start_Lon")) + F.abs(F.col("End_Lat") - F.col("Start_Lat"))))
    poor = dict(maxIter=1, maxDepth=1, stepSize=0.01, seed=1)
    mp = ModelParams(gbt_a=poor, gbt_b=poor, forest=dict(numTrees=8, maxDepth=6, seed=1), oof_folds=2)
    base = jobs.run_base(spark, raw, root, mp)
    assert base.version == "v1" and base.info["best"] != "gbt_a"
    m = spark.read.parquet(f"{root}/metrics")
    assert m.filter(F.col("split") == "val").select("candidate").distinct().count() == 4
    assert m.filter(F.col("split") == "test").count() == 5
    reg = spark.read.parquet(f"{root}/registry")
    final = reg.filter(F.col("model_key") == "final").collect()
    assert len(final) == 1 and final[0]["kind"] == base.info["best"] and final[0]["path"] in jobs.LEARNERS

    # a re-run with resume reuses the written stages, but not for other input
    assert jobs._done(spark, f"{root}/processed")
    again = jobs.run_base(spark, raw, root, mp, resume=True)
    assert again.version == "v1"

    for i in range(3):
        version = SEL.latest_version(spark.read.parquet(f"{root}/registry")).first()
        ct = jobs.run_ct(spark, raw, root, mp)
        assert ct.info["old_version"] == version["latest"] and ct.info["chosen"] in (None, "new", "stacked")
        scorer = SC.resolve(spark, root)
        if ct.info["chosen"] is not None:
            assert scorer.version == version["next"]
            assert scorer.method == ("stacked" if ct.info["chosen"] == "stacked" else "latest")

    # a month that shares no route key with the cache keeps its trips
    month = _shifted(raw, 300, "2024-04")
    cm = jobs.run_cm(spark, month, raw, root, n_current=800, n_reference=800)
    cov = cm.info["coverage"]["current"]
    assert cov["trips"] > 200 and cov["without_route"] == 0 and cov["kept"] >= 0.95 * cov["trips"]
    s = cm.info["summary"]
    per = spark.read.parquet(f"{cm.tables['drift']}/features")
    names = {r["feature"] for r in per.collect()}
    assert s["n_features"] == len(names) >= 25 and {"Fare_Amt", "prediction", "haversine_distance_m"} <= names
    assert "trip_id" not in names and 0.0 <= s["share_drifted"] <= 1.0

    # requests elsewhere: routes are fetched, and the version's method scores
    req = _shifted(raw, 700, "2024-05").limit(50)
    res = jobs.run_score(spark, req, root, str(tmp_path / "scores"))
    got = spark.read.parquet(str(tmp_path / "scores"))
    assert got.count() == 50 and res.info["method"] == SC.resolve(spark, root).method
    assert got.filter(F.col("fare").isNull()).count() == res.info["without_route"]


def test_left_out_months_are_counted(spark):
    raw = load_monthly_trips(spark, SF001)
    extra = raw.limit(7).withColumn("month", F.lit("2024-09"))
    none = raw.limit(3).withColumn("month", F.lit(None).cast("string"))
    got = {r["month"]: r["rows"] for r in S.left_out_months(raw.unionByName(extra).unionByName(none)).collect()}
    assert got == {"2024-09": 7, None: 3} or set(got) == {"2024-09", None}


def test_stage_tables_go(spark):
    from farelane import session
    with session.stage_scope(spark):
        df = session.materialize(spark.range(5))
        path = df.inputFiles()[0]
        assert os.path.exists(path.removeprefix("file://").removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))


def test_cluster_session_needs_a_shared_folder():
    from farelane import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())

"""Streaming scoring equals batch scoring (stream-static join and foreachBatch)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from farelane.operators import models as ML
from farelane.operators import routes as R
from farelane.operators import split as S
from farelane.plans import pipeline
from farelane.plans import scoring as SC
from farelane.sources.tables import load_monthly_trips
from farelane.streaming import scoring_stream as SS

from conftest import SF001


def test_stream_scoring_matches_batch(spark):
    raw = S.split_train_val_test(pipeline.ingest(load_monthly_trips(spark, SF001)))
    t, art = pipeline.processed_table(raw)
    t = ML.training_frame(t)
    feats = ML.feature_columns(t, "Fare_Amt")
    model = ML.fit(t.filter(F.col("split") == "train"), "gbt_a", feats, "Fare_Amt",
                   dict(maxIter=5, maxDepth=3, seed=1))
    req = (raw.filter(F.col("split") != "train")
              .select("trip_id", F.date_format("Trip_Pickup_DateTime", "yyyy-MM-dd HH:mm:ss")
                      .alias("Trip_Pickup_DateTime"), "Passenger_Count", "Start_Lon", "Start_Lat",
                      "End_Lon", "End_Lat"))
    src = tempfile.mkdtemp(prefix="req-")
    req.repartition(2).write.mode("overwrite").parquet(src)
    routes = R.fetch_routes(R.route_keys(pipeline.ingest_requests(spark.read.parquet(src))), R.taxicab_provider)
    routes = routes.cache()
    batch = {r["trip_id"]: r["fare"] for r in SS.score(spark.read.parquet(src), art, model, routes=routes).collect()}

    out1, ck1 = tempfile.mkdtemp(prefix="out-"), tempfile.mkdtemp(prefix="ck-")
    SS.start(spark, src, out1, ck1, art, model, routes=routes).awaitTermination()
    got1 = {r["trip_id"]: r["fare"] for r in spark.read.parquet(out1).collect()}

    out2, ck2 = tempfile.mkdtemp(prefix="out-"), tempfile.mkdtemp(prefix="ck-")
    SS.start(spark, src, out2, ck2, art, model, provider=R.taxicab_provider).awaitTermination()
    got2 = {r["trip_id"]: r["fare"] for r in spark.read.parquet(out2).collect()}

    assert len(batch) > 0
    assert got1 == batch
    assert got2 == batch


def test_score_breakdown_previous_latest_stacked(spark):
    raw = S.split_train_val_test(pipeline.ingest(load_monthly_trips(spark, SF001)))
    t, art = pipeline.processed_table(raw)
    t = ML.training_frame(t)
    feats = ML.feature_columns(t, "Fare_Amt")
    train = t.filter(F.col("split") == "train")
    latest = ML.fit(train, "linear", feats, "Fare_Amt", {})
    previous = ML.fit(train, "gbt_a", feats, "Fare_Amt", dict(maxIter=3, maxDepth=2, seed=1))
    meta = {"intercept": 0.5, "pred_old": 0.3, "pred_new": 0.6}
    req = raw.filter(F.col("split") == "test").select("trip_id", "Trip_Pickup_DateTime", "Passenger_Count",
                                                      "Start_Lon", "Start_Lat", "End_Lon", "End_Lat")
    scorer = SC.Scorer("v2", "stacked", SC.FinalModel("v2", "linear", {"linear": latest}),
                       SC.FinalModel("v1", "gbt_a", {"gbt_a": previous}), meta)
    out = SS.score(req, art, scorer, provider=R.taxicab_provider).collect()
    assert out and set(out[0].asDict()) == {"trip_id", "fare_latest", "fare_previous", "fare"}
    assert any(r["fare"] is not None for r in out)
    for r in out:
        if r["fare"] is None:       # no coordinates, no route
            continue
        assert r["fare"] == pytest.approx(0.5 + 0.3 * r["fare_previous"] + 0.6 * r["fare_latest"], abs=0.02)

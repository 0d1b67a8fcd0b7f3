"""Scoring as a Structured Streaming query.

Request rows arrive as files (or any streaming source); each row is scored
with the stored params and model.  The feature chain is row-wise, and the
route lookup is a stream-static left join against the routes table, so the
query is stateless (no watermark needed) and every micro-batch is
independent; the checkpoint location makes it restart where it stopped.

With ``provider`` instead of a routes table, each micro-batch runs the batch
path in ``foreachBatch``.  A batch that fails half-way is run again, so what it
does can be done twice: its rows overwrite a folder of the query's and the
batch's own, and its routes go through a cache that all batches share, so
that no fare is written and no key is asked for a second time.
"""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.operators import models as ML
from farelane.operators import prep
from farelane.operators import routes as R
from farelane.plans import pipeline
from farelane.session import materialize, stage_scope

REQUEST_SCHEMA = ("trip_id long, Trip_Pickup_DateTime string, Passenger_Count double, Start_Lon double, "
                  "Start_Lat double, End_Lon double, End_Lat double")


def score(requests: DataFrame, artefacts: dict, scorer, routes: DataFrame | None = None, provider=None) -> DataFrame:
    """Fares of request rows, rounded to 2: ``fare`` as the version scores, and
    ``fare_latest`` / ``fare_previous`` of the models that it uses.  ``scorer``:
    a ``Scorer``, or a single fitted model.  Without a route the fares are null."""
    f = pipeline.score_features(pipeline.ingest_requests(requests), artefacts, routes=routes, provider=provider)
    if isinstance(scorer, PipelineModel):
        out = ML.predict(scorer, f, "pred_latest").withColumn("fare", F.col("pred_latest"))
    else:
        out = scorer.predict(f, "fare", breakdown=True)
    known = F.col("route_distance_m").isNotNull()
    cols = [F.when(known, F.round(c, 2)).alias(n) for c, n in (("pred_latest", "fare_latest"), ("pred_previous", "fare_previous"), ("fare", "fare"))
            if c in out.columns]
    keep = [c for c in ("trip_id",) if c in out.columns]
    return out.select(*keep, *cols)


def batch_writer(output: str, checkpoint: str, artefacts: dict, model, provider, route_cache: str | None = None):
    """What a micro-batch does: fetch the routes that the cache lacks, score,
    and overwrite the folder of this query and batch number."""
    cache = route_cache or f"{output.rstrip('/')}_routes"
    # batch numbers start anew with a new checkpoint
    query = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:8]

    def batch(df: DataFrame, epoch: int) -> None:
        with stage_scope(df.sparkSession):
            requests = pipeline.ingest_requests(df)
            # a missing coordinate is filled before its route is looked up
            requests = materialize(prep.transform_imputer(requests, artefacts["imputer"]))
            routes = R.update_route_cache(df.sparkSession, requests, provider, cache)
            score(requests, artefacts, model, routes=routes).write.mode("overwrite").parquet(f"{output.rstrip('/')}/query={query}/batch={epoch}")
    return batch


def start(spark: SparkSession, source: str, output: str, checkpoint: str, artefacts: dict,
          model, routes: DataFrame | None = None, provider=None,
          schema: str = REQUEST_SCHEMA, available_now: bool = True, route_cache: str | None = None):
    """Start the streaming scoring query (Parquet files in, Parquet out).  With
    ``provider``, ``route_cache`` names the routes table that batches read and
    extend (default: beside ``output``); the output's folders are ``query`` (of the
    checkpoint) and ``batch``."""
    stream = spark.readStream.schema(schema).parquet(source)
    trig = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    if routes is not None:
        scored = score(stream, artefacts, model, routes=routes)
        return (scored.writeStream.format("parquet").option("path", output)
                .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trig).start())

    batch = batch_writer(output, checkpoint, artefacts, model, provider, route_cache)
    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**trig).start())

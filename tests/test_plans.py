"""Physical-plan properties that matter at scale."""

import pandas as pd
from pyspark.sql import functions as F

from farelane.operators import polygon as PG
from farelane.operators import prep
from farelane.plans import pipeline
from farelane.sources import files
from farelane.sources.tables import load_monthly_trips

from conftest import SF001


def _plan(df):
    """The formatted physical plan (what ``df.explain("formatted")`` prints)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _monthly_files(spark, tmp_path):
    t = load_monthly_trips(spark, SF001).toPandas()
    for m, g in t.groupby("month"):
        g.drop(columns=["month"]).to_parquet(tmp_path / f"yellow_tripdata_{m}.parquet", index=False,
                                             coerce_timestamps="us", allow_truncated_timestamps=True)
    return str(tmp_path)


def test_source_rules_pushed_into_scan_and_month_pruned(spark, tmp_path):
    d = _monthly_files(spark, tmp_path)
    raw = files.read_trip_files(spark, d, months=["2024-02"])
    assert {r[0] for r in raw.select("month").distinct().collect()} == {"2024-02"}
    q = pipeline.clean_trips(raw)
    scan = [line for line in _plan(q).split("\n") if line.startswith("PushedFilters")][0]
    for pushed in ("IsNotNull(Fare_Amt)", "GreaterThan(Passenger_Count,0.0)", "LessThanOrEqual(Passenger_Count,10.0)",
                   "GreaterThan(Trip_Distance,0.0)", "GreaterThanOrEqual(Start_Lat,-90.0)"):
        assert pushed in scan, pushed
    # derived measures are evaluated once, behind the generator
    assert "Generate" in _plan(q) and "inline(" in _plan(q)


def test_transform_with_params_has_no_shuffle(spark):
    f = pipeline.base_features(pipeline.clean_trips(load_monthly_trips(spark, SF001)))
    p = prep.params_dict(prep.fit_scaler(f, ["haversine_distance_m"]))
    out = prep.transform_scaler(f, p)
    assert "hashpartitioning" not in _plan(out)   # no key shuffle, only the scan spread


def test_polygon_join_is_broadcast(spark):
    e = PG.edges_from_rings(spark, {1: [[(0, 0), (10, 0), (10, 10), (0, 10)]]})
    # points off the edges (edge points are ambiguous by design)
    pts = spark.range(1000).select(F.col("id"), (F.col("id") % 12 + 0.5).alias("x"),
                                   (F.col("id") % 7 + 0.5).alias("y"))
    out = PG.point_in_polygon(pts, e, "x", "y")
    assert "BroadcastHashJoin" in _plan(out)
    got = out.filter("inside").count()
    expect = sum(1 for i in range(1000) if i % 12 + 0.5 < 10)
    assert got == expect

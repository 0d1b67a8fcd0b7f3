"""Edge rows and properties for cleaning, splits and samples."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from farelane.config import OutlierRules
from farelane.operators import clean
from farelane.operators import split as S
from farelane.plans import pipeline
from farelane.sources.tables import load_monthly_trips, load_trips

from conftest import SF001, SF01

SCHEMA = ("trip_id long, Trip_Pickup_DateTime string, Trip_Dropoff_DateTime string, Passenger_Count double, "
          "Trip_Distance double, Start_Lon double, Start_Lat double, End_Lon double, End_Lat double, "
          "Fare_Amt double, Total_Amt double")


def _row(i, pick="2024-01-01 10:00:00", drop="2024-01-01 10:10:00", pc=1.0, dist=1.0,
         sl=(-73.99, 40.75), el=(-73.98, 40.76), fare=10.0):
    return (i, pick, drop, pc, dist, sl[0], sl[1], el[0], el[1], fare, fare + 1)


def test_hand_made_rules(spark):
    rows = [
        _row(1),                                        # kept
        _row(2, pc=float("nan")),                        # NaN passengers -> dropped
        _row(3, pick="not a date"),                      # invalid datetime -> null -> dropped
        _row(4, drop="2024-01-01 09:59:00"),             # negative duration
        _row(5, dist=0.0),                               # zero distance
        _row(6, drop="2024-01-01 10:30:00"),             # exactly 30 min: not < 30 min
        _row(7, drop="2024-01-01 10:00:30", dist=1.0),   # 1 mile in 30 s = 193 km/h
        _row(8, dist=40.0, drop="2024-01-01 10:29:00"),  # 64 km > 56 km
        _row(9, pc=11.0),                                # > 10 passengers
        _row(10, fare=float("nan")),                     # NaN fare -> null -> dropped
        _row(11, sl=(-73.99, 95.0)),                     # latitude out of range
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = {r["trip_id"] for r in pipeline.clean_trips(df).collect()}
    assert kept == {1}
    # relaxing the limits keeps the long and fast trips
    loose = OutlierRules(max_minutes=60, max_velocity_kmh=400, real_velocity_limit_kmh=400, max_distance_km=100)
    kept2 = {r["trip_id"] for r in pipeline.clean_trips(df, loose).collect()}
    assert {1, 6, 7, 8} <= kept2 and not ({2, 3, 4, 5, 9, 10, 11} & kept2)


def test_waterfall_monotone_and_final_count(spark):
    t = load_trips(spark, SF01)
    w = [r["rows"] for r in clean.waterfall(clean.nan_to_nulls(t)).orderBy("step").collect()]
    assert all(a >= b for a, b in zip(w, w[1:]))
    assert w[-1] == pipeline.clean_trips(t).count()


def test_half_split_sizes_and_order(spark):
    t = pipeline.ingest(load_monthly_trips(spark, SF01))
    s = S.half_split(t)
    n = t.count()
    assert s.filter(F.col("split") == "val").count() == n // 2
    assert s.count() == n
    last_val = s.filter(F.col("split") == "val").agg(F.max("Trip_Pickup_DateTime")).first()[0]
    first_test = s.filter((F.col("split") == "test") & F.col("Trip_Pickup_DateTime").isNotNull()) \
        .agg(F.min("Trip_Pickup_DateTime")).first()[0]
    assert last_val <= first_test
    # null pickups sort last -> all in test
    assert s.filter(F.col("Trip_Pickup_DateTime").isNull() & (F.col("split") == "val")).count() == 0


def test_half_split_ties(spark):
    ts = dt.datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(i, ts) for i in range(7)], "trip_id long, Trip_Pickup_DateTime timestamp_ntz")
    val = sorted(r["trip_id"] for r in S.half_split(df).filter(F.col("split") == "val").collect())
    assert val == [0, 1, 2]


def test_folds_partition_rows(spark):
    t = pipeline.clean_trips(load_trips(spark, SF01))
    f = S.hash_folds(t, 5)
    counts = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4} and sum(counts.values()) == t.count()
    assert max(counts.values()) - min(counts.values()) < 0.2 * t.count() / 5


def test_stratified_quota_never_exceeded(spark):
    t = pipeline.clean_trips(load_trips(spark, SF01))
    binned = S.quantile_bins(t, "Fare_Amt", 50)
    counts = S.bin_counts(binned)
    quotas = S.quotas_from_counts(counts, 700)
    smp = S.sample_by_quota(binned, "bin", quotas)
    got = {r["bin"]: r["count"] for r in smp.groupBy("bin").count().collect()}
    assert all(got.get(b, 0) == q for b, q in quotas.items())
    total = sum(counts.values())
    assert abs(sum(got.values()) - 700) <= len(quotas)
    assert all(q == min(counts[b], round(counts[b] / total * 700)) for b, q in quotas.items())


def test_sample_with_a_key_that_repeats(spark):
    """A key that all rows share: quotas are met exactly all the same."""
    df = spark.range(4000).select(F.lit(7).alias("trip_id"), (F.col("id") % 2).alias("g"), "id")
    got = S.sample_by_quota(df, "g", {0: 150, 1: 1, 2: 5})
    assert {r["g"]: r["count"] for r in got.groupBy("g").count().collect()} == {0: 150, 1: 1}
    assert got.columns == df.columns and got.select("id").distinct().count() == 151


def test_half_split_keys_beyond_doubles(spark):
    """200,000 rows of one time: the cut among 63-bit and among text keys."""
    import datetime as dt
    n = 200_001
    base = spark.range(n).select(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("Trip_Pickup_DateTime"),
                                 (F.lit(4_000_000 << 40) + F.col("id")).alias("trip_id"))
    for df in (base, base.withColumn("trip_id", F.concat(F.lit("file-"), F.format_string("%020d", "trip_id")))):
        out = S.half_split(df)
        val = out.filter("split = 'val'")
        assert val.count() == n // 2 and out.count() == n
        assert val.agg(F.max("trip_id")).first()[0] < out.filter("split = 'test'").agg(F.min("trip_id")).first()[0]


def test_month_split_and_findings(spark):
    t = load_monthly_trips(spark, SF001)
    f = {r["check"]: r["ok"] for r in S.month_findings(t).collect()}
    assert f == {"single_year": True, "month_count": True, "consecutive": True}
    ms = S.month_split(t)
    months = {r["split"]: r["months"] for r in ms.groupBy("split").agg(F.countDistinct("month").alias("months"))
              .collect()}
    assert months == {"train": 2, "valtest": 1}


def test_half_split_hot_timestamp_uses_key_order(spark):
    """Many rows share one timestamp: the cut falls inside the tie and is
    resolved by key."""
    ts = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    rows = [(i * 7919 % 100003, ts) for i in range(5001)] + [(10**9 + i, ts + dt.timedelta(seconds=1))
                                                           for i in range(10)]
    df = spark.createDataFrame(rows, "trip_id long, Trip_Pickup_DateTime timestamp_ntz")
    s = S.half_split(df)
    n = len(rows)
    val = sorted(r["trip_id"] for r in s.filter(F.col("split") == "val").collect())
    expect = sorted(k for k, _ in sorted(rows, key=lambda r: (r[1], r[0]))[: n // 2])
    assert val == expect


def test_combined_constant_rule_and_strict_months(spark):
    rows = [_row(1), _row(6, drop="2024-01-01 10:45:00"),           # long but slow and short: kept if combined
            _row(8, dist=100.0, drop="2024-01-01 10:40:00")]        # long, fast and far: dropped either way
    df = spark.createDataFrame(rows, SCHEMA)
    loose = dict(real_velocity_limit_kmh=400)
    sep = {r["trip_id"] for r in pipeline.clean_trips(df, OutlierRules(**loose)).collect()}
    comb = {r["trip_id"] for r in pipeline.clean_trips(df, OutlierRules(constant_mode="combined", **loose)).collect()}
    assert sep == {1} and comb == {1, 6}
    with pytest.raises(ValueError):
        OutlierRules(constant_mode="x") and pipeline.clean_trips(df, OutlierRules(constant_mode="x")).count()
    two = load_monthly_trips(spark, SF001).filter(F.col("month") != "2024-02")
    with pytest.raises(ValueError):
        S.month_findings(two, strict=True)


def test_rules_not_reached_by_driver_data(spark):
    """Rows that only the 300 km/h, 32-day and 56 km rules catch (the other
    limits relaxed), and the 800 km haversine rule."""
    rows = [_row(1),
            _row(2, dist=10.0, drop="2024-01-01 10:01:00"),                 # 965 km/h
            _row(3, drop="2024-02-15 10:00:00", dist=3.0),                  # 45 days
            _row(4, dist=40.0, drop="2024-01-01 11:00:00"),                 # 64 km in 1 h
            _row(5, sl=(-73.99, 40.75), el=(-80.0, 35.0), dist=700.0,       # 820 km straight line
                 drop="2024-01-01 20:00:00")]
    df = spark.createDataFrame(rows, SCHEMA)
    loose = OutlierRules(max_minutes=10 ** 8, max_velocity_kmh=10 ** 6, max_distance_km=10 ** 6)
    assert {r["trip_id"] for r in pipeline.clean_trips(df, loose).collect()} == {1, 4}
    only_56 = OutlierRules(max_minutes=10 ** 8, max_velocity_kmh=10 ** 6)
    assert {r["trip_id"] for r in pipeline.clean_trips(df, only_56).collect()} == {1}
    no_hav = OutlierRules(max_minutes=10 ** 8, max_velocity_kmh=10 ** 6, max_distance_km=10 ** 6,
                          distance_limit_km=10 ** 6, ratio_distance_pairs=())
    assert 5 in {r["trip_id"] for r in pipeline.clean_trips(df, no_hav).collect()}


def test_request_time_parsing_and_month_from_path(spark):
    import datetime as dt
    req = spark.createDataFrame([(1, "2009-01-04 02:52:00"), (2, "2009-01-04T02:52:00"), (3, "garbage"), (4, None)],
                                "trip_id long, Trip_Pickup_DateTime string")
    out = {r["trip_id"]: r["Trip_Pickup_DateTime"] for r in pipeline.ingest_requests(req).collect()}
    assert out[1] == out[2] == dt.datetime(2009, 1, 4, 2, 52)
    now = dt.datetime.now()
    assert abs((out[3] - now).total_seconds()) < 3600 * 14 and abs((out[4] - now).total_seconds()) < 3600 * 14
    paths = spark.createDataFrame([("/data/raw/yellow_tripdata_2009-03.parquet",), ("/d/2010-12/part-0.parquet",)], "p string")
    got = [r[0] for r in paths.select(S.month_from_path(F.col("p"))).collect()]
    assert got[0] == "2009-03"

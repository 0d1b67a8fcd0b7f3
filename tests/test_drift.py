"""W1 drift against the direct formula; properties."""

import pytest
from pyspark.sql import functions as F

from farelane.operators import drift as D
from farelane.plans import pipeline
from farelane.sources.tables import load_trips

from conftest import SF01

COLS = ["Fare_Amt", "Real_distance", "Passenger_Count"]


@pytest.fixture(scope="module")
def halves(spark):
    cl = pipeline.clean_trips(load_trips(spark, SF01)).cache()
    return cl.filter(F.col("trip_id") % 2 == 0), cl.filter(F.col("trip_id") % 2 == 1)


def test_equals_direct_formula(halves):
    import numpy as np
    ref, cur = halves
    got = {r["feature"]: r for r in D.wasserstein(ref, cur, COLS).collect()}
    for c in COLS:
        a, b = (np.sort([float(r[0]) for r in d.select(c).collect() if r[0] is not None]) for d in (ref, cur))
        x = np.unique(np.concatenate([a, b]))
        gap = np.abs(np.searchsorted(a, x, "right") / len(a) - np.searchsorted(b, x, "right") / len(b))
        assert got[c]["w1"] == pytest.approx(float((gap[:-1] * np.diff(x)).sum()), rel=1e-9)
        assert got[c]["ref_std"] == pytest.approx(float(a.std()), rel=1e-9) and got[c]["n_ref"] == len(a)


def test_quality_tests_can_fail(spark):
    ref = spark.range(200).select(F.col("id").cast("double").alias("y"), (F.col("id") + F.col("id") % 3 - 1).cast("double").alias("p"))
    bad = ref.select("y", (F.col("p") + 5).alias("p"))
    same = {r["metric"]: r["passed"] for r in D.regression_drift(ref, ref, "y", "p").collect()}
    moved = {r["metric"]: r["passed"] for r in D.regression_drift(ref, bad, "y", "p").collect()}
    assert all(same.values()) and not moved["mean_error"] and not moved["rmse"] and moved["error_std"]


def test_identical_sets_zero_and_symmetric(halves):
    ref, cur = halves
    same = {r["feature"]: r["w1"] for r in D.wasserstein(ref, ref, COLS).collect()}
    assert all(v == pytest.approx(0.0, abs=1e-12) for v in same.values())
    ab = {r["feature"]: r["w1"] for r in D.wasserstein(ref, cur, COLS).collect()}
    ba = {r["feature"]: r["w1"] for r in D.wasserstein(cur, ref, COLS).collect()}
    for c in COLS:
        assert ab[c] == pytest.approx(ba[c], rel=1e-9)


def test_shift_equals_offset(spark):
    a = spark.range(0, 1000).select(F.col("id").cast("double").alias("x"))
    b = a.select((F.col("x") + 2.5).alias("x"))
    r = D.wasserstein(a, b, ["x"]).first()
    assert r["w1"] == pytest.approx(2.5, rel=1e-9)


def test_sketches_merge_and_bound(spark, halves):
    """Three months merged are one sketch of all rows; W1 is within the bound; the deviation is exact."""
    ref, cur = halves
    ref = ref.withColumns({"month": F.col("trip_id") % 3, "signed": F.when(F.col("trip_id") % 7 == 0, 0.0).otherwise(F.col("Fare_Amt") - 30)})
    cur = cur.withColumn("signed", F.col("Fare_Amt") - 25)
    cols = [*COLS, "signed"]
    months, whole = D.sketch(ref, cols, ("month",)), D.sketch(ref, cols)
    key = ["feature", "sign", "bucket"]
    a = {tuple(r[k] for k in key): r for r in D.merge_sketches(months).collect()}
    b = {tuple(r[k] for k in key): r for r in whole.collect()}
    assert a.keys() == b.keys() and all(a[k]["n"] == b[k]["n"] and a[k]["moved"] == pytest.approx(b[k]["moved"], abs=1e-9) for k in a)
    got = {r["feature"]: r for r in D.wasserstein_sketch(D.merge_sketches(months), D.sketch(cur, cols)).collect()}
    for r in D.wasserstein(ref, cur, cols).collect():
        s = got[r["feature"]]
        assert abs(s["w1"] - r["w1"]) <= s["error_bound"] + 1e-9 and (s["n_ref"], s["n_cur"]) == (r["n_ref"], r["n_cur"])
        assert s["ref_std"] == pytest.approx(r["ref_std"], rel=1e-9) and s["error_bound"] < 0.02 * (abs(r["ref_std"]) + 100)

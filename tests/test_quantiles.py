"""Quantiles by distinct value must equal Spark's exact percentile."""

import pytest
from pyspark.sql import functions as F

from farelane.functions import ranges
from farelane.functions.quantiles import quantiles, value_counts
from farelane.plans import pipeline
from farelane.sources.tables import load_trips

from conftest import SF01


@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.75, 1.0], [i / 50 for i in range(51)]])
def test_equals_exact(spark, probs):
    df = pipeline.clean_trips(load_trips(spark, SF01)).select(
        F.col("Fare_Amt").cast("double").alias("a"), F.col("Real_distance").cast("double").alias("b"))
    got = {(r["column"], r["p"]): r["value"] for r in quantiles(df, ["a", "b"], probs).collect()}
    exact = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in ["a", "b"]]).first()
    assert len(got) == 2 * len(probs)
    for c in ["a", "b"]:
        for p, v in zip(probs, exact[c]):
            assert got[(c, p)] == pytest.approx(v, rel=1e-12, abs=1e-9), (c, p)


@pytest.mark.parametrize("groups", [3, 500])
def test_grouped_quantiles(spark, groups):
    df = pipeline.clean_trips(load_trips(spark, SF01)).withColumn("g", F.when(F.col("trip_id") % groups != 0, F.col("trip_id") % groups))
    got = {(r["g"], r["p"]): r["value"] for r in quantiles(df, ["Fare_Amt"], [0.1, 0.5, 0.9], group_cols=["g"]).collect()}
    exact = df.groupBy("g").agg(F.percentile(F.col("Fare_Amt").cast("double"), F.array(
        F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("v")).collect()
    assert len(got) == 3 * len(exact)
    for r in exact:
        for p, v in zip([0.1, 0.5, 0.9], r["v"]):
            assert got[(r["g"], p)] == pytest.approx(v, rel=1e-12)


def test_ties_are_one_row(spark, monkeypatch):
    """A million rows of 12 values: no ranked table is longer than the values."""
    df = spark.range(1_000_000).select((F.col("id") % 12).cast("double").alias("x"))
    assert value_counts(df, ["x"], []).count() == 12
    seen = []
    real = ranges.materialize
    monkeypatch.setattr(ranges, "materialize", lambda d: (seen.append(d.count()), real(d))[1])
    got = {r["p"]: r["value"] for r in quantiles(df, ["x"], [0.0, 0.5, 0.75, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.5: 5.0, 0.75: 8.0, 1.0: 11.0}
    assert seen and max(seen) <= 12


def _spread(spark, n):
    """Distinct values, in no order, some of them missing."""
    return spark.range(n).select((F.xxhash64("id") / 1e9).alias("x"), F.when(F.col("id") % 9 > 0, F.sqrt("id")).alias("y"))


def test_only_brackets_are_ranked(spark, monkeypatch):
    """200,000 distinct values: what is range-shuffled is the brackets and the gaps."""
    df, probs = _spread(spark, 200_000), [0.0, 0.25, 0.5, 0.75]
    seen = []
    real = ranges.materialize
    monkeypatch.setattr(ranges, "materialize", lambda d: (seen.append(d.count()), real(d))[1])
    got = {(r["column"], r["p"]): r["value"] for r in quantiles(df, ["x", "y"], probs).collect()}
    exact = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in "xy"]).first()
    assert got == {(c, p): pytest.approx(v, rel=1e-12) for c in "xy" for p, v in zip(probs, exact[c])}
    assert len(seen) == 1 and seen[0] < 0.01 * 2 * 200_000


def test_rank_outside_its_bracket_widens_it(spark, monkeypatch):
    """A sketch that is off by a tenth of the rows costs passes, not exactness."""
    df, passes = _spread(spark, 60_000).withColumn("g", F.when(F.col("x") > 0, 1)), []
    real = ranges.materialize
    monkeypatch.setattr(ranges, "materialize", lambda d: (passes.append(1), real(d))[1])
    got = {(r["g"], r["p"]): r["value"] for r in quantiles(df, "x", [0.1, 0.5, 1.0], ["g"], accuracy=4).collect()}
    exact = {r["g"]: r["v"] for r in df.groupBy("g").agg(F.percentile("x", F.array(F.lit(0.1), F.lit(0.5), F.lit(1.0))).alias("v")).collect()}
    assert got == {(g, p): pytest.approx(v, rel=1e-12) for g in exact for p, v in zip([0.1, 0.5, 1.0], exact[g])}
    assert len(passes) > 1


def test_empty_null_and_single(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert quantiles(df, ["x"], [0.5]).count() == 0
    one = spark.createDataFrame([(7.0,), (None,)], "x double")
    assert [r["value"] for r in quantiles(one, ["x"], [0.0, 0.3, 1.0]).collect()] == [7.0] * 3


def test_range_rank_and_running_counts(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("g"), F.col("id"), F.xxhash64("id").alias("h"))
    got = ranges.range_rank(df, ["g"], ["h", "id"], "rank").collect()
    for g in range(7):
        mine = sorted((r["h"], r["rank"]) for r in got if r["g"] == g)
        assert [r for _, r in mine] == list(range(1, len(mine) + 1))
    counts = spark.createDataFrame([("a", "x", 2), ("a", None, 1), ("a", "y", 4), (None, "x", 5)], "g string, v string, n long")
    run = {(r["g"], r["v"]): (r["before_n"], r["total_n"], r["next_value"]) for r in ranges.running_counts(counts, ["g"], "v", ["n"]).collect()}
    assert run == {("a", None): (0, 7, "x"), ("a", "x"): (1, 7, "y"), ("a", "y"): (3, 7, None), (None, "x"): (0, 5, None)}

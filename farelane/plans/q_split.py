"""Registered queries: month discovery and split, half split, folds, samples,
quantile bins, stratified sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelane.operators import split as S
from farelane.plans import pipeline
from farelane.plans.common import comparable
from farelane.plans.sqltext import COORD_RANGE, clean_ctes
from farelane.sources.tables import MONTHLY_TRIPS_SQL, TRIPS_SQL, load_monthly_trips, load_trips

Q, SQL = {}, {}

SEED = 42


def hash_sql(key: str = "trip_id", seed: int = SEED) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8)) AS BIGINT)"


_MONTHS_SQL = f"""trips AS ({MONTHLY_TRIPS_SQL}),
months AS (SELECT month, dense_rank() OVER (ORDER BY month) AS rk FROM (SELECT DISTINCT month FROM trips) m)"""


def month_split(spark, sf):
    t = S.month_split(load_monthly_trips(spark, sf))
    return t.select("trip_id", "month", "split")


Q["month_split"] = month_split
SQL["month_split"] = f"""WITH {_MONTHS_SQL}
SELECT trip_id, month, CASE WHEN rk <= 2 THEN 'train' WHEN rk = 3 THEN 'valtest' ELSE 'extra' END AS split
FROM trips JOIN months USING (month)"""


def month_findings(spark, sf):
    return S.month_findings(load_monthly_trips(spark, sf))


Q["month_findings"] = month_findings
SQL["month_findings"] = f"""WITH {_MONTHS_SQL},
s AS (SELECT count(DISTINCT substr(month, 1, 4)) AS years, count(*) AS n,
             string_agg(month, ',' ORDER BY month) AS list,
             max(CAST(substr(month, 6, 2) AS INTEGER)) - min(CAST(substr(month, 6, 2) AS INTEGER)) AS span
      FROM months)
SELECT 'single_year' AS "check", years = 1 AS ok, list AS detail FROM s
UNION ALL SELECT 'month_count', n = 3, CAST(n AS VARCHAR) FROM s
UNION ALL SELECT 'consecutive', span = n - 1, list FROM s"""


def half_split(spark, sf):
    """Third month, coordinates in range, split in time order: val / test."""
    t = S.month_split(load_monthly_trips(spark, sf)).filter(F.col("split") == "valtest").drop("split")
    t = pipeline.ingest(t)
    return S.half_split(t).select("trip_id", "split")


Q["half_split"] = half_split
SQL["half_split"] = f"""WITH {_MONTHS_SQL},
vt AS (SELECT * FROM trips JOIN months USING (month) WHERE rk = 3 AND {COORD_RANGE}),
o AS (SELECT trip_id, row_number() OVER (ORDER BY Trip_Pickup_DateTime ASC NULLS LAST, trip_id) AS rn,
             count(*) OVER () AS n FROM vt)
SELECT trip_id, CASE WHEN rn <= n // 2 THEN 'val' ELSE 'test' END AS split FROM o"""


def half_split_ties(spark, sf):
    """All trips with the pickup cut to its month, so that one time holds most
    rows, and 63-bit keys that doubles can't tell apart."""
    t = load_trips(spark, sf).select(
        "trip_id", F.date_trunc("month", F.col("Trip_Pickup_DateTime")).cast("timestamp_ntz").alias("pickup"),
        (F.lit(4611686018427387904) + (F.col("trip_id") * 7919) % 1000003).alias("big_key"))
    return S.half_split(t, "pickup", "big_key").select("trip_id", "split")


Q["half_split_ties"] = half_split_ties
SQL["half_split_ties"] = f"""WITH trips AS ({TRIPS_SQL}),
o AS (SELECT trip_id, row_number() OVER (ORDER BY date_trunc('month', Trip_Pickup_DateTime) ASC NULLS LAST,
                                         4611686018427387904 + (trip_id * 7919) % 1000003) AS rn,
             count(*) OVER () AS n FROM trips)
SELECT trip_id, CASE WHEN rn <= n // 2 THEN 'val' ELSE 'test' END AS split FROM o"""


def _cleaned(spark, sf):
    return pipeline.clean_trips(load_trips(spark, sf))


def hash_folds(spark, sf):
    return comparable(S.hash_folds(_cleaned(spark, sf), k=5, seed=SEED).select("trip_id", "fold"))


Q["hash_folds"] = hash_folds
SQL["hash_folds"] = f"""WITH {clean_ctes()}
SELECT trip_id, ({hash_sql()} % 5)::BIGINT AS fold FROM cleaned"""


def exact_folds(spark, sf):
    return comparable(S.exact_folds(_cleaned(spark, sf), k=5, seed=SEED).select("trip_id", "fold"))


Q["exact_folds"] = exact_folds
SQL["exact_folds"] = f"""WITH {clean_ctes()}
SELECT trip_id, ((row_number() OVER (ORDER BY {hash_sql()}, trip_id) - 1) % 5)::BIGINT AS fold FROM cleaned"""


def hash_sample(spark, sf):
    return S.hash_sample(_cleaned(spark, sf), 0.8, seed=SEED).select("trip_id")


Q["hash_sample"] = hash_sample
SQL["hash_sample"] = f"""WITH {clean_ctes()}
SELECT trip_id FROM cleaned WHERE {hash_sql()} < {int(0.8 * 2 ** 32)}"""


_BINS_SQL = f"""v AS (SELECT trip_id, CASE WHEN Fare_Amt > -1 THEN ln(1 + CAST(Fare_Amt AS DOUBLE)) END AS x FROM cleaned),
e AS (SELECT DISTINCT unnest(quantile_cont(x, [{', '.join(repr(i / 50) for i in range(51))}])) AS edge FROM v),
bins AS (SELECT v.trip_id, CASE WHEN v.x IS NULL THEN NULL
                 ELSE greatest((SELECT count(*) FROM e WHERE e.edge < v.x), 1) END AS bin FROM v)"""


def quantile_bins(spark, sf):
    return comparable(S.quantile_bins(_cleaned(spark, sf), "Fare_Amt", 50).select("trip_id", "bin"))


Q["quantile_bins"] = quantile_bins
SQL["quantile_bins"] = f"""WITH {clean_ctes()},
{_BINS_SQL}
SELECT trip_id, bin::BIGINT AS bin FROM bins"""


def stratified_sample(spark, sf):
    """1000 trips stratified over 50 quantile bins of log1p(fare)."""
    return S.stratified_sample(_cleaned(spark, sf), "Fare_Amt", 1000, 50, SEED).select("trip_id")


Q["stratified_sample"] = stratified_sample
SQL["stratified_sample"] = f"""WITH {clean_ctes()},
{_BINS_SQL},
cnt AS (SELECT bin, count(*) AS c FROM bins GROUP BY bin),
tot AS (SELECT count(*) AS n FROM bins),
quota AS (SELECT bin, least(c, CAST(round_even(c / n * 1000, 0) AS BIGINT)) AS q
          FROM cnt, tot WHERE bin IS NOT NULL),
ranked AS (SELECT trip_id, bin, row_number() OVER (PARTITION BY bin ORDER BY {hash_sql()}, trip_id) AS rn
           FROM bins WHERE bin IS NOT NULL)
SELECT trip_id FROM ranked JOIN quota USING (bin) WHERE rn <= q"""

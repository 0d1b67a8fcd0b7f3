"""Registered queries: cleaning, rules, row-wise features, fitted scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelane.config import IMPUTER_COLUMNS, POIS, REQUIRED_COLUMNS, SCALED_COLUMNS
from farelane.operators import clean, features, prep
from farelane.plans import pipeline
from farelane.plans.common import comparable
from farelane.plans.sqltext import (COORD_RANGE, clean_ctes, hav, measures_cte, poi_select,
                                    ratio_expr, rule_list, time_select)
from farelane.operators import split as splits
from farelane.sources.tables import TRIPS_SQL, load_monthly_trips, load_trips

Q, SQL = {}, {}


def _ingested(spark, sf):
    return pipeline.ingest(load_trips(spark, sf))


# -- trips_clean ---------------------------------------------------------------
def trips_clean(spark, sf):
    return comparable(pipeline.clean_trips(load_trips(spark, sf)))


Q["trips_clean"] = trips_clean
SQL["trips_clean"] = f"""WITH {clean_ctes()}
SELECT trip_id, strftime(Trip_Pickup_DateTime, '%Y-%m-%d %H:%M:%S.%f') AS Trip_Pickup_DateTime,
  strftime(Trip_Dropoff_DateTime, '%Y-%m-%d %H:%M:%S.%f') AS Trip_Dropoff_DateTime,
  round(CAST(Passenger_Count AS DOUBLE), 6) AS Passenger_Count,
  round(CAST(Start_Lon AS DOUBLE), 6) AS Start_Lon, round(CAST(Start_Lat AS DOUBLE), 6) AS Start_Lat,
  round(CAST(End_Lon AS DOUBLE), 6) AS End_Lon, round(CAST(End_Lat AS DOUBLE), 6) AS End_Lat,
  round(CAST(Fare_Amt AS DOUBLE), 6) AS Fare_Amt, round(CAST(Total_Amt AS DOUBLE), 6) AS Total_Amt,
  round(CAST(Real_time AS DOUBLE), 6) AS Real_time, round(CAST(Real_distance AS DOUBLE), 6) AS Real_distance,
  round(CAST(haversine_distance_m AS DOUBLE), 6) AS haversine_distance_m
FROM cleaned"""


# -- filter_waterfall ----------------------------------------------------------
def filter_waterfall(spark, sf):
    return comparable(clean.waterfall(clean.nan_to_nulls(load_trips(spark, sf))))


def _waterfall_sql():
    steps = [("all", "TRUE"), ("coordinates_in_range", COORD_RANGE)] + rule_list()
    parts, cum = [], []
    for i, (name, cond) in enumerate(steps):
        cum.append(f"({cond})")
        parts.append(f"SELECT {i + 1}::BIGINT AS step, '{name}' AS rule, count(*)::BIGINT AS rows "
                     f"FROM measured WHERE {' AND '.join(cum)}")
    return (f"WITH trips AS ({TRIPS_SQL}),\n"
            f"measured AS (SELECT *, {ratio_expr()} AS ratio_haversine_real FROM {measures_cte('trips')})\n"
            + "\nUNION ALL\n".join(parts))


Q["filter_waterfall"] = filter_waterfall
SQL["filter_waterfall"] = _waterfall_sql()


# -- audits --------------------------------------------------------------------
def audit_real_lt_haversine(spark, sf):
    c = pipeline.clean_trips(load_trips(spark, sf))
    return comparable(clean.audit_real_shorter_than_haversine(c)
                      .select("trip_id", "Real_distance", "haversine_distance_m"))


Q["audit_real_lt_haversine"] = audit_real_lt_haversine
SQL["audit_real_lt_haversine"] = f"""WITH {clean_ctes()}
SELECT trip_id, round(CAST(Real_distance AS DOUBLE), 6) AS Real_distance,
  round(CAST(haversine_distance_m AS DOUBLE), 6) AS haversine_distance_m
FROM cleaned WHERE Real_distance < haversine_distance_m"""


def top_ratio(spark, sf):
    """Top-100 trips by haversine / metered ratio (the top-k is the feature)."""
    m = clean.with_trip_measures(_ingested(spark, sf)).filter(F.col("ratio_haversine_real").isNotNull())
    top = m.orderBy(F.col("ratio_haversine_real").desc(), F.col("trip_id")).limit(100)
    return comparable(top.select("trip_id", "ratio_haversine_real", "Real_distance", "haversine_distance_m"))


Q["top_ratio"] = top_ratio
SQL["top_ratio"] = f"""WITH trips AS ({TRIPS_SQL}),
ranged AS (SELECT * FROM trips WHERE {COORD_RANGE}),
measured AS (SELECT *, {ratio_expr()} AS ratio_haversine_real FROM {measures_cte('ranged')})
SELECT trip_id, round(CAST(ratio_haversine_real AS DOUBLE), 6) AS ratio_haversine_real,
  round(Real_distance, 6) AS Real_distance, round(CAST(haversine_distance_m AS DOUBLE), 6) AS haversine_distance_m
FROM measured WHERE ratio_haversine_real IS NOT NULL
ORDER BY ratio_haversine_real DESC, trip_id LIMIT 100"""


# -- row-wise functions ---------------------------------------------------------
def haversine(spark, sf):
    t = _ingested(spark, sf)
    from farelane.functions.columns import haversine_m
    return comparable(t.select("trip_id", haversine_m("Start_Lat", "Start_Lon", "End_Lat", "End_Lon")
                               .alias("haversine_m")), 4)


Q["haversine"] = haversine
SQL["haversine"] = f"""WITH trips AS ({TRIPS_SQL})
SELECT trip_id, round({hav('Start_Lat', 'Start_Lon', 'End_Lat', 'End_Lon')}, 4) AS haversine_m
FROM trips WHERE {COORD_RANGE}"""


def poi_distances(spark, sf):
    c = pipeline.clean_trips(load_trips(spark, sf))
    out = features.poi_distances(c)
    cols = [f"{w}_distance_to_{n}_m" for n in POIS for w in ("pickup", "dropoff")]
    return comparable(out.select("trip_id", *cols), 3)


Q["poi_distances"] = poi_distances
SQL["poi_distances"] = f"""WITH {clean_ctes()}
SELECT trip_id, {', '.join(f'round(CAST(x.{w}_distance_to_{n}_m AS DOUBLE), 3) AS {w}_distance_to_{n}_m' for n in POIS for w in ('pickup', 'dropoff'))}
FROM (SELECT trip_id,
    {poi_select()}
  FROM cleaned) x"""


def time_features(spark, sf):
    t = _ingested(spark, sf)        # a missing pickup time gives missing features
    out = features.time_features(t).select("trip_id", "pickup_hour_sin", "pickup_hour_cos",
                                           "pickup_weekday_sin", "pickup_weekday_cos")
    return comparable(out, 5)


Q["time_features"] = time_features
SQL["time_features"] = f"""WITH trips AS ({TRIPS_SQL})
SELECT trip_id, round(CAST(pickup_hour_sin AS DOUBLE), 5) + 0e0 AS pickup_hour_sin,
  round(CAST(pickup_hour_cos AS DOUBLE), 5) + 0e0 AS pickup_hour_cos,
  round(CAST(pickup_weekday_sin AS DOUBLE), 5) + 0e0 AS pickup_weekday_sin,
  round(CAST(pickup_weekday_cos AS DOUBLE), 5) + 0e0 AS pickup_weekday_cos
FROM (SELECT trip_id, {time_select()} FROM trips
      WHERE {COORD_RANGE}) x"""


def log1p_features(spark, sf):
    c = pipeline.clean_trips(load_trips(spark, sf))
    out = features.log1p_features(c, ["haversine_distance_m", "Real_distance", "route_distance_m"])
    return comparable(out.select("trip_id", "haversine_distance_m_log1p", "Real_distance_log1p"), 6)


Q["log1p_features"] = log1p_features
SQL["log1p_features"] = f"""WITH {clean_ctes()}
SELECT trip_id, round(ln(1 + CAST(haversine_distance_m AS DOUBLE)), 6) AS haversine_distance_m_log1p,
  round(ln(1 + CAST(Real_distance AS DOUBLE)), 6) AS Real_distance_log1p
FROM cleaned"""


# -- fitted scalers and imputers ------------------------------------------------
def _features_all(spark, sf):
    return pipeline.base_features(pipeline.clean_trips(load_trips(spark, sf)))


def _scale_query(method):
    def q(spark, sf):
        p = prep.fit_scaler(_features_all(spark, sf), SCALED_COLUMNS, method)
        return comparable(p, 4)
    return q


def _scale_sql(method):
    base = f"""WITH {clean_ctes()},
feats AS (SELECT trip_id, haversine_distance_m, {poi_select()} FROM cleaned)"""
    parts = []
    for c in SCALED_COLUMNS:
        x = f"CAST({c} AS DOUBLE)"
        if method == "standard":
            center, scale = f"avg({x})", f"CASE WHEN stddev_pop({x}) = 0 THEN 1e0 ELSE stddev_pop({x}) END"
        elif method == "minmax":
            center, scale = f"min({x})", f"CASE WHEN max({x}) - min({x}) = 0 THEN 1e0 ELSE max({x}) - min({x}) END"
        else:
            iqr = f"(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25))"
            center, scale = f"quantile_cont({x}, 0.5)", f"CASE WHEN {iqr} = 0 THEN 1e0 ELSE {iqr} END"
        parts.append(f"SELECT 'scaler' AS artefact, '{c}' AS column, 'center' AS stat, round({center}, 4) AS value FROM feats")
        parts.append(f"SELECT 'scaler' AS artefact, '{c}' AS column, 'scale' AS stat, round({scale}, 4) AS value FROM feats")
    return base + "\n" + "\nUNION ALL\n".join(parts)


for _m in ("standard", "minmax", "robust"):
    Q[f"scale_{_m}"] = _scale_query(_m)
    SQL[f"scale_{_m}"] = _scale_sql(_m)


def impute_mean(spark, sf):
    """Mean imputer fitted on the ingested rows, applied to them."""
    t = _ingested(spark, sf)
    p = prep.fit_imputer(t, IMPUTER_COLUMNS)
    out = prep.transform_imputer(t, p).select("trip_id", *IMPUTER_COLUMNS)
    return comparable(out, 6)


Q["impute_mean"] = impute_mean
SQL["impute_mean"] = f"""WITH trips AS ({TRIPS_SQL}),
ranged AS (SELECT * FROM trips WHERE {COORD_RANGE})
SELECT trip_id, {', '.join(f'round(coalesce({c}, (SELECT avg({c}) FROM ranged)), 6) AS {c}' for c in IMPUTER_COLUMNS)}
FROM ranged"""


def null_counts(spark, sf):
    return comparable(prep.null_counts(load_trips(spark, sf), REQUIRED_COLUMNS))


Q["null_counts"] = null_counts
SQL["null_counts"] = f"""WITH trips AS ({TRIPS_SQL})
{' UNION ALL '.join(f"SELECT '{c}' AS column, count_if({c} IS NULL)::BIGINT AS nulls FROM trips" for c in REQUIRED_COLUMNS)}
UNION ALL SELECT '__total__' AS column, ({' + '.join(f'count_if({c} IS NULL)' for c in REQUIRED_COLUMNS)})::BIGINT AS nulls FROM trips"""


# -- flagship: the feature table -----------------------------------------------
def feature_table(spark, sf):
    """Monthly trips -> month split -> clean -> impute -> time -> POI ->
    standard scaling fitted on the training months -> passengers x 0.1."""
    raw = splits.month_split(load_monthly_trips(spark, sf))
    out, _, _ = pipeline.feature_table(raw, split_col="split", fit_on="train")
    cols = (["trip_id", "split", "Passenger_Count", "Start_Lon", "Start_Lat", "End_Lon", "End_Lat",
             "Fare_Amt", "Total_Amt", "Real_time", "Real_distance"] + SCALED_COLUMNS
            + ["pickup_hour_sin", "pickup_hour_cos", "pickup_weekday_sin", "pickup_weekday_cos"])
    return comparable(out.select(*cols), 4)


def _feature_table_sql():
    scaled = ",\n  ".join(
        f"round(CAST(CAST((CAST(f.{c} AS DOUBLE) - s.m_{i}) / s.s_{i} AS FLOAT) AS DOUBLE), 4) + 0e0 AS {c}"
        for i, c in enumerate(SCALED_COLUMNS))
    stats = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{i}, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1e0 "
        f"ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{i}" for i, c in enumerate(SCALED_COLUMNS))
    # "+ 0e0" turns a rounded -0.0 into 0.0, as Spark's rounding returns
    plain = ", ".join(f"round(CAST(f.{c} AS DOUBLE), 4) + 0e0 AS {c}" for c in
                      ["Start_Lon", "Start_Lat", "End_Lon", "End_Lat", "Fare_Amt", "Total_Amt", "Real_time",
                       "Real_distance", "pickup_hour_sin", "pickup_hour_cos", "pickup_weekday_sin",
                       "pickup_weekday_cos"])
    return f"""WITH {clean_ctes(monthly=True)},
months AS (SELECT month, dense_rank() OVER (ORDER BY month) AS rk FROM (SELECT DISTINCT month FROM trips) m),
labelled AS (SELECT c.*, CASE WHEN rk <= 2 THEN 'train' WHEN rk = 3 THEN 'valtest' ELSE 'extra' END AS split
             FROM cleaned c JOIN months USING (month)),
feats AS (SELECT trip_id, split, Passenger_Count, Start_Lon, Start_Lat, End_Lon, End_Lat, Fare_Amt, Total_Amt,
            Real_time, Real_distance, haversine_distance_m, {time_select()},
            {poi_select()}
          FROM labelled),
st AS (SELECT {stats} FROM feats WHERE split = 'train')
SELECT f.trip_id, f.split, round(CAST(CAST(CAST(f.Passenger_Count AS DOUBLE) * 0.1e0 AS FLOAT) AS DOUBLE), 4) AS Passenger_Count,
  {plain},
  {scaled}
FROM feats f, st s"""


Q["feature_table"] = feature_table
SQL["feature_table"] = _feature_table_sql()


def audit_many_passengers(spark, sf):
    """Ingested trips with ten or more passengers."""
    return comparable(clean.audit_many_passengers(_ingested(spark, sf), 10).select("trip_id", "Passenger_Count"))


Q["audit_many_passengers"] = audit_many_passengers
SQL["audit_many_passengers"] = f"""WITH trips AS ({TRIPS_SQL})
SELECT trip_id, round(Passenger_Count, 6) AS Passenger_Count FROM trips
WHERE {COORD_RANGE} AND Passenger_Count >= 10"""


def audit_ratio_pair(spark, sf):
    """Trips (after the basic rules) hit by the stricter (ratio 6, 0.2 km) pair."""
    m = clean.with_trip_measures(_ingested(spark, sf))
    return comparable(clean.audit_ratio_pair(m, 6.0, 0.2).select("trip_id", "ratio_haversine_real"))


Q["audit_ratio_pair"] = audit_ratio_pair
SQL["audit_ratio_pair"] = f"""WITH trips AS ({TRIPS_SQL}),
ranged AS (SELECT * FROM trips WHERE {COORD_RANGE}),
measured AS (SELECT *, {ratio_expr()} AS ratio_haversine_real FROM {measures_cte('ranged')})
SELECT trip_id, round(CAST(ratio_haversine_real AS DOUBLE), 6) AS ratio_haversine_real
FROM measured WHERE ratio_haversine_real > 6 AND Real_distance > 200"""

"""Registered queries: route join, route features and filter, route error,
route scaler."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelane.config import ROUTE_SCALED_COLUMNS
from farelane.operators import features as FE
from farelane.operators import prep
from farelane.operators import routes as R
from farelane.plans import pipeline
from farelane.plans.common import comparable
from farelane.plans.sqltext import clean_ctes, f32
from farelane.session import materialize
from farelane.sources.tables import load_trips

Q, SQL = {}, {}


def routed(spark, sf):
    """Cleaned trips with routes from the provider over their distinct keys."""
    # the cleaned trips feed both the distinct keys and the join: write once
    cl = materialize(pipeline.clean_trips(load_trips(spark, sf)))
    routes = materialize(R.fetch_routes(R.route_keys(cl), R.taxicab_provider))
    return R.join_routes(cl, routes)


def route_join(spark, sf):
    return comparable(routed(spark, sf).select("trip_id", "route_distance_m", "route_duration_s"), 3)


def route_features(spark, sf):
    d = FE.route_ratios(R.route_filter(routed(spark, sf)))
    return comparable(d.select("trip_id", "route_distance_m", "route_duration_s", "average_speed_m_s",
                               "ratio_haversine_osrm"), 4)


def route_error(spark, sf):
    d = FE.route_error(R.route_filter(routed(spark, sf)))
    return comparable(d.select("trip_id", "dist_err_m", "dist_err_pct", "time_err_s", "time_err_pct"), 4)


def route_scale(spark, sf):
    d = FE.route_ratios(R.route_filter(routed(spark, sf)))
    return comparable(prep.fit_scaler(d, ROUTE_SCALED_COLUMNS, "standard", artefact="route_scaler"), 4)


Q.update(route_join=route_join, route_features=route_features, route_error=route_error, route_scale=route_scale)

_dist, _dur = R.taxicab_sql("CAST(Start_Lon AS DOUBLE)", "CAST(Start_Lat AS DOUBLE)",
                            "CAST(End_Lon AS DOUBLE)", "CAST(End_Lat AS DOUBLE)")
_ROUTED = f"""WITH {clean_ctes()},
routed AS (SELECT *, {f32(_dist)} AS route_distance_m, {f32(_dur)} AS route_duration_s FROM cleaned),
rf AS (SELECT *,
         CAST(CAST(route_distance_m AS DOUBLE) / CAST(route_duration_s AS DOUBLE) AS FLOAT) AS average_speed_m_s,
         CAST(CASE WHEN haversine_distance_m = 0 THEN NULL
                   ELSE CAST(route_distance_m AS DOUBLE) / CAST(haversine_distance_m AS DOUBLE) END AS FLOAT)
           AS ratio_haversine_osrm
       FROM routed WHERE route_distance_m > 0 AND route_duration_s > 0)"""

SQL["route_join"] = _ROUTED + """
SELECT trip_id, round(CAST(route_distance_m AS DOUBLE), 3) AS route_distance_m,
       round(CAST(route_duration_s AS DOUBLE), 3) AS route_duration_s FROM routed"""

SQL["route_features"] = _ROUTED + """
SELECT trip_id, round(CAST(route_distance_m AS DOUBLE), 4) AS route_distance_m,
       round(CAST(route_duration_s AS DOUBLE), 4) AS route_duration_s,
       round(CAST(average_speed_m_s AS DOUBLE), 4) AS average_speed_m_s,
       round(CAST(ratio_haversine_osrm AS DOUBLE), 4) AS ratio_haversine_osrm
FROM rf"""

SQL["route_error"] = _ROUTED + """
SELECT trip_id,
  round(CAST(route_distance_m AS DOUBLE) - CAST(Real_distance AS DOUBLE), 4) AS dist_err_m,
  round(CASE WHEN Real_distance = 0 THEN NULL ELSE abs(CAST(route_distance_m AS DOUBLE) - CAST(Real_distance AS DOUBLE)) * 100
        / CAST(Real_distance AS DOUBLE) END, 4) AS dist_err_pct,
  round(CAST(route_duration_s AS DOUBLE) - CAST(Real_time AS DOUBLE), 4) AS time_err_s,
  round(CASE WHEN Real_time = 0 THEN NULL ELSE abs(CAST(route_duration_s AS DOUBLE) - CAST(Real_time AS DOUBLE)) * 100
        / CAST(Real_time AS DOUBLE) END, 4) AS time_err_pct
FROM rf"""

SQL["route_scale"] = _ROUTED + ",\nrr AS (SELECT * FROM rf)\n" + "\nUNION ALL\n".join(
    f"SELECT 'route_scaler' AS artefact, '{c}' AS column, 'center' AS stat, round(avg(CAST({c} AS DOUBLE)), 4) AS value FROM rr\n"
    f"UNION ALL SELECT 'route_scaler', '{c}', 'scale', round(CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1e0 "
    f"ELSE stddev_pop(CAST({c} AS DOUBLE)) END, 4) FROM rr"
    for c in ROUTE_SCALED_COLUMNS)


def routes_to_fetch(spark, sf):
    """Keys the provider must still be called for: distinct coordinate pairs
    of the third month missing from a cache filled for the first two months
    (left anti join of distinct keys)."""
    from farelane.operators import split as S
    from farelane.sources.tables import load_monthly_trips
    cl = materialize(pipeline.clean_trips(S.month_split(load_monthly_trips(spark, sf))))
    cache = materialize(R.fetch_routes(R.route_keys(cl.filter("split = 'train'")), R.taxicab_provider))
    todo = R.missing_keys(R.route_keys(cl.filter("split = 'valtest'")), cache)
    return comparable(todo, 6)


Q["routes_to_fetch"] = routes_to_fetch


def _routes_to_fetch_sql():
    k = "round(CAST(Start_Lon AS DOUBLE), 6) AS start_lon, round(CAST(Start_Lat AS DOUBLE), 6) AS start_lat, " \
        "round(CAST(End_Lon AS DOUBLE), 6) AS end_lon, round(CAST(End_Lat AS DOUBLE), 6) AS end_lat"
    return f"""WITH {clean_ctes(monthly=True)},
months AS (SELECT month, dense_rank() OVER (ORDER BY month) AS rk FROM (SELECT DISTINCT month FROM trips) m),
lab AS (SELECT c.*, rk FROM cleaned c JOIN months USING (month)),
cache AS (SELECT DISTINCT {k} FROM lab WHERE rk <= 2),
want AS (SELECT DISTINCT {k} FROM lab WHERE rk = 3)
SELECT * FROM want w WHERE NOT EXISTS (
  SELECT 1 FROM cache c WHERE c.start_lon = w.start_lon AND c.start_lat = w.start_lat
                          AND c.end_lon = w.end_lon AND c.end_lat = w.end_lat)"""


SQL["routes_to_fetch"] = _routes_to_fetch_sql()


def cm_coverage(spark, sf):
    """A monitored month whose routes a cache of the other months lacks: trips,
    how many have a route from the cache alone, and after the missing keys were
    fetched."""
    from farelane.operators import split as S
    from farelane.sources.tables import load_monthly_trips
    cl = materialize(pipeline.clean_trips(S.month_split(load_monthly_trips(spark, sf))))
    month = cl.filter("split = 'valtest'")
    cache = materialize(R.fetch_routes(R.route_keys(cl.filter("split = 'train'")), R.taxicab_provider))
    new = materialize(R.fetch_routes(R.missing_keys(R.route_keys(month), cache), R.taxicab_provider))
    before = R.route_coverage(month, cache).select(F.lit("cache only").alias("routes"), "*")
    after = R.route_coverage(month, cache.unionByName(new)).select(F.lit("missing fetched").alias("routes"), "*")
    return comparable(before.unionByName(after))


Q["cm_coverage"] = cm_coverage
SQL["cm_coverage"] = f"""WITH {clean_ctes(monthly=True)},
months AS (SELECT month, dense_rank() OVER (ORDER BY month) AS rk FROM (SELECT DISTINCT month FROM trips) m),
lab AS (SELECT c.*, rk, {_dist} AS dist FROM cleaned c JOIN months USING (month)),
cache AS (SELECT DISTINCT Start_Lon, Start_Lat, End_Lon, End_Lat FROM lab WHERE rk <= 2),
m AS (SELECT lab.*, EXISTS (SELECT 1 FROM cache c WHERE c.Start_Lon = lab.Start_Lon AND c.Start_Lat = lab.Start_Lat
             AND c.End_Lon = lab.End_Lon AND c.End_Lat = lab.End_Lat) AS known FROM lab WHERE rk = 3)
SELECT 'cache only' AS routes, count(*)::BIGINT AS trips, count(*) FILTER (NOT known)::BIGINT AS without_route,
       count(*) FILTER (known AND dist > 0)::BIGINT AS kept FROM m
UNION ALL SELECT 'missing fetched', count(*)::BIGINT, 0::BIGINT, count(*) FILTER (dist > 0)::BIGINT FROM m"""

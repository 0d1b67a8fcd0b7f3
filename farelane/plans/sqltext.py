"""SQL text shared by the oracle queries (ANSI SQL that DuckDB runs on the
raw tables).  Each oracle inlines the trip derivation as a CTE, then states
the operator's semantics independently of the Spark code."""

from __future__ import annotations

from farelane.sources.tables import MONTHLY_TRIPS_SQL, TRIPS_SQL


# Points of interest, written out apart from the configuration.
POIS = {
    "nyc": (40.724944, -74.001541),
    "jfk": (40.645494, -73.785937),
    "lga": (40.774071, -73.872067),
    "nla": (40.690764, -74.177721),
    "chp": (41.366138, -73.137393),
    "exp": (40.736000, -74.037500),
}


def f32(x: str) -> str:
    return f"CAST({x} AS FLOAT)"


def f32d(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(6371.0e0 * (2e0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"
            f" * 1000e0)")


def hav_poi(lat: str, lon: str, plat: float, plon: float) -> str:
    return hav(lat, lon, f"{plat!r}e0" if "e" not in repr(plat) else repr(plat),
               f"{plon!r}e0" if "e" not in repr(plon) else repr(plon))


def lit(x: float) -> str:
    r = repr(float(x))
    return r if "e" in r else r + "e0"


def r(x: str, d: int = 6) -> str:
    """Round for comparison (double out)."""
    return f"round(CAST({x} AS DOUBLE), {d})"


COORD_RANGE = ("Start_Lat BETWEEN -90 AND 90 AND End_Lat BETWEEN -90 AND 90 "
               "AND Start_Lon BETWEEN -180 AND 180 AND End_Lon BETWEEN -180 AND 180")


def measures_cte(src: str = "trips") -> str:
    """CTE body adding Real_time, Real_distance, Real_velocity, haversine and ratio."""
    return f"""(
  SELECT *, {f32(div('Real_distance', 'Real_time'))} AS Real_velocity
  FROM (
    SELECT *,
      CAST(epoch_us(Trip_Dropoff_DateTime) - epoch_us(Trip_Pickup_DateTime) AS DOUBLE) / 1e6 AS Real_time,
      Trip_Distance * 1609.344e0 AS Real_distance,
      {f32(hav('Start_Lat', 'Start_Lon', 'End_Lat', 'End_Lon'))} AS haversine_distance_m
    FROM {src}
  ) a
) """


def ratio_expr() -> str:
    return f32(div("CAST(haversine_distance_m AS DOUBLE)", f32d("Real_distance")))


def rule_list() -> list[tuple[str, str]]:
    """The default rules with their limits written out, so that a wrong limit
    in the configuration shows as a difference."""
    rt32, rd32 = f32("Real_time"), f32("Real_distance")
    return [
        ("required_not_null", "Trip_Pickup_DateTime IS NOT NULL AND Trip_Dropoff_DateTime IS NOT NULL "
                              "AND Trip_Distance IS NOT NULL AND Fare_Amt IS NOT NULL AND Total_Amt IS NOT NULL"),
        ("passengers_in_1_10", "Passenger_Count > 0 AND Passenger_Count <= 10"),
        ("duration_positive", "Real_time > 0"),
        ("distance_positive", "Trip_Distance > 0"),
        ("speed_le_limit", "Real_velocity <= 300e0 * 1000e0 / 3600e0"),
        ("duration_le_days", f"{rt32} <= 2764800e0"),
        ("duration_lt_minutes", f"{rt32} < 1800e0"),
        ("speed_le_constant", "Real_velocity <= 100e0 * 1000e0 / 3600e0"),
        ("distance_le_km", f"{rd32} <= 56000e0"),
        ("haversine_le_km", "haversine_distance_m <= 800000e0"),
        ("ratio_lt_limit", "ratio_haversine_real < 80e0"),
        ("ratio_distance_pairs", f"NOT ((ratio_haversine_real > 40e0 AND {rd32} > 800e0) "
                                 f"OR (ratio_haversine_real > 15e0 AND {rd32} > 5000e0) "
                                 f"OR (ratio_haversine_real > 3e0 AND {rd32} > 1000e0) "
                                 f"OR (ratio_haversine_real > 4e0 AND {rd32} > 500e0))"),
    ]


def clean_ctes(monthly: bool = False) -> str:
    """``trips``, ``measured`` (range-filtered + measures) and ``cleaned`` CTEs."""
    src = MONTHLY_TRIPS_SQL if monthly else TRIPS_SQL
    conds = " AND ".join(f"({c})" for _, c in rule_list())
    extra = ", month" if monthly else ""
    return f"""trips AS ({src}),
ranged AS (SELECT * FROM trips WHERE {COORD_RANGE}),
measured AS (SELECT *, {ratio_expr()} AS ratio_haversine_real FROM {measures_cte('ranged')}),
cleaned AS (
  SELECT trip_id{extra}, Trip_Pickup_DateTime, Trip_Dropoff_DateTime,
    {f32('Passenger_Count')} AS Passenger_Count,
    {f32('Start_Lon')} AS Start_Lon, {f32('Start_Lat')} AS Start_Lat,
    {f32('End_Lon')} AS End_Lon, {f32('End_Lat')} AS End_Lat,
    {f32('Fare_Amt')} AS Fare_Amt, {f32('Total_Amt')} AS Total_Amt,
    {f32('Real_time')} AS Real_time, {f32('Real_distance')} AS Real_distance,
    haversine_distance_m
  FROM measured WHERE {conds}
)"""


def poi_select(prefix: str = "") -> str:
    parts = []
    for name, (plat, plon) in POIS.items():
        parts.append(f"{f32(hav_poi(prefix + 'Start_Lat', prefix + 'Start_Lon', plat, plon))} AS pickup_distance_to_{name}_m")
        parts.append(f"{f32(hav_poi(prefix + 'End_Lat', prefix + 'End_Lon', plat, plon))} AS dropoff_distance_to_{name}_m")
    return ",\n    ".join(parts)


def time_select(ts: str = "Trip_Pickup_DateTime") -> str:
    h, w = f"hour({ts})", f"(isodow({ts}) - 1)"
    return (f"{f32(f'sin(2e0 * pi() * {h} / 24e0)')} AS pickup_hour_sin, "
            f"{f32(f'cos(2e0 * pi() * {h} / 24e0)')} AS pickup_hour_cos, "
            f"{f32(f'sin(2e0 * pi() * {w} / 7e0)')} AS pickup_weekday_sin, "
            f"{f32(f'cos(2e0 * pi() * {w} / 7e0)')} AS pickup_weekday_cos")

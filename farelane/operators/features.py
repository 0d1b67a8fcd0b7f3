"""Row-wise feature builders: cyclic time, POI distances, ratios, log1p.

All are projections of native expressions; none shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.config import POIS
from farelane.functions.columns import as_float, cyclic, haversine_to_point_m, safe_div

PICKUP, DROPOFF = "Trip_Pickup_DateTime", "Trip_Dropoff_DateTime"


def time_features(df: DataFrame, ts: str = PICKUP, drop_datetimes: bool = True) -> DataFrame:
    """sin/cos of hour (period 24) and weekday (Monday = 0, period 7)."""
    hour = F.hour(ts)
    wday = F.weekday(ts)
    out = df.withColumns({
        "pickup_hour_sin": as_float(cyclic(hour, 24, "sin")),
        "pickup_hour_cos": as_float(cyclic(hour, 24, "cos")),
        "pickup_weekday_sin": as_float(cyclic(wday, 7, "sin")),
        "pickup_weekday_cos": as_float(cyclic(wday, 7, "cos")),
    })
    return out.drop(PICKUP, DROPOFF) if drop_datetimes else out


def poi_distances(df: DataFrame, pois: dict = POIS, start=("Start_Lat", "Start_Lon"),
                  end=("End_Lat", "End_Lon")) -> DataFrame:
    """Pickup and dropoff distance (m) to each point of interest.  Literal
    expressions per POI: no join, one projection."""
    cols = {}
    for name, (plat, plon) in pois.items():
        cols[f"pickup_distance_to_{name}_m"] = as_float(haversine_to_point_m(*start, plat, plon))
        cols[f"dropoff_distance_to_{name}_m"] = as_float(haversine_to_point_m(*end, plat, plon))
    return df.withColumns(cols)


def log1p_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """``{c}_log1p`` companions for the listed columns that exist."""
    return df.withColumns({f"{c}_log1p": F.log1p(c) for c in columns if c in df.columns})


def passenger_scale(df: DataFrame, col: str = "Passenger_Count", factor: float = 0.1) -> DataFrame:
    return df.withColumn(col, as_float(F.col(col) * factor))


def extras(df: DataFrame) -> DataFrame:
    """Extras = Total - Fare."""
    return df.withColumn("Extras", F.col("Total_Amt") - F.col("Fare_Amt"))


def route_ratios(df: DataFrame, use_raw_haversine: bool = False,
                 haversine_col: str = "haversine_distance_m") -> DataFrame:
    """Route speed and route / haversine ratio.  By default the haversine
    column is whatever the frame holds (the scaled one in the feature table)."""
    h = F.col("haversine_raw_m") if use_raw_haversine else F.col(haversine_col)
    return df.withColumns({
        "average_speed_m_s": as_float(safe_div(F.col("route_distance_m"), F.col("route_duration_s"))),
        "ratio_haversine_osrm": as_float(safe_div(F.col("route_distance_m"), as_float(h))),
    })


def route_error(df: DataFrame) -> DataFrame:
    """Route vs metered error, absolute and percent, for distance and time."""
    rd, rt = F.col("route_distance_m").cast("double"), F.col("route_duration_s").cast("double")
    d, t = F.col("Real_distance").cast("double"), F.col("Real_time").cast("double")
    return df.withColumns({
        "dist_err_m": rd - d,
        "dist_err_pct": safe_div(F.abs(rd - d) * 100.0, d),
        "time_err_s": rt - t,
        "time_err_pct": safe_div(F.abs(rt - t) * 100.0, t),
    })

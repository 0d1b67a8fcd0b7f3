"""Configuration: column names, fixed values and tunable defaults.

Everything an operator needs is passed explicitly; these are only the trip
defaults so that ``clean(df)`` works on the canonical table without arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's values for equal results)
# ---------------------------------------------------------------------------

# Canonical raw columns, in their documented order.
REQUIRED_COLUMNS = [
    "Trip_Pickup_DateTime", "Trip_Dropoff_DateTime",
    "Passenger_Count", "Trip_Distance", "Start_Lon", "Start_Lat", "End_Lon", "End_Lat",
    "Fare_Amt", "Total_Amt",
]
NUMERIC_COLUMNS = [
    "Passenger_Count", "Trip_Distance", "Start_Lon", "Start_Lat", "End_Lon", "End_Lat",
    "Fare_Amt", "Total_Amt",
]
STRING_COLUMNS = ["Trip_Pickup_DateTime", "Trip_Dropoff_DateTime"]
DATETIME_COLUMNS = ["Trip_Pickup_DateTime", "Trip_Dropoff_DateTime"]

# Columns that must not be null after ingest (the null rule).
NOT_NULL_COLUMNS = ["Trip_Pickup_DateTime", "Trip_Dropoff_DateTime", "Trip_Distance",
                    "Fare_Amt", "Total_Amt"]

# Points of interest: name -> (lat, lon).
POIS = {
    "nyc": (40.724944, -74.001541),
    "jfk": (40.645494, -73.785937),
    "lga": (40.774071, -73.872067),
    "nla": (40.690764, -74.177721),
    "chp": (41.366138, -73.137393),
    "exp": (40.736000, -74.037500),
}

EARTH_RADIUS_KM = 6371.0
MILE_M = 1609.344

# Alias names accepted for each canonical column, in priority order (the first
# variant present in a file wins).
COLUMN_ALIASES = {
    "Trip_Pickup_DateTime": ["pickup_datetime", "tpep_pickup_datetime", "lpep_pickup_datetime",
                             "Trip_Pickup_DateTime", "Pickup_DateTime"],
    "Trip_Dropoff_DateTime": ["dropoff_datetime", "tpep_dropoff_datetime", "lpep_dropoff_datetime",
                              "Trip_Dropoff_DateTime", "Dropoff_DateTime"],
    "Passenger_Count": ["passenger_count", "Passenger_count", "Passenger_Count",
                        "passengers", "num_passengers"],
    "Trip_Distance": ["trip_distance", "Trip_distance", "Trip_Distance",
                      "distance", "distance_miles", "trip_miles"],
    "Start_Lon": ["pickup_longitude", "Start_Lon", "pickup_long", "pickup_lon", "start_longitude"],
    "Start_Lat": ["pickup_latitude", "Start_Lat", "pickup_lat", "start_latitude"],
    "End_Lon": ["dropoff_longitude", "End_Lon", "dropoff_long", "dropoff_lon", "end_longitude"],
    "End_Lat": ["dropoff_latitude", "End_Lat", "dropoff_lat", "end_latitude"],
    "Fare_Amt": ["fare_amount", "Fare_Amt", "fare", "fare_amt", "base_fare"],
    "Total_Amt": ["total_amount", "Total_Amt", "total", "total_fare", "payment_total"],
}

# Scaled feature columns of the base feature table.
SCALED_COLUMNS = [
    "haversine_distance_m",
    "pickup_distance_to_nyc_m", "dropoff_distance_to_nyc_m",
    "pickup_distance_to_jfk_m", "dropoff_distance_to_jfk_m",
    "pickup_distance_to_lga_m", "dropoff_distance_to_lga_m",
    "pickup_distance_to_nla_m", "dropoff_distance_to_nla_m",
    "pickup_distance_to_chp_m", "dropoff_distance_to_chp_m",
    "pickup_distance_to_exp_m", "dropoff_distance_to_exp_m",
]
ROUTE_SCALED_COLUMNS = ["route_distance_m", "route_duration_s", "average_speed_m_s",
                        "ratio_haversine_osrm"]

IMPUTER_COLUMNS = ["Passenger_Count", "Start_Lon", "Start_Lat", "End_Lon", "End_Lat"]

# Multi-criteria selection weights and metric directions.
SELECTION_WEIGHTS = {"rmse": 0.50, "mae": 0.25, "r2": 0.05, "mape": 0.10, "medae": 0.10}
METRICS_ORDER = ["rmse", "mae", "r2", "mape", "medae"]
LOWER_IS_BETTER = ["rmse", "mae", "mape", "medae"]
PROMOTION_METRICS = ["rmse", "mae", "mape", "medae"]

MAPE_EPS = 1e-8


@dataclass(frozen=True)
class OutlierRules:
    """Outlier filter limits (defaults are the shipped configuration)."""

    real_time: bool = True              # drop duration <= 0
    trip_distance: bool = True          # drop distance <= 0
    real_velocity_limit_kmh: float = 300.0
    real_time_days: float = 32.0
    max_minutes: float = 30.0           # duration strictly below
    max_velocity_kmh: float = 100.0
    max_distance_km: float = 56.0
    distance_limit_km: float = 800.0    # haversine
    haversine_ratio_limit: float = 80.0
    ratio_distance_pairs: tuple = ((40.0, 0.8), (15.0, 5.0), (3.0, 1.0), (4.0, 0.5))
    # "separate": time, speed and distance limits are three filters (what the
    # original code applies); "combined": a trip is dropped only when it
    # exceeds all three at once (what its configuration comment describes)
    constant_mode: str = "separate"


@dataclass(frozen=True)
class ModelParams:
    """Learner settings.  Defaults follow the shipped configuration where MLlib
    has the same knob; ``quick()`` is a small variant for smoke runs."""

    gbt_a: dict = field(default_factory=lambda: dict(maxIter=550, maxDepth=8, stepSize=0.09,
                                                     subsamplingRate=0.8, seed=42))
    gbt_b: dict = field(default_factory=lambda: dict(maxIter=400, maxDepth=8, stepSize=0.08,
                                                     seed=42))
    forest: dict = field(default_factory=lambda: dict(numTrees=60, maxDepth=8, seed=42))
    ridge_alpha_base: float = 1.2
    ridge_alpha_ct: float = 0.5
    meta_train_frac: float = 0.8
    oof_folds: int = 5
    seed: int = 42

    @staticmethod
    def quick() -> "ModelParams":
        return ModelParams(
            gbt_a=dict(maxIter=20, maxDepth=5, stepSize=0.09, subsamplingRate=0.8, seed=42),
            gbt_b=dict(maxIter=15, maxDepth=5, stepSize=0.08, seed=42),
            forest=dict(numTrees=20, maxDepth=6, seed=42),
        )

"""Ingest cleaning and outlier rules.

Every rule is a native ``Column`` predicate; ``filter_outliers`` applies them as
one conjunction (one codegen'd filter, cheap rules first, so Catalyst pushes
the plain column comparisons into the Parquet scan), and ``waterfall`` counts
the survivors after every rule in one aggregation pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.config import (DATETIME_COLUMNS, NOT_NULL_COLUMNS, NUMERIC_COLUMNS,
                             OutlierRules)
from farelane.functions.columns import (as_float, days_to_s, elapsed_seconds, evaluate_once,
                                        haversine_m, km_to_m, kmh_to_ms, min_to_s, miles_to_m,
                                        nan_to_null, safe_div)

PICKUP, DROPOFF = "Trip_Pickup_DateTime", "Trip_Dropoff_DateTime"
COORDS = ("Start_Lat", "Start_Lon", "End_Lat", "End_Lon")


def _and(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


# ---------------------------------------------------------------------------
# ingest
# ---------------------------------------------------------------------------
def nan_to_nulls(df: DataFrame, columns: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Replace NaN by null in the given floating columns that exist."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns({c: nan_to_null(c) for c in columns if c in floats})


def to_datetime(df: DataFrame, columns: list[str] = DATETIME_COLUMNS, fmt: str | None = None) -> DataFrame:
    """String -> timestamp, invalid strings -> null.  Missing column raises."""
    out = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in columns:
        if c not in types:
            raise ValueError(f"column {c!r} is missing")
        if isinstance(types[c], T.StringType):
            parsed = F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(c))
            out[c] = parsed.cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def coordinate_range_predicate(lat_cols=("Start_Lat", "End_Lat"), lon_cols=("Start_Lon", "End_Lon")) -> Column:
    """Latitudes in [-90, 90] and longitudes in [-180, 180], both ends included."""
    return _and([F.col(c).between(-90.0, 90.0) for c in lat_cols]
                + [F.col(c).between(-180.0, 180.0) for c in lon_cols])


def coordinates_in_range(df: DataFrame, **kw) -> DataFrame:
    return df.filter(coordinate_range_predicate(**kw))


# ---------------------------------------------------------------------------
# derived trip measures
# ---------------------------------------------------------------------------
def with_trip_measures(df: DataFrame) -> DataFrame:
    """Duration (s), distance (m), speed (m/s), haversine (m) and the
    haversine / real ratio.  Float32 rounding is applied where the stored
    columns are float32, so limits compare the same values."""
    real_time = elapsed_seconds(PICKUP, DROPOFF)
    real_distance = miles_to_m("Trip_Distance")
    return df.withColumns({
        "Real_time": real_time,
        "Real_distance": real_distance,
    }).withColumns({
        "Real_velocity": as_float(safe_div("Real_distance", "Real_time")),
        "haversine_distance_m": as_float(haversine_m(*COORDS)),
    }).withColumn(
        "ratio_haversine_real",
        as_float(safe_div(as_float("haversine_distance_m").cast("double"),
                          as_float("Real_distance").cast("double"))),
    )


SOURCE_RULES = {"required_not_null", "passengers_in_1_10", "distance_positive"}


def outlier_predicates(rules: OutlierRules = OutlierRules()) -> list[tuple[str, Column]]:
    """Ordered (name, predicate) list over a frame from ``with_trip_measures``."""
    rt = F.col("Real_time")
    rt32 = as_float("Real_time")
    rd32 = as_float("Real_distance")
    vel = F.col("Real_velocity")
    # NaN must fail like null.  Spark orders NaN above every number, so the
    # range / upper-limit rules reject it already; only the not-null rule
    # needs an explicit check.  Rules stay on raw columns so that the plain
    # comparisons reach the Parquet scan as pushed filters.
    def present(c):
        return F.col(c).isNotNull() & ~F.isnan(c) if c not in (PICKUP, DROPOFF) else F.col(c).isNotNull()

    preds: list[tuple[str, Column]] = [
        ("required_not_null", _and([present(c) for c in NOT_NULL_COLUMNS])),
        ("passengers_in_1_10", (F.col("Passenger_Count") > 0) & (F.col("Passenger_Count") <= 10)),
    ]
    if rules.real_time:
        preds.append(("duration_positive", rt > 0.0))
    if rules.trip_distance:
        preds.append(("distance_positive", F.col("Trip_Distance") > 0.0))
    preds += [
        ("speed_le_limit", vel <= kmh_to_ms(rules.real_velocity_limit_kmh)),
        ("duration_le_days", rt32 <= days_to_s(rules.real_time_days)),
    ]
    time_ok = rt32 < min_to_s(rules.max_minutes)
    speed_ok = vel <= kmh_to_ms(rules.max_velocity_kmh)
    dist_ok = rd32 <= km_to_m(rules.max_distance_km)
    if rules.constant_mode == "separate":
        preds += [("duration_lt_minutes", time_ok), ("speed_le_constant", speed_ok), ("distance_le_km", dist_ok)]
    elif rules.constant_mode == "combined":
        preds.append(("time_speed_distance", time_ok | speed_ok | dist_ok))
    else:
        raise ValueError(f"constant_mode must be 'separate' or 'combined', not {rules.constant_mode!r}")
    preds += [
        ("haversine_le_km", F.col("haversine_distance_m") <= km_to_m(rules.distance_limit_km)),
        ("ratio_lt_limit", F.col("ratio_haversine_real") < rules.haversine_ratio_limit),
    ]
    if rules.ratio_distance_pairs:
        bad = reduce(lambda a, b: a | b, [
            (F.col("ratio_haversine_real") > float(r)) & (rd32 > km_to_m(float(d)))
            for r, d in rules.ratio_distance_pairs])
        preds.append(("ratio_distance_pairs", ~bad))
    return preds


def filter_outliers(df: DataFrame, rules: OutlierRules = OutlierRules(),
                    keep: list[str] | None = None) -> DataFrame:
    """Drop rows failing any rule; returns the cleaned trips with the float32
    measure columns ``Real_time``, ``Real_distance``, ``haversine_distance_m``."""
    preds = outlier_predicates(rules)
    # rules on source columns first: plain comparisons Catalyst pushes into the scan
    src = df.filter(_and([p for n, p in preds if n in SOURCE_RULES]))
    # derived measures computed once per row, then the rules on them
    m = evaluate_once(with_trip_measures(src))
    m = m.filter(_and([p for n, p in preds if n not in SOURCE_RULES]))
    float_cols = ["Passenger_Count", "Fare_Amt", "Total_Amt", "Real_time", "Real_distance",
                  "Start_Lon", "Start_Lat", "End_Lon", "End_Lat"]
    m = m.withColumns({c: as_float(c) for c in float_cols})
    m = m.drop("Trip_Distance", "Real_velocity", "ratio_haversine_real")
    if keep is not None:
        m = m.select(*keep)
    return m


def waterfall(df: DataFrame, rules: OutlierRules = OutlierRules(),
              with_range: bool = True) -> DataFrame:
    """Rows left after each rule in turn, as ``(step, rule, rows)``, from a
    single aggregation (one scan, partial counts combined map-side)."""
    m = evaluate_once(with_trip_measures(df))
    steps: list[tuple[str, Column]] = [("all", F.lit(True))]
    if with_range:
        steps.append(("coordinates_in_range", coordinate_range_predicate()))
    steps += outlier_predicates(rules)
    cum, aggs = F.lit(True), []
    for i, (_, p) in enumerate(steps):
        cum = cum & p
        aggs.append(F.count_if(cum).alias(f"c{i}"))
    wide = m.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("rule"),
                              F.col(f"c{i}").alias("rows"))
                     for i, (name, _) in enumerate(steps)])
    return wide.select(F.inline(rows))


# ---------------------------------------------------------------------------
# audits
# ---------------------------------------------------------------------------
def audit_real_shorter_than_haversine(df: DataFrame) -> DataFrame:
    """Trips whose metered distance is shorter than the straight line."""
    return df.filter(F.col("Real_distance") < F.col("haversine_distance_m"))


def audit_many_passengers(df: DataFrame, limit: float = 10) -> DataFrame:
    return df.filter(F.col("Passenger_Count") >= limit)


def audit_ratio_pair(df: DataFrame, ratio: float = 6.0, km: float = 0.2) -> DataFrame:
    """The stricter (ratio, distance) pair used in the exploratory audit."""
    return df.filter((F.col("ratio_haversine_real") > ratio)
                     & (F.col("Real_distance") > km_to_m(km)))

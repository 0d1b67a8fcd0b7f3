"""Column-expression helpers: every function returns a ``Column`` built from
native Spark expressions, so it stays inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelane.config import EARTH_RADIUS_KM, MILE_M


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def evaluate_once(df):
    """Make every column of ``df`` a materialised attribute for later filters.

    Catalyst substitutes a projected expression into each filter or aggregate
    that references it (a derived distance used by five rules is computed five
    times per row, and the filter is pushed below any repartition).  A
    one-element ``inline`` turns the columns into generator output, which
    filters cannot be pushed beneath, so each expression runs once per row."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


# -- units -----------------------------------------------------------------
def km_to_m(km: float) -> float:
    return km * 1000.0


def kmh_to_ms(kmh: float) -> float:
    return kmh * 1000.0 / 3600.0


def days_to_s(days: float) -> float:
    return days * 24 * 60 * 60


def min_to_s(minutes: float) -> float:
    return minutes * 60


# -- null / NaN / division --------------------------------------------------
def nan_to_null(c) -> Column:
    """NaN -> null, so that a later comparison drops the row as a NaN compare
    would (Spark orders NaN above every number, SQL null drops)."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def safe_div(a, b) -> Column:
    """Division that yields null instead of raising on a zero divisor."""
    return F.try_divide(col(a), col(b))


def as_float(c) -> Column:
    return col(c).cast("float")


def interval_micros(iv: str) -> Column:
    """Microseconds of a day-time interval SQL expression (exact)."""
    return F.expr(f"CAST(extract(DAY FROM {iv}) AS BIGINT) * 86400000000"
                  f" + CAST(extract(HOUR FROM {iv}) AS BIGINT) * 3600000000"
                  f" + CAST(extract(MINUTE FROM {iv}) AS BIGINT) * 60000000"
                  f" + CAST(extract(SECOND FROM {iv}) * 1000000 AS BIGINT)")


def elapsed_seconds(start, end) -> Column:
    """Elapsed seconds between two timestamps, microsecond exact.  Wall-clock
    (NTZ) values are subtracted as intervals, so the session time zone never
    shifts them (``timestampdiff`` would move local times a DST zone lacks)."""
    return interval_micros(f"({_sql(end)} - {_sql(start)})").cast("double") / F.lit(1e6)


def ntz_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (NTZ) timestamp, without
    going through the session time zone."""
    return interval_micros(f"({_sql(c)} - TIMESTAMP_NTZ'1970-01-01 00:00:00')")


def ntz_string(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff`` of a wall-clock timestamp, zone-free."""
    x = col(c)
    s = F.format_string("%s %02d:%02d:%02d.%06d", x.cast("date").cast("string"), F.hour(x), F.minute(x),
                        F.second(x), F.pmod(ntz_micros(c), F.lit(1_000_000)))
    return F.when(x.isNotNull(), s)


def cyclic(value, period: float, fn: str) -> Column:
    ang = F.lit(2 * math.pi) * col(value) / F.lit(float(period))
    return F.sin(ang) if fn == "sin" else F.cos(ang)


# -- geo -------------------------------------------------------------------
def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres (R = 6371 km)."""
    la1, lo1, la2, lo2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    dlat = la2 - la1
    dlon = lo2 - lo1
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.asin(F.sqrt(a))) * F.lit(1000.0)


def haversine_to_point_m(lat, lon, p_lat: float, p_lon: float) -> Column:
    """Distance from each row's point to a fixed point of interest."""
    la = F.radians(col(lat))
    lo = F.radians(col(lon))
    pla = math.radians(p_lat)
    plo = math.radians(p_lon)
    dlat = F.lit(pla) - la
    dlon = F.lit(plo) - lo
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(la) * F.lit(math.cos(pla)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.asin(F.sqrt(a))) * F.lit(1000.0)


def miles_to_m(c) -> Column:
    return col(c) * F.lit(MILE_M)


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("elapsed_seconds takes column names")

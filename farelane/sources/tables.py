"""Table sources: the driver's parquet tables and the trip table derived from
``events``.

The trip table is derived with native expressions only (no Python per row);
its work grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan with column projection pushed into the reader."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


# Trip table derived from events.  The modular arithmetic plants nulls, zero
# distances, out-of-range coordinates and negative / long durations; the same
# text is the oracle's CTE (see ``TRIPS_SQL``), so both engines agree.
_TRIP_EXPRS = {
    "trip_id": "event_id",
    "Trip_Pickup_DateTime": "CASE WHEN event_id % 211 = 0 THEN NULL ELSE ts END",
    "Trip_Dropoff_DateTime": "ts + (event_id * 7919 % 2400 - 60) * INTERVAL '1' SECOND",
    "Passenger_Count": "CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(event_id * 31 % 12 AS DOUBLE) END",
    "Trip_Distance": "CASE WHEN event_id % 41 = 0 THEN 0e0 ELSE CAST(event_id * 104729 % 1500 AS DOUBLE) / 1e2 END",
    "Start_Lon": ("CASE WHEN event_id % 97 = 0 THEN 0e0 WHEN event_id % 389 = 0 THEN -200e0 "
                  "ELSE -74.05e0 + CAST(event_id * 7907 % 3000 AS DOUBLE) / 1e4 END"),
    "Start_Lat": "CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE 40.60e0 + CAST(event_id * 6101 % 3000 AS DOUBLE) / 1e4 END",
    "End_Lon": "-74.05e0 + CAST(event_id * 5003 % 3000 AS DOUBLE) / 1e4",
    "End_Lat": "40.60e0 + CAST(event_id * 4001 % 3000 AS DOUBLE) / 1e4",
    "Fare_Amt": "value",
    "Total_Amt": "value + 1e0",
}

TRIPS_SQL = "SELECT\n  " + ",\n  ".join(f"{v} AS {k}" for k, v in _TRIP_EXPRS.items()) + "\nFROM events"

# Monthly variant: event times are shifted by ``event_id % 3`` months, so the
# trips spread over three months as if read from three monthly files; ``month``
# (``YYYY-MM``) plays the part of the month in the file name.
MONTHLY_TRIPS_SQL = (
    "SELECT\n  " + ",\n  ".join(f"{v} AS {k}" for k, v in _TRIP_EXPRS.items())
    + ",\n  strftime(ts, '%Y-%m') AS month\n"
    + "FROM (SELECT event_id, ts + to_months(CAST(event_id % 3 AS INTEGER)) AS ts, value FROM events) events"
)


def trips_from_events(events: DataFrame, with_month: bool = False) -> DataFrame:
    cols = [F.expr(v).alias(k) for k, v in _TRIP_EXPRS.items()]
    if with_month:
        cols.append(F.format_string("%04d-%02d", F.year("ts"), F.month("ts")).alias("month"))
    return events.select(*cols)


def monthly_trips_from_events(events: DataFrame) -> DataFrame:
    shifted = events.select(
        "event_id",
        (F.col("ts") + F.expr("make_ym_interval(0, CAST(event_id % 3 AS INT))")).alias("ts"),
        "value")
    return trips_from_events(shifted, with_month=True)


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "value"]))


def load_monthly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_trips_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "value"]))

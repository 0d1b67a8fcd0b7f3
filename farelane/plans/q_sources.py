"""Registered queries: alias-tolerant read and schema findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelane.config import NUMERIC_COLUMNS, REQUIRED_COLUMNS, STRING_COLUMNS
from farelane.plans.common import comparable
from farelane.sources import files
from farelane.sources.tables import TRIPS_SQL, load_trips

Q, SQL = {}, {}

# alias layout of a newer file format, plus a decoy column that must lose
# against the higher-priority variant
_RENAMED = {
    "Trip_Pickup_DateTime": "tpep_pickup_datetime", "Trip_Dropoff_DateTime": "tpep_dropoff_datetime",
    "Passenger_Count": "passenger_count", "Trip_Distance": "trip_distance",
    "Start_Lon": "pickup_longitude", "Start_Lat": "pickup_latitude",
    "End_Lon": "dropoff_longitude", "End_Lat": "dropoff_latitude",
    "Fare_Amt": "fare_amount", "Total_Amt": "total_amount",
}


def alias_read(spark, sf):
    t = load_trips(spark, sf)
    aliased = t.select("trip_id", *[F.col(c).alias(a) for c, a in _RENAMED.items()],
                       F.lit(-1.0).alias("passengers"), F.lit(-1.0).alias("fare"))
    return comparable(files.canonical_columns(aliased, keep_extra=["trip_id"]))


Q["alias_read"] = alias_read
SQL["alias_read"] = f"""WITH trips AS ({TRIPS_SQL})
SELECT trip_id, strftime(Trip_Pickup_DateTime, '%Y-%m-%d %H:%M:%S.%f') AS Trip_Pickup_DateTime,
  strftime(Trip_Dropoff_DateTime, '%Y-%m-%d %H:%M:%S.%f') AS Trip_Dropoff_DateTime,
  {', '.join(f'round({c}, 6) AS {c}' for c in REQUIRED_COLUMNS[2:])}
FROM trips"""


def schema_findings(spark, sf):
    return files.schema_findings(spark, load_trips(spark, sf), source="trips")


def _kind(c):
    return (f"CASE WHEN typeof({c}) IN ('DOUBLE', 'FLOAT', 'BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT', 'HUGEINT') "
            f"OR typeof({c}) LIKE 'DECIMAL%' THEN 'numeric' WHEN typeof({c}) = 'VARCHAR' THEN 'string' "
            f"WHEN typeof({c}) LIKE 'TIMESTAMP%' OR typeof({c}) = 'DATE' THEN 'timestamp' ELSE lower(typeof({c})) END")


Q["schema_findings"] = schema_findings
SQL["schema_findings"] = f"""WITH trips AS ({TRIPS_SQL}),
k AS (SELECT {', '.join(f'min({_kind(c)}) AS t_{c}, count({c}) AS n_{c}' for c in NUMERIC_COLUMNS + STRING_COLUMNS)} FROM trips),
f AS ({' UNION ALL '.join(f"SELECT '{c}' AS column, 'numeric' AS expected, t_{c} AS actual, n_{c} AS values FROM k" for c in NUMERIC_COLUMNS)}
      UNION ALL {' UNION ALL '.join(f"SELECT '{c}', 'string', t_{c}, n_{c} FROM k" for c in STRING_COLUMNS)})
SELECT 'trips' AS source, "column", expected, actual, "values"::BIGINT AS "values", "values" > 0 AS present,
       (actual = expected OR (expected = 'string' AND actual = 'timestamp')) AS type_ok,
       CASE WHEN "values" > 0 AND (actual = expected OR (expected = 'string' AND actual = 'timestamp')) THEN 'ok' ELSE 'warning' END AS status
FROM f"""

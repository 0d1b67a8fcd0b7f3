"""Sinks: split tables, params, metrics, ledger, promotions, routes.

Writes are idempotent per run: stage tables are overwritten whole; tables
shared across versions (metrics, registry, ledger, promotions, params) are
partitioned by ``version`` and written with dynamic partition overwrite, so a
re-run replaces only its own version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split_col: str = "split", sort_col: str | None = None) -> None:
    """One directory per split; optionally range-partitioned and sorted by time
    within each file (no global sort).  The table is the stage's whole output:
    a plain overwrite, whose ``_SUCCESS`` marker tells a resumed job it is complete."""
    out = df
    if sort_col:
        out = out.repartitionByRange(sort_col).sortWithinPartitions(sort_col)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(split_col).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def append_metrics(metrics: DataFrame, path: str, version: str) -> None:
    """Metrics table ``(version, candidate, split, metric, value)``; the run's
    version partition is replaced."""
    write_table(metrics.withColumn("version", F.lit(version)), path, ["version"])


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Version -> months; re-writing a version replaces its months."""
    write_table(ledger.select("version", "month").distinct(), path, ["version"])


def write_promotion(promo: DataFrame, path: str, version: str) -> None:
    write_table(promo.withColumn("version", F.lit(version)).withColumn("recorded_at", F.current_timestamp()),
                path, ["version"])


def write_commit(spark: SparkSession, path: str, version: str, kind: str, final: str, learner: str, sources: list[str]) -> None:
    """The record that makes a version: what it is, when it was made, and the
    files that it was made from."""
    row = spark.createDataFrame([(version, kind, final, learner, sorted(sources))],
                                "version string, kind string, final string, learner string, sources array<string>")
    write_table(row.withColumn("created_at", F.current_timestamp()).coalesce(1), path, ["version"])


def write_routes_csv(routes: DataFrame, path: str, mode: str = "append") -> None:
    """Routes as CSV with header, six decimals."""
    r = routes.withColumns({c: F.round(c, 6) for c in ("route_distance_m", "route_duration_s")})
    r.write.mode(mode).option("header", True).csv(path)

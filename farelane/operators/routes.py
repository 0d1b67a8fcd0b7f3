"""Route enrichment: a routes table keyed by coordinates, filled by a
pluggable provider and joined to trips.

* Only *distinct* coordinate keys not yet in the cache (left anti join) reach
  the provider, spread over partitions, via ``mapInPandas`` (Arrow batches):
  the provider is the one place where an external service is called.
* Each provider call is retried with exponential backoff; keys still failing
  get null routes (a later run retries them, since only non-null routes are
  appended to the cache).
* The cache is a table with parts (by a hash of the key) whose files are
  bucketed by the key.  A part is written whole, by dynamic partition overwrite:
  what it held and what was fetched for it, so a key is in it once, and a run that dies
  goes on at the next part.
* Trips join the routes table with a plain left equi-join on the four
  coordinates (both sides grow with the data); the buckets are the join's
  partitioning, so the cache isn't shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.columns import nan_to_null
from farelane.session import materialize

TRIP_KEYS = ["Start_Lon", "Start_Lat", "End_Lon", "End_Lat"]
ROUTE_KEYS = ["start_lon", "start_lat", "end_lon", "end_lat"]
ROUTES_SCHEMA = ("start_lon double, start_lat double, end_lon double, end_lat double, "
                 "route_distance_m float, route_duration_s float")

#: Columns that say where a row comes from; they may be null.
BOOKKEEPING = ("trip_id", "row_key", "month", "source_file", "split")

Provider = Callable[[pd.DataFrame], pd.DataFrame]


def route_keys(trips: DataFrame) -> DataFrame:
    """Distinct coordinate keys of the trips, named like the routes table."""
    # -0.0 and 0.0 are one key, in every hash
    return trips.select(*[(F.col(t).cast("double") + F.lit(0.0)).alias(r) for t, r in zip(TRIP_KEYS, ROUTE_KEYS)]).distinct()


def key_hash(columns: list[str]):
    """The long that stands for a coordinate key in buckets and joins (doubles
    as join keys are normalised first, which hides a table's buckets)."""
    return F.xxhash64(*[F.col(c).cast("double") + F.lit(0.0) for c in columns])


def _same(left: DataFrame, lefts: list[str], right: DataFrame, rights: list[str]):
    """The coordinates are equal; the hash is the key, this tells the rare
    keys apart that share one."""
    cond = F.lit(True)
    for a, b in zip(lefts, rights):
        x = left[a].cast("double")
        cond = cond & (x >= right[b]) & (x <= right[b])
    return cond


def missing_keys(keys: DataFrame, cache: DataFrame | None) -> DataFrame:
    if cache is None:
        return keys
    k = keys.withColumn("_key", key_hash(ROUTE_KEYS))
    c = cache if "key" in cache.columns else cache.withColumn("key", key_hash(ROUTE_KEYS))
    c = c.select("key", *[F.col(x).alias(f"_c{i}") for i, x in enumerate(ROUTE_KEYS)])
    cond = (k["_key"] == c["key"]) & _same(k, ROUTE_KEYS, c, [f"_c{i}" for i in range(4)])
    return k.join(c, cond, "left_anti").drop("_key")


def with_retry(provider: Provider, retries: int = 6, backoff_s: float = 0.4) -> Provider:
    """Retry a failing provider call ``retries`` times, waiting
    ``backoff_s * 2**attempt``.  A batch that still fails is halved, and its
    halves are tried once each, down to single keys: only the keys that fail on
    their own get null routes."""

    def failed(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[ROUTE_KEYS].copy()
        out["route_distance_m"] = np.nan
        out["route_duration_s"] = np.nan
        return out

    def halves(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) == 1:
            return failed(pdf)
        parts = []
        for part in (pdf.iloc[:len(pdf) // 2], pdf.iloc[len(pdf) // 2:]):
            try:
                parts.append(provider(part))
            except Exception:  # noqa: BLE001 - a part without the bad key succeeds
                parts.append(halves(part))
        return pd.concat(parts)

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        for attempt in range(retries):
            try:
                return provider(pdf)
            except Exception:  # noqa: BLE001 - any provider failure is retried
                if attempt < retries - 1:
                    time.sleep(backoff_s * 2 ** attempt)
        return halves(pdf) if len(pdf) else failed(pdf)

    return call


def fetch_routes(keys: DataFrame, provider: Provider, partitions: int | None = None,
                 retries: int = 6, backoff_s: float = 0.4) -> DataFrame:
    """Run the provider over the keys, batch by batch, in parallel tasks.  The
    frame calls the provider whenever it is evaluated: write it before use."""
    call = with_retry(provider, retries, backoff_s)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                out = call(pdf)
                yield out[ROUTE_KEYS + ["route_distance_m", "route_duration_s"]].astype(
                    {"route_distance_m": "float32", "route_duration_s": "float32"})

    if partitions:
        keys = keys.repartition(partitions, *ROUTE_KEYS)
    out = keys.mapInPandas(run, ROUTES_SCHEMA)
    # a failed lookup comes back as NaN: make it null, so the cache skips it
    # (and a later run retries the key) and the route rules drop the trip
    return out.withColumns({c: nan_to_null(c) for c in ("route_distance_m", "route_duration_s")})


#: Parts that a cache is written in.
PARTS = 16


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _layout(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(buckets, parts) of the cache at ``path``, from its folder's name; None
    only if there is no such path.  Any other error is raised: a storage fault
    must not look like an empty cache."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    for f in fs.listStatus(p):
        if m := re.fullmatch(r"b(\d+)p(\d+)", f.getPath().getName()):
            return int(m[1]), int(m[2])
    return None


def _part(parts: int):
    return F.pmod(key_hash(ROUTE_KEYS), F.lit(parts)).cast("int")


def open_cache(spark: SparkSession, path: str, buckets: int | None = None, parts: int = PARTS) -> tuple[str, int, int]:
    """(table name, buckets, parts) of the cache at ``path``, made if there is
    none.  A cache keeps the buckets that it was made with (default: the
    session's shuffle partitions)."""
    path = path.rstrip("/")
    found = _layout(spark, path)
    buckets, parts = found or (buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), parts)
    at = f"{path}/b{buckets}p{parts}"
    if found is None:
        p, fs = _fs(spark, at)
        fs.mkdirs(p)
    name = f"routes_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ROUTES_SCHEMA}, key long, part int) USING parquet PARTITIONED BY (part) "
              f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{at}'")
    spark.catalog.recoverPartitions(name)           # parts that another session has written
    spark.catalog.refreshTable(name)
    return name, buckets, parts


def read_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """The routes table at ``path``; None if there is none."""
    if _layout(spark, path.rstrip("/")) is None:
        return None
    return spark.table(open_cache(spark, path)[0]).drop("part")


def update_route_cache(spark: SparkSession, trips: DataFrame, provider: Provider, path: str,
                       refresh: bool = False, partitions: int | None = None,
                       chunk_keys: int = 1_000_000, fetch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Fetch routes for keys not in the cache at ``path`` and add them.
    Returns the cache.  ``fetch``: another way from keys to routes than
    ``provider`` (say :func:`farelane.operators.lookups.fetch_routes_async`).

    The missing keys are written by part; each chunk reads the parts that it
    fetches, about ``chunk_keys`` keys, and overwrites just those, so a run that dies
    keeps the finished parts and no key is sent twice.  ``refresh=True``
    fetches all keys of the trips into a table of its own first; its routes then
    replace all others at once."""
    if refresh:
        new = update_route_cache(spark, trips, provider, f"{path.rstrip('/')}_refresh", False, partitions, chunk_keys, fetch)
        name, buckets, parts = open_cache(spark, path)
        _write_parts(new, name, buckets, parts, "static")
        return spark.table(name).drop("part")
    name, buckets, parts = open_cache(spark, path)
    cache = spark.table(name)
    todo = missing_keys(route_keys(trips), cache.drop("part")).withColumn("part", _part(parts))
    todo = materialize(todo, ["part"])
    counts = {r["part"]: r["count"] for r in todo.groupBy("part").count().collect()}
    chunk: list[int] = []
    for i, p in enumerate(sorted(counts)):
        chunk.append(p)
        if i + 1 < len(counts) and sum(counts[c] for c in chunk) + counts[sorted(counts)[i + 1]] <= chunk_keys:
            continue
        keys = todo.filter(F.col("part").isin(chunk)).drop("part")
        got = (fetch(keys) if fetch else fetch_routes(keys, provider, partitions)).withColumn("key", key_hash(ROUTE_KEYS))
        held = spark.table(name).filter(F.col("part").isin(chunk)).drop("part")
        # written before the parts that it is read from are replaced
        both = materialize(got.where(F.col("route_distance_m").isNotNull()).unionByName(held))
        _write_parts(both, name, buckets, parts, "dynamic")
        chunk = []
    return spark.table(name).drop("part")


def _write_parts(routes: DataFrame, name: str, buckets: int, parts: int, mode: str) -> None:
    """Replace the parts that ``routes`` has rows of ("dynamic"), or all."""
    conf, key = routes.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    old = conf.get(key)
    conf.set(key, mode)
    try:
        # a key's rows meet in one bucket: one file a bucket and part
        routes.repartition(buckets, "key").withColumn("part", _part(parts)).write.insertInto(name, overwrite=True)
    finally:
        conf.set(key, old)
    routes.sparkSession.catalog.refreshTable(name)


def route_coverage(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """One row: ``trips``, ``without_route`` and ``kept`` (trips that the route
    filter keeps)."""
    j = join_routes(trips, routes)
    good = F.coalesce((F.col("route_distance_m") > 0) & (F.col("route_duration_s") > 0), F.lit(False))
    return j.agg(F.count(F.lit(1)).alias("trips"), F.count_if(F.col("route_distance_m").isNull()).alias("without_route"),
                 F.count_if(good).alias("kept"))


#: Trips of one key beyond which its route is sent to them: a task joins no
#: more of a key.  There are fewer than trips / HOT_TRIPS such keys.
HOT_TRIPS = 1_000_000


def join_routes(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Left join: trips without a route keep null route columns.  A key that the
    cache holds twice (two runs at once) counts once: a route per key, the
    shortest, so that no trip is multiplied.

    With the bucketed cache only the trips are shuffled.  Its side can't be
    split then, so the trips of a key with more than ``HOT_TRIPS`` meet its
    route by broadcast (one more pass over their coordinates finds such keys; a
    stream has none in a batch)."""
    bucketed = "key" in routes.columns
    r = routes if bucketed else routes.withColumn("key", key_hash(ROUTE_KEYS))
    one = r.groupBy("key", *ROUTE_KEYS).agg(F.min(F.struct("route_distance_m", "route_duration_s")).alias("_r"))
    one = one.select("key", *[F.col(k).alias(f"_c{i}") for i, k in enumerate(ROUTE_KEYS)],
                     F.col("_r.route_distance_m").alias("route_distance_m"), F.col("_r.route_duration_s").alias("route_duration_s"))
    t = trips.withColumn("_key", key_hash(TRIP_KEYS))
    cols = [*trips.columns, "route_distance_m", "route_duration_s"]
    ends = [f"_c{i}" for i in range(4)]

    def joined(left, right):
        return left.join(right, (left["_key"] == right["key"]) & _same(left, TRIP_KEYS, right, ends), "left").select(*cols)

    if not bucketed or trips.isStreaming:           # both sides are shuffled: AQE splits a hot key
        return joined(t, one)
    hot = materialize(t.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_TRIPS).select("_key"))
    if hot.isEmpty():
        return joined(t, one)
    sent = materialize(one.join(F.broadcast(hot), F.col("key") == F.col("_key"), "left_semi"))
    return (joined(t.join(F.broadcast(hot), "_key", "left_semi"), F.broadcast(sent))
            .unionByName(joined(t.join(F.broadcast(hot), "_key", "left_anti"), one)))


def route_filter(df: DataFrame) -> DataFrame:
    """Positive route distance and duration, then drop rows with a null in any
    column but the bookkeeping ones (a file without a month keeps its trips)."""
    data = [c for c in df.columns if c not in BOOKKEEPING]
    return df.filter((F.col("route_distance_m") > 0) & (F.col("route_duration_s") > 0)).na.drop(subset=data)


# ---------------------------------------------------------------------------
# a deterministic provider (stands in for a routing service)
# ---------------------------------------------------------------------------
TAXICAB_SPEED_M_S = 6.5
TAXICAB_OVERHEAD_S = 60.0


def taxicab_provider(pdf: pd.DataFrame) -> pd.DataFrame:
    """Grid ("taxicab") distance on a local equirectangular projection and a
    constant-speed duration; zero distance gives zero duration."""
    k = math.pi / 180.0 * 6371000.0
    lat_mid = np.radians((pdf["start_lat"].to_numpy() + pdf["end_lat"].to_numpy()) / 2.0)
    dy = np.abs(pdf["end_lat"].to_numpy() - pdf["start_lat"].to_numpy()) * k
    dx = np.abs(pdf["end_lon"].to_numpy() - pdf["start_lon"].to_numpy()) * k * np.cos(lat_mid)
    dist = dx + dy
    dur = np.where(dist > 0, dist / TAXICAB_SPEED_M_S + TAXICAB_OVERHEAD_S, 0.0)
    out = pdf[ROUTE_KEYS].copy()
    out["route_distance_m"] = dist
    out["route_duration_s"] = dur
    return out


def taxicab_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> tuple[str, str]:
    """The same provider as SQL expressions (for oracles)."""
    k = repr(math.pi / 180.0 * 6371000.0)
    dist = (f"(abs({lat2} - {lat1}) * {k} + abs({lon2} - {lon1}) * {k} * cos(radians(({lat1} + {lat2}) / 2e0)))")
    dur = f"(CASE WHEN {dist} > 0 THEN {dist} / {TAXICAB_SPEED_M_S!r} + {TAXICAB_OVERHEAD_S!r} ELSE 0e0 END)"
    return dist, dur

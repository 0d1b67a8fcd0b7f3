"""Spark session helpers.

The library never creates its own session inside an operator; jobs and tests
call :func:`get_spark` once.  Settings are the ones a cluster job wants too:
AQE on (coalesce + skew join), UTC session time zone, Arrow for pandas
transfer, UI off.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "farelane",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for jobs, tests and the bench.

    Under ``spark-submit`` (a master is configured) the cluster's own sizing
    is kept: no master, shuffle-partition or memory overrides, AQE coalesces
    and splits partitions at run time.  Without one (tests, bench) it runs
    ``local[$BENCH_CPUS]`` with as many shuffle partitions as cores."""
    external = False
    if master is None:
        if "PYSPARK_GATEWAY_PORT" in os.environ:
            # started by spark-submit: the JVM exists, its conf holds the master
            from pyspark import SparkConf
            conf_master = SparkConf().get("spark.master", "")
            external = bool(conf_master) and not conf_master.startswith("local")
        # an explicit --master for the JVM this process is about to launch
        external = external or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")        # concurrent fits share the cores
    )
    if not external:
        cpus = os.environ.get("BENCH_CPUS", "8")
        builder = (builder.master(master or f"local[{cpus}]")
                   .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
                   .config("spark.driver.memory", "16g"))
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting names a shared, fault-tolerant folder and is used
    as is; a cluster session without one is an error, because a machine-local
    folder would scatter the files over the executors.  Only a local master
    without the setting (tests) gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session exposes no SparkContext
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares") from None
        return d
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        d = tempfile.mkdtemp(prefix="farelane-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_STAGES: list[str] = []


def materialize(df, partition_by=()):
    """Cut the lineage: write ``df`` as a Parquet table under the shared
    checkpoint folder and read it back.  One pass (``Dataset.checkpoint``
    computes its input twice unless cached), columnar on disk, and it survives
    executor loss, unlike local checkpoints.  ``partition_by``: columns whose
    values become folders, so that a reader of some reads only those.  Jobs run in a
    :func:`stage_scope`, which deletes the table when they end."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/farelane-stage-{uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    _STAGES.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def stage_scope(spark):
    """Delete the stage tables that are written inside, when a job ends."""
    before = set(_STAGES)
    try:
        yield
    finally:
        drop_stages(spark, [p for p in _STAGES if p not in before])


def settled(spark, make):
    """``materialize(make())``, without the stage tables that ``make`` wrote on
    the way: for a caller that goes on with the result."""
    before = set(_STAGES)
    out = materialize(make())
    drop_stages(spark, [p for p in _STAGES[:-1] if p not in before])
    return out


def drop_frame(df) -> None:
    """Delete the stage table that ``df`` reads directly, if it is one."""
    mine = {p.split("/")[-1]: p for p in _STAGES}
    found = {mine[d] for f in df.inputFiles() for d in f.split("/") if d in mine}
    drop_stages(df.sparkSession, list(found))


def drop_stages(spark, paths: list[str] | None = None) -> int:
    """Delete stage tables written by :func:`materialize` (all that this
    process wrote, or ``paths``); returns how many went.  Frames that read
    them must not be used afterwards."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for p in list(paths if paths is not None else _STAGES):
        path = jvm.org.apache.hadoop.fs.Path(p)
        gone += bool(path.getFileSystem(conf).delete(path, True))
        if p in _STAGES:
            _STAGES.remove(p)
    return gone

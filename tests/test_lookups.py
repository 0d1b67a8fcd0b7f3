"""Lookups in flight, the bucketed route cache, replayed batches, publishing."""
import asyncio
import time

import pytest
from pyspark.sql import functions as F

from farelane.operators import lookups as L
from farelane.operators import routes as R
from farelane.plans import scoring as SC
from farelane.sources import sinks
from farelane.streaming import scoring_stream as SS


def _keys(n):
    return [(float(i), 0.0, 1.0, 1.0) for i in range(n)]


def _run(keys, provider, **options):
    async def go():
        return [r async for r in L.lookup(keys, provider, **({"in_flight": 5, "per_second": None, "retries": 3, "backoff_s": 0.0} | options))]
    return asyncio.run(go())


def test_open_calls_are_bounded_and_come_as_they_end():
    now = most = 0

    async def slow(key):
        nonlocal now, most
        now += 1
        most = max(most, now)
        await asyncio.sleep(0.2 if key[0] == 0 else 0.01)
        now -= 1
        return key[0], 1.0

    t = time.monotonic()
    got = _run(_keys(60), slow)
    assert most == 5 and len(got) == 60 and {k[0]: v[0] for k, v in got} == {float(i): float(i) for i in range(60)}
    assert got[0][0][0] != 0 and time.monotonic() - t < 60 * 0.01 + 0.2   # the slow first key holds nobody up


def test_rate_and_retries():
    starts = []

    async def flaky(key):
        starts.append((time.monotonic(), key))
        if key[0] == 3 or (key[0] == 4 and sum(k == key for _, k in starts) < 3):
            raise RuntimeError("busy")
        return 1.0, 1.0

    got = dict(_run(_keys(12), flaky, per_second=50))
    assert sum(k[0] == 3 for _, k in starts) == 3 and got[(3.0, 0.0, 1.0, 1.0)][0] != got[(3.0, 0.0, 1.0, 1.0)][0]
    assert got[(4.0, 0.0, 1.0, 1.0)] == (1.0, 1.0) and len(starts) == 12 + 2 + 2
    span = starts[-1][0] - starts[0][0]
    assert span >= (len(starts) - 1) / 50 * 0.95


def test_a_task_run_again_asks_only_for_the_rest(spark, tmp_path):
    """The task dies once half-way; finished keys are in the journal."""
    calls, journal = tmp_path / "calls", L.FolderJournal(str(tmp_path / "journal"))
    calls.mkdir()
    keys = spark.createDataFrame(_keys(40), "start_lon double, start_lat double, end_lon double, end_lat double")

    async def provider(key):
        import uuid
        (calls / f"{int(key[0])}-{uuid.uuid4().hex}").write_text("")
        if key[0] == 25 and len(list(calls.glob("25-*"))) == 1:
            raise SystemExit("the worker dies")
        return 5.0, 6.0

    def fetch():
        return L.fetch_routes_async(keys, provider, 1, in_flight=1, journal=journal, flush=1).collect()
    try:                                            # a local session doesn't try a task again
        got = fetch()
    except Exception:
        got = fetch()
    assert len(got) == 40 and all(r["route_distance_m"] == 5 for r in got)
    sent = [int(f.name.split("-")[0]) for f in calls.iterdir()]
    # the key that killed the worker, and the call that was open with it
    assert sorted(set(sent)) == list(range(40)) and 41 <= len(sent) <= 42


def _trips(spark, n):
    return spark.range(n).select(F.col("id").alias("trip_id"), (F.col("id") / 100 - 74).alias("Start_Lon"), F.lit(40.7).alias("Start_Lat"),
                                 F.lit(-73.9).alias("End_Lon"), F.lit(40.8).alias("End_Lat"))


def test_cache_resumes_at_the_next_part(spark, tmp_path):
    """A run that dies keeps its parts; the next one asks for the rest, once each."""
    path, log = str(tmp_path / "routes"), tmp_path / "calls"
    log.mkdir()

    def dying(pdf):
        import uuid
        if len(list(log.glob("*"))) >= 4 and not (tmp_path / "up").exists():
            raise SystemExit("the run dies")
        (log / uuid.uuid4().hex).write_text("\n".join(map(repr, pdf["start_lon"])))
        return R.taxicab_provider(pdf)

    with pytest.raises(Exception):
        R.update_route_cache(spark, _trips(spark, 60), dying, path, chunk_keys=8, partitions=1)
    kept = R.read_cache(spark, path).count()
    assert 0 < kept < 60
    (tmp_path / "up").write_text("")
    cache = R.update_route_cache(spark, _trips(spark, 60), dying, path, chunk_keys=8, partitions=1)
    sent = [x for f in log.iterdir() for x in f.read_text().split("\n")]
    assert cache.count() == 60 and len(sent) == len(set(sent)) == 60
    # more keys later: held ones stay, each key once
    more = R.update_route_cache(spark, _trips(spark, 90), R.taxicab_provider, path)
    assert more.count() == 90 == more.select(*R.ROUTE_KEYS).distinct().count()
    fresh = R.update_route_cache(spark, _trips(spark, 10), R.taxicab_provider, path, refresh=True)
    assert fresh.count() == 10


def test_join_does_not_shuffle_the_cache(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "routes")
    cache = R.update_route_cache(spark, _trips(spark, 50), R.taxicab_provider, path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        j = R.join_routes(_trips(spark, 70), cache)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert j.filter(F.col("route_distance_m").isNull()).count() == 20
        # a key with many trips meets its route by broadcast, with the same result
        many = _trips(spark, 70).unionByName(_trips(spark, 3).crossJoin(spark.range(9)).drop("id"))
        want = sorted(map(str, R.join_routes(many, cache).collect()))
        monkeypatch.setattr(R, "HOT_TRIPS", 5)
        assert sorted(map(str, R.join_routes(many, cache).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_replayed_batch_writes_each_fare_once(spark, tmp_path, monkeypatch):
    out, log = str(tmp_path / "out"), tmp_path / "calls"
    log.mkdir()

    def counted(pdf):
        import uuid
        (log / uuid.uuid4().hex).write_text(str(len(pdf)))
        return R.taxicab_provider(pdf)

    monkeypatch.setattr(SS, "score", lambda requests, art, model, routes: R.join_routes(requests, routes).select("trip_id", F.col("route_distance_m").alias("fare")))
    req = _trips(spark, 20).withColumns({"Trip_Pickup_DateTime": F.lit("2024-01-01 10:00:00"), "Passenger_Count": F.lit(1.0)})
    batch = SS.batch_writer(out, str(tmp_path / "ck"), {"imputer": {}}, None, counted)
    batch(req.filter("trip_id < 12"), 0)
    batch(req.filter("trip_id < 12"), 0)            # the commit of the batch was lost: it is run again
    batch(req.filter("trip_id >= 8"), 1)            # shares routes with the first
    got = spark.read.parquet(out)
    assert got.count() == 24 and got.groupBy("batch", "trip_id").count().filter("count > 1").count() == 0
    assert sum(int(f.read_text()) for f in log.iterdir()) == 20
    other = SS.batch_writer(out, str(tmp_path / "ck2"), {"imputer": {}}, None, counted)
    other(req.filter("trip_id < 5"), 0)             # another query's batch 0 is another folder
    assert spark.read.parquet(out).count() == 29


def test_nothing_is_published_before_the_record(spark, tmp_path):
    """A job may die after any of its writes: the version before stays in force."""
    root = str(tmp_path)

    def rows(version, final):
        reg = spark.createDataFrame([(version, "gbt_a", "base", f"/m/{version}"), (version, "stacked", "meta", "m"), (version, "final", final, "gbt_a")],
                                    "version string, model_key string, kind string, path string").withColumn("created_at", F.current_timestamp())
        promo = spark.createDataFrame([(final,)], "chosen_on_val string")
        ledger = spark.createDataFrame([(version, "2024-01")], "version string, month string")
        return [lambda: sinks.write_table(reg, f"{root}/registry", ["version"]), lambda: sinks.write_promotion(promo, f"{root}/promotions", version),
                lambda: sinks.write_ledger(ledger, f"{root}/ledger")]

    assert SC.published(spark, root, "registry") is None
    SC.publish(spark, root, "v1", "base", "gbt_a", "gbt_a", ["b", "a"], rows("v1", "gbt_a"))

    def resolved():
        from farelane.operators import selection as SEL
        reg = SC.registry(spark, root)
        got = SEL.scoring_resolution(reg, SC.promotions(spark, root)).orderBy("num").collect()
        return [(r["version"], r["method"]) for r in got], SEL.latest_version(reg).first()["next"]

    before = resolved()
    assert before == ([("v1", "latest")], "v2")

    class Died(Exception):
        pass

    for stop in range(4):
        def die():
            raise Died
        with pytest.raises(Died):
            SC.publish(spark, root, "v2", "ct", "stacked", "gbt_a", [], [*rows("v2", "stacked")[:stop], die])
        assert resolved() == before and SC.published(spark, root, "ledger").count() == 1
    SC.publish(spark, root, "v2", "ct", "stacked", "gbt_a", ["c"], rows("v2", "stacked"))
    assert resolved() == ([("v1", "latest"), ("v2", "stacked")], "v3")
    rec = {r["version"]: r for r in spark.read.parquet(f"{root}/commits").collect()}
    assert rec["v1"]["sources"] == ["a", "b"] and rec["v2"]["final"] == "stacked" and rec["v2"]["created_at"] >= rec["v1"]["created_at"]



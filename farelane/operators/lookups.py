"""Route lookups with many calls in flight.

A routing service answers one key a call, and slowly, so a task keeps a bounded
number of calls open, starts them no faster than its share of a rate that the
service allows, tries each key again on its own, and hands results on in the
order in which they come.  A journal that the workers share keeps finished
keys, so that a task that is run again asks only for the rest."""

from __future__ import annotations

import asyncio
import glob
import json
import os
import time
import uuid
from collections.abc import AsyncIterator, Awaitable, Callable

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.columns import nan_to_null
from farelane.operators.routes import ROUTE_KEYS, ROUTES_SCHEMA

Key = tuple[float, float, float, float]
#: (start_lon, start_lat, end_lon, end_lat) -> (distance in m, duration in s)
AsyncProvider = Callable[[Key], Awaitable[tuple[float, float]]]
NO_ROUTE = (float("nan"), float("nan"))


class FolderJournal:
    """Finished keys of a lookup, in small files in a folder that all workers
    mount.  A file is complete or not there: it is renamed when it is written."""

    def __init__(self, folder: str):
        self.folder = folder
        os.makedirs(folder, exist_ok=True)

    def seen(self, part: int) -> dict[Key, tuple[float, float]]:
        out: dict[Key, tuple[float, float]] = {}
        for name in glob.glob(f"{self.folder}/{part}-*.json"):
            with open(name) as f:
                out.update((tuple(k), tuple(v)) for k, v in json.load(f))
        return out

    def add(self, part: int, rows: list[tuple[Key, tuple[float, float]]]) -> None:
        name = f"{self.folder}/{part}-{uuid.uuid4().hex}"
        with open(f"{name}.tmp", "w") as f:
            json.dump(rows, f)
        os.replace(f"{name}.tmp", f"{name}.json")


async def lookup(keys: list[Key], provider: AsyncProvider, in_flight: int, per_second: float | None, retries: int,
                 backoff_s: float) -> AsyncIterator[tuple[Key, tuple[float, float]]]:
    """(key, route) as they complete; at most ``in_flight`` calls open, at most
    ``per_second`` started a second.  A key that fails ``retries`` times has no
    route; it holds no place while it waits to be tried again."""
    open_calls = asyncio.Semaphore(in_flight)
    turn, next_start = asyncio.Lock(), 0.0

    async def start() -> None:
        nonlocal next_start
        if per_second:
            async with turn:
                wait = next_start - time.monotonic()
                if wait > 0:
                    await asyncio.sleep(wait)
                next_start = max(next_start, time.monotonic()) + 1 / per_second

    async def one(key: Key):
        for attempt in range(retries):
            async with open_calls:
                await start()
                try:
                    return key, tuple(map(float, await provider(key)))
                except Exception:  # noqa: BLE001 - any provider failure is retried
                    pass
            if attempt < retries - 1:
                await asyncio.sleep(backoff_s * 2 ** attempt)
        return key, NO_ROUTE

    waiting: set[asyncio.Task] = set()
    rest = iter(keys)
    while True:
        # no more tasks than a few rounds of calls, however many keys there are
        while len(waiting) < 4 * in_flight and (key := next(rest, None)) is not None:
            waiting.add(asyncio.create_task(one(key)))
        if not waiting:
            return
        done, waiting = await asyncio.wait(waiting, return_when=asyncio.FIRST_COMPLETED)
        for t in done:
            yield t.result()


def fetch_routes_async(keys: DataFrame, provider: AsyncProvider, partitions: int, in_flight: int = 32, per_second: float | None = None,
                       retries: int = 6, backoff_s: float = 0.4, journal: FolderJournal | None = None, flush: int = 64) -> DataFrame:
    """Routes of ``keys`` (distinct; written, so that a task that is run again
    has the same ones): ``partitions`` tasks with up to ``in_flight`` open calls
    each, and ``per_second`` calls a second in all (a task's share counts all
    partitions, so the rate holds however many run at once).  Results that the
    journal holds aren't asked for again; up to ``flush`` results of a task that
    dies are.  A key without a route has nulls.  The frame calls the provider
    whenever it is evaluated: write it before use."""
    rate = per_second / partitions if per_second else None

    def run(batches):
        part = TaskContext.get().partitionId()
        known = journal.seen(part) if journal else {}
        loop = asyncio.new_event_loop()
        try:
            for pdf in batches:
                asked = list(map(tuple, pdf[ROUTE_KEYS].astype(float).to_numpy().tolist()))
                got = [(k, known[k]) for k in asked if k in known]
                calls = lookup([k for k in asked if k not in known], provider, in_flight, rate, retries, backoff_s)
                fresh: list = []
                while (r := loop.run_until_complete(anext(calls, None))) is not None:
                    got.append(r)
                    if r[1][0] == r[1][0]:           # failures are asked for again
                        fresh.append(r)
                    if journal and len(fresh) >= flush:
                        journal.add(part, fresh)
                        fresh = []
                if journal and fresh:
                    journal.add(part, fresh)
                yield pd.DataFrame(np.array([[*k, *v] for k, v in got], np.float64).reshape(-1, 6),
                                   columns=ROUTE_KEYS + ["route_distance_m", "route_duration_s"]).astype(
                    {"route_distance_m": "float32", "route_duration_s": "float32"})
        finally:
            loop.close()

    out = keys.repartition(partitions, *ROUTE_KEYS).mapInPandas(run, ROUTES_SCHEMA)
    return out.withColumns({c: nan_to_null(c) for c in ("route_distance_m", "route_duration_s")})

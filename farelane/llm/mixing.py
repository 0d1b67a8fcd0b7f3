"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of rows.  In the ideal mix all sources that last
are dealt at once, each at the rate of its weight among them; one that runs out
leaves, and the rates of the others are scaled up (the next phase).  A block
owes its slot between the floor of the time its ideal dealing begins and the
ceiling of the time it ends; earliest deadline first over the released blocks
meets every deadline, because the rates add up to one, so at every slot of
every phase each source is less than one block from its exact share.

Weights are not rounded and no cycle is repeated: the times come from
i / weight and (i + 1) / weight and the sums over the sources that have run
out.  All rows are kept.  The row count of each source comes to the driver,
which deals the slots one by one (a block of ``block_rows`` rows each) and
hands them on in parts of ``SLOTS``; each block finds its slot by a join.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import cells_for, fresh, quoted, random_key, ranked, told_apart
from farelane.session import materialize

#: Slots that are dealt, and handed to Spark, at once.
SLOTS = 500_000
#: Sources, and blocks, up to which their table is broadcast (some 50 bytes a row).
BROADCAST_ROWS = 1_000_000


class Ideal:
    """The ideal mix: ``blocks`` (positive) and ``weights`` by source.  Its
    clock runs so that every source that lasts deals its weight in a unit."""

    def __init__(self, blocks: Mapping[int, int], weights: Mapping[int, float]):
        order = sorted(blocks, key=lambda s: blocks[s] / weights[s])
        self.ends = [blocks[s] / weights[s] for s in order]
        self.gone = [0, *np.cumsum([blocks[s] for s in order]).tolist()]
        self.rate = [*np.cumsum([weights[s] for s in reversed(order)])[::-1].tolist(), 0.0]

    def slots(self, clock: float) -> float:
        """Blocks dealt by ``clock``; a whole number if only rounding parts it from one."""
        k = bisect_right(self.ends, clock)
        x = self.gone[k] + self.rate[k] * clock
        near = round(x)
        return float(near) if abs(x - near) <= max(1e-9, 1e-12 * x) else x

    def starts(self) -> list[int]:
        """First slot of each phase."""
        return sorted({0, *(math.ceil(self.slots(e)) for e in set(self.ends))} - {self.gone[-1]})


def dealt(blocks: Mapping[int, int], weights: Mapping[int, float]) -> Iterator[tuple[int, int]]:
    """(source, its block) of each slot.  Ties of deadlines go to the smaller
    source number."""
    blocks = {s: m for s, m in blocks.items() if m > 0}
    ideal = Ideal(blocks, weights)
    waiting = [(0, s, 0) for s in blocks]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []  # (deadline, source, block, release of the next)
    for slot in range(sum(blocks.values())):
        while waiting and (waiting[0][0] <= slot or not ready):
            _, s, i = heapq.heappop(waiting)
            end = ideal.slots((i + 1) / weights[s])
            heapq.heappush(ready, (math.ceil(end), s, i, math.floor(end)))
        _, s, i, release = heapq.heappop(ready)
        yield s, i
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, (release, s, i + 1))


def _schedule(spark: SparkSession, blocks: Mapping[int, int], weights: Mapping[int, float]) -> DataFrame:
    """(t_source, t_block, t_phase, slot_) of every block."""
    schema = "t_source int, t_block long, t_phase int, slot_ long"
    total, deal, parts = sum(blocks.values()), dealt(blocks, weights), []
    starts = np.array(Ideal(blocks, weights).starts())
    for first in range(0, total, SLOTS):
        n = min(SLOTS, total - first)
        got = np.fromiter((x for _ in range(n) for x in next(deal)), np.int64, 2 * n).reshape(n, 2)
        slot = np.arange(first, first + n)
        part = spark.createDataFrame(pd.DataFrame({
            "t_source": got[:, 0].astype(np.int32), "t_block": got[:, 1],
            "t_phase": (np.searchsorted(starts, slot, side="right") - 1).astype(np.int32), "slot_": slot}), schema)
        parts.append(materialize(part) if total > SLOTS else part)
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def mix(df: DataFrame, source: str = "source", weights: Mapping[str | None, float] | None = None, power: float = 0.5,
        block_rows: int = 64, max_sources: int | None = None, seed: int = 23, rows_per_cell: int = 50_000) -> DataFrame:
    """``df`` with ``phase`` (int), ``block`` (long, of the source), ``slot``
    (long, of the schedule), ``block_row`` (int) and ``mix_position`` (long,
    slot x block_rows + block_row: the order of the mix).

    ``weights``: target weight of each source, positive; without it a source
    of n rows weighs n ** power.  Weights count exactly.  Null is a source
    like any other.  A source
    that ``weights`` lacks raises; any number of sources is mixed, unless
    ``max_sources`` is given, which more sources than that raise.
    Every row is kept; rows of a source come in a random order.  Names get
    ``_`` appended if ``df`` has them.  An empty table gives an empty one."""
    spark = df.sparkSession
    key, sid, s2, rank = fresh(df, "key", "source_no", "source_name", "rank")
    phase, block, slot, brow, pos = fresh(df, "phase", "block", "slot", "block_row", "mix_position")
    rows, salt = told_apart(df)
    keyed = rows.withColumn(key, random_key(df, seed, salt))
    found = keyed.groupBy(quoted(source)).agg(F.count(F.lit(1)).alias("n"))
    found = (found if max_sources is None else found.limit(max_sources + 1)).collect()
    if max_sources is not None and len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    counts = dict(sorted(((r[0], r[1]) for r in found), key=lambda x: (x[0] is None, str(x[0]))))
    if weights is None:
        weights = {s: n ** power for s, n in counts.items()}
    if lacking := [s for s in counts if not weights.get(s, 0) > 0]:
        raise ValueError(f"no positive weight for sources {lacking[:5]}")
    names = list(counts)
    blocks = {i: -(-counts[s] // block_rows) for i, s in enumerate(names)}
    slots = _schedule(spark, blocks, {i: float(weights[s]) for i, s in enumerate(names)})
    kind = df.schema[source].dataType
    sources = spark.createDataFrame(list(enumerate(names)), f"{sid} int, {s2} {kind.simpleString()}")
    if len(names) <= BROADCAST_ROWS:
        sources = F.broadcast(sources)
    if sum(blocks.values()) <= BROADCAST_ROWS:
        slots = F.broadcast(slots)
    total = sum(counts.values())
    base = keyed.select(F.struct(*[quoted(c) for c in df.columns]).alias("row_"), quoted(source).alias("source_"), quoted(key).alias("key_"))
    base = (base.join(sources, F.col("source_").eqNullSafe(quoted(s2)))
            .select("row_", "key_", quoted(sid).alias("sid_")))
    done = ranked(base, ["sid_"], "key_", cells_for(total, rows_per_cell), "rank_")
    done = done.withColumns({"b_": F.floor(F.col("rank_") / block_rows), "in_": F.col("rank_") % block_rows})
    # a block has block_rows rows at most, so this join has no hot key
    done = done.join(slots, (F.col("sid_") == F.col("t_source")) & (F.col("b_") == F.col("t_block")))
    return done.select("row_.*", F.col("t_phase").cast("int").alias(phase), F.col("b_").cast("long").alias(block),
                       F.col("slot_").cast("long").alias(slot), F.col("in_").cast("int").alias(brow),
                       (F.col("slot_") * block_rows + F.col("in_")).cast("long").alias(pos))


def in_mix_order(df: DataFrame, **options) -> DataFrame:
    """All rows of ``df``, its columns only, sorted by their place in the mix:
    files written from it are read in that order."""
    mixed = mix(df, **options)
    return mixed.orderBy(quoted(mixed.columns[-1])).select(*[quoted(c) for c in df.columns])

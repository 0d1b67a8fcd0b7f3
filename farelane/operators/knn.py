"""Exact k-nearest-neighbour imputation as a distributed search.

A missing value becomes the mean of the column over the ``k`` rows nearest to
its row among the fit rows that have the column (ties of distance go to the smaller
key).  The distance is the nan-Euclidean one: over the columns that both rows
have, scaled up by (columns / common columns).  A row that shares no column
with any donor gets the column's mean.

For each column with gaps:

1. Donors alike in all other columns are equally near to every row, so only the
   ``k`` smallest keys of a point can count (a partial top-k before the
   shuffle): no point holds more than ``k`` donors, whatever the data.
2. Donors of one pattern (set of present columns) go to the cells of a k-d tree, cut
   at the medians of a bounded sample: crowded regions are split, sparse ones
   stay whole.  The directory holds each cell's exact rows and box; it has
   ``max_cells`` cells and one per pattern at most, whatever the rows.
3. A row's home cell is the one with the nearest box.  Its k-th distance there,
   and the distances within which the directory proves ``k`` donors, bound
   the search.
4. Only cells whose box comes within the bound are visited.  Rows meet a cell in
   blocks, and a cell travels only to the blocks that reach it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions.columns import nan_to_null
from farelane.session import materialize

#: Rows of the sample that places the cuts of a pattern's tree.
SAMPLE = 32_768


@dataclass
class Cells:
    """k-d cuts of one pattern: inner node i has the children 2i + 1 and 2i + 2."""

    axis: list[int]
    cut: list[float]
    first: int                              # number of its first cell

    def of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        axis, cut = np.array(self.axis, np.int64), np.array(self.cut)
        while len(axis) and (inner := at < len(axis)).any():
            i = at[inner]
            at[inner] = 2 * i + 1 + (x[inner, axis[i]] > cut[i])
        return self.first + at - len(axis)


def cut_cells(sample: np.ndarray, axes: list[int], cells: int, first: int) -> Cells:
    """A tree of (about) ``cells`` cells, a power of two, cut at the medians of
    the widest axis."""
    depth = max(0, math.ceil(math.log2(max(1, cells)))) if axes else 0
    parts, axis, cut = [sample], [], []
    for _ in range(depth):
        below = []
        for p in parts:
            spread = [np.ptp(p[:, a]) if len(p) else 0.0 for a in axes]
            a = axes[int(np.argmax(spread))]
            c = float(np.median(p[:, a])) if len(p) else 0.0
            axis.append(a)
            cut.append(c)
            below += [p[p[:, a] <= c], p[p[:, a] > c]]
        parts = below
    return Cells(axis, cut, first)


class Directory:
    """Boxes and row counts of the cells of all patterns."""

    def __init__(self, rows: list, columns: int):
        self.cell = np.array([r["cell"] for r in rows], np.int64)
        self.n = np.array([r["n"] for r in rows], np.int64)
        self.lo = np.array([[np.nan if v is None else v for v in r["lo"]] for r in rows], np.float64).reshape(len(rows), columns)
        self.hi = np.array([[np.nan if v is None else v for v in r["hi"]] for r in rows], np.float64).reshape(len(rows), columns)

    def ranges(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, largest) squared nan-Euclidean distance of each row from
        each cell's box; NaN where they share no column."""
        least = np.zeros((len(x), len(self.n)))
        most, common = least.copy(), least.copy()
        for c in range(x.shape[1]):
            v, lo, hi = x[:, c, None], self.lo[None, :, c], self.hi[None, :, c]
            both = ~(np.isnan(v) | np.isnan(lo))
            near = np.maximum(0.0, np.maximum(lo - v, v - hi))
            far = np.maximum(np.abs(v - lo), np.abs(v - hi))
            least += np.where(both, near * near, 0.0)
            most += np.where(both, far * far, 0.0)
            common += both
        with np.errstate(divide="ignore"):
            scale = np.where(common > 0, (x.shape[1] + 1) / common, np.nan)
        return least * scale, most * scale

    def bound(self, most: np.ndarray, k: int) -> float:
        """Squared distance within which ``k`` donors lie for sure."""
        order = np.argsort(most, kind="stable")  # NaN last
        held = np.cumsum(np.where(np.isnan(most[order]), 0, self.n[order]))
        at = int(np.searchsorted(held, k))
        return float(most[order[at]]) if at < len(held) else math.inf


#: For rounding: a box distance may exceed a donor's own by some ulps.
ROOM = 1 + 1e-12


def _reach(d: Directory, k: int):
    @F.pandas_udf("struct<home:long,bound:double,cells:array<long>,near:array<double>>")
    def reach(xs: pd.Series) -> pd.DataFrame:
        out = []
        step = max(1, 4_000_000 // max(1, len(d.n)))
        x = np.array([[np.nan if v is None else v for v in r] for r in xs], np.float64)
        for i in range(0, len(x), step):
            least, most = d.ranges(x[i:i + step])
            for lo, hi in zip(least, most):
                if np.isnan(lo).all():
                    out.append((None, None, [], []))
                    continue
                bound = d.bound(hi, k)
                ok = np.flatnonzero(lo <= bound * ROOM)  # NaN is never within
                ok = ok[np.argsort(lo[ok], kind="stable")]
                out.append((int(d.cell[ok[0]]), bound, d.cell[ok].tolist(), lo[ok].tolist()))
        return pd.DataFrame(out, columns=["home", "bound", "cells", "near"])
    return reach


def nearest(x: np.ndarray, donors: np.ndarray, keys: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row of ``x``: (donors, squared distances) of its ``k`` nearest."""
    d2 = np.zeros((len(x), len(donors)))
    common = np.zeros(d2.shape)
    for c in range(x.shape[1]):                     # column by column, as SQL adds them up
        diff = x[:, c, None] - donors[None, :, c]
        both = ~np.isnan(diff)
        d2 += np.where(both, diff * diff, 0.0)
        common += both
    with np.errstate(divide="ignore", invalid="ignore"):
        d2 = np.where(common > 0, d2 * ((x.shape[1] + 1) / common), np.inf)
    out = []
    for row in d2:
        cand = np.flatnonzero(row <= np.partition(row, k - 1)[k - 1]) if len(row) > k else np.arange(len(row))
        cand = cand[np.isfinite(row[cand])]
        cand = cand[np.lexsort((keys[cand], row[cand]))[:k]]
        out.append((cand, row[cand]))
    return out


def _matrix(points) -> np.ndarray:
    return np.array([[np.nan if v is None else v for v in p] for p in points], np.float64)


def _visit(k: int, step: int = 512):
    def run(donors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(donors) and len(rows):
            y, keys, value = _matrix(donors["x"]), donors["key"].to_numpy(), donors["value"].to_numpy()
            x, rid = _matrix(rows["x"]), rows["rid"].to_numpy()
            for i in range(0, len(x), step):
                for r, (at, d2) in zip(rid[i:i + step], nearest(x[i:i + step], y, keys, k)):
                    out += zip([r] * len(at), d2.tolist(), keys[at].tolist(), value[at].tolist())
        return pd.DataFrame(out, columns=["rid", "d2", "key", "value"])
    return run


def _search(cells: DataFrame, asked: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The ``k`` nearest donors of each (row, cell) of ``asked`` (rid, x, cell)."""
    asked = materialize(asked)
    blocks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    blocks = materialize(blocks)                    # a row per cell: bounded by the directory
    rows = asked.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    sent = cells.join(F.broadcast(blocks), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (sent.select("cell", "block", "x", "key", "value").groupBy("cell", "block")
            .cogroup(rows.select("cell", "block", "rid", "x").groupBy("cell", "block"))
            .applyInPandas(_visit(k), f"rid long, d2 double, key {cells.schema['key'].dataType.simpleString()}, value double"))


def _impute_one(rows: DataFrame, fit: DataFrame, columns: list[str], target: str, key: str, k: int, cell_rows: int,
                max_cells: int, block_rows: int) -> DataFrame:
    """(rid, value) of the rows that lack ``target``."""
    others = [c for c in columns if c != target]
    point = F.array(*[F.col(c) for c in others]).cast("array<double>")
    lacking = materialize(rows.filter(F.col(target).isNull()).select("rid", point.alias("x")))
    have = fit.filter(F.col(target).isNotNull())
    mean = have.agg(F.avg(target)).first()[0]
    if not others:
        return lacking.select("rid", F.lit(mean).cast("double").alias("value"))
    pattern = sum((F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(others)), F.lit(0))
    first = F.row_number().over(Window.partitionBy(*others).orderBy(key))
    donors = materialize(have.withColumn("_r", first).filter(F.col("_r") <= k).select(
        F.col(key).alias("key"), point.alias("x"), F.col(target).alias("value"), pattern.alias("pattern")))
    sizes = {r["pattern"]: r["n"] for r in donors.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes.pop(0, None)                              # no column but the target: never a common one
    total, trees, used = sum(sizes.values()), {}, 0
    for p, n in sorted(sizes.items()):
        want = min(math.ceil(n / cell_rows), max(1, max_cells * n // max(1, total)))
        axes = [i for i in range(len(others)) if p >> i & 1]
        some = []
        if want > 1:
            some = donors.filter(F.col("pattern") == p).orderBy(F.xxhash64(F.lit(9), "x")).limit(SAMPLE).select("x").collect()
        trees[p] = cut_cells(_matrix([r["x"] for r in some]) if some else np.empty((0, len(others))), axes, want if some else 1, used)
        used += len(trees[p].axis) + 1

    @F.pandas_udf("long")
    def cell(ps: pd.Series, xs: pd.Series) -> pd.Series:
        out, p, x = np.zeros(len(xs), np.int64), ps.to_numpy(), _matrix(xs)
        for v in np.unique(p):
            out[p == v] = trees[int(v)].of(x[p == v])
        return pd.Series(out)

    cells = materialize(donors.filter(F.col("pattern") != 0).select("key", "x", "value", cell("pattern", "x").alias("cell")))
    box = [f(F.get("x", F.lit(i))) for f in (F.min, F.max) for i in range(len(others))]
    directory = Directory(cells.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.array(*box[:len(others)]).alias("lo"), F.array(*box[len(others):]).alias("hi")).collect(), len(others))
    placed = materialize(lacking.withColumn("r", _reach(directory, k)("x")).select("rid", "x", "r.*"))
    at_home = materialize(_search(cells, placed.filter(F.col("home").isNotNull()).select("rid", "x", F.col("home").alias("cell")), k, block_rows))
    kth = at_home.groupBy("rid").agg(F.max("d2").alias("kth"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
    away = (placed.join(kth, "rid", "left")
            .withColumn("bound", F.least("bound", F.coalesce("kth", F.lit(math.inf))) * F.lit(ROOM))
            .select("rid", "x", "home", "bound", F.inline(F.arrays_zip("cells", "near")))
            .filter((F.col("near") <= F.col("bound")) & (F.col("cells") != F.col("home")))
            .select("rid", "x", F.col("cells").alias("cell")))
    found = at_home.unionByName(_search(cells, away, k, block_rows))
    best = F.row_number().over(Window.partitionBy("rid").orderBy("d2", "key"))
    means = found.withColumn("_r", best).filter(F.col("_r") <= k).groupBy("rid").agg(F.avg("value").alias("value"))
    return lacking.select("rid").join(means, "rid", "left").select("rid", F.coalesce("value", F.lit(mean).cast("double")).alias("value"))


def knn_impute(df: DataFrame, columns: list[str], key: str, fit: DataFrame | None = None, k: int = 5, cell_rows: int = 4096,
               max_cells: int = 16_384, block_rows: int = 4096) -> DataFrame:
    """``df`` with the nulls and NaNs of ``columns`` imputed from the rows of
    ``fit`` (default: ``df``), all other columns untouched.

    Distances see the rows as they came, not values imputed before.  A column
    without any value in ``fit`` stays null.  Fewer than ``k`` donors that
    share a column: the mean of those there are; none: the column's mean.
    ``key`` orders ties; rows of ``fit`` that repeat a key count each, nulls
    come first.  Results are doubles.  An empty table stays empty."""
    clean = {c: nan_to_null(F.col(c).cast("double")) for c in columns}
    source = df if fit is None else fit
    fit = materialize(source.select(key, *[e.alias(c) for c, e in clean.items()]))
    lacks = F.lit(False)
    for c in columns:
        lacks = lacks | clean[c].isNull()
    whole = df.filter(~lacks).withColumns(clean)
    # numbered once written: the numbers hang on the tasks that make them
    rows = materialize(df.filter(lacks).withColumns(clean).withColumn("rid", F.monotonically_increasing_id()))
    gaps = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    points = rows.select("rid", *columns)
    for c in columns:
        if gaps[c]:
            got = _impute_one(points, fit, columns, c, key, k, cell_rows, max_cells, block_rows)
            rows = rows.join(got.withColumnRenamed("value", "_v"), "rid", "left").withColumn(c, F.coalesce(c, "_v")).drop("_v")
    return whole.unionByName(rows.drop("rid"))

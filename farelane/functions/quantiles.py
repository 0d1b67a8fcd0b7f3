"""Exact quantiles (linear interpolation between order statistics, the
``quantile_cont`` / NumPy default) that stay bounded at any table size.

Spark's exact ``percentile`` keeps every distinct value of a group in one
task's buffer, which does not survive a trips-sized group.  Here

1. one wide pass of ``percentile_approx`` puts a bracket around each (column,
   probability);
2. a second pass counts, map-side, the rows between the brackets (one row per
   gap) and the rows inside them by value: a value that a million rows share is
   one row from then on, and what is shuffled is a thousandth of the rows for
   each probability;
3. the counts get their running sums by range partitions
   (:mod:`farelane.functions.ranges`), so no task holds a key;
4. the row whose running sum covers a target rank holds the order statistic,
   and it or the next value holds the one after.  A rank that fell between the
   brackets widens them, in the end to all values, so the sketch decides what
   is shuffled, never the result.

Groups under ``WHOLE`` rows have all their values in the bracket.
Output: ``(*group_cols, column, p, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.columns import nan_to_null
from farelane.functions.ranges import running_counts
from farelane.session import materialize

#: Error of the sketch's ranks is 1 / ACCURACY of the rows, a bracket reaches HALF of them to both sides.
ACCURACY = 10_000
HALF = 5e-4
#: Rows under which the bracket is the whole group.
WHOLE = 10_000
#: Bounds of brackets (16 bytes each) up to which their table is broadcast.
BROADCAST_BOUNDS = 1_000_000


def _melt(df: DataFrame, columns: list[str], group_cols: list[str]) -> DataFrame:
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
    long = df.select(*group_cols, F.inline(F.array(*items)))
    return long.filter(F.col("x").isNotNull() & ~F.isnan("x"))


def value_counts(df: DataFrame, columns: list[str], group_cols: list[str]) -> DataFrame:
    """``(*group_cols, column, x, n)``: rows per distinct value."""
    return _melt(df, columns, group_cols).groupBy(*group_cols, "column", "x").agg(F.count(F.lit(1)).alias("n"))


def brackets(df: DataFrame, columns: list[str], probs: list[float], group_cols: list[str], half: float = HALF,
             accuracy: int = ACCURACY) -> DataFrame:
    """``(*group_cols, column, los, his)``: for each of the (sorted)
    probabilities the bounds that should hold its order statistics."""
    asked = [min(max(p + side, 0.0), 1.0) for side in (-half, half) for p in probs]
    sketch, k = [], len(probs)
    for i, c in enumerate(columns):
        x = nan_to_null(F.col(c).cast("double"))
        sketch += [F.percentile_approx(x, asked, accuracy).alias(f"_q{i}"), F.count(x).alias(f"_n{i}")]
    wide = df.groupBy(*group_cols).agg(*sketch) if group_cols else df.agg(*sketch)

    def bounds(i, side, open_end):
        return F.array(*[F.when(F.col(f"_n{i}") < WHOLE, F.lit(open_end)).otherwise(
            F.lit(open_end) if not 0 < p + side < 1 else F.get(f"_q{i}", F.lit(j + (k if side > 0 else 0))))
            for j, p in enumerate(probs)])

    items = [F.struct(F.lit(c).alias("column"), bounds(i, -half, float("-inf")).alias("los"),
                      bounds(i, half, float("inf")).alias("his")) for i, c in enumerate(columns)]
    return wide.select(*group_cols, F.inline(F.array(*items)))


def bracket_counts(df: DataFrame, columns: list[str], bounds: DataFrame, n_probs: int, group_cols: list[str]) -> DataFrame:
    """``(*group_cols, column, x, n, outside)``: rows per distinct value inside
    a bracket, and one row per gap between brackets (``outside``) with its
    smallest value."""
    names = [f"_b{i}" for i in range(len(group_cols))]
    bounds = bounds.select(*[F.col(g).alias(b) for g, b in zip(group_cols, names)], F.col("column").alias("_bc"), "los", "his")
    on = F.col("column") == F.col("_bc")
    for g, b in zip(group_cols, names):
        on = on & F.col(g).eqNullSafe(F.col(b))
    rows = _melt(df, columns, group_cols).join(bounds, on)
    # lower and upper bounds both rise, so the first bracket that ends at or
    # after a value is the only one that needs a look
    gap = sum((F.when(F.get("his", F.lit(j)) < F.col("x"), 1).otherwise(0) for j in range(n_probs)), F.lit(0))
    rows = rows.withColumn("_gap", gap)
    inside = F.coalesce(F.get("los", F.col("_gap")) <= F.col("x"), F.lit(False))
    rows = rows.select(*group_cols, "column", "_gap", "x", F.when(inside, F.col("x")).alias("_v"))
    counts = rows.groupBy(*group_cols, "column", "_gap", "_v").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"))
    return counts.select(*group_cols, "column", "x", "n", F.col("_v").isNull().alias("outside"))


def quantiles(df: DataFrame, columns, probs, group_cols=(), accuracy: int = ACCURACY) -> DataFrame:
    columns = [columns] if isinstance(columns, str) else list(columns)
    group_cols = list(group_cols)
    keys = group_cols + ["column"]
    probs = sorted({float(p) for p in probs})

    def pos(p):
        return p * (F.col("total_n") - 1)

    # the probabilities whose lower order statistic is this value
    here = F.filter(F.array(*[F.lit(p) for p in probs]),
                    lambda p: (F.floor(pos(p)) >= F.col("before_n")) & (F.floor(pos(p)) < F.col("before_n") + F.col("n")))
    half, found = HALF, False
    while not found:
        bounds = brackets(df, columns, probs, group_cols, half, accuracy)
        if group_cols:  # written, so that its size is known before it is broadcast
            bounds = materialize(bounds)
        if not group_cols or bounds.count() * len(probs) <= BROADCAST_BOUNDS:
            bounds = F.broadcast(bounds)
        run = running_counts(bracket_counts(df, columns, bounds, len(probs), group_cols), keys, "x", ["n"])
        hit = run.withColumn("p", F.explode(here)).withColumn("_lo", F.floor(pos(F.col("p"))))
        above = F.when((F.col("_lo") + 1 < F.col("before_n") + F.col("n")) | (F.col("_lo") + 1 >= F.col("total_n")), F.col("x")) \
            .otherwise(F.col("next_value"))
        # a rank without a value would be a defect of the running sums: fail loudly
        above = F.coalesce(above, F.raise_error(F.lit("quantile rank without a value")).cast("double"))
        # one row per key and probability, written: callers read it more than once
        out = materialize(hit.select(*keys, "p", (F.col("x") + (pos(F.col("p")) - F.col("_lo")) * (above - F.col("x"))).alias("value"),
                                     (F.col("outside") & (F.col("n") > 1)).alias("_missed")))
        found = half >= 1 or out.filter("_missed").isEmpty()
        half *= 8
    return out.drop("_missed")


def quantile_value(df: DataFrame, column: str, p: float) -> float | None:
    """Single exact quantile, brought to the driver (one number)."""
    r = quantiles(df, [column], [p]).collect()
    return r[0]["value"] if r else None

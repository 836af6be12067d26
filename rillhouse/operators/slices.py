"""Time slices: ordered per-key work whose keys may be arbitrarily hot.

Ordering all rows of one device in one window puts a hot device into one task. The questions
asked here only need a short stretch of its history, so rows are partitioned by
(device, time slice). A slice never crosses midnight of the session zone. Where a row must be
seen from the slice before it, a copy stripped to its order columns goes there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rillhouse.functions.times import DAY_MS

SHORTEST_MS = 60_000
# Copies are about 1/SPREAD of the rows when a slice is SPREAD times the horizon.
SPREAD = 30


def default_width(horizon_ms: int = 0) -> int:
    return max(horizon_ms, min(DAY_MS, max(SHORTEST_MS, SPREAD * horizon_ms)))


def slice_start(ms: Column, width_ms: int) -> Column:
    """Start of the slice holding `ms`, as epoch milliseconds."""
    midnight = F.unix_millis(F.date_trunc("DAY", F.timestamp_millis(ms)))
    return ms - (ms - midnight) % F.lit(width_ms)


def add_slice(df: DataFrame, width_ms: int, ts: str = "ts") -> DataFrame:
    return df.withColumn("slice", slice_start(F.col(ts), width_ms))


def add_slice_with_reach(
    df: DataFrame, horizon_ms: int, width_ms: int, ts: str = "ts"
) -> DataFrame:
    """Add `slice` and `own`; rows are copied (`own` false) to every slice that ends less than
    `horizon_ms` before them.

    The last slice of a day may be shorter than the horizon (odd widths, clock changes), so up
    to three slices are considered.
    """
    if width_ms < horizon_ms:
        raise ValueError("a slice must be at least as long as the horizon")
    t, home = F.col(ts), F.col("_home")
    near = t - home < F.lit(horizon_ms)
    targets = F.array(
        home,
        F.when(near, slice_start(home - 1, width_ms)),
        F.when(near, slice_start(t - F.lit(horizon_ms - 1), width_ms)),
    )
    spread = F.explode(F.array_distinct(F.array_compact(targets)))
    placed = df.withColumn("_home", slice_start(t, width_ms)).withColumn("slice", spread)
    return placed.withColumn("own", F.col("slice") == home).drop("_home")


def slice_order(key: str = "mid", ts: str = "ts", seq: str = "seq") -> WindowSpec:
    return Window.partitionBy(key, "slice").orderBy(ts, seq)


def nth_in_slice(condition: Column, order: WindowSpec) -> Column:
    """Running count of rows meeting `condition`, the current row included."""
    frame = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(F.when(condition, 1).otherwise(0)).over(frame)

"""Interval joins and dimension lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(et: Column, width_ms: int) -> Column:
    ms = F.unix_millis(et)
    return ms - F.pmod(ms, F.lit(width_ms))


def _seconds(ms: int) -> str:
    return f"INTERVAL '{ms / 1000:.3f}' SECOND"


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    lower_ms: int,
    upper_ms: int,
) -> DataFrame:
    """Pairs with equal keys and `right_time` in `[left_time + lower, left_time + upper]`.

    Both sides also carry a time bucket as wide as the interval: a left row goes to the one or
    two buckets its interval touches, a right row to its own, so each pair meets once. Under a
    hot key only rows near in time are compared, and the key spreads over its buckets. Works
    on batches and on watermarked streams; the range condition bounds the stream state.
    Give the smaller side as `left`. Column names of the sides must differ.
    """
    if upper_ms < lower_ms:
        raise ValueError("the interval is empty")
    width = max(upper_ms - lower_ms, 1000)
    at = F.col(left_time)
    reach = F.sequence(
        _bucket(at + F.expr(_seconds(lower_ms)), width),
        _bucket(at + F.expr(_seconds(upper_ms)), width),
        F.lit(width),
    )
    near = left.where(at.isNotNull()).withColumn("_left_bucket", F.explode(reach))
    placed = right.withColumn("_right_bucket", _bucket(F.col(right_time), width))
    met = near.join(
        placed,
        F.expr(
            f"{left_key} = {right_key} AND _left_bucket = _right_bucket "
            f"AND {right_time} >= {left_time} + {_seconds(lower_ms)} "
            f"AND {right_time} <= {left_time} + {_seconds(upper_ms)}"
        ),
        "inner",
    )
    return met.drop("_left_bucket", "_right_bucket")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: Column,
    take: dict[str, Column],
    dim_key: str = "ID",
    row_id: str | None = None,
) -> DataFrame:
    """Add or replace columns from the current dimension row of `key`.

    `dim` holds one row per key. A missing row leaves a new column null and an existing column
    as it was. How to join is left to the planner, which knows the table's size: a dimension
    under the broadcast limit is broadcast, a larger one is shuffled, hot keys split at run
    time. Rows without a key would all hash alike, so they get scattered keys that match
    nothing, drawn from `row_id` or, without one, from the whole row.
    """
    drawn = F.xxhash64(F.col(row_id) if row_id else F.struct("*"))
    scattered = F.concat(F.lit("\u0000"), F.pmod(drawn, F.lit(1009)).cast("string"))
    keyed = df.withColumn("_key", F.coalesce(key.cast("string"), scattered))
    side = dim.select(
        F.col(dim_key).alias("_dim_key"), *(c.alias(f"_take_{n}") for n, c in take.items())
    )
    joined = keyed.join(side, F.col("_key") == F.col("_dim_key"), "left")
    hit = F.col("_dim_key").isNotNull()
    have = set(df.columns)
    taken = {
        n: F.when(hit, F.col(f"_take_{n}")).otherwise(F.col(n)) if n in have else F.col(f"_take_{n}")
        for n in take
    }
    return joined.withColumns(taken).drop("_key", "_dim_key", *(f"_take_{n}" for n in take))


def point_lookup(dim: DataFrame, key: str, dim_key: str = "ID") -> DataFrame:
    """The rows of one key; the filter reaches the scan."""
    return dim.where(F.col(dim_key) == F.lit(key))

"""Batch runs that store every layer as a table, so that each is computed once.

Later layers read the stored one with the columns they need; a lost executor costs a re-read,
not a recomputation from the raw lines. Tables are Parquet, split by day where rows have one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions.times import day_of
from rillhouse.operators import logs, orders, stats, visitors
from rillhouse.plans import warehouse


def store(df: DataFrame, path: str, *split_by: str) -> DataFrame:
    """Write a table and read it back.

    Rebalancing before the write gives files of even size: small pieces of a day are put
    together and a day with much of the data is cut into several files.
    """
    writer = df.hint("rebalance", *split_by) if split_by else df
    writer = writer.write.mode("overwrite")
    (writer.partitionBy(*split_by) if split_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_log_layers(
    lines: DataFrame,
    base: str,
    window: str = stats.WINDOW,
    horizon_ms: int = visitors.BOUNCE_HORIZON_MS,
) -> DataFrame:
    """Raw log lines to all behaviour layers under `base`; returns the stored statistics."""
    store(logs.dirty_lines(lines), f"{base}/{schemas.DWD_DIRTY}")
    fixed = warehouse.corrected_records(lines)
    dated = fixed.withColumn("dt", day_of(F.col("ts"))).withColumn(
        "kind", F.when(logs.is_start(), "start").otherwise("page")
    )
    records = store(dated, f"{base}/dwd_records", "dt", "kind")
    pages = records.where(F.col("kind") == "page")
    shown = logs.display_logs(pages, "seq", "ts", "dt").select(
        "seq", "ts", "display", "dt"
    )
    store(shown, f"{base}/{schemas.DWD_DISPLAY}", "dt")
    plain = pages.drop("dt", "kind")
    visits = store(visitors.first_visits(plain), f"{base}/{schemas.DWM_VISIT}", "dt")
    jumped = visitors.bounces(plain, horizon_ms).withColumn("dt", day_of(F.col("ts")))
    jumps = store(jumped, f"{base}/{schemas.DWM_JUMP}", "dt")
    shaped = stats.union_shaped(visits, jumps, plain)
    return store(stats.window_stats(shaped, window), f"{base}/{schemas.DWS_VISITOR}")


def build_order_layers(
    order_info: DataFrame,
    order_detail: DataFrame,
    payment_info: DataFrame,
    dims: dict[str, DataFrame],
    base: str,
    lower_ms: int = orders.ORDER_LOWER_MS,
    upper_ms: int = orders.ORDER_UPPER_MS,
    as_of_ms: Column | None = None,
) -> DataFrame:
    """Orders, details and payments to the two wide tables; returns the stored payments."""
    wide = warehouse.order_wide(order_info, order_detail, dims, lower_ms, upper_ms, as_of_ms)
    stored = store(wide, f"{base}/{schemas.DWM_ORDER_WIDE}", "create_date")
    paid = warehouse.payment_wide(payment_info, stored)
    return store(paid, f"{base}/{schemas.DWM_PAYMENT_WIDE}")


def topic_lines(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """A stored record layer as JSON lines, for consumers that want text."""
    records = spark.read.parquet(f"{base}/dwd_records").where(F.col("kind") == kind)
    return records.select(logs.record_line(F.col("raw_is_new")).alias("value"), "seq")

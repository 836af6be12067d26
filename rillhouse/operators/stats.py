"""Windowed visitor statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions.times import format_instant
from rillhouse.operators.logs import is_entry

WINDOW = "10 seconds"
DIMENSIONS = ("ar", "ch", "is_new", "vc")
MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def _shape(df: DataFrame, **measures: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    cells = (measures.get(m, zero).cast("bigint").alias(m) for m in MEASURES)
    return df.select(*DIMENSIONS, *cells, "ts")


def shape_visits(visits: DataFrame) -> DataFrame:
    return _shape(visits, uv_ct=F.lit(1))


def shape_bounces(jumps: DataFrame) -> DataFrame:
    return _shape(jumps, uj_ct=F.lit(1))


def shape_pages(pages: DataFrame) -> DataFrame:
    return _shape(
        pages,
        pv_ct=F.lit(1),
        sv_ct=F.when(is_entry(), 1).otherwise(0),
        dur_sum=F.coalesce(F.col("during_time"), F.lit(0)),
    )


def shape_flagged(flagged: DataFrame) -> DataFrame:
    """All measures of a page row at once, from `visitors.visit_flags`.

    A visit or bounce row has the dimensions and time of its own page row, so adding the
    measures per page gives the sums the three-way union gives, without the copies.
    """
    return _shape(
        flagged,
        uv_ct=F.when(F.col("is_visit"), 1).otherwise(0),
        pv_ct=F.lit(1),
        sv_ct=F.when(is_entry(), 1).otherwise(0),
        uj_ct=F.when(F.col("is_bounce"), 1).otherwise(0),
        dur_sum=F.coalesce(F.col("during_time"), F.lit(0)),
    )


def union_shaped(visits: DataFrame, jumps: DataFrame, pages: DataFrame) -> DataFrame:
    return (
        shape_visits(visits)
        .unionByName(shape_bounces(jumps))
        .unionByName(shape_pages(pages))
    )


def timed(shaped: DataFrame, delay: str | None = None) -> DataFrame:
    """The event time `et` beside a shaped row, with a watermark in a stream."""
    rows = shaped.withColumn("et", F.timestamp_millis("ts"))
    return rows if delay is None else rows.withWatermark("et", delay)


def window_stats(shaped: DataFrame, window: str = WINDOW, delay: str | None = None) -> DataFrame:
    """Sum the measures per tumbling window and dimensions, in the result table's layout.

    `delay` sets the watermark of a stream and is left out for a batch, and for rows that are
    `timed` already. `ts` is the earliest event time of the group.
    """
    rows = shaped if "et" in shaped.columns else timed(shaped, delay)
    summed = rows.groupBy(F.window("et", window).alias("w"), *DIMENSIONS).agg(
        *(F.sum(m).alias(m) for m in MEASURES), F.min("ts").alias("ts")
    )
    bounds = (format_instant(F.col("w.start")).alias("stt"), format_instant(F.col("w.end")).alias("edt"))
    return summed.select(*bounds, *DIMENSIONS, *MEASURES, "ts").select(
        *schemas.VISITOR_STATS.fieldNames()
    )

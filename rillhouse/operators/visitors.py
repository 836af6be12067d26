"""Visitor state: new-visitor correction, first visit of the day, bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.functions.times import day_of
from rillhouse.operators import slices
from rillhouse.operators.logs import entry_pages, is_entry, is_start

BOUNCE_HORIZON_MS = 10_000
FOLLOWED, TIMED_OUT = "followed", "timed out"


def _claims_new() -> Column:
    return F.col("is_new").eqNullSafe("1")


def fix_new_visitors(records: DataFrame, slice_ms: int | None = None) -> DataFrame:
    """Keep `is_new = '1'` only on a device's first such record by `(ts, seq)`; later ones
    become '0'. Other flags are neither read nor changed. The flag as it came stays in
    `raw_is_new`.

    The first slice in which a device claims to be new comes from a partial aggregate, one
    small row per device and task. Only inside that slice does the order of rows matter.
    The summary joins on the partitioning the slice window already has, so the wide rows
    are shuffled once and no task holds a whole device.
    """
    width = slice_ms or slices.default_width(BOUNCE_HORIZON_MS)
    sliced = slices.add_slice(records, width)
    first = (
        sliced.where(_claims_new())
        .groupBy("mid")
        .agg(F.min("slice").alias("slice"))
        .withColumn("first_slice", F.lit(True))
    )
    ranked = sliced.withColumn("_nth", slices.nth_in_slice(_claims_new(), slices.slice_order()))
    joined = ranked.join(first, ["mid", "slice"], "left")
    keeps = F.col("first_slice").isNotNull() & (F.col("_nth") == 1)
    fixed = F.when(_claims_new() & ~keeps, "0").otherwise(F.col("is_new"))
    others = [c for c in records.columns if c != "is_new"]
    return joined.select(*others, F.col("is_new").alias("raw_is_new"), fixed.alias("is_new"))


def first_visits(pages: DataFrame) -> DataFrame:
    """The first entry page of each device and day by `(ts, seq)`.

    Keeping rank 1 lets Spark drop all but one row per group inside each map task, before the
    shuffle, however many rows the group has.
    """
    entries = entry_pages(pages).withColumn("dt", day_of(F.col("ts")))
    order = Window.partitionBy("mid", "dt").orderBy("ts", "seq")
    ranked = entries.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def bounces(
    pages: DataFrame,
    horizon_ms: int = BOUNCE_HORIZON_MS,
    inclusive: bool = False,
    slice_ms: int | None = None,
    with_kind: bool = False,
) -> DataFrame:
    """Entry pages that led nowhere: the device's next page is an entry page too, or does not
    come within the horizon.

    A page exactly at the horizon counts as not within it, unless `inclusive`. Rows that
    cannot be emitted travel without their payload. `with_kind` adds which of the two it was.
    """
    within = horizon_ms + 1 if inclusive else horizon_ms
    width = slice_ms or slices.default_width(within)
    marked = slices.add_slice_with_reach(
        pages.withColumn("_entry", is_entry()), within, width
    )
    emits = F.col("own") & F.col("_entry")
    order_columns = ("mid", "ts", "seq")
    payload = [
        c if c in order_columns else F.when(emits, F.col(c)).alias(c) for c in pages.columns
    ]
    slim = marked.select(*payload, "slice", "_entry", emits.alias("_emits"))
    order = slices.slice_order()
    seen = slim.select(
        "*",
        F.lead("ts").over(order).alias("_next_ts"),
        F.lead("_entry").over(order).alias("_next_entry"),
    )
    gone = F.col("_next_ts").isNull() | (F.col("_next_ts") - F.col("ts") >= F.lit(within))
    found = seen.where(F.col("_emits") & (gone | F.col("_next_entry")))
    if not with_kind:
        return found.select(*pages.columns)
    kind = F.when(gone, TIMED_OUT).otherwise(FOLLOWED)
    return found.select(*pages.columns, kind.alias("bounce_kind"))


def followed_bounces(pages: DataFrame, horizon_ms: int = BOUNCE_HORIZON_MS, **how) -> DataFrame:
    """Entry pages whose next page, within the horizon, is an entry page too."""
    found = bounces(pages, horizon_ms, with_kind=True, **how)
    return found.where(F.col("bounce_kind") == FOLLOWED).drop("bounce_kind")


def timed_out_bounces(pages: DataFrame, horizon_ms: int = BOUNCE_HORIZON_MS, **how) -> DataFrame:
    """Entry pages with no next page within the horizon."""
    found = bounces(pages, horizon_ms, with_kind=True, **how)
    return found.where(F.col("bounce_kind") == TIMED_OUT).drop("bounce_kind")


def visit_flags(
    records: DataFrame,
    horizon_ms: int = BOUNCE_HORIZON_MS,
    inclusive: bool = False,
    slice_ms: int | None = None,
) -> DataFrame:
    """Page records with the corrected `is_new` and the flags `is_visit` and `is_bounce`.

    Same answers as `fix_new_visitors`, `first_visits` and `bounces` in a row, from one
    shuffle of the wide rows and one narrow pre-aggregation: all three questions are settled
    within a slice but for which slice came first.
    """
    within = horizon_ms + 1 if inclusive else horizon_ms
    width = slice_ms or slices.default_width(within)
    marked = records.select(
        "*",
        (~is_start()).alias("_page"),
        (~is_start() & is_entry()).alias("_entry"),
        _claims_new().alias("_claims"),
    )

    # The first slice of each device's days, and of its claims under an empty day.
    days = F.array_compact(
        F.array(
            F.when(F.col("_entry"), day_of(F.col("ts"))), F.when(F.col("_claims"), F.lit(""))
        )
    )
    narrow = slices.add_slice(marked.select("mid", "ts", "_entry", "_claims"), width)
    firsts = (
        narrow.select("mid", "slice", F.explode(days).alias("day"))
        .groupBy("mid", "day")
        .agg(F.min("slice").alias("slice"))
        .groupBy("mid", "slice")
        .agg(
            F.max(F.col("day") == "").alias("claim_here"),
            F.max(F.col("day") != "").alias("visit_here"),
        )
    )

    # Start records only count as claims and copies only as followers: no payload for either.
    placed = slices.add_slice_with_reach(marked, within, width)
    emits = F.col("own") & F.col("_page")
    needed = ("mid", "ts", "seq")
    slim = [c if c in needed else F.when(emits, F.col(c)).alias(c) for c in records.columns]
    placed = placed.where(F.col("own") | F.col("_page")).select(
        *slim, "slice", "own", "_page", "_entry", "_claims"
    )
    order = slices.slice_order()
    follower = (
        "lead(CASE WHEN _page THEN struct(ts, _entry) END) IGNORE NULLS "
        "OVER (PARTITION BY mid, slice ORDER BY ts, seq)"
    )
    seen = placed.select(
        "*",
        F.expr(follower).alias("_next"),
        slices.nth_in_slice(F.col("own") & F.col("_claims"), order).alias("_nth_claim"),
        slices.nth_in_slice(F.col("own") & F.col("_entry"), order).alias("_nth_entry"),
    ).where(F.col("own") & F.col("_page"))
    joined = seen.join(firsts, ["mid", "slice"], "left")

    keeps = F.coalesce(F.col("claim_here"), F.lit(False)) & (F.col("_nth_claim") == 1)
    visits = F.coalesce(F.col("visit_here"), F.lit(False)) & (F.col("_nth_entry") == 1)
    gone = F.col("_next").isNull() | (F.col("_next.ts") - F.col("ts") >= F.lit(within))
    others = [c for c in records.columns if c != "is_new"]
    return joined.select(
        *others,
        F.when(F.col("_claims") & ~keeps, "0").otherwise(F.col("is_new")).alias("is_new"),
        (F.col("_entry") & visits).alias("is_visit"),
        (F.col("_entry") & (gone | F.col("_next._entry"))).alias("is_bounce"),
    )

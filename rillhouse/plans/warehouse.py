"""Whole layers as batch plans; each takes and returns frames, nothing runs here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from rillhouse.operators import logs, orders, stats, visitors


def corrected_records(lines: DataFrame, slice_ms: int | None = None) -> DataFrame:
    """Log lines to clean records with the new-visitor flag corrected."""
    return visitors.fix_new_visitors(logs.clean_records(lines), slice_ms)


def visitor_stats(
    lines: DataFrame,
    window: str = stats.WINDOW,
    horizon_ms: int = visitors.BOUNCE_HORIZON_MS,
    slice_ms: int | None = None,
) -> DataFrame:
    """Raw log lines to visitor statistics with one shuffle of the wide rows."""
    flagged = visitors.visit_flags(logs.clean_records(lines), horizon_ms, slice_ms=slice_ms)
    return stats.window_stats(stats.shape_flagged(flagged), window)


def visitor_stats_from_layers(
    pages: DataFrame,
    window: str = stats.WINDOW,
    horizon_ms: int = visitors.BOUNCE_HORIZON_MS,
    slice_ms: int | None = None,
) -> DataFrame:
    """Stored page logs to visitor statistics through the visit and bounce layers."""
    shaped = stats.union_shaped(
        visitors.first_visits(pages),
        visitors.bounces(pages, horizon_ms, slice_ms=slice_ms),
        pages,
    )
    return stats.window_stats(shaped, window)


def order_wide(
    order_info: DataFrame,
    order_detail: DataFrame,
    dims: dict[str, DataFrame],
    lower_ms: int = orders.ORDER_LOWER_MS,
    upper_ms: int = orders.ORDER_UPPER_MS,
    as_of_ms: Column | None = None,
) -> DataFrame:
    joined = orders.join_details(order_info, order_detail, lower_ms, upper_ms)
    return orders.add_dimensions(joined, dims, as_of_ms)


def payment_wide(payment_info: DataFrame, wide: DataFrame) -> DataFrame:
    timed = orders.with_wide_time(wide)
    return orders.join_payments(orders.with_payment_time(payment_info), timed)

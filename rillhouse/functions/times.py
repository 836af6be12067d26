"""Time helpers. All text times are read and written in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
DAY_MS = 86_400_000
YEAR_MS = 365 * DAY_MS


def format_instant(ts: Column) -> Column:
    """Timestamp to `yyyy-MM-dd HH:mm:ss`."""
    return F.date_format(ts, SECONDS_FORMAT)


def day_of(ms: Column) -> Column:
    """Epoch milliseconds to `yyyy-MM-dd`; a date cast prints exactly that form."""
    return F.timestamp_millis(ms).cast("date").cast("string")


def text_time(text: Column, fmt: str = SECONDS_FORMAT) -> Column:
    """Text to timestamp, null when it cannot be read."""
    return F.try_to_timestamp(text, F.lit(fmt))


def text_millis(text: Column, fmt: str = SECONDS_FORMAT) -> Column:
    """Text to epoch milliseconds, null when it cannot be read."""
    return F.unix_millis(text_time(text, fmt))


def text_millis_at_offset(text: Column, offset: str = "+08:00") -> Column:
    """Text written in a fixed UTC offset to epoch milliseconds."""
    return text_millis(F.concat(text, F.lit(offset)), SECONDS_FORMAT + "XXX")


def text_time_or_record(text: Column, record_ms: Column) -> Column:
    """Event time from text, or the time the record arrived when the text is unreadable."""
    return F.coalesce(text_time(text), F.timestamp_millis(record_ms))


def age_years(birthday: Column, as_of_ms: Column | None = None) -> Column:
    """Whole 365-day years from a `yyyy-MM-dd` birthday to `as_of_ms` (now by default)."""
    now = F.unix_millis(F.current_timestamp()) if as_of_ms is None else as_of_ms
    born = text_millis(birthday, DAY_FORMAT)
    span = now - born
    return ((span - span % F.lit(YEAR_MS)) / F.lit(YEAR_MS)).cast("int")


def date_part(text: Column) -> Column:
    """What stands before the first blank."""
    return F.substring_index(text, " ", 1)


def hour_part(text: Column) -> Column:
    """The digits between the first blank and the next colon, empty when there is no blank."""
    clock = F.substring_index(F.substring_index(text, " ", 2), " ", -1)
    return F.when(F.contains(text, F.lit(" ")), F.substring_index(clock, ":", 1)).when(
        text.isNotNull(), ""
    )

"""Behaviour log lines: strict reading, dirty lines, and the start/page/display split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions.records import (
    array_items, field_text, is_blank, json_line, put_text_field, set_text_field, strict_records, whole_number,
    with_value,
)

# Columns of a read log record, beside the untouched `value` and its `seq`.
RECORD_FIELDS = (
    "mid", "is_new", "vc", "ch", "ar", "page_id", "last_page_id", "during_time",
    "start", "displays", "ts",
)


def read_lines(lines: DataFrame) -> DataFrame:
    """`value, seq` lines to flat records plus `reject_reason` (null for a clean record).

    A line is rejected when it is not exactly one JSON object, or when it has no device id or
    no event time: nothing downstream can key or order such a record.
    """
    read = strict_records(lines, schemas.LOG_RECORD)
    flat = read.select(
        *lines.columns,
        *(F.col(f"_r.common.{c}").alias(c) for c in ("mid", "is_new", "vc", "ch", "ar")),
        F.col("_r.page.page_id").alias("page_id"),
        F.col("_r.page.last_page_id").alias("last_page_id"),
        whole_number(F.col("_r.page.during_time")).alias("during_time"),
        F.col("_r.start").alias("start"),
        F.col("_r.displays").alias("displays"),
        whole_number(F.col("_r.ts")).alias("ts"),
        F.col("_r").isNotNull().alias("_readable"),
    )
    reason = (
        F.when(~F.col("_readable"), "not one JSON object")
        .when(F.col("mid").isNull(), "no device id")
        .when(F.col("ts").isNull(), "no event time")
    )
    return flat.withColumn("reject_reason", reason).drop("_readable")


def clean_records(lines: DataFrame) -> DataFrame:
    return read_lines(lines).where(F.col("reject_reason").isNull()).drop("reject_reason")


def dirty_lines(lines: DataFrame) -> DataFrame:
    """Rejected lines, verbatim, with the reason."""
    read = read_lines(lines).where(F.col("reject_reason").isNotNull())
    return read.select(*lines.columns, "reject_reason")


def is_start() -> Column:
    """A record is a start log when `start` has any text, `{}` included."""
    return ~is_blank(F.col("start"))


def is_entry() -> Column:
    """A page reached from no earlier page."""
    return is_blank(F.col("last_page_id"))


def start_logs(records: DataFrame) -> DataFrame:
    return records.where(is_start())


def page_logs(records: DataFrame) -> DataFrame:
    return records.where(~is_start())


def entry_pages(pages: DataFrame) -> DataFrame:
    return pages.where(is_entry())


def is_object(display: Column) -> Column:
    """Whether a display's text is a JSON object; others are no displays."""
    return F.coalesce(F.ltrim(display).startswith("{"), F.lit(False))


def with_page_id(display: Column, page_id: Column) -> Column:
    """A display's own text with `page_id` set, replacing one it already has.

    Null for a display that is no object; a page without an id gives a null one.
    """
    new = F.to_json(F.array(page_id))
    named = F.substring(new, F.lit(2), F.length(new) - 2)
    return put_text_field(display, "page_id", named)


def display_texts(records: DataFrame) -> Column:
    """The displays of a record as its line spells them; as they were read where the line is not
    there or is nested too deep to walk."""
    if "value" not in records.columns:
        return F.col("displays")
    spelled = array_items(field_text(F.col("value"), "displays"))
    same = with_value(spelled, lambda s: F.when(F.size(s) == F.size("displays"), s).otherwise(F.col("displays")))
    return F.when(F.size("displays") > 0, same)


def display_logs(records: DataFrame, *keep: str) -> DataFrame:
    """One row per display of a page record: its JSON text `display`, with `keep` columns beside it."""
    pages = page_logs(records).where(F.size("displays") > 0)
    shown = pages.select(*keep, "page_id", F.explode(display_texts(records)).alias("_d"))
    shown = shown.where(is_object(F.col("_d")))
    return shown.select(*keep, with_page_id(F.col("_d"), F.col("page_id")).alias("display"))


def record_line(raw_is_new: Column) -> Column:
    """JSON text of a record: the line as it came, rewritten only where the flag was corrected."""
    typed = json_line(
        F.struct(*(F.col(c) for c in ("mid", "is_new", "vc", "ch", "ar"))).alias("common"),
        F.struct(
            "page_id", "last_page_id", F.col("during_time").alias("during_time")
        ).alias("page"),
        "start", "displays", "ts",
    )
    edited = F.coalesce(set_text_field(F.col("value"), "common", "is_new", "0"), typed)
    return F.when(raw_is_new.eqNullSafe(F.col("is_new")), F.col("value")).otherwise(edited)


def routed_lines(records: DataFrame, raw_is_new: str = "raw_is_new") -> DataFrame:
    """Every output line of the split in one pass: `topic, value, seq`.

    One exploding projection feeds all topics, so the corrected records are computed once and
    written by one sink, instead of once per topic. Rows with a `reject_reason`, where the
    frame has that column, go to the dirty topic as they came.
    """
    line = record_line(F.col(raw_is_new))
    one = F.array(
        F.struct(
            F.when(is_start(), schemas.DWD_START).otherwise(schemas.DWD_PAGE).alias("topic"),
            line.alias("value"),
        )
    )
    shown = F.filter(
        F.when(is_start(), None).otherwise(display_texts(records)), is_object
    )
    displays = F.transform(
        shown,
        lambda d: F.struct(
            F.lit(schemas.DWD_DISPLAY).alias("topic"),
            with_page_id(d, F.col("page_id")).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<topic:string,value:string>>")
    outputs = F.concat(one, F.coalesce(displays, none))
    if "reject_reason" in records.columns:
        dirty = F.struct(
            F.lit(schemas.DWD_DIRTY).alias("topic"),
            json_line("value", "reject_reason").alias("value"),
        )
        outputs = F.when(F.col("reject_reason").isNotNull(), F.array(dirty)).otherwise(outputs)
    return records.select("seq", F.explode(outputs).alias("_o")).select(
        "_o.topic", "_o.value", "seq"
    )

"""The eight jobs as streaming queries over topics. Every query has its own checkpoint."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillhouse import schemas
from rillhouse.functions.records import json_line, parse_bean
from rillhouse.operators import changes, logs, orders, stats
from rillhouse.sinks import dimensions, results
from rillhouse.sinks.topics import start_topics, write_topics_once
from rillhouse.sources.tables import read_rules
from rillhouse.sources.topics import ROUTED_FACTS, Topics, stream_topic, timed_group
from rillhouse.streaming import operators


@dataclass(frozen=True)
class Job:
    """What the jobs share: session, topics, folders, pace."""

    spark: SparkSession
    topics: Topics
    dims: str
    checkpoints: str
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
    max_files: int | None = None
    #: Where a query without a checkpoint starts on Kafka; its checkpoint decides from then on.
    start: str = "earliest"

    def read(self, topic: str, group: str) -> DataFrame:
        return stream_topic(self.spark, self.topics, topic, group, self.start, self.max_files)

    def run_of(self, name: str) -> str:
        """The id that a query's checkpoint was given when it was made: what its batch ids belong to."""
        metadata = self.spark.read.text(f"{self.checkpoints}/{name}/metadata", wholetext=True)
        return metadata.select(F.get_json_object("value", "$.id")).first()[0]

    def write(self, rows: DataFrame, group: str) -> StreamingQuery:
        return start_topics(rows, self.topics, group, self.checkpoints, self.trigger)

    def each_batch(self, df: DataFrame, name: str, handle) -> StreamingQuery:
        writer = df.writeStream.foreachBatch(handle).queryName(name)
        writer = writer.option("checkpointLocation", f"{self.checkpoints}/{name}")
        return writer.trigger(**self.trigger).start()


def _as_topic(rows: DataFrame, topic: str, *keep: str) -> DataFrame:
    return rows.select(F.lit(topic).alias("topic"), "value", *keep)


def capture_changes(job: Job, events: DataFrame) -> StreamingQuery:
    """Change events `topic, before, after, op, seq` to envelope text."""
    lines = changes.envelope_line(changes.envelopes(events, "seq"), "seq")
    return job.write(_as_topic(lines, schemas.ODS_DB, "seq"), "ods_db")


def split_logs(job: Job) -> StreamingQuery:
    """Raw log lines to start, page and display topics, dirty lines to a topic of their own."""
    lines = job.read(schemas.ODS_LOG, "base_log")
    records = operators.fix_new_visitors(lines, keep_rejected=True)
    return job.write(logs.routed_lines(records), "dwd_log")


def route_changes(job: Job, rules_path: str, rules_format: str = "json") -> StreamingQuery:
    """Envelopes to fact topics and dimension changelogs by the rules of the moment."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rules = read_rules(spark, rules_path, rules_format)
        dimensions.create_tables(spark, job.dims, rules)
        envelopes = changes.read_envelopes(batch, "seq", "record_ms")
        routed = changes.route_changes(envelopes, rules).persist()
        try:
            facts = changes.facts(routed).select(
                F.col("sink_table").alias("topic"), F.col("after").alias("value"), "seq", "record_ms"
            )
            rejected = changes.rejects(routed).select(
                F.lit(schemas.DWD_REJECTED).alias("topic"),
                json_line("tableName", "type", "reject_reason", "after").alias("value"),
                "seq",
                "record_ms",
            )
            write_topics_once(facts.unionByName(rejected), batch_id, job.topics, ROUTED_FACTS)
            dimensions.append_changes(changes.dimension_images(routed), batch_id, job.dims, job.run_of("route_changes"))
            dimensions.merge(spark, job.dims)
        finally:
            routed.unpersist()

    return job.each_batch(job.read(schemas.ODS_DB, "base_db"), "route_changes", handle)


def unique_visits(job: Job, delay: str = "24 hours") -> StreamingQuery:
    visits = operators.first_visits(job.read(schemas.DWD_PAGE, "unique_visit"), delay)
    return job.write(_as_topic(visits, schemas.DWM_VISIT, "seq"), "dwm_unique_visit")


def user_jumps(job: Job, delay: str = "2 seconds", **how) -> StreamingQuery:
    jumps = operators.bounces(job.read(schemas.DWD_PAGE, "user_jump"), delay, **how)
    return job.write(_as_topic(jumps, schemas.DWM_JUMP, "seq"), "dwm_user_jump_detail")


def visitor_stats(
    job: Job,
    folder: str,
    window: str = stats.WINDOW,
    delay: str = "11 seconds",
    jump_delay: str = "21 seconds",
) -> StreamingQuery:
    """Windowed statistics to files.

    Each input has a watermark of its own, and the slowest one counts: a window stays open until
    visits, bounces and pages are all past it, however late the bounces' job runs. `delay` is only
    how far rows of one topic may be out of order; a bounce may be a horizon more, as one that
    times out is written after later ones that did not. A topic without rows holds all windows.
    """
    visits, jumps, pages = (
        logs.clean_records(job.read(topic, "visitor_stats"))
        for topic in (schemas.DWM_VISIT, schemas.DWM_JUMP, schemas.DWD_PAGE)
    )
    rows = (
        stats.timed(stats.shape_visits(visits), delay)
        .unionByName(stats.timed(stats.shape_bounces(jumps), jump_delay))
        .unionByName(stats.timed(stats.shape_pages(pages), delay))
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        results.write_files(batch, batch_id, folder)

    return job.each_batch(stats.window_stats(rows, window), "visitor_stats", handle)


def split_late(job: Job, topic: str, delay_ms: int, event_ms: Column | None = None) -> StreamingQuery:
    """A topic's rows to `<topic>_on_time` and `<topic>_late`, by the watermark Spark would hold them to.

    The watermark of a batch is the latest event time of the batches before it less the delay; it
    is stored with each batch, so a repeated batch is split as before. A late row goes out as
    `{"value", "event_ms", "missed_ms"}` with the watermark it missed. Rows without a time are on
    time: the reader's own rules say what becomes of them.
    """
    own = event_ms if event_ms is not None else F.get_json_object("value", "$.ts").try_cast("bigint")
    name, marks = f"split_{topic}", f"{job.checkpoints}/split_{topic}-marks"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.createDataFrame([], "high BIGINT").write.mode("ignore").parquet(f"{marks}/batch_id=-1")
        before = spark.read.schema("high BIGINT, batch_id BIGINT").parquet(marks)
        high = before.where(F.col("batch_id") == batch_id - 1).agg(F.max("high")).first()[0]
        rows = batch.withColumn("event_ms", own).persist()
        try:
            late = F.lit(False) if high is None else F.coalesce(F.col("event_ms") <= high - delay_ms, F.lit(False))
            missed = F.lit(None if high is None else high - delay_ms).cast("bigint").alias("missed_ms")
            report = json_line("value", "event_ms", "missed_ms")
            out = rows.select("*", missed).select(
                F.when(late, f"{topic}_late").otherwise(f"{topic}_on_time").alias("topic"),
                F.when(late, report).otherwise(F.col("value")).alias("value"),
                "seq",
                "record_ms",
            )
            write_topics_once(out, batch_id, job.topics, timed_group(topic))
            top = rows.agg(F.greatest(F.max("event_ms"), F.lit(high).cast("bigint")).alias("high"))
            top.write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return job.each_batch(job.read(topic, name), name, handle)


def _timed_beans(lines: DataFrame, schema, delay: str) -> DataFrame:
    beans = parse_bean(lines, schema, "value")
    plain = beans.drop("create_date", "create_hour", "create_ts")
    return orders.with_event_time(plain).withWatermark("et", delay)


def order_wide(
    job: Job,
    delay: str = "0 seconds",
    lower_ms: int = orders.ORDER_LOWER_MS,
    upper_ms: int = orders.ORDER_UPPER_MS,
    as_of_ms: Column | None = None,
) -> StreamingQuery:
    """Orders joined to details, then to the dimensions as they are at each batch."""
    info = _timed_beans(job.read(schemas.DWD_ORDER, "order_wide"), schemas.ORDER_INFO, delay)
    detail = _timed_beans(job.read(schemas.DWD_DETAIL, "order_wide"), schemas.ORDER_DETAIL, delay)
    joined = orders.join_details(info, detail, lower_ms, upper_ms)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dims = {t: dimensions.read_table(spark, job.dims, t.lower()) for t in schemas.DIM_TABLES}
        wide = orders.add_dimensions(batch, dims, as_of_ms)
        rows = wide.select(
            F.lit(schemas.DWM_ORDER_WIDE).alias("topic"), json_line(*wide.columns).alias("value"),
            F.col("detail_id").alias("seq"),
            F.unix_millis(F.current_timestamp()).alias("record_ms"),
        )
        write_topics_once(rows, batch_id, job.topics, "dwm_order_wide")

    return job.each_batch(joined, "order_wide", handle)


def payment_wide(
    job: Job,
    delay: str = "0 seconds",
    lower_ms: int = orders.PAYMENT_LOWER_MS,
    upper_ms: int = orders.PAYMENT_UPPER_MS,
) -> StreamingQuery:
    """Payments joined to order rows; an unreadable time falls back to the record's arrival."""
    paid = parse_bean(
        job.read(schemas.DWD_PAYMENT, "payment_wide"), schemas.PAYMENT_INFO, "value", "record_ms"
    )
    wide = parse_bean(
        job.read(schemas.DWM_ORDER_WIDE, "payment_wide"), schemas.ORDER_WIDE, "value", "record_ms"
    )
    joined = orders.join_payments(
        orders.with_payment_time(paid).withWatermark("et", delay),
        orders.with_wide_time(wide, "record_ms").withWatermark("et", delay),
        lower_ms, upper_ms,
    )
    rows = joined.select(
        F.lit(schemas.DWM_PAYMENT_WIDE).alias("topic"),
        json_line(*joined.columns).alias("value"),
        F.col("payment_id").alias("seq"),
    )
    return job.write(rows, "dwm_payment_wide")

"""Topics of text records, on files or on Kafka, read as batches or streams.

A topic row is `value STRING, seq BIGINT, record_ms BIGINT`: the text, its order within the
source, and when it arrived. On files a group of topics shares a folder split by `topic`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas

TOPIC_FILE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("record_ms", T.LongType()),
        T.StructField("topic", T.StringType()),
    ]
)

# Which job's folder holds a topic; rule-routed facts share the last one.
GROUPS = {
    schemas.ODS_LOG: "ods_log",
    schemas.ODS_DB: "ods_db",
    schemas.DWD_START: "dwd_log",
    schemas.DWD_PAGE: "dwd_log",
    schemas.DWD_DISPLAY: "dwd_log",
    schemas.DWD_DIRTY: "dwd_log",
    schemas.DWM_VISIT: "dwm_unique_visit",
    schemas.DWM_JUMP: "dwm_user_jump_detail",
    schemas.DWM_ORDER_WIDE: "dwm_order_wide",
    schemas.DWM_PAYMENT_WIDE: "dwm_payment_wide",
}
ROUTED_FACTS = "dwd_db"
ON_TIME, LATE = "_on_time", "_late"


def timed_group(topic: str) -> str:
    """The group of a topic's two halves, on time and late."""
    return f"timed_{topic}"


@dataclass(frozen=True)
class Topics:
    """Where topics live: `kind` is "files" (base is a folder) or "kafka" (base is the brokers)."""

    base: str
    kind: str = "files"
    options: dict[str, str] = field(default_factory=dict)

    def folder(self, topic: str) -> str:
        for end in (ON_TIME, LATE):
            if topic.endswith(end):
                return f"{self.base}/{timed_group(topic.removesuffix(end))}"
        return f"{self.base}/{GROUPS.get(topic, ROUTED_FACTS)}"

    def group_folder(self, group: str) -> str:
        return f"{self.base}/{group}"


def _from_kafka(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("offset").alias("seq"),
        F.unix_millis("timestamp").alias("record_ms"),
    )


def kafka_options(topics: Topics, topic: str, start: str, group: str | None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": topics.base,
        "subscribe": topic,
        "startingOffsets": start,
        **topics.options,
    }
    if group:
        options["groupIdPrefix"] = group
    return options


def read_topic(spark: SparkSession, topics: Topics, topic: str) -> DataFrame:
    """A topic's rows so far."""
    if topics.kind == "kafka":
        options = kafka_options(topics, topic, "earliest", None)
        return _from_kafka(spark.read.format("kafka").options(**options).load())
    rows = spark.read.schema(TOPIC_FILE).parquet(topics.folder(topic))
    return rows.where(F.col("topic") == topic).select("value", "seq", "record_ms")


def stream_topic(
    spark: SparkSession,
    topics: Topics,
    topic: str,
    group: str | None = None,
    start: str = "latest",
    max_files: int | None = None,
) -> DataFrame:
    """A topic as a stream. `start` and `group` matter on Kafka; files start from the oldest."""
    if topics.kind == "kafka":
        options = kafka_options(topics, topic, start, group)
        return _from_kafka(spark.readStream.format("kafka").options(**options).load())
    reader = spark.readStream.schema(TOPIC_FILE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(topics.folder(topic))
    return rows.where(F.col("topic") == topic).select("value", "seq", "record_ms")


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A folder of plain text as topic rows; equal times are then ordered by a line hash."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.text(path)
    arrived = F.unix_millis(F.col("_metadata.file_modification_time"))
    return lines.select("value", F.xxhash64("value").alias("seq"), arrived.alias("record_ms"))

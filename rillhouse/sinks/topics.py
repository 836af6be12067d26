"""Writers of topic rows `topic, value, seq, record_ms`; the target is each row's `topic`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillhouse.sources.topics import TOPIC_FILE, Topics


def topic_rows(rows: DataFrame) -> DataFrame:
    """The columns of a topic file; what a row lacks becomes null."""
    have = set(rows.columns)
    return rows.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TOPIC_FILE
        )
    )


def write_topics(rows: DataFrame, topics: Topics, group: str) -> None:
    """Append a batch. Each task writes its own file per topic, so a big topic is no hot spot."""
    rows = topic_rows(rows)
    if topics.kind == "kafka":
        kafka = rows.select("topic", "value").write.format("kafka")
        kafka.option("kafka.bootstrap.servers", topics.base).options(**topics.options).save()
        return
    rows.write.mode("append").partitionBy("topic").parquet(topics.group_folder(group))


def write_topics_once(rows: DataFrame, batch_id: int, topics: Topics, group: str) -> None:
    """Write one micro-batch; a repeated batch replaces its own folder instead of adding to it."""
    if topics.kind == "kafka":
        write_topics(rows, topics, group)
        return
    folder = f"{topics.group_folder(group)}/batch_id={batch_id}"
    topic_rows(rows).write.mode("overwrite").partitionBy("topic").parquet(folder)


def start_topics(
    rows: DataFrame,
    topics: Topics,
    group: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Stream rows to their topics: exactly once on files, at least once on Kafka."""
    rows = topic_rows(rows)
    if topics.kind == "kafka":
        writer = rows.select("topic", "value").writeStream.format("kafka")
        writer = writer.option("kafka.bootstrap.servers", topics.base).options(**topics.options)
    else:
        writer = rows.writeStream.format("parquet").partitionBy("topic")
        writer = writer.option("path", topics.group_folder(group))
    writer = writer.option("checkpointLocation", f"{checkpoint}/{name or group}")
    return writer.queryName(name or group).trigger(**(trigger or {"availableNow": True})).start()

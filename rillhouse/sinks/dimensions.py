"""Dimension tables: an append-only changelog with a commit log, read as one row per key.

    <base>/layout                          columns, key and options of each rule seen
    <base>/commits/epoch=E                 one row per commit: its place, level, source and folder
    <base>/images/commit=C/sink_table=X    images of one commit

A commit is one appended file, so readers see a batch whole or not at all, and a folder without
a commit is nothing. Commits are numbered; a batch of a run (a checkpoint) that is committed is
not written again, and a new run's batches follow all earlier ones, whatever their batch ids.

An upsert touches the columns that its image has; a row is the last value of each column by
(commit, seq). Commits of one level that lie side by side are merged into one of the next level,
one image per key and sorted by key, so each image is merged once per level and a reader meets a
bounded number of folders. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rillhouse.functions.records import in_list
from rillhouse.operators.changes import DEFAULT_KEY, TO_DIMENSION, current_rules, last_columns

IMAGE = "after STRING, seq BIGINT, pk STRING, number BIGINT, sink_table STRING"
LAYOUT = "sink_table STRING, sink_columns STRING, sink_pk STRING, sink_extend STRING"
COMMIT = "number BIGINT, level INT, run STRING, batch_id BIGINT, folder STRING, epoch INT"
#: Commits of a level that are merged into one of the next.
FAN_IN = 8
#: A key range of a merged commit is one file of about so many images.
RANGE_IMAGES = 1_000_000


def layouts(spark: SparkSession, base: str) -> DataFrame:
    """The rules of every dimension so far: `sink_table, sink_columns, sink_pk, sink_extend`."""
    path = f"{base}/layout"
    spark.createDataFrame([], LAYOUT).write.mode("ignore").parquet(path)
    return spark.read.schema(LAYOUT).parquet(path)


def _record(spark: SparkSession, base: str, wanted: DataFrame) -> None:
    key = F.coalesce("sink_pk", F.lit(DEFAULT_KEY))
    bad = wanted.where(~in_list(key, F.col("sink_columns"))).first()
    if bad:
        raise ValueError(f"the key of {bad.sink_table} is not among its columns {bad.sink_columns}")
    known = layouts(spark, base).alias("known")
    same = [F.col(f"wanted.{c}").eqNullSafe(F.col(f"known.{c}")) for c in known.columns]
    new = wanted.alias("wanted").join(known, same, "left_anti")
    if not new.isEmpty():
        new.write.mode("append").parquet(f"{base}/layout")


def create_table(
    spark: SparkSession, base: str, table: str, columns: str, pk: str | None = None, extend: str | None = None
) -> None:
    """Create a dimension of text columns, or add the columns to it; the key must be one of them."""
    _record(spark, base, spark.createDataFrame([(table, columns, pk, extend)], LAYOUT))


def create_tables(spark: SparkSession, base: str, rules: DataFrame) -> None:
    """Record the layout of every dimension rule in force that is not known yet.

    A table has the columns of all rules it ever had, so a narrower rule takes nothing away and a
    wider one adds its columns.
    """
    wanted = current_rules(rules).where(F.col("sink_type") == TO_DIMENSION)
    _record(spark, base, wanted.select("sink_table", "sink_columns", "sink_pk", "sink_extend").distinct())


def commits(spark: SparkSession, base: str) -> DataFrame:
    """The commit log in force, that of the last epoch."""
    path = f"{base}/commits"
    spark.createDataFrame([(None, None, None, None, None, 0)], COMMIT).write.mode("ignore").partitionBy("epoch").parquet(path)
    log = spark.read.schema(COMMIT).parquet(path)
    last = log.agg(F.max("epoch")).first()[0]
    return log.where((F.col("epoch") == last) & F.col("number").isNotNull())


def _add_commit(spark: SparkSession, base: str, number: int, level: int, run: str | None, batch_id: int | None, folder: str) -> None:
    epoch = spark.read.schema(COMMIT).parquet(f"{base}/commits").agg(F.max("epoch")).first()[0]
    row = spark.createDataFrame([(number, level, run, batch_id, folder, epoch)], COMMIT).coalesce(1)
    row.write.mode("append").partitionBy("epoch").parquet(f"{base}/commits")


def append_changes(rows: DataFrame, batch_id: int, base: str, run: str = "") -> bool:
    """Store routed dimension rows of one micro-batch of a run; whether they were not there yet.

    `run` names the checkpoint that numbers the batches. A batch is repeated after a crash with
    the same rows, so one that is committed stands.
    """
    spark = rows.sparkSession
    log = commits(spark, base)
    state = log.agg(
        F.max("number").alias("last"), F.max(F.when((F.col("run") == run) & (F.col("batch_id") >= batch_id), 1)).alias("known")
    ).first()
    if state["known"]:
        return False
    number = 0 if state["last"] is None else state["last"] + 1
    key = F.coalesce("sink_pk", F.lit(DEFAULT_KEY))
    images_ = rows.withColumn("_path", F.concat(F.lit("$."), key)).select(
        "after", "seq", F.expr("get_json_object(after, _path)").alias("pk"), F.lit(number).cast("bigint").alias("number"), "sink_table"
    )
    folder = f"images/commit={number:012d}-{uuid.uuid4().hex}"
    images_.write.partitionBy("sink_table").parquet(f"{base}/{folder}")
    _add_commit(spark, base, number, 0, run, batch_id, folder)
    return True


def live_commits(spark: SparkSession, base: str) -> list[Row]:
    """Commits that readers need, oldest first: those of a level that no higher level has merged.

    Merging takes the oldest commits of a level, so what is merged ends at the highest number
    of the levels above. At most some FAN_IN per level are left, and these come to the driver.
    """
    log = commits(spark, base)
    tops = {r["level"]: r["top"] for r in log.groupBy("level").agg(F.max("number").alias("top")).collect()}
    left = F.lit(False)
    for level in tops:
        merged = max((top for higher, top in tops.items() if higher > level), default=-1)
        left |= (F.col("level") == level) & (F.col("number") > merged) & F.col("folder").isNotNull()
    return log.where(left).orderBy("number").collect()


def images(spark: SparkSession, base: str, found: list[Row] | None = None) -> DataFrame:
    """Stored images of the commits that matter, or of the given ones."""
    found = live_commits(spark, base) if found is None else found
    if not found:
        return spark.createDataFrame([], IMAGE)
    read = spark.read.schema(IMAGE).option("basePath", f"{base}/images")
    return read.parquet(*(f"{base}/{r['folder']}" for r in found)).drop("commit")


def merged_images(stored: DataFrame) -> DataFrame:
    """One image per table and key with the last value of each column, null values included."""
    fields = F.explode(F.from_json("after", "map<string,string>")).alias("name", "value")
    cells = stored.where(F.col("pk").isNotNull()).select("sink_table", "pk", "number", "seq", fields)
    order = F.struct("number", "seq")
    last = cells.groupBy("sink_table", "pk", "name").agg(
        F.max_by(F.struct("value"), order)["value"].alias("value"), F.max(order).alias("last")
    )
    image = F.to_json(F.map_from_entries(F.collect_list(F.struct("name", "value")))).alias("after")
    rows = last.groupBy("sink_table", "pk").agg(image, F.max("last").alias("last"))
    return rows.select("after", "last.seq", "pk", "last.number", "sink_table")


def _merge(spark: SparkSession, base: str, found: list[Row], level: int) -> None:
    """Merge commits that lie side by side into one of a level, in key ranges."""
    number = max(r["number"] for r in found)
    rows = merged_images(images(spark, base, found)).withColumn("number", F.lit(number).cast("bigint"))
    rows = rows.repartitionByRange("sink_table", "pk").sortWithinPartitions("sink_table", "pk")
    folder = f"images/commit={number:012d}-{level}-{uuid.uuid4().hex}"
    rows.write.option("maxRecordsPerFile", RANGE_IMAGES).partitionBy("sink_table").parquet(f"{base}/{folder}")
    _add_commit(spark, base, number, level, None, None, folder)


def merge(spark: SparkSession, base: str, fan_in: int = FAN_IN) -> int:
    """Merge each level that has `fan_in` commits into one commit of the next; how many merges that took.

    Only what came since the last merge of a level is read, so the work follows the changes and
    not the table.
    """
    done, level = 0, 0
    while True:
        found = live_commits(spark, base)
        here = [r for r in found if r["level"] == level]
        if len(here) >= fan_in:
            _merge(spark, base, here, level + 1)
            done += 1
        elif level >= max((r["level"] for r in found), default=0):
            return done
        level += 1


def compact(spark: SparkSession, base: str, upto: int | None = None) -> None:
    """Merge all commits, or those up to a number, into one."""
    found = [r for r in live_commits(spark, base) if upto is None or r["number"] <= upto]
    if len(found) > 1:
        _merge(spark, base, found, max(r["level"] for r in found) + 1)


def vacuum(spark: SparkSession, base: str) -> int:
    """Empty the folders that a merge replaced, and shorten the commit log; how many were emptied.

    A reader that planned before the last merge may still want them, so this is for quiet hours.
    The new log keeps the live commits and the last batch of each run, in a new epoch.
    """
    log = commits(spark, base)
    live = live_commits(spark, base)
    kept = {r["folder"] for r in live}
    dead = [r["folder"] for r in log.where(F.col("folder").isNotNull()).select("folder").collect() if r["folder"] not in kept]
    nothing = spark.createDataFrame([], IMAGE)
    for folder in dead:
        # Overwriting is the one way to remove files that every kind of session has.
        nothing.write.mode("overwrite").parquet(f"{base}/{folder}")
    if dead:
        epoch = log.first()["epoch"] + 1
        last = log.where("run is not null").groupBy("run").agg(F.max_by(F.struct("number", "batch_id"), "number").alias("l"))
        seen = [(r["l"]["number"], 0, r["run"], r["l"]["batch_id"], None, epoch) for r in last.collect()]
        rows = [(r["number"], r["level"], None, None, r["folder"], epoch) for r in live]
        spark.createDataFrame(rows + seen, COMMIT).coalesce(1).write.mode("append").partitionBy("epoch").parquet(f"{base}/commits")
        for old in range(epoch):
            spark.createDataFrame([], COMMIT).drop("epoch").write.mode("overwrite").parquet(f"{base}/commits/epoch={old}")
    return len(dead)


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A dimension as it is now: one row per key, upper-case text columns of all its rules."""
    rules = layouts(spark, base).where(F.col("sink_table") == table)
    column = F.posexplode(F.split("sink_columns", ",")).alias("pos", "name")
    columns = rules.select(column).groupBy("name").agg(F.min("pos").alias("pos")).orderBy("pos", "name")
    names = [r["name"] for r in columns.collect()]
    if not names:
        raise ValueError(f"no dimension {table}")
    key = rules.select(F.coalesce(F.max("sink_pk"), F.lit(DEFAULT_KEY)).alias("key")).first()["key"]
    stored = images(spark, base).where(F.col("sink_table") == table)
    return last_columns(stored, names, key, F.struct("number", "seq"))

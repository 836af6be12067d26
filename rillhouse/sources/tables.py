"""Tables of other databases over JDBC, and the rule table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.functions.naming import camel_columns


def jdbc_options(
    url: str,
    query: str,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a partition column the query is read in key ranges."""
    options = {"url": url, "dbtable": f"({query}) q", "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def query_rows(
    spark: SparkSession, url: str, query: str, camel: bool = False, **how
) -> DataFrame:
    """Rows of a query, columns optionally renamed to lowerCamel."""
    rows = spark.read.format("jdbc").options(**jdbc_options(url, query, **how)).load()
    return camel_columns(rows) if camel else rows


def as_inserts(rows: DataFrame, database: str, table: str, seq: str) -> DataFrame:
    """Existing rows of a table as insert envelopes, for a first load."""
    return rows.select(
        F.lit(database).alias("database"),
        F.lit(table).alias("tableName"),
        F.lit("{}").alias("before"),
        F.to_json(F.struct("*")).alias("after"),
        F.lit("insert").alias("type"),
        F.col(seq).cast("bigint").alias("seq"),
    )


def read_rules(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The rule table as it is now. Read again for every batch, so edits and deletions hold."""
    layout = (
        "source_table STRING, operate_type STRING, sink_type STRING, sink_table STRING, "
        "sink_columns STRING, sink_pk STRING, sink_extend STRING, rule_seq BIGINT"
    )
    return spark.read.schema(layout).format(fmt).load(path)

"""Result tables: every column that is not marked transient, in declared order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rillhouse.operators.columns import drop_transient

#: Rows of one insert; small batches are slow, but the size is the caller's choice.
BATCH = 1000


def write_files(df: DataFrame, batch_id: int, folder: str) -> None:
    """One micro-batch to files; a repeated batch replaces its own folder."""
    drop_transient(df).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def jdbc_writer_options(
    url: str, table: str, driver: str | None = None, batch_size: int = BATCH
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    return options | ({"driver": driver} if driver else {})


def write_jdbc(df: DataFrame, url: str, table: str, **how) -> None:
    """Append to a table of another database. A repeated batch is inserted again."""
    options = jdbc_writer_options(url, table, **how)
    drop_transient(df).write.format("jdbc").options(**options).mode("append").save()

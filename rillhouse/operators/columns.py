"""Column marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mark_transient(df: DataFrame, *names: str) -> DataFrame:
    """Mark columns that the result sink leaves out."""
    return df.select(
        *(F.col(c).alias(c, metadata={"transient": True}) if c in names else F.col(c) for c in df.columns)
    )


def drop_transient(df: DataFrame) -> DataFrame:
    return df.drop(*(f.name for f in df.schema.fields if f.metadata.get("transient")))

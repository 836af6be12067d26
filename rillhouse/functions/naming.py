"""Column naming."""

from __future__ import annotations

from pyspark.sql import DataFrame


def camel(name: str) -> str:
    """lower_underscore (any case) to lowerCamel."""
    head, *tail = name.lower().split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in tail)


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(camel(name) for name in df.columns))

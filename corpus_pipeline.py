"""From raw documents to token ids: five stages, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.llm import decontamination, jaccard_join, sentencepiece, substring_dedup, toxicity
from rillhouse.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity model, learned from `labels`, predicts as toxic."""
    sample = stored(toxicity.training_rows(docs, table(spark, sf_dir, "labels")), "toxic-sample")
    model = toxicity.fit(sample)
    return docs.select(*COLUMNS).where(toxicity.scored(model, F.col("text"))["predicted"] == 0)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """Write and reread the documents with a `row` that tells rows of one id apart."""
    return stored(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies, of the smallest id.

    Rows of one id are documents of their own. Rows without an id are in no component and stay.
    """
    docs = numbered(docs, "near-rows")
    ids = docs.where("doc_id is not null").select("row", "doc_id")
    near = jaccard_join.near_components(docs.where("doc_id is not null").select(F.col("row").alias("doc_id"), "text"))
    near = stored(near.select(F.col("doc_id").alias("row"), "component_id"), "near-components")
    several = near.where("row <> component_id").select("component_id").distinct()
    members = near.join(several, "component_id").join(ids, "row")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "row"))["row"].alias("first"))
    found = members.join(first, "component_id").where("row <> first").select("row")
    return docs.join(found, "row", "left_anti").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines out that an earlier document has; every document stays, if need be empty."""
    kept = substring_dedup.without_repeats(docs.select(*COLUMNS))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that hold a window of a benchmark item."""
    docs = numbered(docs, "test-rows")
    found = decontamination.contamination(docs.select(F.col("row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = found.where("contaminated").select(F.col("doc_id").alias("row"))
    return docs.join(found, "row", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the text decoded from them."""
    return sentencepiece.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_lines),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: The toxicity model is not SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs

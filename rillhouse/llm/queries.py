"""The registered queries of the text operators, and DuckDB texts where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rillhouse.llm import (
    block_labeller,
    decontamination,
    fill_in_middle,
    jaccard_join,
    language_mixture,
    license_scan,
    pruned_graph,
    sentencepiece,
    spelling_variants,
    spot_signatures,
    substring_dedup,
    token_records,
    toxicity,
)
from rillhouse.llm.common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_labeller.extract_pages(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.selectExpr("doc_id", "held_out", "score", "predicted", "size(passages) AS n_passages")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_components(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_records(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.selectExpr(
        "doc_id",
        "coalesce(text, '') AS text",
        "n_words",
        "n_removed",
        "cast(size(passages) AS bigint) AS n_passages",
        "array_join(transform(passages, p -> concat(p.start, ':', p.length)), ',') AS passages",
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pruned_graph.near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_language_id": op2_language_id,
    "op3_toxicity": op3_toxicity,
    "op4_fingerprints": op4_fingerprints,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_token_records": op7_token_records,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_license_scan": op10_license_scan,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

ORACLES: dict[str, str] = {
    "op6_decontamination": decontamination.ORACLE,
    "op8_substring_dedup": substring_dedup.ORACLE,
    "op11_fill_in_middle": fill_in_middle.ORACLE,
}

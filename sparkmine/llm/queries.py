"""The registered queries of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import (
    decontaminate, filter_audit, language, main_text, overlap_join, packing, pieces, quality, repeats, resampling, secrets, toxicity, vector_links)
from sparkmine.sources.tables import read_parquet

VOCABULARY, WORD_VOCABULARY = "piece_bpe_32k.model", "word_bpe_49k.json"


def op1_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeats.remove_repeats(read_parquet(spark, d, "documents"))


def op2_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return main_text.extract(read_parquet(spark, d, "pages"))


def op3_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan(read_parquet(spark, d, "documents"))


def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language.language(read_parquet(spark, d, "documents"))


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score(read_parquet(spark, d, "documents"), read_parquet(spark, d, "labels"))


def op6_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.leaks(read_parquet(spark, d, "documents"), read_parquet(spark, d, "benchmark"))


def op7_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encode_frame(read_parquet(spark, d, "documents"), public_tokenizers.path(VOCABULARY))


def op8_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return overlap_join.jaccard_classes(read_parquet(spark, d, "documents"))


def op9_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    return vector_links.vector_classes(read_parquet(spark, d, "embeddings"))


def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.classify(read_parquet(spark, d, "documents"))


def op11_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_parquet(spark, d, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op12_resampling(spark: SparkSession, d: str) -> DataFrame:
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return resampling.resample(read_parquet(spark, d, "documents"), read_parquet(spark, d, "benchmark")).select(*columns)


def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.filter_audit(read_parquet(spark, d, "documents"), read_parquet(spark, d, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_html_extraction, op3_secret_scan, op4_language_id, op5_toxicity, op6_decontaminate, op7_sentencepiece, op8_jaccard_join, op9_embedding_dedup, op10_quality,
    op11_packing, op12_resampling, op13_filter_audit)}
SQL: dict[str, str] = {
    "op1_substring_dedup": repeats.SQL, "op8_jaccard_join": overlap_join.SQL, "op9_embedding_dedup": vector_links.SQL,
    "op13_filter_audit": filter_audit.SQL}

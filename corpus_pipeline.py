"""A corpus cleaned stage by stage: reject junk, keep one of near-duplicates, drop leaked benchmark items, redact secrets, encode.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.lineage import scratch_path
from sparkmine.llm import decontaminate, overlap_join, pieces, quality, secrets
from sparkmine.llm.common import kept, shuffles_dropped
from sparkmine.sources.tables import read_parquet

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
MARK = "[secret]"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer does not reject."""
    return quality.classify(docs, keep=COLUMNS).filter("good").select(*NAMES)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class; of rows that repeat an id one stays, without an id all."""
    classes = kept(overlap_join.jaccard_classes(docs).filter("not kept").select("doc_id"), "copies")
    left = docs.join(classes, "doc_id", "left_anti").select(*NAMES)
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return left
    named = left.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct(*NAMES[1:])).alias("r")).select("doc_id", "r.*")
    return named.union(left.filter("doc_id is null"))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other values."""
    return decontaminate.without_leaks(docs.select(*NAMES), read_parquet(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced and ``n_chars`` counted again where a text changed."""
    found = secrets.scan(docs, keep=COLUMNS, redact=MARK)
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("redacted")).cast("long").alias("n_chars"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return pieces.encode_frame(docs, public_tokenizers.path("piece_bpe_32k.model"), keep="doc_id long, lang string, source string")


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_class),
    ("benchmark decontamination", no_benchmark),
    ("secret scans", no_secrets),
    ("SentencePiece coding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each result written and read again."""
    docs = read_parquet(spark, sf_dir, "documents").select(*NAMES)
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        done = stage(spark, docs, sf_dir)
        with shuffles_dropped(spark):
            done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs


ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}

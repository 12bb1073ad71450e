"""A corpus pipeline: quality, near duplicates, benchmark contamination, secrets, token ids.

Each stage gets the documents that its predecessor kept and returns documents with the same columns, but for the last one,
which returns token ids. ``run`` writes each stage's result as Parquet in the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import decontamination, jaccard_join, quality, secret_scan, sentencepiece_codec
from logtide.scratch import Scratch
from logtide.session import ship


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return decontamination.clean(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    ship(spark)
    return secret_scan.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token ids (packed, 32 bits each), their number, and whether decoding restores the text."""
    ship(spark)
    path = sentencepiece_codec.model_path()
    out = sentencepiece_codec.round_trip(docs, path, carry=("doc_id", "lang", "source", "text"))
    restored = F.col("decoded") == F.translate(F.coalesce("row.text", F.lit("")), "▁", " ")
    return out.select("row.doc_id", "row.lang", "row.source", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids", restored.alias("restored"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", token_ids),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, from the folder's documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.cut(stage(spark, docs, sf_dir), f"stage-{i}")
    return STAGES[-1][1](spark, docs, sf_dir)

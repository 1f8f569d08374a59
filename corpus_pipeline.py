"""From raw documents to token ids: quality, near duplicates, benchmark passages, personal data, encoding.

Each stage works on all that the stage before has kept, written as Parquet and read again. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.llm import bpe, cotrain, decontaminate, jaccard, personal
from turnweave.llm.lineage import park

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BROADCAST_ROWS = 200_000  # dropped rows up to this number are broadcast, three small values each; more are joined by a shuffle


def _row() -> Column:
    """What tells one row of documents from another: its doc_id, those without one last, and a hash of its text. Rows equal in both are one
    document and share its fate."""
    return F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` less the rows in gone (row), in one pass where `gone` is small."""
    gone = park(gone.distinct())
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, _row() == gone["row"], "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the co-trained quality classifier rejects. Rows go through unchanged. Null and empty texts are judged like any
    other; repeated rows share a verdict; an empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return cotrain.keep_good(docs, labels)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates (five words, similarity 0.8) the document with the smallest doc_id, one without a
    doc_id only where all are. Rows with one doc_id but different texts are different documents; repeated rows of a kept
    document stay; documents without words have no group and stay."""
    near = jaccard.near_duplicates(docs.select(_row().alias("row"), "text"), id_col="row")
    return _without(docs, near.where("component_id <> doc_id").select(F.col("doc_id").alias("row")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item (five words, four fifths of its shingles). Of rows with one doc_id only those
    whose own text does go; rows without a doc_id are judged alike; null and empty texts contain nothing."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contained_items(docs.select(_row().alias("row"), "text"), items, id_col="row")
    return _without(docs, found.select(F.col("doc_id").alias("row")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts <KIND> in place of every span of personal data, and n_chars right. No row goes; null texts and their n_chars
    stay null; repeated rows change alike."""
    masked = personal.mask(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and decoded_sha256, of the bytes that the ids decode to: one row per row. Null and empty texts give no
    ids and the digest of nothing. `docs` is a table that the stage before has written."""
    decoded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), RANKS, from_files=True), RANKS)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", byte_level_bpe),
]
ORACLE_SQL = None  # a trained classifier and a tokenizer are no SQL; tests/llm/test_pipeline.py holds the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = park(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

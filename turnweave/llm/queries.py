"""The numbered queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from turnweave.llm import align, bpe, chat, cotrain, decontaminate, divergence, extract, jaccard, licences, merkle, personal, repetition, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_VOCABULARY, PIECE_MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_quality(_docs(spark, sf_dir))


def op2_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_docs(spark, sf_dir), n_gram=3, percent=90)


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return cotrain.quality(_docs(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars"), labels)


def op4_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digests(personal.find(_docs(spark, sf_dir)))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_docs(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.toxicity(_docs(spark, sf_dir), labels)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.decode(bpe.encode(_docs(spark, sf_dir), RANKS, from_files=True), RANKS))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{said}' AS text")
    return chat.digests(chat.format_conversations(turns.union(own)))


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.contained_items(_docs(spark, sf_dir), items)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_docs(spark, sf_dir, "lang", "source", "text"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(_docs(spark, sf_dir))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(_docs(spark, sf_dir), BYTE_VOCABULARY, PIECE_MODEL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repetition": op1_repetition,
    "op2_parity_join": op2_parity_join,
    "op3_cotraining": op3_cotraining,
    "op4_personal": op4_personal,
    "op5_licences": op5_licences,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_chat": op8_chat,
    "op9_extract": op9_extract,
    "op10_decontaminate": op10_decontaminate,
    "op11_divergence": op11_divergence,
    "op12_merkle": op12_merkle,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op5_licences": licences.oracle(),
    "op8_chat": chat.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_divergence": divergence.ORACLE,
}

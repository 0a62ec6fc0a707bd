"""The operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.queries.base import table

from .bpe import encode_documents
from .common import tokenizer
from .conversations import damaged, repair_reports
from .exact_copies import exact_copies
from .fill_in_middle import fill_in_middle, restored
from .html_text import extract_text
from .languages import identify_languages
from .licences import scan_licenses
from .near_copies import near_copies
from .oracles import ORACLES
from .packing import pack
from .passages import remove_passages
from .quality import classify_quality
from .toxicity import score_toxicity
from .vector_links import link_vectors

__all__ = ["ORACLES", "QUERIES", "WITHOUT_SQL"]

# Queries that tests hold against brute force, a library or held-out rows.
WITHOUT_SQL = {
    "op1_vector_links", "op2_pack_sequences", "op3_exact_copies", "op4_main_text", "op5_encode_documents", "op6_near_copies",
    "op7_toxicity", "op8_quality", "op9_repeated_passages", "op10_license_scan", "op13_languages", "pipeline",
}


def op1_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op5_encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(table(spark, sf_dir, "documents")).drop("kept_text")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_reports(damaged(table(spark, sf_dir, "conversations")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = fill_in_middle(table(spark, sf_dir, "documents"))
    text = restored(F.col("output"), F.col("form"))
    return examples.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = identify_languages(documents, documents.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_links": op1_vector_links,
    "op2_pack_sequences": op2_pack_sequences,
    "op3_exact_copies": op3_exact_copies,
    "op4_main_text": op4_main_text,
    "op5_encode_documents": op5_encode_documents,
    "op6_near_copies": op6_near_copies,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_license_scan": op10_license_scan,
    "op11_repair_conversations": op11_repair_conversations,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_languages": op13_languages,
}

"""Registered queries of the text operators, and their DuckDB SQL where SQL
can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.llm import (chat, decontaminate, html_extract, licenses, line_dedup, merkle, ngram_join, packing, quality,
                         substring_dedup, token_files, toxicity, whitening)
from logflow.llm._common import read_table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bit-plane shuffled token files, written and read back."""
    return token_files.token_files(spark, read_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles have a Jaccard
    similarity of 0.9 or more."""
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of the convolutional classifier."""
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and covered notice spans."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after windows of 13 words that start in an earlier document
    are removed."""
    return substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents")).drop("spans")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document statistics, the base rule and the trees' verdict."""
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark."""
    return decontaminate.find_contamination(read_table(spark, sf_dir, "documents"),
                                            read_table(spark, sf_dir, "benchmark")).drop("matches")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's wrapper."""
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids packed into sequences."""
    return packing.pack(spark, read_table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without quotations, in reply order."""
    return chat.format_conversations(read_table(spark, sf_dir, "conversations"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on their 16 main components, scaled to variance 1."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document before holds."""
    rows = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, checked on a tampered copy."""
    return merkle.verified(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_ngram_join, op3_toxicity, op4_licenses, op5_substring_dedup, op6_quality_rules,
    op7_decontamination, op8_html_extract, op9_packing, op10_chat_format, op11_whitening, op12_line_dedup,
    op13_merkle_manifest)}

# Window hashes of whole texts, classifiers, packings and the like have no SQL
# here; their queries are tested against brute-force versions.  SQL could
# number the words of whole texts for some of them, but is too slow on whole
# tables.
ORACLE: dict[str, str] = {"op12_line_dedup": line_dedup.ORACLE, "op13_merkle_manifest": merkle.ORACLE}

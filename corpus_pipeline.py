"""Corpus pipeline: toxicity, n-gram Jaccard join, substring dedup, benchmark
decontamination and best-fit packing, one after another.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logflow.llm import decontaminate, ngram_join, packing, substring_dedup, toxicity
from logflow.llm._common import read_table, stored


#: Rows of an Arrow batch: both sides hold a batch of texts whole, and Python
#: works on no more rows than these at a time.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """For the rest of the session, unless it asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, a similarity
    of 0.8 or more), the smallest doc_id."""
    small_batches(spark)
    return ngram_join.keep_one_of_each(docs, k=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start in a document before."""
    small_batches(spark)
    return substring_dedup.cut_substrings(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in packed sequences."""
    small_batches(spark)
    return packing.pack(spark, docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("ngram_join", keep_one_copy),
    ("substring_dedup", cut_repeats),
    ("decontamination", remove_contaminated),
    ("packing", pack_sequences),
]

#: The classifier and the packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

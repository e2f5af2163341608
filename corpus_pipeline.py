"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input.

Rejected documents go in the first stage, copies in the second and third, secrets are masked in the fourth, and the last packs
what is left into training sequences. All but the last return the columns of documents.

This is an application: its stages set the session's Arrow batches to ARROW_ROWS rows, since rows are whole documents here and every
batch is held several times by the executor and its Python worker. Results don't depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import chunk_dedup, ngram_join, packing, quality_rules, secret_scan
from blotter.llm.queries import WORD_BPE
from blotter.llm.shared import table
from blotter.session import scratch_path


#: Rows of an Arrow batch; 10,000 documents, Spark's default, are tens of megabytes.
ARROW_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _small_batches(spark)
    return quality_rules.drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    _small_batches(spark)
    return chunk_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of five-word shingles with a Jaccard similarity of 0.8 or more."""
    _small_batches(spark)
    return ngram_join.drop_near_copies(docs, shingle=5, num=80, den=100)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars counted anew."""
    _small_batches(spark)
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 2048 tokens."""
    _small_batches(spark)
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", near_dedup_stage),
    ("secret_scans", secret_scan_stage),
    ("best_fit_packing", packing_stage),
]

#: Fitted models and packing can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all of documents. Each stage's Parquet lies below the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

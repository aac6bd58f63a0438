"""Corpus preparation as a pipeline of stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and reread as the next stage's documents.  All stages but
the last return the columns of documents.

Texts go to Python in Arrow batches of at most ``BATCH`` rows, for the memory
of an executor holds some copies of a batch for each task.  The stages set
this in the session, because what they return is computed later; a smaller
setting stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm import blob_ledger, decontam, minmax, ordinal, packing
from tallyho.llm.components import row_keyed, saved
from tallyho.llm.queries import grades, table, tokenizer
from tallyho.session import scratch_path

BATCH = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= BATCH:  # 0 or less: no limit
        spark.conf.set(_BATCH_ROWS, str(BATCH))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of a grade above the lowest is at least one half."""
    _small_batches(spark)
    model = ordinal.train(docs, grades(table(spark, sf_dir, "labels")))
    return ordinal.selected(docs, model, grade=1, least=0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates, one row of it; rows that share an id or have none are documents of their own."""
    _small_batches(spark)
    rows = row_keyed(docs)
    dropped = saved(minmax.near_duplicates(rows.select(F.col("__row_key").alias("doc_id"), "text"), width=5, percent=80).where("NOT kept").select(F.col("doc_id").alias("__row_key")), "near-duplicates")
    return rows.join(dropped, "__row_key", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    _small_batches(spark)
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark."""
    found = blob_ledger.findings(docs, scratch_path(spark, "blob-ledger"))
    masked = found.withColumn("text", blob_ledger.redacted(F.col("text"), F.col("found")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.size("found") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in fixed-length sequences."""
    _small_batches(spark)
    return packing.packed(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("secret scans", secrets), ("packing", pack)]

#: A trained model and a tokenizer are in it, so there is no SQL for its rows; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

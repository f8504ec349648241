"""Training-corpus pipeline: the stages in order, each over all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and reread as the next one's ``docs``.
All but the last return the columns of ``documents``.

1. language ID (op 4): documents without a determined language go;
2. near-dedup (op 10): one document of each near-duplicate group stays (five-word
   shingles, a similarity of 0.8 or more);
3. decontamination (op 2): documents that hold enough of the benchmark go;
4. secrets (op 7): every secret found is replaced by a mark, documents stay;
5. packing (op 3): the pieces of all documents left, with their sequence.

The stages set the session's Arrow batches to at most ``BATCH_ROWS`` rows and leave
them so, as a stage's result is computed after its function returns: a task then
holds a few MB of whole texts at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import decontam, langid, minhash, packing, secrets
from shoplens.llm.staging import Staging, documents


BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    spark.conf.set(key, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))     # 0 or less: no bound


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; the model is learned from these documents."""
    small_batches(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of least doc_id."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs, minhash.GENERAL)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark stay."""
    small_batches(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    small_batches(spark)
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    small_batches(spark)
    return packing.pack(docs, packing.byte_bpe_path())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, staging = documents(spark, sf_dir), Staging(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        before, docs = docs, staging.save(stage(spark, docs, sf_dir), name)
        staging.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained model, a genetic algorithm and a guess-cost program are no SQL.
ORACLE_SQL = None

"""A training-data pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidyline.llm import mixing, near_dedup, packing, quality_rules, secrets
from tidyline.llm.common import read_documents, written


#: Rows that an Arrow batch holds at most.  A worker holds the whole texts of a batch at once, beside the JVM's copy.
BATCH_ROWS = 1000


def bounded(docs: DataFrame) -> DataFrame:
    """Bound the batches of this session's Python workers before a stage is planned."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go."""
    return quality_rules.kept_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the least doc_id stays."""
    return near_dedup.kept_rows(bounded(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars is counted anew."""
    return secrets.redact(bounded(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the budgets of their leaves ask for."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pieces(bounded(docs))


STAGES = [("quality_rules", rules), ("near_dedup", near_copies), ("secret_scan", secret_scan), ("mixing", mixture), ("packing", pack)]

#: SQL expresses neither the signatures, the guess costs nor the tokens; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

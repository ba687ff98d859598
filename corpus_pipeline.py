"""A corpus pipeline over ``documents``: rules, near-dedup, decontamination, secrets, encoding.

Each stage takes the session, the documents that the stage before it kept, and the input folder, and its
result is written as Parquet and read again before the next one. All but the last return the columns
of ``documents``; the last returns the encoded documents.

Defined cases follow the operators: null texts fail the rules; rows repeated under one doc_id that
are equal in whole are one document after the near-dedup; an empty table passes as an empty table;
extra columns are carried through all filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from greenlane.llm import decontam, neardup, pieces, rules, secrets
from greenlane.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the learned decision list keep (operator 6)."""
    return rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked at 0.8 on five-word shingles (operator 4)."""
    return neardup.kept_documents(docs, width=5, threshold=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with the benchmark (operator 10)."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and n_chars counted anew (operator 1)."""
    return secrets.redact(docs, count_col="n_chars")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids, their number and whether they decode to the text (operator 3)."""
    return pieces.encoded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]
#: The rules are learned, and sampled encodings are hashes: no SQL gives the rows of ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

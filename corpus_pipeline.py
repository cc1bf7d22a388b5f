"""Corpus pipeline: from raw documents to packed training sequences.

Five stages, each one operator of ``ledgerlens.llm`` over all rows that the
stage before it kept. A stage's result is written as Parquet to the shared
folder and read again as the next stage's documents, so a lost executor costs
at most one stage. All stages but the last return the columns of the
documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, packing, quality, secrets, simhash
from ledgerlens.llm.common import read_table, shared_folder, written
from ledgerlens.llm.tokens import vocabulary_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table; null and
    empty texts go."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.keep_one(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the row with the smallest doc_id."""
    return simhash.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; found secrets are masked and n_chars follows."""
    return secrets.redact(docs, shared_folder(spark, "secret-ledger"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of up to 2048 tokens."""
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("secret scans", secret_stage),
    ("packing", packing_stage),
]

#: Fingerprints, components and packing are beyond SQL; tests/llm holds run()
#: against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs


QUERIES = {"pipeline": run}

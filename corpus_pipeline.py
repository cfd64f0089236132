"""Corpus pipeline: quality rules, exact dedup, near dedup, personal data, packing.

Each stage takes the rows its predecessor kept (read back from Parquet) and works on all of
them. All but the last return the columns of ``documents``; the last returns packed pieces
with their token ids (``ids``: little-endian unsigned 32-bit), so the training sequences are its rows
by sequence_id and offset. Of equal texts the longest row stays, then the smallest doc_id; of near
copies the smallest doc_id. Extra columns, whatever their names, go through all stages but the last.
Empty tables pass through as empty tables; null texts are judged as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import exact_dedup, near_dedup, packing, pii, quality
from medallion.llm.common import read_table, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("pii", personal_data),
    ("packing", packed),
]

#: Hash sketches, regular-expression spans and token ids are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

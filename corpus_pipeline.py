"""Training-data pipeline over ``documents``: five stages, each a DataFrame to a DataFrame.

Every stage works on all rows that its predecessor kept and is written to the shared
folder before the next one reads it, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquia.llm import decontaminate, packing, pii, quality, simhash
from colloquia.llm.common import read_table, saved
from colloquia.llm.queries import tokenizer_paths


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    return pii.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of training sequences."""
    return packing.pack(docs, *tokenizer_paths())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_masking", pii_masking),
    ("sequence_packing", sequence_packing),
]

#: Trained trees and fingerprint components have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}

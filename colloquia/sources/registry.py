"""The source registry: a tiny dimension table joined to corpora by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Registry enumerations.
STATUSES = ("planned", "active", "excluded")
REGISTERS = ("puhekieli", "mixed", "kirjakieli")
ROLES = ("pairs", "flavor", "synth")

# Registered sources as (name, register, role, status, note).
SOURCES = (
    ("opensubtitles_enfi", "mixed", "pairs", "active", "subtitle dialogue pairs"),
    ("opus_100", "mixed", "pairs", "active", "broad mixed-domain pairs"),
    ("genius_rap", "puhekieli", "flavor", "active", "curated seed lyric lines"),
    ("rap_synthetic", "puhekieli", "synth", "active", "back-translated seed lines"),
)

SCHEMA = "name string, register string, role string, status string, note string"


def source_registry(spark: SparkSession, rows=SOURCES) -> DataFrame:
    df = spark.createDataFrame(list(rows), SCHEMA)
    valid = (F.col("status").isin(*STATUSES) & F.col("register").isin(*REGISTERS)
             & F.col("role").isin(*ROLES))
    return df.where(valid)


def active_sources(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("status") == "active")

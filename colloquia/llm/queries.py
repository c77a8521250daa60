"""The registered queries of this subpackage: one thin query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.llm import (alignment, bytebpe, decontaminate, langid, licenses, lm, oracle, packing, phrases,
                           pii, quality, rules, secrets, simhash)
from colloquia.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op2_pii", oracle.personal_data())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read_table(spark, sf_dir, "documents"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


@query("op4_rules", rules.oracle())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.evaluate(read_table(spark, sf_dir, "documents")).drop("clean_text")


@query("op5_secrets", oracle.secret_scan("source || '/' || lang", "source"))
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a source owns its documents and has one repository per language
    return secrets.scan(read_table(spark, sf_dir, "documents"),
                        F.concat_ws("/", "source", "lang"), F.col("source"))


def tokenizer_paths() -> tuple[str, str]:
    """The public byte-level BPE that packing counts with, and the same as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), *tokenizer_paths())


@query("op7_licenses", oracle.licence_scan())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


@query("op8_decontamination", oracle.decontamination())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op10_lm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(docs))


@query("op9_langid")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def encoded_digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bytebpe.decode(bytebpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                      F.sha2("bytes", 256).alias("decoded_sha256"))


@query("op13_bytebpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digest(read_table(spark, sf_dir, "documents"))


def aligned(docs: DataFrame) -> alignment.Alignment:
    import public_tokenizers

    return alignment.Alignment(docs, alignment.Tokenizers(*tokenizer_paths(), public_tokenizers.path("piece_bpe_32k.model")))


@query("op11_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aligned(read_table(spark, sf_dir, "documents")).by_document()
    return out.withColumnRenamed("groups", "groups_sha256")


@query("op12_phrases", oracle.collocations())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))

"""Whole stages over a user's own folders: collect, synthesise, tokenise, compose.

Each stage reads folders and writes folders; the registered queries call these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.operators import chat as C
from colloquia.operators import clean
from colloquia.operators import split as SP
from colloquia.operators import synth as S
from colloquia.operators import vocab as V
from colloquia.sources import seed
from colloquia.sources.jsonl import FLAVOR_SCHEMA, PAIR_SCHEMA, read_jsonl, write_jsonl
from colloquia.sources.pairs import pairs_scan_flat, pairs_scan_nested
from colloquia.sources.textfile import write_token_lines, write_vocab


def flavor_of_files(spark: SparkSession, seed_path: str) -> DataFrame:
    """The flavor corpus of a folder of ``artist_<name>.txt`` files."""
    return clean.flavor_corpus(seed.read_seed_lines(spark, seed_path),
                               chunk_bound=seed.seed_chunk_bound(spark, seed_path))


def collect_flavor(spark: SparkSession, seed_path: str, out: str) -> int:
    """Seed files -> flavor JSONL; returns the rows written."""
    return write_jsonl(flavor_of_files(spark, seed_path).drop("idx"), out)


def pair_corpus(spark: SparkSession, path: str, source: str, nested: bool, out: str,
                max_pairs: int | None = None) -> int:
    """Scan -> clean -> cap (none by default) -> JSONL, one corpus; returns the rows written."""
    raw = pairs_scan_nested(spark, path) if nested else pairs_scan_flat(spark, path)
    pairs = clean.pair_clean(raw, source)
    if max_pairs is not None:
        pairs = clean.pair_cap(pairs, max_pairs)
    return write_jsonl(pairs.select("source", "id", "en", "fi", "register"), out)


def synthesise(spark: SparkSession, flavor_path: str, out: str, factory: S.TranslatorFactory,
               model: str, limit: int | None = None) -> int:
    """Back-translate the lines of a flavor JSONL that ``out`` does not hold yet."""
    lines = read_jsonl(spark, flavor_path, FLAVOR_SCHEMA).select(
        "id", "fi", F.regexp_extract("id", "([0-9]+)$", 1).cast("long").alias("idx"))
    return S.run_synthesis(spark, lines, out, factory, model, limit)


def fi_text_union(flavor: DataFrame, synth: DataFrame) -> DataFrame:
    """``id, fi`` of the flavor and the synthetic lines."""
    return flavor.select("id", "fi").unionByName(synth.select("id", "fi"))


def tokenise(spark: SparkSession, flavor_path: str, synth_path: str, vocab_out: str, lines_out: str,
             vocab_size: int = V.WORD_VOCAB_SIZE) -> None:
    """Word vocabulary of the collected lines, and the lines as vocabulary tokens."""
    texts = fi_text_union(read_jsonl(spark, flavor_path, FLAVOR_SCHEMA), read_jsonl(spark, synth_path, PAIR_SCHEMA))
    counts = V.word_counts(texts, "fi", ["id"])
    vocab = V.vocab_final(V.vocab_level_order(counts, vocab_size), vocab_size)
    write_vocab(vocab, vocab_out)
    write_token_lines(V.whitespace_tokenize(texts, "fi", ["id"], vocab), "tokens", lines_out)


def compose(flavor: DataFrame, synth: DataFrame) -> DataFrame:
    """Training composition: all flavor rows, and the synthetic rows split exactly."""
    return C.compose_train(flavor, SP.split_exact(synth, "id"))

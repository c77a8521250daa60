"""Corpus inputs derived by Spark from the given tables.

The test tables hold no Finnish, no seed files and no parallel corpus, so the
registered queries derive them (whole tables, no sampling):

* document lines ``DL``: every line of every document;
* line pairs ``LP``: each line with the next line of the same document, as a
  flat parallel corpus ``pos, english, non_english`` (pos in document order);
* seed view: per document a ``#`` title line (a bare ``#`` for German
  documents, which resets the title), a bracket tag, then the document's
  lines, the first carrying an ``<id>Embed`` suffix; one seed file per source.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.functions import text as T
from colloquia.operators.clean import explode_lines
from colloquia.operators.order import dense_index, input_bytes
from colloquia.session import shuffles_dropped, table  # noqa: F401  (re-exported)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def doc_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, line_no, line`` (DL)."""
    return explode_lines(docs, "text", ["doc_id", "source", "lang"])


def line_pairs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_pairs`` of a table folder."""
    return line_pairs(documents(spark, sf_dir))


def line_pairs(docs: DataFrame) -> DataFrame:
    """``pos, english, non_english`` (LP): consecutive lines within a document.

    Pairs are built inside each document's line array (no shuffle); only the
    global position needs the range-partitioned dense index.
    """
    arr = docs.select("doc_id", T.split_lines("text").alias("ls"))
    # sequence() counts down when stop < start, so guard short documents
    starts = F.when(F.size("ls") >= 2, F.sequence(F.lit(0), F.size("ls") - 2)).otherwise(
        F.array().cast("array<int>"))
    pairs = arr.select("doc_id", F.explode(F.transform(
        starts, lambda i: F.struct(i.alias("line_no"),
                                   F.element_at("ls", i + 1).alias("english"),
                                   F.element_at("ls", i + 2).alias("non_english")))).alias("p"))
    flat = pairs.select("doc_id", "p.line_no", "p.english", "p.non_english")
    return dense_index(flat, ["doc_id", "line_no"], "pos").select("pos", "english", "non_english")


DOC_BLOCK = 4_096   # document ids whose titles are carried together


BYTES_PER_FILE = 16 << 20   # of the tables' files behind one file of a stream's input


def stream_input(df: DataFrame, path: str, form: str) -> int:
    """Write a stream's input, to arrive in two batches; returns the files of a batch.

    Files follow the input's size, so none is written by a task that gets half the rows."""
    n = max(1, input_bytes(df) // (2 * BYTES_PER_FILE))
    with shuffles_dropped(df.sparkSession):
        df.repartition(2 * n).write.format(form).option("compression", "gzip" if form == "json" else "zstd").save(path)
    return n


def seed_view(docs: DataFrame) -> DataFrame:
    """``file, artist, chunk, pos, line``: the seed-file view of the documents."""
    title = F.when(F.col("lang") == "de", F.lit("#")).otherwise(
        F.concat(F.lit("# "), F.col("source"), F.lit(" "), F.col("doc_id").cast("string")))
    tag = F.concat(F.lit("["), F.col("lang"), F.lit("]"))
    body = explode_lines(docs, "text", ["doc_id", "source", "lang"])
    body = body.select(
        "doc_id", "source", F.col("line_no").cast("long").alias("pos"),
        F.when(F.col("line_no") == 0, F.concat(F.col("line"), F.col("doc_id").cast("string"),
                                                F.lit("Embed"))).otherwise(F.col("line"))
        .alias("line"))
    heads = docs.select("doc_id", "source", F.array(
        F.struct(F.lit(-2).cast("long").alias("pos"), title.alias("line")),
        F.struct(F.lit(-1).cast("long").alias("pos"), tag.alias("line"))).alias("h"))
    heads = heads.select("doc_id", "source", F.inline("h"))
    lines = body.unionByName(heads)
    name = F.concat(F.lit("artist_"), F.col("source"))
    return lines.select(F.concat(name, F.lit(".txt")).alias("file"),
                        F.translate(name, "_", " ").alias("artist"),
                        F.col("doc_id").alias("chunk"), "pos", "line")



# --- a deterministic stand-in translator for tests and the registered queries ----

_DIGIT = re.compile(r"[0-9]")


def mirror_translator_factory(model: str = "", system: str = "", temperature: float = 0.0,
                              max_tokens: int = 0,
                              reasoning_effort: str = "") -> Callable[[list[str]], list[str]]:
    """Reverses word order; fails on digits, returns an empty quote pair on '?',
    and wraps answers in a think block and quotes like a chatty model."""

    def translate(texts: list[str]) -> list[str]:
        out = []
        for t in texts:
            if _DIGIT.search(t):
                raise ValueError("digits in input")
            if "?" in t:
                out.append('""')
                continue
            out.append('<think>fi-en</think>\n"' + " ".join(reversed(t.split(" "))) + '"')
        return out

    return translate

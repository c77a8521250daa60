"""Back-translation as a resumable batch job, plus model-output tidying.

The translation call is caller-supplied: ``factory(model, system, temperature,
max_tokens)`` returns ``translate(list[str]) -> list[str]``.  One translator is
built per partition and fed Arrow batches through ``mapInPandas``; a failing
batch is retried row by row so each error lands on its own row instead of
aborting the task.  Results are appended keyed by id, and a rerun anti-joins
the ids already written, so a crashed or repeated run never redoes finished
rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from colloquia.functions import text as T
from colloquia.operators.clean import first_n
from colloquia.session import (drop_table, path_exists, reliable_checkpoint, scratch_path, ship_package,
                               write_table)

SYSTEM_PROMPT = (
    "Translate one line of spoken Finnish into plain everyday English. Reply with the "
    "translation alone. A line that is not Finnish stays as it is."
)
# Settings of a back-translation request.
NO_THINK = " /no_think"
MAX_TOKENS = 1024
TEMPERATURE = 0.2
REASONING_EFFORT = "low"
SLICES = 8   # parts of a run that are committed one after another
FILE_ROWS = 1 << 19   # rows of one file of pairs
SYNTH_SOURCE, SYNTH_REGISTER, SYNTH_PREFIX = "rap_synthetic", "puhekieli", "synth-"
# Quote characters the tidier may strip (opening, closing).
OPEN_QUOTES = ('"', "'", "“", "‘")
CLOSE_QUOTES = ('"', "'", "”", "’")
PROMPT_PREFIX = "Translate to Finnish: "

TranslatorFactory = Callable[..., Callable[[list[str]], list[str]]]


def system_prompt(model: str) -> str:
    return SYSTEM_PROMPT + (NO_THINK if "qwen" in model.lower() else "")


def tidy_output(c: Column) -> Column:
    """Strip, drop ``<think>...</think>`` blocks, strip one surrounding quote pair."""
    def unquoted(t: Column) -> Column:
        quoted = ((F.length(t) >= 2) & F.substring(t, 1, 1).isin(*OPEN_QUOTES)
                  & F.substring(t, -1, 1).isin(*CLOSE_QUOTES))
        return F.when(quoted, T.strip(t.substr(F.lit(2), F.length(t) - F.lit(2)))).otherwise(t)

    return T.bound(T.strip(F.regexp_replace(T.strip(c), "(?s)<think>.*?</think>", "")), unquoted)


def reply_tidy(c: Column) -> Column:
    """Text after the first ``</think>`` (when present), stripped."""
    after = F.regexp_replace(c, "(?s)^.*?</think>", "")
    return T.strip(F.when(c.contains("</think>"), after).otherwise(c))


def prompt_normalise(c: Column) -> Column:
    """Prefix ``Translate to Finnish: `` unless the text already starts with it."""
    has = F.lower(c).startswith("translate to finnish")
    return F.when(has, c).otherwise(F.concat(F.lit(PROMPT_PREFIX), c))


def backtranslate(df: DataFrame, factory: TranslatorFactory, model: str,
                  text_col: str = "fi", id_col: str = "id",
                  num_partitions: int | None = None) -> DataFrame:
    """``id, fi, en_raw, error`` for every input row (one call per row or batch)."""
    ship_package(df.sparkSession)
    system = system_prompt(model)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("fi"))
    if num_partitions:
        src = src.repartition(num_partitions)   # even inference tasks

    def run(batches: Iterable):
        import pandas as pd

        translate = factory(model=model, system=system, temperature=TEMPERATURE,
                            max_tokens=MAX_TOKENS, reasoning_effort=REASONING_EFFORT)

        def attempt(texts: list[str], outs: list, errs: list, at: int) -> None:
            """Translate, halving a failing batch until the failing rows stand alone."""
            try:
                got = list(translate(texts))
                if len(got) != len(texts):
                    raise ValueError("translator returned a different number of rows")
                outs[at:at + len(texts)] = got
            except Exception as exc:  # noqa: BLE001 -- isolate the failing rows
                if len(texts) == 1:
                    errs[at] = f"{type(exc).__name__}: {exc}"
                    return
                half = len(texts) // 2
                attempt(texts[:half], outs, errs, at)
                attempt(texts[half:], outs, errs, at + half)

        for pdf in batches:
            texts = pdf["fi"].tolist()
            outs: list = [None] * len(texts)
            errs: list = [None] * len(texts)
            if texts:
                attempt(texts, outs, errs, 0)
            yield pd.DataFrame({"id": pdf["id"], "fi": pdf["fi"], "en_raw": outs, "error": errs})

    return src.mapInPandas(run, "id string, fi string, en_raw string, error string")


def pairs_from_translations(raw: DataFrame) -> DataFrame:
    """Successful, non-trivial translations as pairs (FI side is the original)."""
    ok = raw.where(F.col("error").isNull() & F.col("en_raw").isNotNull())
    ok = T.compute_once(ok, ["id", "fi"], en=tidy_output(F.col("en_raw")))
    return ok.where(F.length("en") >= 2).select(
        F.lit(SYNTH_SOURCE).alias("source"),
        F.concat(F.lit(SYNTH_PREFIX), F.col("id")).alias("id"),
        "en", "fi", F.lit(SYNTH_REGISTER).alias("register"))


def first_rows(source: DataFrame, limit: int | None, order_col: str = "idx",
               dense: bool = False) -> DataFrame:
    """The first ``limit`` rows (0/None = all).  A caller who knows that ``order_col``
    is a dense 0-based index (the whole flavor corpus' ``idx``) gets a plain filter."""
    if not limit:
        return source
    if dense:
        return source.where(F.col(order_col) < limit)
    return first_n(source, limit, [order_col])


def plan_batch(source: DataFrame, existing: DataFrame | None, limit: int | None,
               order_col: str = "idx", dense: bool = False) -> DataFrame:
    """Rows of this run: the first ``limit`` source rows (0/None = all), minus
    those whose ``synth-<id>`` is already written (anti join on id)."""
    batch = first_rows(source, limit, order_col, dense)
    if existing is None:
        return batch
    done = existing.select(F.col("id").alias("_done_id"))
    return batch.join(done, F.concat(F.lit(SYNTH_PREFIX), F.col("id")) == F.col("_done_id"),
                      "left_anti")


def synthesize(source: DataFrame, existing: DataFrame | None, factory: TranslatorFactory,
               model: str, limit: int | None = None, num_partitions: int | None = None,
               order_col: str = "idx", dense: bool = False) -> tuple[DataFrame, DataFrame]:
    """One run: ``(all_pairs, raw)``; all_pairs = existing rows then new rows.

    The translations are materialised once (reliable checkpoint): every later
    action reads them back instead of calling the translator again.
    """
    todo = plan_batch(source, existing, limit, order_col, dense)
    raw = reliable_checkpoint(backtranslate(todo, factory, model, num_partitions=num_partitions))
    new = pairs_from_translations(raw)
    out = new if existing is None else existing.select(
        "source", "id", "en", "fi", "register").unionByName(new)
    return out, raw


def synth_progress(source: DataFrame, existing: DataFrame | None, raw: DataFrame,
                   limit: int | None, order_col: str = "idx", dense: bool = False) -> DataFrame:
    """``status, n``: skipped (already done), failed, dropped (empty/short), added."""
    batch = first_rows(source, limit, order_col, dense)
    n_batch = batch.select(F.count(F.lit(1))).scalar()
    en = tidy_output(F.col("en_raw"))
    status = (F.when(F.col("error").isNotNull(), F.lit("failed"))
              .when(F.col("en_raw").isNull() | (F.length(en) < 2), F.lit("dropped"))
              .otherwise(F.lit("added")))
    # a few rows; materialised so the translations are read once
    counted = reliable_checkpoint(raw.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("n")))
    n_raw = counted.select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    skipped = source.sparkSession.range(1).select(F.lit("skipped").alias("status"),
                                                  (n_batch - n_raw).alias("n"))
    return counted.unionByName(skipped)


def errors_path(out_path: str) -> str:
    """Where a run into ``out_path`` records its failures (``id, fi, error``)."""
    return out_path.rstrip("/") + "_errors"


def run_synthesis(spark: SparkSession, source: DataFrame, out_path: str,
                  factory: TranslatorFactory, model: str, limit: int | None = None,
                  existing_schema=None, order_col: str = "idx", dense: bool = False,
                  slices: int = SLICES) -> int:
    """Resumable run: read what ``out_path`` holds, translate the rest, append.

    Returns the number of new rows.  The run is cut into ``slices`` by id hash and
    each is committed when it is done, so a run that dies keeps its finished slices;
    the next run translates what is missing, failed rows included.  Failures are
    appended to ``errors_path``.
    """
    from colloquia.sources.jsonl import PAIR_SCHEMA, read_jsonl

    existing = None
    if path_exists(out_path):   # first run: nothing written yet
        existing = read_jsonl(spark, out_path, existing_schema or PAIR_SCHEMA)
    # the rows of this run are fixed before any slice adds to the output
    path = scratch_path(spark, "synthesis-todo")
    todo = plan_batch(source, existing, limit, order_col, dense).select(
        "id", "fi", F.pmod(F.xxhash64("id"), F.lit(slices)).alias("_slice"))
    todo = write_table(todo, path, ["_slice"])   # a slice reads its own files only
    n = 0
    for k in range(slices):
        n += translate_into(todo.where(F.col("_slice") == k), factory, model, out_path, errors_path(out_path), "append")
        drop_table(spark, f"{path}/_slice={k}")   # it is committed
    return n


def translate_into(todo: DataFrame, factory: TranslatorFactory, model: str, out_path: str,
                   err_path: str, mode: str) -> int:
    """Translate rows and write their pairs and failures; returns the pairs' number.

    The translator is called once per row: its answers are written, read for both outputs
    and dropped when these are committed."""
    path = scratch_path(todo.sparkSession, "translated")
    n = write_translations(write_table(backtranslate(todo, factory, model), path), out_path, err_path, mode)
    drop_table(todo.sparkSession, path)
    return n


def write_translations(raw: DataFrame, out_path: str, err_path: str, mode: str) -> int:
    """Write the pairs and the failures of translated rows; returns the pairs' number."""
    raw.where(F.col("error").isNotNull()).select("id", "fi", "error").write.mode(mode).json(err_path)
    return write_pairs(pairs_from_translations(raw), out_path, mode)


def write_pairs(pairs: DataFrame, path: str, mode: str) -> int:
    """Write pairs as gzipped JSON Lines, in files of bounded length (a gzipped file is read
    by one task); returns their number."""
    obs = Observation("pairs")
    (pairs.observe(obs, F.count(F.lit(1)).alias("rows"))
          .write.mode(mode).option("ignoreNullFields", "false").option("maxRecordsPerFile", FILE_ROWS)
          .json(path, compression="gzip"))
    return int(obs.get["rows"])

"""Chat-formatted rows, training composition and fixed-length model rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquia.functions.text import json_string, ws_split
from colloquia.operators.vocab import joined_tokens, mapped_tokens, small_mapping

# The reference's chat prompts and training settings.
PAIR_PROMPT = "Translate to Finnish: "
FLAVOR_PROMPT = "Generate Finnish text:"
MAX_LEN = 512
BATCH_SIZE = 4
EPOCHS = 2
WARMUP_STEPS = 250
IGNORE_LABEL = -100


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_rows_pairs(df: DataFrame, en_col: str = "en", fi_col: str = "fi") -> DataFrame:
    """Append ``messages``: user asks for a translation, assistant answers in FI."""
    user = F.concat(F.lit(PAIR_PROMPT), F.coalesce(F.col(en_col), F.lit("")))
    return df.withColumn("messages", F.array(
        message("user", user), message("assistant", F.coalesce(F.col(fi_col), F.lit("")))))


def reference_json_line(df: DataFrame) -> Column:
    """A flavor record as the reference's JSON writer prints it (", " / ": ")."""
    def field(name: str, c: Column) -> Column:
        return F.concat(F.lit(f'"{name}": '), json_string(c))
    meta = F.concat(F.lit('"meta": {'), field("artist", F.col("meta.artist")), F.lit(", "),
                    field("title", F.col("meta.title")), F.lit("}"))
    return F.concat(F.lit("{"), field("source", F.col("source")), F.lit(", "),
                    field("id", F.col("id")), F.lit(", "), field("fi", F.col("fi")), F.lit(", "),
                    field("register", F.col("register")), F.lit(", "), meta, F.lit("}"))


def chat_rows_flavor(df: DataFrame, mode: str = "intended") -> DataFrame:
    """Append ``messages`` for FI-only rows.

    ``mode='reference'`` answers with the whole JSON record line (what the
    reference trains on); the default answers with the ``fi`` text.
    """
    answer = reference_json_line(df) if mode == "reference" else F.col("fi")
    return df.withColumn("messages", F.array(message("user", F.lit(FLAVOR_PROMPT)),
                                             message("assistant", answer)))


def formatted_text(messages: Column) -> Column:
    """``role: content`` lines of a conversation."""
    return F.concat_ws("\n", F.transform(
        messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])))


def compose_train(flavor: DataFrame, synth_split: DataFrame) -> DataFrame:
    """``id, fi, role, split``: all flavor rows train; synthetic rows keep their split."""
    fl = flavor.select("id", "fi", F.lit("flavor").alias("role"), F.lit("train").alias("split"))
    sy = synth_split.select("id", "fi", F.lit("synth").alias("role"), "split")
    return fl.unionByName(sy)


def composition_summary(composed: DataFrame) -> DataFrame:
    """Counts per (split, role) with subtotals per split and a grand total."""
    return composed.rollup("split", "role").agg(F.count(F.lit(1)).alias("n"))


def step_plan(composed: DataFrame, batch_size: int = BATCH_SIZE, epochs: int = EPOCHS,
              warmup: int = WARMUP_STEPS) -> DataFrame:
    """One row: optimizer steps per epoch, total steps, effective warm-up."""
    n_train = F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("long")
    n_valid = F.sum(F.when(F.col("split") == "valid", 1).otherwise(0)).cast("long")
    agg = composed.agg(n_train.alias("n_train"), n_valid.alias("n_valid"))
    per_epoch = F.ceil(F.col("n_train") / F.lit(batch_size)).cast("long")
    total = per_epoch * F.lit(epochs)
    return agg.select("n_train", "n_valid", per_epoch.alias("steps_per_epoch"),
                      total.alias("total_steps"),
                      F.least(F.lit(warmup).cast("long"),
                              F.greatest(F.lit(1).cast("long"),
                                         F.floor(total / 10).cast("long"))).alias("warmup_steps"))


def token_ids(df: DataFrame, text_col: str, key_cols: Sequence[str], vocab: DataFrame,
              unk_id: int, max_tokens: int | None = None) -> DataFrame:
    """``key_cols..., ids``: vocabulary id of every whitespace token (lower-cased
    lookup), ``unk_id`` when missing, in token order.

    With ``max_tokens`` the rest of a text is cut before any lookup.  A vocabulary
    of checked size is mapped in place; a larger one is joined."""
    toks = F.coalesce(ws_split(F.col(text_col)), F.array().cast("array<string>"))
    toks = toks if max_tokens is None else F.slice(toks, 1, max_tokens)
    voc = vocab.groupBy(F.col("token").alias("_vtok")).agg(F.min("token_id").alias("_vid"))
    rows = small_mapping(voc, "_vtok", "_vid")
    if rows is not None:
        ids = df.sparkSession.sparkContext.broadcast({r["_vtok"]: r["_vid"] for r in rows})
        look = mapped_tokens(df.sparkSession, "int", lambda t, low: ids.value.get(low, unk_id))
        return df.select(*key_cols, look(toks).alias("ids"))
    value = F.coalesce(F.col("_vid"), F.lit(unk_id)).cast("int")
    return joined_tokens(df, toks, key_cols, voc, value, "ids")


def chunked_ids(ids: Column, max_len: int) -> Column:
    """``ids`` cut into consecutive arrays of at most ``max_len - 1``, so that
    ``fixed_length_rows`` of the chunks keeps every token."""
    step = max_len - 1
    starts = F.sequence(F.lit(1), F.greatest(F.size(ids), F.lit(1)), F.lit(step))
    return F.transform(starts, lambda i: F.slice(ids, i, step))


def fixed_length_rows(ids: Column, eos_id: int, max_len: int = MAX_LEN) -> Column:
    """``struct(input_ids, attention_mask, labels)`` of length ``max_len``.

    EOS is appended, the sequence truncated, then padded with EOS (pad = EOS
    as in the reference); labels mask every pad id, so EOS is masked too.
    """
    body = F.slice(F.concat(ids, F.array(F.lit(eos_id))), 1, max_len)
    n_pad = F.lit(max_len) - F.size(body)
    input_ids = F.concat(body, F.array_repeat(F.lit(eos_id), n_pad))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(body)), F.array_repeat(F.lit(0), n_pad))
    labels = F.transform(input_ids, lambda x: F.when(x == eos_id, F.lit(IGNORE_LABEL))
                         .otherwise(x))
    return F.struct(input_ids.alias("input_ids"), mask.alias("attention_mask"),
                    labels.alias("labels"))

"""The registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the given tables (or data Spark
derives from them) in full and returns a DataFrame whose column names match
the DuckDB oracle in ``ORACLE``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquia.functions.register import STANDIN_LEXICON
from colloquia.operators import bpe as B
from colloquia.operators import chat as C
from colloquia.operators import clean
from colloquia.operators import split as SP
from colloquia.operators import synth as S
from colloquia.operators import vocab as V
from colloquia.operators.order import dense_index
from colloquia.operators.register import marker_counts, register_rate, score_texts
from colloquia.plans import fixtures as fx
from colloquia.plans import oracle as O
from colloquia.plans import stages
from colloquia.session import drop_scratch, model_folder, reliable_checkpoint, scratch_path
from colloquia.sources import registry as R
from colloquia.sources import seed as seed_src
from colloquia.sources.jsonl import FLAVOR_SCHEMA, PAIR_SCHEMA, read_jsonl, write_jsonl
from colloquia.sources.pairs import FLAT_SCHEMA
from colloquia.sources.pairs import pairs_scan_flat, pairs_scan_nested, to_nested
from colloquia.sources.songs import (MAX_PAGES, MAX_SONGS, read_song_lists, song_listing,
                                     write_song_lists)
from colloquia.sources.textfile import vocab_scan, write_token_lines, write_vocab
from colloquia.streaming import pipelines as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


# --- 2.2 cleaning, dedup, ids ---------------------------------------------------

@query("split_lines", O.sql("SELECT doc_id, line_no, line FROM dl", "dl"))
def q_split_lines(spark, sf):
    return fx.doc_lines(fx.documents(spark, sf)).select("doc_id", "line_no", "line")


@query("lyric_line_clean", O.sql(f"""
SELECT doc_id, line_no - 1 AS line_no, line FROM (
  SELECT doc_id, line_no, {O.clean_line('raw')} AS line FROM (
    SELECT doc_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS line_no,
           unnest(parts) AS raw
    FROM (SELECT doc_id, {O.split_lines('raw')} AS parts FROM (
      SELECT doc_id, '[' || lang || ']' || chr(10) || text || chr(10)
             || 'You might also like ' || source || 'Lyrics' AS raw FROM documents))))
WHERE line IS NOT NULL"""))
def q_lyric_line_clean(spark, sf):
    docs = fx.documents(spark, sf)
    # raw text with a bracket tag before and a cruft line after every document
    raw = docs.select("doc_id", F.concat(
        F.lit("["), F.col("lang"), F.lit("]\n"), F.col("text"), F.lit("\n"),
        F.lit("You might also like "), F.col("source"), F.lit("Lyrics")).alias("text"))
    out = clean.lyric_line_clean(raw, "text", ["doc_id"])
    # renumber to the document's own line numbers (tag = -1, cruft line = last)
    return out.select("doc_id", (F.col("line_no") - 1).alias("line_no"), "line")


@query("dedup_first", O.sql("""
SELECT doc_id, line_no, line FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(line) ORDER BY doc_id, line_no) AS rn FROM dl)
WHERE rn = 1""", "dl"))
def q_dedup_first(spark, sf):
    lines = fx.doc_lines(fx.documents(spark, sf)).select("doc_id", "line_no", "line")
    return clean.dedup_first(lines, "line", ["doc_id", "line_no"])


@query("dense_index", O.sql("""
SELECT doc_id, line_no, CAST(row_number() OVER (ORDER BY doc_id, line_no) - 1 AS BIGINT) AS idx
FROM dl""", "dl"))
def q_dense_index(spark, sf):
    lines = fx.doc_lines(fx.documents(spark, sf)).select("doc_id", "line_no")
    return dense_index(lines, ["doc_id", "line_no"], "idx")


# --- 2.3 register scoring ----------------------------------------------------------

def _clean_dedup_lines(spark, sf) -> DataFrame:
    docs = fx.documents(spark, sf)
    lines = clean.lyric_line_clean(docs, "text", ["doc_id", "source"])
    return clean.dedup_first(lines, "line", ["doc_id", "line_no"])


FLAGSHIP_SQL = O.sql(f"""
SELECT source, CAST(count(*) AS BIGINT) AS n_texts,
       CAST(sum(CASE WHEN score > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_spoken,
       CAST(sum(CASE WHEN score > 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS rate
FROM (SELECT source, {O.score('puhe', 'kirja')} AS score FROM (
        SELECT source, {O.scored_cols('line', O.STANDIN)} FROM (
          SELECT *, row_number() OVER (PARTITION BY lower(line) ORDER BY doc_id, line_no) AS rn
          FROM (SELECT doc_id, source, line_no, {O.clean_line('line')} AS line FROM dl)
          WHERE line IS NOT NULL)
        WHERE rn = 1))
GROUP BY source""", "dl")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Spoken-leaning rate per source of the cleaned, deduplicated lines."""
    scored = score_texts(_clean_dedup_lines(spark, sf), "line", STANDIN_LEXICON)
    return register_rate(scored, ["source"]).select("source", "n_texts", "n_spoken", "rate")


query("register_rate", FLAGSHIP_SQL)(flagship)


@query("register_score", O.sql(f"""
SELECT doc_id, puhe, kirja, {O.score('puhe', 'kirja')} AS score
FROM (SELECT doc_id, {O.scored_cols('text', O.STANDIN)} FROM documents)"""))
def q_register_score(spark, sf):
    docs = fx.documents(spark, sf)
    return score_texts(docs, "text", STANDIN_LEXICON).select("doc_id", "puhe", "kirja", "score")


def _lexicon_sql(lex) -> str:
    rows = [f"('{w}', '{side}', {n})" for w, side, n in lex.rows()]
    return "(VALUES " + ", ".join(rows) + ") AS lex(word, side, weight)"


def _marker_sql(lex) -> str:
    return f"""
SELECT lex.word, lex.side, CAST(lex.weight AS INTEGER) AS weight,
       CAST(coalesce(h.hits, 0) AS BIGINT) AS hits,
       CAST(coalesce(h.hits, 0) * lex.weight AS BIGINT) AS weighted
FROM {_lexicon_sql(lex)}
LEFT JOIN (SELECT word, count(*) AS hits
           FROM (SELECT unnest({O.tokens('text')}) AS word FROM documents)
           GROUP BY word) h ON h.word = lex.word"""


@query("marker_lexicon", O.sql(_marker_sql(O.LEX)))
def q_marker_lexicon(spark, sf):
    """The reference's lexicon with its hit counts over the documents."""
    return marker_counts(fx.documents(spark, sf), "text")


@query("marker_counts", O.sql(_marker_sql(O.STANDIN)))
def q_marker_counts(spark, sf):
    return marker_counts(fx.documents(spark, sf), "text", STANDIN_LEXICON)


@query("corpus_peek", O.sql(f"""
SELECT doc_id, text, puhe, kirja, {O.score('puhe', 'kirja')} AS score,
       (SELECT CAST(count(*) AS BIGINT) FROM documents) AS n_rows
FROM (SELECT doc_id, text, {O.scored_cols('text')} FROM documents ORDER BY doc_id LIMIT 8)"""))
def q_corpus_peek(spark, sf):
    docs = fx.documents(spark, sf)
    n_rows = docs.select(F.count(F.lit(1))).scalar()   # scalar subquery, one value
    head = score_texts(docs.select("doc_id", "text").orderBy("doc_id").limit(8), "text")
    return head.select("doc_id", "text", "puhe", "kirja", "score", n_rows.alias("n_rows"))


# --- seed files, titles, flavor corpus ------------------------------------------------


def write_seed_fixture(spark, sf) -> str:
    """Write the documents' seed view as one ``artist_<source>.txt`` per source."""
    path = scratch_path(spark, "seed")
    view = fx.seed_view(fx.documents(spark, sf))
    written = seed_src.write_named_text_files(
        view.withColumn("name", F.regexp_replace("file", "\\.txt$", "")),
        path, "name", "line", ["chunk", "pos"])
    written.collect()   # one row per written file
    return path


def flavor_from_documents(spark, sf) -> DataFrame:
    """The flavor corpus of the documents' seed view, without writing files."""
    return clean.flavor_corpus(fx.seed_view(fx.documents(spark, sf)), chunk_block=fx.DOC_BLOCK)


def written_flavor(spark, sf) -> DataFrame:
    """The flavor corpus as a later stage finds it: written once (by its numbering), read several times."""
    return flavor_from_documents(spark, sf)


def _flat_flavor(df: DataFrame) -> DataFrame:
    return df.select("id", "fi", "source", "register", F.col("meta.artist").alias("artist"),
                     F.col("meta.title").alias("title"))


FLAVOR_SQL = O.sql("SELECT id, fi, source, register, artist, title FROM flavor", "flavor")


@query("seed_text_scan", O.sql("""
SELECT file, artist,
       CAST(row_number() OVER (PARTITION BY file ORDER BY chunk, pos) - 1 AS BIGINT) AS line_no,
       line
FROM seed""", "seed"))
def q_seed_text_scan(spark, sf):
    return seed_src.seed_text_scan(spark, write_seed_fixture(spark, sf))


@query("song_title_tag", O.sql("""
SELECT file, artist, chunk, pos, title, s AS line FROM seed_titled WHERE NOT is_title""",
                               "seed_titled"))
def q_song_title_tag(spark, sf):
    titled = clean.tag_titles(fx.seed_view(fx.documents(spark, sf)), ["file"], "chunk", "pos",
                              chunk_block=fx.DOC_BLOCK)
    return titled.where(~F.col("is_title")).select(
        "file", "artist", "chunk", "pos", "title", F.col("s").alias("line"))


@query("flavor_corpus", FLAVOR_SQL)
def q_flavor_corpus(spark, sf):
    return _flat_flavor(stages.flavor_of_files(spark, write_seed_fixture(spark, sf)))


# --- parallel pairs ------------------------------------------------------------------------

def _pair_sql(src: str, table_name: str = "lp") -> str:
    en, fi = O.strip("english"), O.strip("non_english")
    return f"""
SELECT '{src}' AS source, '{src}-' || CAST(pos AS VARCHAR) AS id,
       {O.collapse(en)} AS en, {O.collapse(fi)} AS fi, 'mixed' AS register, pos
FROM {table_name}
WHERE english IS NOT NULL AND non_english IS NOT NULL
  AND length({en}) BETWEEN 2 AND 200 AND length({fi}) BETWEEN 2 AND 200"""


O.cte("pairs_opus", _pair_sql("opus_100"), ("lp",))
O.cte("pairs_subs", _pair_sql("opensubtitles_enfi"), ("lp",))

PAIR_CAP_DEMO = 1_000        # cap used by the registered pair_cap query


def _write_lp(spark, sf, nested: bool = False) -> str:
    path = scratch_path(spark, "lp-nested" if nested else "lp-flat")
    lp = fx.line_pairs_of(spark, sf)
    (to_nested(lp) if nested else lp).write.mode("overwrite").parquet(path)
    return path


@query("pairs_scan_flat", O.sql("SELECT pos, english, non_english FROM lp", "lp"))
def q_pairs_scan_flat(spark, sf):
    return pairs_scan_flat(spark, _write_lp(spark, sf))


@query("pairs_scan_nested", O.sql("SELECT pos, english, non_english FROM lp", "lp"))
def q_pairs_scan_nested(spark, sf):
    return pairs_scan_nested(spark, _write_lp(spark, sf, nested=True))


@query("pair_clean", O.sql("SELECT * FROM pairs_opus", "pairs_opus"))
def q_pair_clean(spark, sf):
    return clean.pair_clean(fx.line_pairs_of(spark, sf), "opus_100")


@query("pair_cap", O.sql(f"SELECT * FROM pairs_opus ORDER BY pos LIMIT {PAIR_CAP_DEMO}",
                         "pairs_opus"))
def q_pair_cap(spark, sf):
    pairs = clean.pair_clean(fx.line_pairs_of(spark, sf), "opus_100")
    return clean.pair_cap(pairs, PAIR_CAP_DEMO)


@query("pair_corpus", O.sql("""
SELECT source, id, en, fi, register FROM pairs_subs
UNION ALL SELECT source, id, en, fi, register FROM pairs_opus""", "pairs_subs", "pairs_opus"))
def q_pair_corpus(spark, sf):
    out_subs, out_opus = scratch_path(spark, "subs-jsonl"), scratch_path(spark, "opus-jsonl")
    stages.pair_corpus(spark, _write_lp(spark, sf), "opensubtitles_enfi", False, out_subs)
    stages.pair_corpus(spark, _write_lp(spark, sf, nested=True), "opus_100", True, out_opus)
    return read_jsonl(spark, out_subs, PAIR_SCHEMA).unionByName(
        read_jsonl(spark, out_opus, PAIR_SCHEMA))


# --- JSON Lines ---------------------------------------------------------------------------

@query("jsonl_scan", FLAVOR_SQL)
def q_jsonl_scan(spark, sf):
    path = scratch_path(spark, "flavor-jsonl")
    write_jsonl(flavor_from_documents(spark, sf).drop("idx"), path)
    return _flat_flavor(read_jsonl(spark, path, FLAVOR_SCHEMA))


@query("jsonl_sink", O.sql("SELECT id, en, fi, source, register FROM pairs_opus", "pairs_opus"))
def q_jsonl_sink(spark, sf):
    path = scratch_path(spark, "pairs-jsonl")
    pairs = clean.pair_clean(fx.line_pairs_of(spark, sf), "opus_100")
    n = write_jsonl(pairs.select("source", "id", "en", "fi", "register"), path)
    text = spark.read.text(path)
    got = text.select(*[F.get_json_object("value", f"$.{c}").alias(c)
                        for c in ("id", "en", "fi", "source", "register")])
    # the written line count must equal the observed count of the write job
    return got.where(F.lit(n) == text.select(F.count(F.lit(1))).scalar())


# --- 2.4 vocabularies ------------------------------------------------------------------------


O.cte("words", f"""
SELECT doc_id, CAST(unnest(generate_series(0, len(ts) - 1)) AS BIGINT) AS tok_pos,
       unnest(ts) AS word
FROM (SELECT doc_id, {O.ws_split('lower(text)')} AS ts FROM documents)""")
O.cte("wcounts", """
SELECT word, CAST(count(*) AS BIGINT) AS cnt, min(doc_id * 100000000 + tok_pos) AS first
FROM words GROUP BY word""", ("words",))
O.cte("lorder", f"""
SELECT CAST(row_number() OVER (ORDER BY level DESC, first) - 1 AS BIGINT) AS rank, word,
       CAST(level AS BIGINT) AS level
FROM (SELECT word, first, unnest(generate_series(1, cnt)) AS level FROM wcounts)
ORDER BY level DESC, first LIMIT {V.WORD_VOCAB_SIZE}""", ("wcounts",))
_SPECIALS_SQL = ", ".join(f"({i}, '{t}')" for i, t in enumerate(V.REFERENCE_SPECIALS))
O.cte("vfinal", f"""
SELECT token_id, token FROM (
  SELECT CAST(row_number() OVER (ORDER BY word) - 1 AS BIGINT) AS token_id, word AS token
  FROM lorder
  UNION ALL
  SELECT CAST((SELECT count(*) FROM lorder) + k AS BIGINT), t FROM (VALUES {_SPECIALS_SQL}) s(k, t))
WHERE token_id < {V.WORD_VOCAB_SIZE}""", ("lorder",))
O.cte("ws_tokens", f"""
SELECT d.doc_id, coalesce(x.line, '') AS line FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(CASE WHEN v.token IS NOT NULL THEN t ELSE '<UNK>' END, ' '
                            ORDER BY p) AS line
  FROM (SELECT doc_id, unnest(ts) AS t, unnest(generate_series(1, len(ts))) AS p
        FROM (SELECT doc_id, {O.ws_split('text')} AS ts FROM documents)) w
  LEFT JOIN (SELECT DISTINCT token FROM vfinal) v ON lower(w.t) = v.token
  GROUP BY doc_id) x ON x.doc_id = d.doc_id""", ("vfinal",))


def _doc_word_counts(spark, sf):
    """Word counts (read several times, so written once)."""
    return reliable_checkpoint(V.word_counts(fx.documents(spark, sf), "text"))


def reference_word_vocab(spark, sf) -> DataFrame:
    """The documents' word vocabulary (reference mode)."""
    counts = V.word_counts(fx.documents(spark, sf), "text", ["doc_id"])
    return V.vocab_final(V.vocab_level_order(counts, V.WORD_VOCAB_SIZE), V.WORD_VOCAB_SIZE)


@query("word_counts", O.sql("SELECT word, cnt FROM wcounts", "wcounts"))
def q_word_counts(spark, sf):
    return V.word_counts(fx.documents(spark, sf), "text")


@query("vocab_level_order", O.sql("SELECT rank, word, level FROM lorder", "lorder"))
def q_vocab_level_order(spark, sf):
    return V.vocab_level_order(V.word_counts(fx.documents(spark, sf), "text", ["doc_id"]),
                               V.WORD_VOCAB_SIZE)


@query("vocab_final", O.sql("SELECT token_id, token FROM vfinal", "vfinal"))
def q_vocab_final(spark, sf):
    return reference_word_vocab(spark, sf)


@query("vocab_topk", O.sql(f"""
SELECT CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS BIGINT) AS token_id, word, cnt
FROM wcounts ORDER BY cnt DESC, word LIMIT {V.WORD_VOCAB_SIZE}""", "wcounts"))
def q_vocab_topk(spark, sf):
    return V.vocab_topk(_doc_word_counts(spark, sf), V.WORD_VOCAB_SIZE)


@query("keyword_coverage", O.sql(f"""
SELECT k.keyword, v.token IS NOT NULL AS found
FROM (SELECT DISTINCT unnest({O.ws_split('lower(text)')}) AS keyword FROM benchmark) k
LEFT JOIN (SELECT DISTINCT token FROM vfinal) v ON v.token = k.keyword""", "vfinal"))
def q_keyword_coverage(spark, sf):
    """Which words of the benchmark passages the documents' vocabulary covers."""
    bench = fx.table(spark, sf, "benchmark")
    keywords = bench.select(F.explode(V.ws_split(F.lower("text"))).alias("keyword")).distinct()
    return V.keyword_coverage(reference_word_vocab(spark, sf), keywords)


@query("whitespace_tokenize", O.sql("SELECT doc_id, line FROM ws_tokens", "ws_tokens"))
def q_whitespace_tokenize(spark, sf):
    toks = V.whitespace_tokenize(fx.documents(spark, sf), "text", ["doc_id"],
                                 reference_word_vocab(spark, sf))
    return toks.select("doc_id", F.concat_ws(" ", "tokens").alias("line"))


@query("raw_token_count", O.sql(f"""
SELECT CAST(coalesce(sum(len({O.ws_split('text')})), 0) AS BIGINT) AS n_tokens FROM documents"""))
def q_raw_token_count(spark, sf):
    return V.raw_token_count(fx.documents(spark, sf), "text")


# --- 2.4 synthesis ------------------------------------------------------------------------


SYNTH_MODEL = "stand-in-mirror"
BATCH_LIMIT = 6_000   # fixed value: lines per run, for the batch_limit query only
RUN1_LIMIT = 500   # an earlier, smaller run; the run after it translates all the rest


def _synth_source(spark, sf) -> DataFrame:
    return written_flavor(spark, sf).select("id", "fi", "idx")


def _run1(src: DataFrame) -> DataFrame:
    pairs, _ = S.synthesize(src, None, fx.mirror_translator_factory, SYNTH_MODEL, RUN1_LIMIT,
                            dense=True)
    return pairs


@query("backtranslate_batch", O.sql("SELECT id, fi, en_raw, error FROM stub", "stub"))
def q_backtranslate_batch(spark, sf):
    return S.backtranslate(_synth_source(spark, sf), fx.mirror_translator_factory, SYNTH_MODEL)


@query("resume_filter", O.sql("""
SELECT id, fi FROM flavor WHERE 'synth-' || id NOT IN (SELECT id FROM run1)""", "flavor", "run1"))
def q_resume_filter(spark, sf):
    src = _synth_source(spark, sf)
    return S.plan_batch(src, _run1(src), None).select("id", "fi")


@query("batch_limit", O.sql(f"SELECT id, fi FROM run2_todo WHERE idx < {BATCH_LIMIT}", "run2_todo"))
def q_batch_limit(spark, sf):
    src = _synth_source(spark, sf)
    return S.plan_batch(src, _run1(src), BATCH_LIMIT).select("id", "fi")


@query("synth_pairs", O.sql("SELECT source, id, en, fi, register FROM synth", "synth"))
def q_synth_pairs(spark, sf):
    """Two resumable runs into one JSONL folder: 500 lines, then all the others."""
    out = scratch_path(spark, "synth-jsonl")
    src = _synth_source(spark, sf)
    S.run_synthesis(spark, src, out, fx.mirror_translator_factory, SYNTH_MODEL, RUN1_LIMIT, slices=1)
    S.run_synthesis(spark, src, out, fx.mirror_translator_factory, SYNTH_MODEL)
    return read_jsonl(spark, out, PAIR_SCHEMA)


@query("synth_progress", O.sql(f"""
SELECT status, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN error IS NOT NULL THEN 'failed'
              WHEN en_raw IS NULL OR length({O.tidy('en_raw')}) < 2 THEN 'dropped'
              ELSE 'added' END AS status FROM run2_todo)
GROUP BY status
UNION ALL
SELECT 'skipped', CAST((SELECT count(*) FROM stub)
                       - (SELECT count(*) FROM run2_todo) AS BIGINT)""", "stub", "run2_todo"))
def q_synth_progress(spark, sf):
    src = _synth_source(spark, sf)
    existing = _run1(src)
    _, raw = S.synthesize(src, existing, fx.mirror_translator_factory, SYNTH_MODEL)
    return S.synth_progress(src, existing, raw, None)


def _conv_raw(spark, sf) -> DataFrame:
    cv = fx.conversations(spark, sf)
    raw = (F.when(F.col("role") == "assistant", F.concat(
        F.lit("<think>"), F.col("role"), F.lit("\n"), F.col("turn").cast("string"),
        F.lit("</think>\n\""), F.col("text"), F.lit("\" ")))
        .when(F.col("role") == "user", F.concat(F.lit("  ‘"), F.col("text"), F.lit("’")))
        .otherwise(F.col("text")))
    return cv.withColumn("raw", raw)


@query("model_output_tidy", O.sql(f"""
SELECT conv_id, turn, {O.tidy('raw')} AS tidy FROM conv_raw""", "conv_raw"))
def q_model_output_tidy(spark, sf):
    return _conv_raw(spark, sf).select("conv_id", "turn", S.tidy_output(F.col("raw")).alias("tidy"))


@query("prompt_normalise", O.sql("""
SELECT conv_id, turn,
       CASE WHEN starts_with(lower(text), 'translate to finnish') THEN text
            ELSE 'Translate to Finnish: ' || text END AS prompt
FROM conversations WHERE role = 'user'"""))
def q_prompt_normalise(spark, sf):
    cv = fx.conversations(spark, sf).where(F.col("role") == "user")
    return cv.select("conv_id", "turn", S.prompt_normalise(F.col("text")).alias("prompt"))


@query("reply_tidy", O.sql(f"""
SELECT conv_id, turn,
       {O.strip("CASE WHEN contains(raw, '</think>') THEN substr(raw, strpos(raw, '</think>') + 8) ELSE raw END")} AS reply
FROM (SELECT conv_id, turn, role || '</think> ' || text || ' </think> end' AS raw
      FROM conversations WHERE role = 'assistant')"""))
def q_reply_tidy(spark, sf):
    cv = fx.conversations(spark, sf).where(F.col("role") == "assistant")
    raw = F.concat(F.col("role"), F.lit("</think> "), F.col("text"), F.lit(" </think> end"))
    return cv.select("conv_id", "turn", S.reply_tidy(raw).alias("reply"))


# --- 2.4 splits, composition, chat rows -----------------------------------------------------


def _synth_pairs(flavor: DataFrame) -> DataFrame:
    """Both synthesis runs over the flavor lines (translations checkpointed)."""
    src = flavor.select("id", "fi", "idx")
    pairs, _ = S.synthesize(src, _run1(src), fx.mirror_translator_factory, SYNTH_MODEL)
    return pairs


def _composed(spark, sf) -> DataFrame:
    """Training composition (flavor + exact synthetic split)."""
    flavor = written_flavor(spark, sf)
    return stages.compose(flavor, _synth_pairs(flavor))


@query("split_exact", O.sql(f"SELECT doc_id, {O.exact_split('doc_id', 'documents')} AS split "
                            "FROM documents"))
def q_split_exact(spark, sf):
    return SP.split_exact(fx.documents(spark, sf).select("doc_id"), "doc_id")


@query("split_random", O.sql(f"""
SELECT doc_id, CASE WHEN {O.below_share('doc_id')} THEN 'train' ELSE 'valid' END AS split
FROM documents"""))
def q_split_random(spark, sf):
    return SP.split_random(fx.documents(spark, sf).select("doc_id"), "doc_id")


@query("compose_train", O.sql("SELECT id, fi, role, split FROM composed", "composed"))
def q_compose_train(spark, sf):
    return _composed(spark, sf)


@query("composition_summary", O.sql("""
SELECT split, role, CAST(count(*) AS BIGINT) AS n FROM composed GROUP BY ROLLUP (split, role)""",
                                    "composed"))
def q_composition_summary(spark, sf):
    return C.composition_summary(_composed(spark, sf))


@query("step_plan", O.sql("""
SELECT n_train, n_valid, steps_per_epoch, total_steps,
       CAST(least(250, greatest(1, total_steps // 10)) AS BIGINT) AS warmup_steps
FROM (SELECT n_train, n_valid, CAST(ceil(n_train / 4.0) AS BIGINT) AS steps_per_epoch,
             CAST(ceil(n_train / 4.0) * 2 AS BIGINT) AS total_steps
      FROM (SELECT CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
                   CAST(sum(CASE WHEN split = 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS n_valid
            FROM composed))""", "composed"))
def q_step_plan(spark, sf):
    return C.step_plan(_composed(spark, sf))


@query("split_leakage", O.sql("""
SELECT id, fi FROM composed
WHERE split = 'valid' AND lower(fi) IN (SELECT lower(fi) FROM composed WHERE split = 'train')""",
                              "composed"))
def q_split_leakage(spark, sf):
    comp = _composed(spark, sf)
    valid = comp.where(F.col("split") == "valid")
    train = comp.where(F.col("split") == "train")
    return SP.split_leakage(valid, train).select("id", "fi")


@query("split_leak_safe", O.sql(f"""
SELECT id, role, CASE WHEN {O.below_share('lower(fi)')} THEN 'train' ELSE 'valid' END AS split
FROM composed""", "composed"))
def q_split_leak_safe(spark, sf):
    comp = _composed(spark, sf).drop("split")
    return SP.split_leak_safe(comp, "fi").select("id", "role", "split")


@query("epoch_shards", O.sql(f"""
SELECT id, CAST(row_number() OVER (ORDER BY {O.hash_key('id')}, id) - 1 AS BIGINT) AS position,
       CAST((row_number() OVER (ORDER BY {O.hash_key('id')}, id) - 1) // 4 AS BIGINT) AS batch_id
FROM composed WHERE split = 'train'""", "composed"))
def q_epoch_shards(spark, sf):
    train = _composed(spark, sf).where(F.col("split") == "train").select("id")
    shards = SP.epoch_shards(train, "id", C.BATCH_SIZE).select("id", "position", "batch_id")
    path = scratch_path(spark, "epoch-shards")
    SP.write_shards(shards, path, rows_per_file=C.BATCH_SIZE * 1000)
    return spark.read.parquet(path)


@query("chat_rows_pairs", O.sql("""
SELECT id, 'Translate to Finnish: ' || coalesce(en, '') AS user_content,
       coalesce(fi, '') AS assistant_content FROM pairs_opus""", "pairs_opus"))
def q_chat_rows_pairs(spark, sf):
    pairs = clean.pair_clean(fx.line_pairs_of(spark, sf), "opus_100")
    rows = C.chat_rows_pairs(pairs)
    return rows.select("id", F.col("messages")[0]["content"].alias("user_content"),
                       F.col("messages")[1]["content"].alias("assistant_content"))


def _json_field(name: str, x: str) -> str:
    return f"'\"{name}\": ' || CAST(to_json({x}) AS VARCHAR)"


@query("chat_rows_flavor", O.sql(f"""
SELECT id, 'Generate Finnish text:' AS user_content,
       '{{' || {_json_field('source', 'source')} || ', ' || {_json_field('id', 'id')} || ', '
       || {_json_field('fi', 'fi')} || ', ' || {_json_field('register', 'register')}
       || ', "meta": {{' || {_json_field('artist', 'artist')} || ', '
       || {_json_field('title', 'title')} || '}}}}' AS assistant_content
FROM flavor""", "flavor"))
def q_chat_rows_flavor(spark, sf):
    rows = C.chat_rows_flavor(flavor_from_documents(spark, sf), mode="reference")
    return rows.select("id", F.col("messages")[0]["content"].alias("user_content"),
                       F.col("messages")[1]["content"].alias("assistant_content"))


@query("formatted_example", O.sql("""
SELECT id, 'user: Translate to Finnish: ' || en || chr(10) || 'assistant: ' || fi AS text
FROM pairs_opus ORDER BY pos LIMIT 1""", "pairs_opus"))
def q_formatted_example(spark, sf):
    pairs = clean.pair_clean(fx.line_pairs_of(spark, sf), "opus_100")
    first = C.chat_rows_pairs(pairs.orderBy("pos").limit(1))
    return first.select("id", C.formatted_text(F.col("messages")).alias("text"))


O.cte("vdistinct", f"""
SELECT k AS token_id, t AS token
FROM (VALUES {", ".join(f"({i}, '{t}')" for i, t in enumerate(V.SPECIALS))}) s(k, t)
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 + {len(V.SPECIALS)} AS BIGINT), word
FROM (SELECT word, cnt FROM wcounts ORDER BY cnt DESC, word
      LIMIT {V.WORD_VOCAB_SIZE - len(V.SPECIALS)})""", ("wcounts",))
_EOS, _UNK = V.SPECIALS.index("<EOS>"), V.SPECIALS.index("<UNK>")


@query("fixed_length_rows", O.sql(f"""
SELECT d.doc_id,
       array_to_string(list_resize(list_concat(coalesce(x.ids, []), [{_EOS}])[1:{C.MAX_LEN}],
                                   {C.MAX_LEN}, {_EOS}), ' ') AS input_ids,
       array_to_string(list_resize(list_transform(
           list_concat(coalesce(x.ids, []), [{_EOS}])[1:{C.MAX_LEN}], lambda i: 1),
           {C.MAX_LEN}, 0), ' ') AS attention_mask,
       array_to_string(list_transform(list_resize(
           list_concat(coalesce(x.ids, []), [{_EOS}])[1:{C.MAX_LEN}], {C.MAX_LEN}, {_EOS}),
           lambda i: CASE WHEN i = {_EOS} THEN {C.IGNORE_LABEL} ELSE i END), ' ') AS labels
FROM documents d LEFT JOIN (
  SELECT doc_id, list(coalesce(v.token_id, {_UNK}) ORDER BY p) AS ids
  FROM (SELECT doc_id, unnest(ts) AS t, unnest(generate_series(1, len(ts))) AS p
        FROM (SELECT doc_id, {O.ws_split('text')} AS ts FROM documents)) w
  LEFT JOIN (SELECT token, min(token_id) AS token_id FROM vdistinct GROUP BY token) v
    ON lower(w.t) = v.token
  GROUP BY doc_id) x ON x.doc_id = d.doc_id""", "vdistinct"))
def q_fixed_length_rows(spark, sf):
    docs = fx.documents(spark, sf)
    counts = _doc_word_counts(spark, sf)
    vocab = V.vocab_final(counts, V.WORD_VOCAB_SIZE, mode="distinct", counts=counts)
    ids = C.token_ids(docs, "text", ["doc_id"], vocab, _UNK, C.MAX_LEN)
    return _spelled_rows(ids.select("doc_id", C.fixed_length_rows(F.col("ids"), _EOS).alias("r")), "doc_id")


def _spelled_rows(rows: DataFrame, *keys: str) -> DataFrame:
    def s(c):
        return F.concat_ws(" ", F.transform(F.col(f"r.{c}"), lambda x: x.cast("string")))
    return rows.select(*keys, *[s(c).alias(c) for c in ("input_ids", "attention_mask", "labels")])


O.cte("all_ids", f"""
SELECT d.doc_id, coalesce(i.ids, []) AS ids FROM documents d LEFT JOIN (
  SELECT doc_id, list(coalesce(v.token_id, {_UNK}) ORDER BY p) AS ids
  FROM (SELECT doc_id, unnest(ts) AS t, unnest(generate_series(1, len(ts))) AS p
        FROM (SELECT doc_id, {O.ws_split('text')} AS ts FROM documents)) w
  LEFT JOIN (SELECT token, min(token_id) AS token_id FROM vdistinct GROUP BY token) v ON lower(w.t) = v.token
  GROUP BY doc_id) i ON i.doc_id = d.doc_id""", ("vdistinct",))
_STEP = C.MAX_LEN - 1
O.cte("id_chunks", f"""
SELECT doc_id, chunk, list_append(ids[chunk * {_STEP} + 1:(chunk + 1) * {_STEP}], {_EOS}) AS ids
FROM (SELECT doc_id, ids, CAST(unnest(range(0, greatest(1, (len(ids) + {_STEP - 1}) // {_STEP}))) AS INTEGER) AS chunk
      FROM all_ids)""", ("all_ids",))


@query("chunked_length_rows", O.sql(f"""
SELECT doc_id, chunk, array_to_string(list_resize(ids, {C.MAX_LEN}, {_EOS}), ' ') AS input_ids,
       array_to_string(list_resize(list_transform(ids, lambda i: 1), {C.MAX_LEN}, 0), ' ') AS attention_mask,
       array_to_string(list_transform(list_resize(ids, {C.MAX_LEN}, {_EOS}),
           lambda i: CASE WHEN i = {_EOS} THEN {C.IGNORE_LABEL} ELSE i END), ' ') AS labels
FROM id_chunks""", "id_chunks"))
def q_chunked_length_rows(spark, sf):
    """Fixed-length rows that keep every token: a text is cut into as many as it fills."""
    docs = fx.documents(spark, sf)
    counts = _doc_word_counts(spark, sf)
    vocab = V.vocab_final(counts, V.WORD_VOCAB_SIZE, mode="distinct", counts=counts)
    ids = C.token_ids(docs, "text", ["doc_id"], vocab, _UNK)
    chunks = ids.select("doc_id", F.posexplode(C.chunked_ids(F.col("ids"), C.MAX_LEN)).alias("chunk", "ids"))
    return _spelled_rows(chunks.select("doc_id", "chunk", C.fixed_length_rows(F.col("ids"), _EOS).alias("r")),
                         "doc_id", "chunk")


# --- 2.4 pre-tokeniser, BPE, segmentation --------------------------------------------------


_PRE_W = "[\\p{L}\\p{Nl}\\p{M}\\p{Nd}\\p{Pc}\\x{200c}\\x{200d}]"
_PRE_S = ("\\t-\\r\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
          "\\x{202f}\\x{205f}\\x{3000}")
_PRE_SQL = f"{_PRE_W}+|[^\\p{{L}}\\p{{Nl}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}\\x{{200c}}\\x{{200d}}{_PRE_S}]+"


@query("pretokenize", O.sql(f"""
SELECT doc_id, CAST(len(ps) AS INTEGER) AS n_pieces, array_to_string(ps, ' ') AS pieces
FROM (SELECT doc_id, regexp_extract_all(text, '{_PRE_SQL}') AS ps FROM documents)"""))
def q_pretokenize(spark, sf):
    docs = fx.documents(spark, sf)
    ps = B.pretokenize(F.col("text"))
    return docs.select("doc_id", F.size(ps).alias("n_pieces"),
                       F.concat_ws(" ", ps).alias("pieces"))


def bpe_model(spark, sf) -> B.BpeModel:
    """The documents' model: trained once for the same texts, then read."""
    return B.kept_model(fx.documents(spark, sf), "text", model_folder(spark))


@query("bpe_train")
def q_bpe_train(spark, sf):
    return bpe_model(spark, sf).vocab


@query("bpe_vocab_filter")
def q_bpe_vocab_filter(spark, sf):
    return B.bpe_vocab_filter(bpe_model(spark, sf).vocab)


@query("bpe_keyword_coverage")
def q_bpe_keyword_coverage(spark, sf):
    """Which words of the benchmark passages are entries of the learned vocabulary."""
    bench = fx.table(spark, sf, "benchmark")
    keywords = bench.select(F.explode(V.ws_split(F.lower("text"))).alias("keyword")).distinct()
    return V.keyword_coverage(bpe_model(spark, sf).vocab, keywords)


@query("bpe_encode")
def q_bpe_encode(spark, sf):
    """Every document in tokens of the learned model."""
    toks = B.bpe_encode(fx.documents(spark, sf), "text", ["doc_id"], bpe_model(spark, sf))
    return toks.select("doc_id", F.size("tokens").alias("n_tokens"), F.concat_ws(" ", "tokens").alias("tokens"))


O.cte("seg_vocab", f"""
SELECT word AS token FROM wcounts ORDER BY cnt DESC, word LIMIT {V.WORD_VOCAB_SIZE}""", ("wcounts",))
O.cte("seg_doc_words", f"""
SELECT doc_id, list_filter(regexp_split_to_array(text, '[{B.SPACES}]+'), lambda t: length(t) > 0) AS ws
FROM documents""")
O.cte("seg_best", """
SELECT word, p, max_by(token, n) AS token
FROM (SELECT word, unnest(range(0, length(word))) AS p
      FROM (SELECT DISTINCT unnest(ws) AS word FROM seg_doc_words)) w
JOIN (SELECT DISTINCT length(token) AS n FROM seg_vocab) l ON p + n <= length(word)
JOIN seg_vocab v ON v.token = substr(word, p + 1, n)
GROUP BY word, p""", ("seg_vocab", "seg_doc_words"))


@query("vocab_segment", O.sql("""
SELECT d.doc_id, CAST(coalesce(x.n_tokens, 0) AS INTEGER) AS n_tokens,
       CAST(coalesce(x.n_unk, 0) AS INTEGER) AS n_unk, coalesce(x.tokens, '') AS tokens
FROM documents d LEFT JOIN (
  SELECT doc_id, sum(len(toks)) AS n_tokens, sum(len(list_filter(toks, lambda t: t = '<UNK>'))) AS n_unk,
         string_agg(array_to_string(toks, ' '), ' ' ORDER BY k) AS tokens
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS k FROM seg_doc_words)
  JOIN (WITH RECURSIVE r(word, p, toks) AS (
          SELECT DISTINCT word, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) FROM (SELECT unnest(ws) AS word FROM seg_doc_words)
          UNION ALL
          SELECT r.word, r.p + coalesce(length(b.token), 1), list_append(r.toks, coalesce(b.token, '<UNK>'))
          FROM r LEFT JOIN seg_best b ON b.word = r.word AND b.p = r.p WHERE r.p < length(r.word))
        SELECT word, toks FROM r WHERE p >= length(word)) s USING (word)
  GROUP BY doc_id) x ON x.doc_id = d.doc_id""", "seg_best"))
def q_vocab_segment(spark, sf):
    """Every document in leftmost-longest entries of its corpus' word vocabulary, read
    back from a vocabulary file."""
    path = scratch_path(spark, "segment-vocab")
    counts = V.word_counts(fx.documents(spark, sf), "text")
    words = V.vocab_topk(counts, V.WORD_VOCAB_SIZE).withColumnRenamed("word", "token")
    write_vocab(words, path)
    vocab = [r["token"] for r in vocab_scan(spark, path).collect()]  # capped at 20,000 entries
    toks = fx.documents(spark, sf).select("doc_id", B.segment(F.col("text"), vocab).alias("tokens"))
    return toks.select("doc_id", F.size("tokens").alias("n_tokens"),
                       F.size(F.filter("tokens", lambda t: t == "<UNK>")).alias("n_unk"),
                       F.concat_ws(" ", "tokens").alias("tokens"))


# --- 2.1 remaining scans and sinks ---------------------------------------------------------


SONG_PAGE_DOCS = 50   # documents per search-reply page in the derived replies
SONG_ARTIST_DOCS = SONG_PAGE_DOCS * MAX_PAGES


def search_replies(docs: DataFrame) -> DataFrame:
    """``artist, page, payload``: one search reply per (source, page) of documents.

    Each source is one artist per ``MAX_PAGES`` pages of document ids, so that the
    listing's page limit leaves no document out.  English and French documents name
    the artist (upper case) as primary artist, the others a different one.  Pages hold
    ``SONG_PAGE_DOCS`` consecutive document ids, so some artists miss pages.
    """
    artist = F.concat_ws("-", "source", F.floor(F.col("doc_id") / SONG_ARTIST_DOCS).cast("string"))
    hit = F.struct(F.struct(
        F.try_element_at(fx.T.split_lines("text"), F.lit(1)).alias("title"),
        F.concat(F.lit("https://songs.invalid/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("doc_id").alias("id"),
        F.struct(F.when(F.col("lang").isin("en", "fr"), F.upper(artist))
                 .otherwise(F.lit("Various Artists")).alias("name")).alias("primary_artist"))
        .alias("result"))
    page = F.floor(F.pmod("doc_id", F.lit(SONG_ARTIST_DOCS)) / SONG_PAGE_DOCS) + 1
    paged = docs.select(artist.alias("artist"), page.cast("int").alias("page"),
                        "doc_id", hit.alias("hit"))
    # at most SONG_PAGE_DOCS hits per (artist, page) group
    pages = paged.groupBy("artist", "page").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "hit"))).alias("hs"))
    payload = F.to_json(F.struct(F.struct(F.col("hs.hit").alias("hits")).alias("response")))
    return pages.select("artist", "page", payload.alias("payload"))


O.cte("song_hits", f"""
SELECT *, CASE WHEN lang IN ('en', 'fr') THEN upper(artist) ELSE 'Various Artists' END AS name FROM (
SELECT source || '-' || CAST(doc_id // {SONG_ARTIST_DOCS} AS VARCHAR) AS artist, lang,
       CAST(doc_id % {SONG_ARTIST_DOCS} // {SONG_PAGE_DOCS} + 1 AS INTEGER) AS page, doc_id,
       {O.split_lines('text')}[1] AS title, 'https://songs.invalid/' || CAST(doc_id AS VARCHAR) AS url
FROM documents)""")


@query("song_listing", O.sql(f"""
SELECT artist, song_no, title, url, id FROM (
  SELECT h.artist, h.title, h.url, h.doc_id AS id,
         CAST(row_number() OVER (PARTITION BY h.artist ORDER BY h.page, h.doc_id) - 1 AS BIGINT)
             AS song_no
  FROM song_hits h
  JOIN (SELECT artist, page FROM (
          SELECT artist, page, row_number() OVER (PARTITION BY artist ORDER BY page) AS k
          FROM (SELECT DISTINCT artist, page FROM song_hits WHERE page BETWEEN 1 AND {MAX_PAGES}))
        WHERE k = page) ok ON ok.artist = h.artist AND ok.page = h.page
  WHERE lower(h.name) = lower(h.artist))
WHERE song_no < {MAX_SONGS}""", "song_hits"))
def q_song_listing(spark, sf):
    """Listing from the replies, written as one list per artist, read back."""
    path = scratch_path(spark, "song-lists")
    write_song_lists(song_listing(search_replies(fx.documents(spark, sf))), path)
    return read_song_lists(spark, path).select("artist", "song_no", "title", "url", "id")


@query("vocab_scan", O.sql("SELECT token_id, token FROM vfinal", "vfinal"))
def q_vocab_scan(spark, sf):
    path = scratch_path(spark, "vocab-txt")
    write_vocab(reference_word_vocab(spark, sf), path)
    return vocab_scan(spark, path)


@query("token_lines_sink", O.sql("SELECT line FROM ws_tokens", "ws_tokens"))
def q_token_lines_sink(spark, sf):
    path = scratch_path(spark, "token-lines")
    toks = V.whitespace_tokenize(fx.documents(spark, sf), "text", ["doc_id"],
                                 reference_word_vocab(spark, sf))
    write_token_lines(toks, "tokens", path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("source_registry", O.sql(f"""
SELECT r.name, r.role, r.register, r.status, CAST(coalesce(c.n, 0) AS BIGINT) AS n_records
FROM (VALUES {", ".join(f"('{n}', '{g}', '{o}', '{s}')" for n, g, o, s, _ in R.SOURCES)})
     AS r(name, register, role, status)
LEFT JOIN (SELECT source, count(*) AS n FROM (
             SELECT source FROM flavor UNION ALL SELECT source FROM pairs_subs
             UNION ALL SELECT source FROM pairs_opus UNION ALL SELECT source FROM synth)
           GROUP BY source) c ON c.source = r.name
WHERE r.status = 'active'""", "flavor", "pairs_subs", "pairs_opus", "synth"))
def q_source_registry(spark, sf):
    lp = fx.line_pairs_of(spark, sf)
    flavor = written_flavor(spark, sf)
    corpus = (flavor.select("source")
              .unionByName(clean.pair_clean(lp, "opensubtitles_enfi").select("source"))
              .unionByName(clean.pair_clean(lp, "opus_100").select("source"))
              .unionByName(_synth_pairs(flavor).select("source")))
    counts = corpus.groupBy("source").agg(F.count(F.lit(1)).alias("n_records"))
    reg = R.active_sources(R.source_registry(spark))
    # the registry is a handful of hand-written rows: broadcast it
    out = F.broadcast(reg).join(counts, reg["name"] == counts["source"], "left")
    return out.select("name", "role", "register", "status",
                      F.coalesce(F.col("n_records"), F.lit(0)).cast("long").alias("n_records"))


@query("fi_text_union", O.sql("SELECT id, fi FROM flavor UNION ALL SELECT id, fi FROM synth",
                              "flavor", "synth"))
def q_fi_text_union(spark, sf):
    flavor = written_flavor(spark, sf)
    return stages.fi_text_union(flavor, _synth_pairs(flavor))


# --- 2.4b streaming -------------------------------------------------------------------------


@query("stream_pair_clean", O.sql("SELECT * FROM pairs_opus", "pairs_opus"))
def q_stream_pair_clean(spark, sf):
    src = scratch_path(spark, "stream-pairs-in")
    files = fx.stream_input(fx.line_pairs_of(spark, sf), src, "parquet")
    return ST.stream_pair_clean(spark, src, FLAT_SCHEMA, scratch_path(spark, "stream-pairs-out"),
                                scratch_path(spark, "stream-pairs-ckpt"), "opus_100",
                                max_files=files).select("source", "id", "en", "fi", "register", "pos")


@query("stream_synth_resume", O.sql(f"""
SELECT * FROM run1 UNION ALL
{O._synth_rows("(SELECT * FROM stub WHERE 'synth-' || id NOT IN (SELECT id FROM run1))")}""",
                                    "stub", "run1"))
def q_stream_synth_resume(spark, sf):
    """Earlier output (run of 500 lines) exists; the stream covers every line."""
    out = scratch_path(spark, "stream-synth-out")
    lines = _synth_source(spark, sf)
    S.write_pairs(_run1(lines), os.path.join(out, "batch=-1"), "errorifexists")
    src = scratch_path(spark, "stream-synth-in")
    files = fx.stream_input(lines, src, "json")
    drop_scratch(lines)   # all of them are in the stream's input
    schema = T.StructType([T.StructField("id", T.StringType()),
                           T.StructField("fi", T.StringType()),
                           T.StructField("idx", T.LongType())])
    return ST.stream_synth_resume(spark, src, schema, out, scratch_path(spark, "stream-synth-ckpt"),
                                  fx.mirror_translator_factory, SYNTH_MODEL, max_files=files)


@query("stream_dedup", O.sql("SELECT DISTINCT lower(line) AS key FROM dl", "dl"))
def q_stream_dedup(spark, sf):
    src = scratch_path(spark, "stream-lines-in")
    files = fx.stream_input(fx.doc_lines(fx.documents(spark, sf)), src, "parquet")
    schema = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("source", T.StringType()),
                           T.StructField("lang", T.StringType()),
                           T.StructField("line_no", T.IntegerType()),
                           T.StructField("line", T.StringType())])
    out = ST.stream_dedup(spark, src, schema, "line", scratch_path(spark, "stream-dedup-out"),
                          scratch_path(spark, "stream-dedup-ckpt"), max_files=files)
    return out.select("key")

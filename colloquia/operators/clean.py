"""Line splitting, lyric cleaning, order-preserving dedup and pair preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquia.functions import text as T
from colloquia.operators.order import before, chunked_scan, cut_key, dense_index
from colloquia.session import drop_table, scratch_path, write_table

# The reference's UI-cruft and bracket-tag patterns.
CRUFT = "(?iu)\\p{Nd}*Embed$|You might also like|Lyrics$"
BRACKET_TAG = "(?s)^[\\[(].*[\\])]$"

MIN_FLAVOR_LEN = 8          # fixed value: lines shorter than this are dropped
PAIR_MIN_LEN, PAIR_MAX_LEN = 2, 200   # fixed values: pair side length bounds
TOPK_LIMIT = 5_000          # caps up to this use a top-k; larger ones a cut in the order


def explode_lines(df: DataFrame, text_col: str = "text", keep: Sequence[str] = (),
                  line_col: str = "line", pos_col: str = "line_no") -> DataFrame:
    """``str.splitlines()`` as rows: one row per line with its 0-based number."""
    return df.select(*keep, F.posexplode(T.split_lines(text_col)).alias(pos_col, line_col))


def clean_chain(c: Column) -> Column:
    """Cruft removed, stripped, whitespace collapsed (before the keep test).

    Collapsing a stripped line keeps its first and last character, so the
    emptiness and bracket tests may run on the collapsed text.
    """
    return T.bound(T.bound(c, _without_cruft), lambda t: T.collapse_ws(T.strip(t)))


def _without_cruft(c: Column) -> Column:
    """A search by bytes spares most lines the case-folding regex: these heads of its words
    hold no letter that anything but its own lower case folds to (as Kelvin's sign to k)."""
    low = F.lower(c)
    maybe = low.contains("embed") | low.contains("you m") | low.contains("lyr")
    return F.when(maybe, F.regexp_replace(c, CRUFT, "")).otherwise(c)


def kept_line(t: Column) -> Column:
    """Keep test on a ``clean_chain`` result: non-empty, not a bracket tag."""
    return (F.length(t) > 0) & ~t.rlike(BRACKET_TAG)


def clean_line(c: Column) -> Column:
    """One raw line through the lyric cleaner; null when the line is dropped."""
    t = clean_chain(c)
    return F.when(kept_line(t), t)


def lyric_line_clean(df: DataFrame, text_col: str = "text", keep: Sequence[str] = (),
                     line_col: str = "line", pos_col: str = "line_no") -> DataFrame:
    """``clean_lyric_lines``: split raw text, drop cruft, tags and blanks.

    Lines are cleaned inside the generator (one pass of the regex chain per
    line); the keep test then filters generated rows.
    """
    pieces = df.select(*keep, F.posexplode(F.transform(T.split_lines(text_col), clean_chain))
                       .alias(pos_col, line_col))
    return pieces.where(kept_line(F.col(line_col)))


def dedup_first(df: DataFrame, text_col: str, order_by: Sequence[str]) -> DataFrame:
    """Keep the first row (in ``order_by``, unique) of every case-insensitive text.

    ``min`` over a struct led by the order keys picks that row, with a map-side
    partial step, so a chorus repeated in a third of all rows collapses before the
    shuffle.  (A struct is no fixed-width buffer: Spark sorts for this aggregate.)
    """
    rest = [c for c in df.columns if c not in order_by]
    rec = F.struct(*[F.col(c) for c in [*order_by, *rest]])
    return (df.groupBy(F.lower(F.col(text_col)).alias("_dedup_key"))
            .agg(F.min(rec).alias("_rec"))
            .select(*[F.col(f"_rec.{c}").alias(c) for c in df.columns]))


def tag_titles(lines: DataFrame, group_cols: Sequence[str], chunk_col: str, pos_col: str,
               chunk_bound: int | None = None, chunk_block: int | None = None) -> DataFrame:
    """Seed-file title state: ``#`` lines set the title of the lines after them.

    Input ``line`` is raw; output adds ``s`` (stripped line), ``is_title`` and
    ``title`` (``''`` before the first ``#`` line of a file and after a bare ``#``).
    """
    stripped = T.compute_once(lines, lines.columns, s=T.strip(F.col("line")))
    marked = (stripped.where(F.length("s") > 0)
              .withColumn("is_title", F.col("s").startswith("#"))
              .withColumn("_title_set", F.when(
                  F.col("is_title"), T.strip(F.regexp_replace("s", "^#+", "")))))
    return chunked_scan(marked, group_cols, chunk_col, pos_col, fill_col="_title_set",
                        fill_out="title", fill_default=F.lit(""),
                        chunk_bound=chunk_bound, chunk_block=chunk_block).drop("_title_set")


def flavor_corpus(seed_lines: DataFrame, source: str = "genius_rap",
                  register: str = "puhekieli", chunk_bound: int | None = None,
                  chunk_block: int | None = None) -> DataFrame:
    """Seed lines -> titled, cleaned, length-filtered, deduplicated, numbered.

    ``seed_lines``: ``file, artist, chunk, pos, line`` where (file, chunk, pos)
    is the reading order and files are taken in name order.
    """
    titled = tag_titles(seed_lines, ["file"], "chunk", "pos", chunk_bound, chunk_block)
    body = (T.compute_once(titled.where(~F.col("is_title")),
                           ["file", "chunk", "pos", "artist", "title"], fi=clean_chain(F.col("s")))
            .where(kept_line(F.col("fi")) & (F.length("fi") >= MIN_FLAVOR_LEN)))
    # written between the shuffles of the titles and of the numbering, so that they are not on
    # disk together; what is numbered is a table of its own
    spark, path = seed_lines.sparkSession, scratch_path(seed_lines.sparkSession, "flavor-first")
    first = write_table(dedup_first(body, "fi", ["file", "chunk", "pos"]), path)
    numbered = dense_index(first, ["file", "chunk", "pos"], "idx")
    drop_table(spark, path)
    return numbered.select(
        F.lit(source).alias("source"),
        F.concat(F.lit(f"{source}-"), F.col("idx").cast("string")).alias("id"),
        "fi",
        F.lit(register).alias("register"),
        F.struct("artist", "title").alias("meta"),
        "idx",
    )


def pair_clean(df: DataFrame, source: str, pos_col: str = "pos", en_col: str = "english",
               fi_col: str = "non_english", register: str = "mixed") -> DataFrame:
    """``_clean_pair`` for every row: strip, length bounds before collapsing.

    Rows with a null side are dropped (the reference would raise).
    """
    present = df.where(F.col(en_col).isNotNull() & F.col(fi_col).isNotNull())
    stripped = T.compute_once(present, [F.col(pos_col).alias("pos")],
                              _en=T.strip(F.col(en_col)), _fi=T.strip(F.col(fi_col)))
    ok = (F.length("_en").between(PAIR_MIN_LEN, PAIR_MAX_LEN)
          & F.length("_fi").between(PAIR_MIN_LEN, PAIR_MAX_LEN))
    return (stripped.where(ok)
            .select(
                F.lit(source).alias("source"),
                F.concat(F.lit(f"{source}-"), F.col("pos").cast("string")).alias("id"),
                T.collapse_ws(F.col("_en")).alias("en"),
                T.collapse_ws(F.col("_fi")).alias("fi"),
                F.lit(register).alias("register"),
                "pos"))


def first_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order_by`` (unique, ascending) order, exactly.

    Caps up to ``TOPK_LIMIT`` use Spark's top-k (``TakeOrderedAndProject``); above it
    a single task would merge every partition's top-n, so the n-th key is found by
    histograms of the keys and every row is compared with it; no row is shuffled.
    """
    if n <= 0:
        return df.limit(0)
    if n <= TOPK_LIMIT:
        return df.orderBy(*order_by).limit(n)
    return df.where(before(df, order_by, cut_key(df, order_by, n - 1), or_at=True))


def pair_cap(df: DataFrame, max_pairs: int, order_col: str = "pos") -> DataFrame:
    """Keep the first ``max_pairs`` surviving pairs in source order."""
    return first_n(df, max_pairs, [order_col])

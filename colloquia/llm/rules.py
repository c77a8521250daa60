"""Line-first quality rules, in DataFrame functions only.

Every line is judged by punctuation, navigation, boilerplate, symbol and repetition
rules; failing lines are removed, then a document is rejected if it fails a base
rule or loses more than half of its word characters.

Words are runs outside ASCII white space.  A null or empty text has no words, so it
fails the base rule of fewer than 50 words.  Repeated rows each get a row; extra
columns are ignored (``clean`` carries them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquia.functions.text import compute_once

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r"

#: A line of this many words needs a punctuation mark somewhere.
UNPUNCTUATED_WORDS = 20
SHOUTS = 3
NAVIGATION_MARKS = 3
LINE_SYMBOL_PERCENT = 10
REPEAT_LINE_WORDS = 10
REPEAT_LINE_PERCENT = 30
# Marks that end or part sentences, by script: Latin, Greek and Cyrillic;
# Arabic; Devanagari; Chinese and Japanese; full-width; Armenian; Ethiopic; Khmer; Burmese;
# Tibetan.
PUNCTUATION = ".,;:!?…" "،؛؟۔" "।॥" "。、" "！，．：；？" "։՞՜" "።፣፤፥፧" "។៕" "၊။" "།༎"
# Phrases of English, German, French and Spanish pages.
BOILERPLATE = ("cookie policy", "accept cookies", "enable javascript", "privacy policy", "terms of use",
               "terms of service", "sign up for our newsletter", "subscribe to our newsletter", "click here to",
               "all rights reserved", "lorem ipsum", "page not found",
               "alle rechte vorbehalten", "nutzungsbedingungen", "seite nicht gefunden",
               "tous droits réservés", "politique de confidentialité", "page introuvable",
               "todos los derechos reservados", "política de privacidad", "página no encontrada")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _without(c: Column, marks: str) -> Column:
    for m in marks:
        c = F.replace(c, F.lit(m), F.lit(""))
    return c


def _count(c: Column, marks: str) -> Column:
    """How many of the (ASCII) marks the string has."""
    return F.octet_length(c) - F.octet_length(_without(c, marks))


def flat(c: Column) -> Column:
    """ASCII white space as blanks."""
    for m in SPACES:
        c = F.replace(c, F.lit(m), F.lit(" "))
    return c


def split_words(blanked: Column) -> Column:
    return F.array_remove(F.split(blanked, " ", -1), "")


def line_fails(line: Column, words: Column, n_symbols: Column, n_shouts: Column, phrased: Column) -> Column:
    """Whether a line is removed.

    ``n_symbols``, ``n_shouts`` and ``phrased`` are the whole document's: what the
    document does not have, no line of it needs to be searched for."""
    n = F.size(words)
    unpunctuated = (n >= UNPUNCTUATED_WORDS) & ~line.rlike(f"[{PUNCTUATION}]")
    shouted = (n_shouts >= SHOUTS) & (_count(line, "!?") >= SHOUTS)
    navigation = (n_symbols >= NAVIGATION_MARKS) & (_count(line, "|") >= NAVIGATION_MARKS)
    symbols = (n_symbols > 0) & (_count(line, SYMBOLS) * 100 > F.length(line) * LINE_SYMBOL_PERCENT)
    repeated = (n >= REPEAT_LINE_WORDS) & (
        F.size(F.array_distinct(words)) * 100 < n * REPEAT_LINE_PERCENT)
    return unpunctuated | shouted | navigation | symbols | repeated | (phrased & has_phrase(line))


def has_phrase(text: Column) -> Column:
    def search(low: Column) -> Column:
        found = F.lit(False)
        for p in BOILERPLATE:
            found = found | F.contains(low, F.lit(p))
        return found
    return let(F.lower(text), search)


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    A document whose window hashes are all distinct has none; only the others sort
    their windows (by the words themselves, so the count is exact)."""
    n = F.size(words)

    def windows(w: Column) -> Column:
        return F.arrays_zip(F.slice(w, 1, F.size(w) - 2).alias("a"), F.slice(w, 2, F.size(w) - 2).alias("b"),
                            F.slice(w, 3, F.size(w) - 2).alias("c"), F.sequence(F.lit(0), F.size(w) - 3).alias("i"))

    def same(x: Column, y: Column) -> Column:
        # y is null behind the last window
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    def covered(rows: Column) -> Column:
        twins = F.filter(F.zip_with(rows, F.slice(rows, 2, F.size(rows)),
                                    lambda x, y: F.when(same(x, y), F.array(x["i"], y["i"]))),
                         lambda t: t.isNotNull())
        at = F.array_distinct(F.flatten(twins))
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    def counted(zipped: Column) -> Column:
        hashes = F.transform(zipped, lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(zipped), F.lit(0)).otherwise(
            let(F.sort_array(zipped), covered))

    return F.when(n < 4, F.lit(0)).otherwise(let(windows(words), counted))


def evaluate(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Base counts, base verdict, line verdicts and the final verdict per row.

    ``clean_text`` holds the lines that passed, joined by newlines."""
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    text = F.col("__text")
    rows = compute_once(rows, [*keep, "__text"], __lines=F.split(text, "\n", -1), __symbols=_count(text, SYMBOLS),
                        __shouts=_count(text, "!?"), __phrased=has_phrase(text))
    rows = compute_once(rows, [*keep, "__text", "__lines", "__symbols", "__shouts", "__phrased"],
                        __of_line=F.transform("__lines", lambda x: split_words(flat(x))))
    good = F.filter("__lines", lambda x, i: ~line_fails(
        x, F.get("__of_line", i), F.col("__symbols"), F.col("__shouts"), F.col("__phrased")))
    rows = compute_once(rows, [*keep, "__text", "__lines", "__symbols", "__of_line"],
                        __words=F.flatten("__of_line"), __good=good)
    worded = F.filter("__lines", lambda x, i: F.size(F.get("__of_line", i)) > 0)
    rows = compute_once(
        rows, [*keep, "__lines", "__good"],
        n_words=F.size("__words").cast("long"),
        word_chars=(F.length(text) - _count(text, " " + SPACES)).cast("long"),
        n_symbols=F.col("__symbols").cast("long"),
        n_dup_lines=let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        n_repeat_words=repeat_words(F.col("__words")).cast("long"),
        clean_text=F.array_join("__good", "\n"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    left = F.length("clean_text") - _count(F.col("clean_text"), " " + SPACES)
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (left * 100 >= F.col("word_chars") * MIN_KEPT_PERCENT)).alias("kept"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__good")).cast("long").alias("n_bad_lines"), "clean_text")


def clean(docs: DataFrame) -> DataFrame:
    """The accepted documents with their failing lines removed; all columns stay."""
    others = [c for c in docs.columns if c != "text"]
    own = docs.select(F.struct(*others).alias("__row"), "text") if others else docs.select(
        F.lit(1).alias("__row"), "text")
    out = evaluate(own, ["__row"]).where("kept")
    return out.select(*[F.col("clean_text").alias("text") if c == "text" else F.col("__row")[c].alias(c)
                        for c in docs.columns])


# --- DuckDB ---------------------------------------------------------------------------------


def oracle() -> str:
    ws = "[\\x20\\x09-\\x0D]"
    phrases = " OR ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)
    return rf"""
WITH d AS (SELECT doc_id, coalesce("text", '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{ws}+'), lambda x: x <> '') AS words,
             string_split(t, chr(10)) AS lines FROM d),
g AS (SELECT doc_id, i, words[i] AS a, words[i+1] AS b, words[i+2] AS c
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
p AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS k FROM p) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(lines) AS l FROM w),
x AS (SELECT doc_id, l, len(list_filter(regexp_split_to_array(l, '{ws}+'), lambda x: x <> '')) AS n,
             len(list_distinct(list_filter(regexp_split_to_array(l, '{ws}+'), lambda x: x <> ''))) AS u,
             len(regexp_replace(l, '{ws}', '', 'g')) AS chars FROM l),
y AS (SELECT *, (n >= {UNPUNCTUATED_WORDS} AND NOT regexp_matches(l, '[{PUNCTUATION}]'))
             OR len(l) - len(regexp_replace(l, '[!?]', '', 'g')) >= {SHOUTS}
             OR len(l) - len(replace(l, '|', '')) >= {NAVIGATION_MARKS}
             OR (len(l) - len(regexp_replace(l, '[#*$%&|<>]', '', 'g'))) * 100 > len(l) * {LINE_SYMBOL_PERCENT}
             OR (n >= {REPEAT_LINE_WORDS} AND u * 100 < n * {REPEAT_LINE_PERCENT})
             OR {phrases} AS bad FROM x),
z AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_bad_lines,
             coalesce(sum(chars) FILTER (NOT bad), 0) AS chars_left,
             count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines FROM y GROUP BY doc_id),
o AS (SELECT w.doc_id, len(words) AS n_words, len(regexp_replace(t, '{ws}', '', 'g')) AS word_chars,
             len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words, n_lines, n_bad_lines, chars_left
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN z USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         AND chars_left * 100 >= word_chars * {MIN_KEPT_PERCENT} AS kept, n_lines, n_bad_lines
FROM o"""

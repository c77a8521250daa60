"""Unicode-exact text expressions shared by every module.

Spark's ``trim`` strips only U+0020 and Java's ``\\s`` is ASCII-only, so the
classes below spell out the whitespace and line-break sets that Python's
``str.strip``/``str.split``/``str.splitlines`` use.  The same literals are
valid in Java regex (Spark) and RE2 (DuckDB oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace set (str.isspace) as one regex class.
WS = ("[\\t-\\r\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
      "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
# Line boundaries of Python's str.splitlines.
LB = "\\r\\n|[\\n\\x{0b}\\x{0c}\\r\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]"
# The characters of ``WS``, for functions that take a set of characters.
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + \
    "\u2028\u2029\u202f\u205f\u3000"
WS_NO_SPACE = WS.replace("\\x{20}", "\\x{1f}")
WS_RUN = f"{WS_NO_SPACE}{WS}*|\\x{{20}}{WS}+"   # a run of white space that is not one space
# Word characters of Python's ``\w`` on str patterns (letters, numbers, _).
WORD = "[\\p{L}\\p{N}_]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: a trim looks at the ends, a regex at every place of a text."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """``re.sub(r"\\s+", " ", s)``; single spaces are left where they are."""
    return F.regexp_replace(_c(c), WS_RUN, " ")


def ws_split(c: Column | str) -> Column:
    """Python ``str.split()`` (no argument): whitespace runs, no empty pieces."""
    return F.filter(F.split(_c(c), f"{WS}+", -1), lambda t: F.length(t) > 0)


def split_lines(c: Column | str) -> Column:
    """Python ``str.splitlines()``: split on line boundaries, no trailing piece.

    ``split`` leaves one trailing empty piece after a final line break (and
    returns ``['']`` for an empty string); Python does not, so it is cut off.
    """
    return bound(F.split(_c(c), LB, -1), lambda ls: F.when(
        F.element_at(ls, -1) == "", F.slice(ls, 1, F.size(ls) - 1)).otherwise(ls))


def bound(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` names it."""
    return F.transform(F.array(c), use)[0]


def word_tokens(c: Column | str) -> Column:
    """Lower-cased maximal ``\\w`` runs: the units ``\\bword\\b`` can match."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(WORD), 0)


def compute_once(df, keep, **exprs):
    """Select ``keep`` plus ``exprs`` evaluated exactly once per row.

    A later filter on a projected expression is pushed below the projection
    with the expression substituted, so an expensive regex chain would run in
    the filter and again in the projection.  Generated columns are a barrier
    to that push-down: the expressions go through ``inline`` of a one-element
    array.
    """
    packed = F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))
    return df.select(*keep, F.inline(packed))


def json_string(c: Column | str) -> Column:
    """A JSON string literal of ``c`` (quotes and escapes), UTF-8 unescaped."""
    arr = F.to_json(F.array(_c(c)))
    return arr.substr(F.lit(2), F.length(arr) - F.lit(2))

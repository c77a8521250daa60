"""DuckDB SQL that recomputes every registered query from the raw tables.

The same regex literals as the Spark side (``WS``, ``LB``, ``WORD``) are valid
RE2, so both engines split, strip and tokenise identically.  CTEs are named
and pulled in with their dependencies by ``sql()``.
"""

from __future__ import annotations

from colloquia.functions.register import DEFAULT_LEXICON, STANDIN_LEXICON, Lexicon
from colloquia.functions.text import LB, WORD, WS

CRUFT_RE2 = "\\p{Nd}*Embed$|You might also like|Lyrics$"
BRACKET_RE2 = "(?s)^[\\[(].*[\\])]$"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def ws_split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda t: length(t) > 0)"


def split_lines(x: str) -> str:
    parts = f"regexp_split_to_array({x}, '{LB}')"
    return (f"(CASE WHEN {parts}[len({parts})] = '' "
            f"THEN {parts}[1:len({parts}) - 1] ELSE {parts} END)")


def clean_line(x: str) -> str:
    s = strip(f"regexp_replace({x}, '{CRUFT_RE2}', '', 'gi')")
    return (f"(CASE WHEN length({s}) > 0 AND NOT regexp_matches({s}, '{BRACKET_RE2}') "
            f"THEN {collapse(s)} END)")


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}')"


def _weight(t: str, weights) -> str:
    by_w: dict[int, list[str]] = {}
    for w, n in weights.items():
        by_w.setdefault(n, []).append(w)
    parts = []
    for n in sorted(by_w, reverse=True):
        words = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(by_w[n]))
        parts.append(f"WHEN {t} IN ({words}) THEN {n}")
    return f"(CASE {' '.join(parts)} ELSE 0 END)"


def hits(x: str, weights) -> str:
    return (f"CAST(coalesce(list_sum(list_transform({tokens(x)}, "
            f"lambda t: {_weight('t', weights)})), 0) AS INTEGER)")


def score(p: str, k: str) -> str:
    return (f"(CASE WHEN {p} + {k} = 0 THEN 0.0 "
            f"ELSE round_even(CAST({p} - {k} AS DOUBLE) / ({p} + {k}), 3) END)")


def scored_cols(x: str, lex: Lexicon = DEFAULT_LEXICON) -> str:
    return f"{hits(x, lex.spoken)} AS puhe, {hits(x, lex.formal)} AS kirja"


# --- named CTEs ----------------------------------------------------------------
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (deps, body)


cte("dl", f"""
SELECT doc_id, source, lang,
       CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS line_no,
       unnest(parts) AS line
FROM (SELECT doc_id, source, lang, {split_lines('text')} AS parts FROM documents)
""")

cte("lp_raw", """
SELECT doc_id, line_no, line AS english,
       lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS non_english
FROM dl
""", ("dl",))

cte("lp", """
SELECT CAST(row_number() OVER (ORDER BY doc_id, line_no) - 1 AS BIGINT) AS pos,
       english, non_english
FROM lp_raw WHERE non_english IS NOT NULL
""", ("lp_raw",))

# seed view: title line, bracket tag, document lines (first with an Embed suffix)
cte("seed", f"""
SELECT 'artist_' || source || '.txt' AS file, 'artist ' || source AS artist,
       doc_id AS chunk, CAST(line_no AS BIGINT) AS pos,
       CASE WHEN line_no = 0 THEN line || CAST(doc_id AS VARCHAR) || 'Embed' ELSE line END AS line
FROM dl
UNION ALL
SELECT 'artist_' || source || '.txt', 'artist ' || source, doc_id, -2,
       CASE WHEN lang = 'de' THEN '#' ELSE '# ' || source || ' ' || CAST(doc_id AS VARCHAR) END
FROM documents
UNION ALL
SELECT 'artist_' || source || '.txt', 'artist ' || source, doc_id, -1, '[' || lang || ']'
FROM documents
""", ("dl",))

cte("seed_titled", f"""
SELECT file, artist, chunk, pos, s, is_title,
       coalesce(last_value(title_set IGNORE NULLS) OVER (
           PARTITION BY file ORDER BY chunk, pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS title
FROM (SELECT *, starts_with(s, '#') AS is_title,
             CASE WHEN starts_with(s, '#') THEN {strip("regexp_replace(s, '^#+', '')")} END
                 AS title_set
      FROM (SELECT *, {strip('line')} AS s FROM seed)
      WHERE length(s) > 0)
""", ("seed",))

cte("flavor", f"""
SELECT 'genius_rap' AS source, 'genius_rap-' || CAST(idx AS VARCHAR) AS id, fi,
       'puhekieli' AS register, artist, title, idx
FROM (SELECT *, CAST(row_number() OVER (ORDER BY file, chunk, pos) - 1 AS BIGINT) AS idx
      FROM (SELECT *, row_number() OVER (PARTITION BY lower(fi) ORDER BY file, chunk, pos) AS rn
            FROM (SELECT file, chunk, pos, artist, title, {clean_line('s')} AS fi
                  FROM seed_titled WHERE NOT is_title)
            WHERE fi IS NOT NULL AND length(fi) >= 8)
      WHERE rn = 1)
""", ("seed_titled",))


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    withs = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH {withs}\n{body.strip()}"


LEX = DEFAULT_LEXICON
STANDIN = STANDIN_LEXICON


def tidy(x: str) -> str:
    t = strip(f"regexp_replace({strip(x)}, '(?s)<think>.*?</think>', '', 'g')")
    inner = strip(f"substr({t}, 2, length({t}) - 2)")
    return (f"(CASE WHEN length({t}) >= 2 AND substr({t}, 1, 1) IN ('\"', '''', '“', '‘') "
            f"AND right({t}, 1) IN ('\"', '''', '”', '’') THEN {inner} ELSE {t} END)")


def hash_key(x: str) -> str:
    return f"md5(CAST({x} AS VARCHAR) || ':42')"


def below_share(x: str, share: float = 0.9) -> str:
    return f"(CAST(('0x' || substr({hash_key(x)}, 1, 8)) AS BIGINT) < {int(share * 2 ** 32)})"


def exact_split(id_col: str, table_name: str) -> str:
    return (f"(CASE WHEN row_number() OVER (ORDER BY {hash_key(id_col)}, {id_col}) - 1 < "
            f"floor(CAST(0.9 AS DOUBLE) * (SELECT count(*) FROM {table_name})) "
            f"THEN 'train' ELSE 'valid' END)")


cte("stub", """
SELECT id, idx, fi,
       CASE WHEN regexp_matches(fi, '[0-9]') THEN NULL
            WHEN contains(fi, '?') THEN '""'
            ELSE '<think>fi-en</think>' || chr(10) || '"'
                 || array_to_string(list_reverse(string_split(fi, ' ')), ' ') || '"' END AS en_raw,
       CASE WHEN regexp_matches(fi, '[0-9]') THEN 'ValueError: digits in input' END AS error
FROM flavor""", ("flavor",))


def _synth_rows(src: str) -> str:
    return (f"SELECT 'rap_synthetic' AS source, 'synth-' || id AS id, {tidy('en_raw')} AS en, fi, "
            f"'puhekieli' AS register FROM {src} WHERE error IS NULL AND en_raw IS NOT NULL "
            f"AND length({tidy('en_raw')}) >= 2")


cte("run1", _synth_rows("(SELECT * FROM stub WHERE idx < 500)"), ("stub",))
cte("run2_todo", """
SELECT * FROM stub WHERE 'synth-' || id NOT IN (SELECT id FROM run1)""",
    ("stub", "run1"))
cte("synth", f"SELECT * FROM run1 UNION ALL {_synth_rows('run2_todo')}", ("run1", "run2_todo"))
cte("synth_split", f"SELECT id, fi, {exact_split('id', 'synth')} AS split FROM synth", ("synth",))
cte("composed", """
SELECT id, fi, 'flavor' AS role, 'train' AS split FROM flavor
UNION ALL SELECT id, fi, 'synth' AS role, split FROM synth_split""", ("flavor", "synth_split"))
cte("conv_raw", """
SELECT conv_id, turn, role, text,
       CASE WHEN role = 'assistant' THEN '<think>' || role || chr(10) || CAST(turn AS VARCHAR)
                 || '</think>' || chr(10) || '"' || text || '" '
            WHEN role = 'user' THEN '  ‘' || text || '’'
            ELSE text END AS raw
FROM conversations""")

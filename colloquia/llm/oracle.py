"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

from colloquia.llm import decontaminate, licenses, phrases, pii, secrets

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


def decontamination() -> str:
    n, share = decontaminate.WINDOW, decontaminate.SHARE
    return f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, len(x) AS size, array_to_string(x, ' ') AS win FROM (
         SELECT item, w[s:s + {n} - 1] AS x
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {n} + 1, 1) + 1)) AS s FROM i WHERE len(w) > 0))),
d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
dw AS (SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win FROM (
         SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
         FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
h AS (SELECT doc_id, s, dw.size AS size, item FROM dw JOIN iw USING (win)),
p AS (SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT DISTINCT doc_id, unnest(range(s, s + size)) AS k FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)"""


def licence_scan() -> str:
    """Places of all key phrases, then templates whose phrases stand near their relative places."""
    ts = [*((label, text, (text,), True) for text, label in licenses.BASE),
          *((label, text, keys, False) for label, text, keys in licenses.TEMPLATES)]
    texts, phrases = [], []
    for k, (label, text, own, base) in enumerate(ts):
        words, keys = licenses.key_phrases(text, own)
        texts.append(f"({k}, '{label}', {str(base).lower()}, {len(keys)}, '{b' '.join(words).decode()}')")
        phrases += [f"({k}, {j}, {at}, '{b' '.join(p).decode()}')" for j, (at, p) in enumerate(keys)]
    return f"""
WITH names(k, label, base, n_phrases, text) AS (VALUES {', '.join(texts)}),
t AS (SELECT k, unnest(string_split(text, ' ')) AS word, unnest(range(0, len(string_split(text, ' ')))) AS i FROM names),
phrases(k, j, place, phrase) AS (VALUES {', '.join(phrases)}),
m AS (SELECT k, j, len(string_split(phrase, ' ')) AS size, unnest(string_split(phrase, ' ')) AS word,
             place + unnest(range(0, len(string_split(phrase, ' ')))) AS i FROM phrases),
d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
w AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d),
o AS (SELECT doc_id, k, j, p - i AS start FROM w JOIN m USING (word)
      GROUP BY doc_id, k, j, size, p - i HAVING count(*) = size),
f AS (SELECT a.doc_id, a.k, a.start FROM o a JOIN o b ON a.doc_id = b.doc_id AND a.k = b.k JOIN names ON names.k = a.k
      WHERE a.j = 0 AND abs(a.start - b.start) <= {licenses.SLACK}
      GROUP BY a.doc_id, a.k, a.start, n_phrases HAVING count(DISTINCT b.j) = n_phrases),
h AS (SELECT f.doc_id, f.k, f.start, count(DISTINCT t.i) AS same
      FROM f JOIN t ON t.k = f.k JOIN w ON w.doc_id = f.doc_id AND w.word = t.word
      WHERE abs(w.p - t.i - f.start) <= {licenses.SLACK} GROUP BY f.doc_id, f.k, f.start),
g AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
             max(start) FILTER (base) AS last_word,
             array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
             array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
             max(CASE WHEN base THEN 0.5 ELSE same / CAST(len(string_split(text, ' ')) AS DOUBLE) END) AS score
      FROM h JOIN names USING (k) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (doc_id)"""


def secret_scan(repo: str, owner: str) -> str:
    """Spans from the lengths of matches and of the pieces between them."""
    found = []
    for k, (name, pattern, group, least) in enumerate(secrets.KINDS):
        p = pattern.replace("(?<![0-9a-f])", "").replace("'", "''")
        found.append(f"""
SELECT doc_id, repo, owner, {k} AS kind, '{name}' AS name, unnest(v) AS value, unnest(list_transform(range(1, len(m) + 1),
         lambda i: list_sum(list_transform(g[1:i], lambda x: len(x)))
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0))) AS start,
       unnest(list_transform(m, lambda x: len(x))) AS size, {least} AS least
FROM (SELECT doc_id, repo, owner, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {group}) AS v,
             string_split_regex(t, '{p}') AS g FROM d WHERE regexp_matches(t, '{p}'))""")
    random = ("regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND NOT regexp_matches(value, "
              "'(?i)example|changeme|placeholder|your[_-]|xxxx|test|dummy|sample') "
              "AND len(replace(lower(value), lower(value[1]), '')) > 0")
    listed = "string_agg(name || ':' || start || ':' || (start + size), ',' ORDER BY start, kind)"
    counts = ", ".join(f"CAST(coalesce(n_{n}, 0) AS BIGINT) AS n_{n}"
                       for n in (*(k[0] for k in secrets.KINDS[:secrets.BASE]), "live", "example", "weak"))
    per_kind = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k[0]}" for i, k in enumerate(secrets.KINDS[:secrets.BASE]))
    per_verdict = ", ".join(f"count(*) FILTER (verdict = '{v}') AS n_{v}" for v in ("live", "example", "weak"))
    return f"""
WITH d AS (SELECT doc_id, coalesce("text", '') AS t, {repo} AS repo, {owner} AS owner FROM documents),
s AS (SELECT * FROM ({' UNION ALL '.join(found)}) WHERE len(value) >= least),
v AS (SELECT value, CASE WHEN count(DISTINCT owner) > {secrets.MAX_OWNERS} THEN 'example'
                         WHEN {random} THEN 'live' ELSE 'weak' END AS verdict FROM s GROUP BY value),
r AS (SELECT doc_id, {per_kind}, {per_verdict}, {listed} FILTER (kind < {secrets.BASE}) AS base, {listed} AS spans
      FROM s JOIN v USING (value) GROUP BY doc_id)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (doc_id)"""


def personal_data() -> str:
    """Spans from the lengths of matches and of the pieces between them, checked in SQL."""
    digits = "regexp_extract_all(value, '[0-9]')"
    luhn = (f"list_sum(list_transform(list_reverse({digits}), lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INTEGER) "
            "WHEN CAST(x AS INTEGER) > 4 THEN 2 * CAST(x AS INTEGER) - 9 ELSE 2 * CAST(x AS INTEGER) END)) % 10 = 0")
    bare = "replace(value, ' ', '')"
    turned = (f"list_transform(string_split({bare}[5:] || {bare}[1:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' "
              "THEN CAST(c AS BIGINT) ELSE CAST(ascii(c) - 55 AS BIGINT) END)")
    mod97 = (f"len({bare}) BETWEEN 15 AND 34 AND list_reduce({turned}, "
             "lambda a, x: (CASE WHEN x > 9 THEN a * 100 + x ELSE a * 10 + x END) % 97) % 97 = 1")
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_bool_and(list_transform(string_split(value, '.'), lambda p: "
               "len(ltrim(p, '0')) <= 3 AND CAST('0' || ltrim(p, '0')[1:3] AS INTEGER) <= 255))"),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", f"len({digits}) BETWEEN 14 AND 19 AND {luhn}"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"len({digits}) BETWEEN 10 AND 15"),
        "iban": (pii.IBAN, mod97),
        "ssn": (pii.SSN, "value[1:3] NOT IN ('000', '666') AND value[1] <> '9' AND value[5:6] <> '00' AND value[8:] <> '0000'"),
    }
    found = [f"""
SELECT doc_id, t, {k} AS kind, '{name}' AS name, unnest(m) AS value, unnest(list_transform(range(1, len(m) + 1),
         lambda i: list_sum(list_transform(g[1:i], lambda x: len(x)))
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0))) AS start
FROM (SELECT doc_id, t, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g
      FROM d WHERE regexp_matches(t, '{p}'))""" for k, (name, (p, _)) in enumerate(kinds.items())]
    passes = " ".join(f"WHEN '{n}' THEN {check}" for n, (_, check) in kinds.items())
    prior = " ".join(f"WHEN '{n}' THEN {v}" for n, v in pii.PRIOR.items())
    near = (f"translate(t[greatest(start - {pii.CONTEXT_CHARS} + 1, 1):start] || ' ' || "
            f"t[start + len(value) + 1:start + len(value) + {pii.CONTEXT_CHARS}], '{_UPPER}', '{_LOWER}')")
    context = " ".join(f"WHEN '{n}' THEN regexp_matches({near}, '{p}')" for n, p in pii.NEAR.items())
    base = len(pii.BASE_KINDS)
    one = "name || ':' || start || ':' || (start + len(value))"
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(pii.BASE_KINDS))
    shown = ", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in pii.BASE_KINDS)
    return f"""
WITH d AS (SELECT doc_id, coalesce("text", '') AS t FROM documents),
s AS (SELECT *, least(1.0, CASE name {prior} END + CASE WHEN CASE name {context} END
                THEN {pii.CONTEXT_BONUS} ELSE 0 END) AS score
      FROM ({' UNION ALL '.join(found)}) WHERE CASE name {passes} END),
r AS (SELECT doc_id, {counts}, string_agg({one}, ',' ORDER BY start, kind) FILTER (kind < {base}) AS base,
             string_agg({one}, ',' ORDER BY start, kind) AS spans,
             string_agg(printf('%.2f', CAST(score AS DOUBLE)), ',' ORDER BY start, kind) AS scores
      FROM s WHERE kind < {base} OR score >= {pii.THRESHOLD} GROUP BY doc_id)
SELECT doc_id, {shown}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(scores, '') AS scores
FROM d LEFT JOIN r USING (doc_id)"""


def collocations() -> str:
    """Every phrase as a list of words; a candidate is compared with all longer ones."""
    least, most = phrases.MIN_COUNT, phrases.MAX_WORDS
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
tok AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, x, CAST(count(*) AS BIGINT) AS f FROM (
        SELECT lang, w[s:s + k - 1] AS x FROM (
          SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s
          FROM w, (SELECT unnest(range(1, {most} + 1)) AS k) WHERE len(w) >= k))
      GROUP BY lang, x HAVING count(*) >= {least}),
cut AS (SELECT lang, x, f AS a, unnest(range(1, len(x))) AS k FROM g WHERE len(x) > 1),
s AS (SELECT cut.lang, cut.x, a, k, gl.f AS l, gr.f AS r, n,
             CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(gl.f AS HUGEINT) * gr.f) AS BIGINT) AS score
      FROM cut JOIN g gl ON gl.lang = cut.lang AND gl.x = cut.x[1:k]
               JOIN g gr ON gr.lang = cut.lang AND gr.x = cut.x[k + 1:] JOIN tok ON tok.lang = cut.lang),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, x ORDER BY score, k) AS c FROM s) WHERE c = 1),
inner_of AS (SELECT DISTINCT lang, x[i:i + k - 1] AS x, f FROM (
               SELECT lang, x, f, k, unnest(range(1, len(x) - k + 2)) AS i
               FROM g, (SELECT unnest(range(2, {most})) AS k) WHERE len(x) > k)),
gone AS (SELECT DISTINCT b.lang, b.x FROM b JOIN inner_of o ON o.lang = b.lang AND o.x = b.x
         WHERE 100 * o.f >= {phrases.COVERED_PERCENT} * b.a),
left_over AS (SELECT b.*, array_to_string(b.x, ' ') AS phrase FROM b LEFT JOIN gone ON gone.lang = b.lang AND gone.x = b.x
              WHERE gone.lang IS NULL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank FROM left_over)
WHERE rank <= {phrases.TOP}"""
